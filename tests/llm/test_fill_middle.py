"""Units, cuts and forms against a plain version on strings, and the exact round trip."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from helpers import SF_SMALL, awkward, clashing, documents, empty, read, rows
from hypothesis import given
from hypothesis import strategies as st

from spendlake.llm.fill_middle import BLOCK, ExceptionIndex, Units, digest, fill_in_middle, restored


def plain(doc_id, text: str | None) -> dict:
    """As the contract has it, on strings."""
    text = text or ""
    name = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(name[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, len(units))))
    row = {"doc_id": doc_id, "n": len(units), "prefix_chars": len(prefix), "middle_chars": len(middle)}
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return row | {"form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    if h4 % 100 < 20:
        return row | {"form": "spm", "output": f"<S>{suffix}<P>{prefix}<M>{middle}"}
    return row | {"form": "psm", "output": f"<P>{prefix}<S>{suffix}<M>{middle}"}


def key(row: dict) -> str:
    return repr(sorted(row.items()))


@given(st.text(), st.integers(0, 50))
def test_index_converts_both_ways(text, char):
    data = np.frombuffer(text.encode(), np.uint8)
    index = ExceptionIndex(data)
    assert len(index.bytes) == sum(ord(c) > 127 for c in text)
    cuts = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in cuts])
    assert (index.byte_of(cuts) == at).all()
    assert (index.char_of(at) == cuts).all()


def test_units_across_blocks_and_rows():
    rng = random.Random(3)
    texts = ["", "a" * (2 * BLOCK), "", "".join(rng.choice("aZ é漢\n@[`{\U0001f600") for _ in range(3 * BLOCK)), "ab", "cd", ""]
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, raw)])
    units = Units(np.frombuffer(b"".join(raw), np.uint8), starts)
    count = 0
    for text, begin in zip(texts, starts.tolist()):
        assert units.rank(begin) == count
        for unit in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text):
            assert units.byte_of(count) == begin + len(text[: unit.start()].encode())
            count += 1
    assert units.byte_of(count) == starts[-1]


def test_marks_that_parts_seem_to_begin():
    for prefix, middle, suffix in [("<", "<", "<"), ("<P", "P>", "S>"), ("<S", ">", "M>"), ("", "", ""), ("<M", "", "<")]:
        text = prefix + middle + suffix
        for form, output in (("psm", f"<P>{prefix}<S>{suffix}<M>{middle}"), ("spm", f"<S>{suffix}<P>{prefix}<M>{middle}")):
            assert restored(output.encode(), form).decode() == text
    assert restored(b"<P>x<S>", "plain") == b"<P>x<S>"


def test_given_documents(spark):
    docs = rows(read(spark, "documents", SF_SMALL))
    want = [plain(d["doc_id"], d["text"]) for d in docs]
    assert sorted(map(key, rows(fill_in_middle(read(spark, "documents", SF_SMALL))))) == sorted(map(key, want))
    assert {r["form"] for r in want} == {"plain", "psm", "spm"}
    hashes = {r["doc_id"]: r for r in rows(digest(read(spark, "documents", SF_SMALL)))}
    for d, r in zip(docs, want):
        got = hashes[d["doc_id"]]
        assert got["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert got["restored_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_awkward_rows(spark):
    marked = ["a <P> b", "<S>", "x<M>", "< P> <p> <<S", "<", "ÿ" * 10_000, "\x00\x01", "a" * 100_000]
    for docs in (awkward(spark), documents(spark, marked * 5), empty(spark)):
        want = sorted(key(plain(d["doc_id"], d["text"])) for d in rows(docs))
        assert sorted(map(key, rows(fill_in_middle(clashing(docs))))) == want
        for text, got in zip([d["text"] or "" for d in rows(docs)], rows(digest(docs))):
            assert got["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_shares_are_parameters(spark):
    docs = documents(spark, ["some text"] * 50)
    forms = lambda **p: {r["form"] for r in rows(fill_in_middle(docs, **p))}
    assert forms(fim_percent=0) == {"plain"}
    assert forms(fim_percent=100, spm_percent=100) == {"spm"}
    assert forms(fim_percent=100, spm_percent=0) == {"psm"}
    assert rows(fill_in_middle(docs, seed=2)) != rows(fill_in_middle(docs, seed=1))
