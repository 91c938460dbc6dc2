"""Winnowing against a plain version, its guarantee, and the neighbours against a sorted list."""

from __future__ import annotations

import hashlib
import random
from functools import lru_cache

import pytest
from helpers import SF_SMALL, awkward, clashing, documents, empty, read, rows, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlake.llm import fingerprints as fp

MASK = (1 << 64) - 1
POWERS = [pow(fp.BASE, j, 1 << 64) for j in range(max(fp.K, 6))]


@lru_cache
def plain(text: str, k: int = fp.K, w: int = fp.W) -> list[tuple[int, int]]:
    """(position, hash) by the definition."""
    if not text:
        return []
    k = min(k, len(text))
    hashes = []
    for i in range(len(text) - k + 1):
        h = sum((ord(c) + 1) * power for c, power in zip(text[i : i + k], POWERS)) & MASK
        h = ((h ^ (h >> 32)) * fp.MIX) & MASK
        hashes.append(h ^ (h >> 32))
    w = min(w, len(hashes))
    order = [(h, -p) for p, h in enumerate(hashes)]
    kept = {-min(order[i : i + w])[1] for i in range(len(hashes) - w + 1)}
    return [(p, hashes[p]) for p in sorted(kept)]


def made(text: str, k: int = fp.K, w: int = fp.W) -> list[tuple[int, int]]:
    positions, hashes = fp.Winnower(k, w)(text)
    return list(zip(positions.tolist(), hashes.tolist()))


def like(a: list, b: list) -> float:
    one, other = {h for _, h in a}, {h for _, h in b}
    return len(one & other) / len(one | other) if one | other else 1.0


def text_of(entries: list[tuple[int, int]]) -> str:
    return " ".join(f"{p}:{h:016x}" for p, h in entries)


def beside(docs: list[tuple]) -> list[tuple]:
    """Of rows (doc_id, text) in order: what ``beside_edited`` returns."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        mine, new = plain(text), plain(changed)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text), sha, text_of(mine), text_of(new), like(mine, new), like(mine, plain(after))))
    return out


@given(st.text(alphabet="ab é\U0001f600", max_size=60), st.integers(1, 6), st.integers(1, 9))
def test_equals_the_definition(text, k, w):
    assert made(text, k, w) == plain(text, k, w)


def test_blocks_make_no_difference(monkeypatch):
    rng = random.Random(1)
    text = sentence(rng, 400) + "x" * 700 + sentence(rng, 200) + "ab" * 300
    monkeypatch.setattr(fp, "BLOCK", 64)
    assert made(text) == plain(text)


@settings(max_examples=50)
@given(st.text(max_size=40), st.text(max_size=40), st.text(min_size=12, max_size=12), st.text(max_size=40))
def test_every_long_shared_span_is_found(a, b, shared, c):
    one, other = (dict((h, p) for p, h in made(t, 5, 8)) for t in (a + shared + b, c + shared + a))
    assert one.keys() & other.keys()


def test_ties_go_right():
    assert [p for p, _ in made("aaaaaaaaaa", 2, 3)] == [2, 3, 4, 5, 6, 7, 8]


def test_given_documents(spark):
    docs = sorted((d["doc_id"], d["text"]) for d in rows(read(spark, "documents", SF_SMALL)))
    got = sorted(tuple(r) for r in fp.beside_edited(read(spark, "documents", SF_SMALL).repartition(7)).collect())
    assert got == beside(docs)
    long = [r for r in got if r[1] > 400]
    assert sum(r[5] > 0.4 for r in long) > 0.95 * len(long)


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_few_documents(spark, n):
    docs = [(7 * i - 20, sentence(random.Random(i), i)) for i in range(n)]
    got = sorted(tuple(r) for r in fp.beside_edited(documents(spark, [t for _, t in docs], [i for i, _ in docs])).collect())
    assert got == sorted(beside(docs))


def test_awkward_rows(spark):
    df = awkward(spark)
    keyed = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")).collect()
    ordered = sorted(keyed, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["key"]))
    want = beside([(r["doc_id"], r["text"]) for r in ordered])
    got = [tuple(r) for r in fp.beside_edited(clashing(df)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fp.beside_edited(empty(spark)).collect() == []


def test_one_row_repeated_is_split(spark):
    """Copies of one row are dealt over the blocks and each is followed by a copy, but for the last."""
    df = documents(spark, ["first", "second text", "third"], [1, 2, 3])
    many = df.union(spark.range(500).selectExpr("2L as doc_id", "'second text' as text", "'en'", "'s'", "1L")).repartition(8)
    got = fp.beside_edited(many).collect()
    assert len(got) == 503
    assert sum(r["near_next"] == 1.0 for r in got) == 500
    per_block = fp._dealt(many).where("not last").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_block) < 300


def test_fingerprints_and_spans(spark):
    rng = random.Random(9)
    passage = sentence(rng, 30)
    docs = documents(spark, [sentence(rng, 20) + " " + passage, passage + " " + sentence(rng, 20), sentence(rng, 40), None])
    prints = fp.fingerprints(clashing(docs))
    for r in rows(prints):
        text = rows(docs.where(F.col("doc_id") == r["doc_id"]))[0]["text"] or ""
        assert [(p, h & MASK) for p, h in zip(r["positions"], r["hashes"])] == plain(text)
    found = rows(fp.shared_spans(prints, prints).where("a_id < b_id"))
    assert {(r["a_id"], r["b_id"]) for r in found} == {(0, 1)}
    both = prints.alias("a").crossJoin(prints.alias("b")).where("a.doc_id = 0 and b.doc_id = 1")
    share = both.select(fp.common_share(F.col("a.hashes"), F.col("b.hashes"))).first()[0]
    assert 0 < share < 1
