"""Verdicts against comparing every pair of lines."""

from __future__ import annotations

import random
import re

import pytest
from helpers import SF_SMALL, awkward, clashing, documents, empty, read, rows, sentence, word

from spendlake.llm.line_dedup import MIN_NEAR, cleaned, decide, within_one_edit


def near(a: list, b: list) -> bool:
    """At most one word replaced, inserted or deleted, by trying all ways."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(texts: list) -> dict:
    """(doc, line) to (kept, first equal line, earliest near line)."""
    lines = [
        ((d, n), tuple(re.findall(r"[^\x20\x09-\x0d]+", line)))
        for d, text in enumerate(texts) for n, line in enumerate((text or "").split("\n"))
    ]
    lines = [(at, w) for at, w in lines if w]
    first: dict[tuple, tuple] = {}
    for at, w in lines:
        first.setdefault(w, at)
    sized: dict[int, list] = {}
    for w, at in first.items():
        if len(w) >= MIN_NEAR:
            sized.setdefault(len(w), []).append((at, list(w)))
    earliest = {}
    for w, at in first.items():
        if len(w) >= MIN_NEAR:
            around = [x for n in (len(w) - 1, len(w), len(w) + 1) for x in sized.get(n, []) if x[0] < at]
            earliest[w] = min((x[0] for x in around if near(list(w), x[1])), default=None)
    return {at: (first[w] == at and earliest.get(w) is None, first[w], earliest.get(w)) for at, w in lines}


def compared(spark, texts: list) -> int:
    want = brute_force(texts)
    got = rows(decide(documents(spark, texts)))
    assert len(got) == len(want)
    for r in got:
        other = None if r["near_doc_id"] is None else (r["near_doc_id"], r["near_line_no"])
        assert (r["kept"], (r["first_doc_id"], r["first_line_no"]), other) == want[r["doc_id"], r["line_no"]]
    return sum(not kept for kept, *_ in want.values())


def test_edits_of_all_kinds_and_places(spark):
    rng = random.Random(4)
    texts = []
    for n in (4, 5, 6, 7, 9, 10, 11, 31, 32, 33, 63, 64, 65, 66, 97, 200):
        base = sentence(rng, n).split()
        lines = [base]
        for at in sorted({0, 1, n // 2 - 1, n // 2, 31 % n, 32 % n, n - 2, n - 1}):
            lines.append([*base[:at], "new" + word(rng), *base[at + 1 :]])
            lines.append(base[:at] + base[at + 1 :])
            lines.append([*base[:at], "added" + word(rng), *base[at:]])
            lines.append([*base[:at], "two" + word(rng), "more" + word(rng), *base[at:]])
        lines.append([*base[: n // 2], base[n // 2], base[n // 2], *base[n // 2 + 1 :]])
        rng.shuffle(lines)
        texts += ["\n".join(" ".join(x) for x in lines[i::3]) for i in range(3)]
    assert compared(spark, texts) > 100


def test_random_lines_of_few_words(spark):
    rng = random.Random(6)
    texts = ["\n".join(" ".join(rng.choice("ab") for _ in range(rng.randint(3, 13))) for _ in range(10)) for _ in range(12)]
    texts += ["  a\tb \n\n a b\x0b\na  b", "a b", None, "", "\n"]
    assert compared(spark, texts) > 10


def test_given_documents(spark):
    texts = [r["text"] for r in sorted(rows(read(spark, "documents", SF_SMALL)), key=lambda r: r["doc_id"])]
    assert compared(spark, texts) > 100


def test_short_lines_that_repeat(spark):
    """Notices stay once, whatever their length; lines of four words are not near each other."""
    notices = ["All rights reserved.", "Subscribe to our newsletter", "Read more", "Top"]
    texts = ["\n".join([*notices, f"number {i} of fifty"]) for i in range(50)]
    assert compared(spark, texts) == 49 * len(notices)
    assert compared(spark, ["one two three four five six", "one two 3 four five six", "one two three four"]) == 1


def test_one_template_on_many_lines(spark):
    """A group in which every pair is near stays a star."""
    base = sentence(random.Random(8), 20)
    texts = [f"user {i} {base}" for i in range(2000)]
    got = rows(decide(documents(spark, texts)))
    assert [(r["doc_id"], r["near_doc_id"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [(0, None)] + [(i, 0) for i in range(1, 2000)]


def test_within_one_edit(spark):
    rng = random.Random(9)
    pairs = [tuple([rng.choice("ab") for _ in range(rng.randint(0, 5))] for _ in range(2)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>").select("a", "b", within_one_edit("a", "b").alias("same"))
    assert all(r["same"] == near(r["a"], r["b"]) for r in rows(df))


def test_cleaned_text(spark):
    a, b = sentence(random.Random(1), 12), sentence(random.Random(2), 12)
    docs = documents(spark, [f"{a}\n\n{b}", f"x\n{a} \n\ny", f"{b}\n{a}", None, "", "\n\n", "lone", f"{a} more\nz"])
    got = {r["doc_id"]: r for r in rows(cleaned(clashing(docs)))}
    assert {i: r["text"] for i, r in got.items()} == {0: f"{a}\n\n{b}", 1: "x\n\ny", 3: None, 4: "", 5: "\n\n", 6: "lone", 7: "z"}
    assert got[1]["n_chars"] == 4
    assert cleaned(clashing(docs)).columns == clashing(docs).columns


@pytest.mark.parametrize("make", [decide, cleaned])
def test_awkward_rows(spark, make):
    docs = clashing(awkward(spark))
    assert len(rows(make(docs))) > 0
    assert rows(make(empty(spark))) == []


def test_repeated_rows_share_their_verdict(spark):
    text = sentence(random.Random(3), 15)
    got = rows(decide(documents(spark, [text, text, text], [1, 1, None])))
    assert sorted((r["doc_id"] or 9, r["kept"]) for r in got) == [(1, True), (1, True), (9, False)]
