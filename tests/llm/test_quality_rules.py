"""Counts against plain Python on strings, the order of the cascade, the labels."""

from __future__ import annotations

import re

from helpers import SF, SF_SMALL, awkward, clashing, documents, empty, read, rows

from spendlake.llm.quality_rules import RULES, Text, judge, keep_good, ordered, passes, profile


def counted(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0d]", line) and line in lines[:i])
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(hit),
        "base_failed": len(words) < 50 or 100 * len(hit) > 50 * len(words),
    }


def test_counts_equal_plain_python(spark):
    texts = [r["text"] for r in rows(read(spark, "documents", SF_SMALL)) if len(r["text"]) < 6000]
    texts += ["a a a a", "a b c a b c", "a b c d a b c", "x\n\nx\n \n \nx", "#|<> é\x1f\x85\xa0é", None, ""]
    for r in rows(judge(documents(spark, texts), fraction=0.5)):
        want = counted(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert not (r["base_failed"] and r["kept"])


def test_verdict_is_that_of_all_rules_in_any_order(spark):
    docs = read(spark, "documents")
    want = {r["doc_id"] for r in rows(docs) if passes(Text(r["text"].encode()), list(RULES.values()))}
    assert {r["doc_id"] for r in rows(keep_good(docs))} == want
    assert {r["doc_id"] for r in rows(judge(docs)) if r["kept"]} == want


def test_cheap_and_rejecting_rules_run_first():
    rules = {"a": None, "b": None, "c": None, "d": None}
    assert ordered(rules, {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (1.0, 0.0)}) == ["b", "a", "c", "d"]


def test_profile_measures_every_rule(spark):
    measured = profile(read(spark, "documents"), RULES, fraction=0.5)
    assert measured.keys() == RULES.keys()
    assert all(seconds > 0 and 0 <= rejected <= 1 for seconds, rejected in measured.values())


def test_labels_agree(spark):
    quality = {r["doc_id"]: r["quality"] for r in rows(read(spark, "labels"))}
    labelled = [(quality[r["doc_id"]], r) for r in rows(judge(read(spark, "documents"))) if r["doc_id"] in quality]
    assert all(not r["kept"] for q, r in labelled if q == 0)
    assert all(r["kept"] for q, r in labelled if q == 1 and not r["base_failed"])


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    assert len(rows(judge(docs))) == docs.count()
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], len(r["text"])) for r in rows(kept)) == sorted(
        (r["doc_id"], len(r["text"])) for r in rows(docs) if r["text"] and passes(Text(r["text"].encode()), list(RULES.values()))
    )
    assert rows(judge(empty(spark))) == rows(keep_good(empty(spark))) == []
    assert SF
