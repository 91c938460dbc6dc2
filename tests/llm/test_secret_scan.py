"""Spans against Python's own regular expressions; the trigram queries against what matches."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import SF, SF_SMALL, awkward, clashing, documents, empty, read, rows

from spendlake.llm.secret_scan import ALWAYS, BASE_RULES, MORE_RULES, candidates, digest, trigram_index, trigram_query

# The contract's expressions, with the check of the length apart.
PLAIN = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 0, 20),
    "hex": (r"[0-9a-f]+", 0, 0, 24),
}


def base_spans(text: str) -> list[tuple]:
    out = []
    for rank, (kind, (pattern, flags, group, least)) in enumerate(PLAIN.items()):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def secrets() -> list[str]:
    rng = random.Random(2)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made = [
        "secret: token: abcdefgh", "token=token=abcdef", "password='abc12' password=\"abc123\"", "API_KEY : a.b/c+d=e apikey=short Apikey:longer1",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 11, "AKIAAKIA" + "B" * 12 + "a", "akia" + "A" * 20, hexed(23), hexed(24),
        "g" + hexed(40) + "G" + hexed(24), "é\U0001f600 token=" + hexed(30) + " é " + hexed(24), "passwd:" + "AKIA" + "Z9" * 10, "secret\n=abcdefg",
        "password " * 50 + "password=abcdef", "ghp_" + "a1B2" * 9, "xoxb-123456789012", "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12,
        "ſecret=abcdefg", "toKen=abcdefg", "", "token=" + "x" * 100_000, ("token=abcdef " + hexed(24) + "\n") * 500,
    ]
    glue = ["password", "token", "=", ":", " ", "'", "AKIA", "a1", "ff00", "Z", "_", "api", "key", "é", "\n", "0123456789ab"]
    return made + ["".join(rng.choice(glue) for _ in range(rng.randint(1, 60))) for _ in range(400)]


def test_spans_equal_python(spark):
    texts = secrets() + [r["text"] for r in rows(read(spark, "documents"))]
    got = rows(digest(documents(spark, texts)))
    assert len(got) == len(texts)
    n_found = 0
    for r in got:
        want = base_spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[2] == k for s in want) for k in PLAIN]
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        assert ",".join(s for s in r["spans"].split(",") if s.split(":")[0] in PLAIN) == joined(want)
        more = [(m.start(), rank, rule.kind, m.end()) for rank, rule in enumerate(MORE_RULES, 3) for m in re.finditer(rule.pattern, texts[r["doc_id"]], re.A)]
        assert r["spans"] == joined(sorted(want + more))
        n_found += len(want) + len(more)
    assert n_found > 1000


@pytest.mark.parametrize("rule", BASE_RULES + MORE_RULES, ids=lambda r: r.kind)
def test_every_match_satisfies_the_query(rule):
    query = trigram_query(rule.pattern)
    assert (query == ALWAYS) == (rule.kind == "hex")
    for text in secrets():
        if re.search(rule.pattern, text, re.A):
            low = text.lower()
            assert any(all(t in low for t in clause) for clause in query)


def test_queries_of_other_expressions():
    assert trigram_query("abc|de") == ALWAYS
    assert trigram_query("(abcd|bcde)x") == {frozenset(["abc", "bcd", "cdx"]), frozenset(["bcd", "cde", "dex"])}
    assert trigram_query("abc.*def") == {frozenset(["abc", "def"])}
    assert trigram_query("(?:abcd)+e?") == {frozenset(["abc", "bcd"])}
    assert trigram_query("[^a]bcd$") == {frozenset(["bcd"])}
    assert trigram_query("(a|b.*)xyz") == {frozenset(["xyz"])}
    assert trigram_query("") == ALWAYS


def test_postings_are_intersected(spark):
    texts = spark.createDataFrame([(1, "x PASSWORD x"), (2, "pass word"), (3, "token"), (4, "to ken AKIA")], "key long, text string")
    queries = {r.kind: trigram_query(r.pattern) for r in BASE_RULES if r.kind != "hex"}
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    found = {r["key"]: r["kinds"] for r in rows(candidates(trigram_index(texts, trigrams), queries))}
    assert found == {1: ["assign"], 3: ["assign"], 4: ["access"]}


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    assert len(rows(digest(docs))) == docs.count()
    assert rows(digest(empty(spark))) == []
    assert SF and SF_SMALL
