"""Fingerprints bit by bit, links and components against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
import xxhash
from helpers import SF_SMALL, awkward, clashing, documents, empty, read, rows, sentence
from pyspark.sql import functions as F

from spendlake.llm import near_dup
from spendlake.llm.near_dup import BITS, components, fingerprint, keep_one, links, masks, simhash_groups


def plain_fingerprint(text: str | None, n: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grouped(points: list[int], radius: int) -> dict[int, int]:
    """Root (the least of its component) of each point, by all pairs."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(points), 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in points}


def clustered(seed: int, clusters: int, members: int) -> list[int]:
    """Points around centres, a few bits apart, so that chains and large buckets arise."""
    rng = random.Random(seed)
    out = set()
    for _ in range(clusters):
        p = rng.getrandbits(64)
        for _ in range(members):
            out.add(signed(p))
            q = p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            p = q if rng.random() < 0.5 else p ^ (1 << rng.randrange(3))
    return sorted(out)


def test_fingerprint_equals_plain():
    rng = random.Random(1)
    for text in [None, "", " \x0b", "A", "a b", "a b c", "A b C d", "é \x85 \xa0 ü", *(sentence(rng, rng.randint(1, 90)) for _ in range(100))]:
        assert fingerprint((text or "").encode()) == signed(plain_fingerprint(text))


def test_hash_is_that_of_spark(spark):
    got = spark.sql("select xxhash64('the quick fox') h").first()["h"]
    assert got == signed(xxhash.xxh64(b"the quick fox", seed=42).intdigest())


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_masks_cover(radius):
    """For any differing bits some table keeps none of them."""
    for bits in combinations(range(BITS), radius):
        gone = sum(1 << b for b in bits)
        assert any(mask & gone == 0 for mask in masks(radius))
    assert all(30 < (m & (1 << 64) - 1).bit_count() <= 64 for m in masks(radius))


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("small", [0, 32])
def test_components_equal_all_pairs(spark, radius, small):
    points = clustered(radius, 40, 25)
    df = spark.createDataFrame([(p,) for p in points], "fingerprint long")
    found = {r["node"]: r["root"] for r in rows(components(links(df, radius, small)))}
    want = grouped(points, radius)
    assert {p: found.get(p, p) for p in points} == want


def test_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 1000), (5, 7)], "a long, b long")
    assert {r["node"]: r["root"] for r in rows(components(edges))} == dict.fromkeys(range(301), 0)
    assert rows(components(edges.limit(0))) == []


def test_groups_of_given_documents(spark):
    docs = rows(read(spark, "documents", SF_SMALL))
    prints = {d["doc_id"]: signed(plain_fingerprint(d["text"])) for d in docs}
    root = grouped(list(set(prints.values())), 2)
    name = {}
    for i, p in sorted(prints.items()):
        name.setdefault(root[p], i)
    got = {r["doc_id"]: r for r in rows(simhash_groups(read(spark, "documents", SF_SMALL)))}
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{p & (1 << 64) - 1:016x}", name[root[p]]) for i, p in prints.items()
    }
    assert len(set(name.values())) < len(docs)


def test_keep_one_of_each_group(spark):
    text = sentence(random.Random(1), 60)
    docs = documents(spark, [text, text, text.upper(), "other words", None, "", text], [7, 3, 3, 4, 9, None, 3])
    kept = keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    got = sorted((r["doc_id"], r["text"] is None) for r in rows(kept))
    assert got == [(3, False), (4, False), (9, True)]
    ids = documents(spark, [text, text], [None, None])
    assert len(rows(keep_one(ids))) == 1


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    got = rows(simhash_groups(docs))
    assert len(got) == docs.count()
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {1}
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["fingerprint"] != "0" * 16] == [None]
    assert rows(simhash_groups(empty(spark))) == rows(keep_one(empty(spark))) == []


def test_radius_is_checked(spark):
    with pytest.raises(ValueError):
        links(spark.range(1).select(F.col("id").alias("fingerprint")), 3)
    assert near_dup.SEED == 42
