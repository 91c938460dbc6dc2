"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: bit b is 1 if it is set in more than half of the XXH64 hashes of the text's word shingles.

Covering: each bit gets one of the ``2**(r+1) - 1`` non-zero vectors of r+1 bits, and table v keeps the bits whose
vector has an odd inner product with v. The vectors of r differing bits span at most r dimensions, so some v is
orthogonal to all of them: its table keeps none of the differing bits, and the pair collides there for certain.

Links stay linear. Equal fingerprints are one row from the start. Within a small bucket all pairs are compared;
fingerprints of larger buckets are linked through centres instead: two fingerprints are at most 2 bits apart
exactly if a third, or one of them, is at most 1 bit from both, so each emits itself and its 64 neighbours, and all
that share a centre are linked to the least of them. Components come from alternating large-star and small-star rounds.

Null or empty text: fingerprint 0, linked like any other. Fewer words than a shingle: the whole sequence is the only
shingle. Null ids are never the name of a component unless all its ids are null. Repeated rows are each returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import bytes_of, text_of
from spendlake.sources.scratch import written

SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([hashed(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint (a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], ["doc_id", "text_key", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), bytes_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fingerprint long")


def masks(radius: int) -> list[int]:
    """The kept bits of each table, as signed longs."""
    vectors = 2 ** (radius + 1) - 1
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << b for b in range(BITS) if ((b % vectors + 1) & v).bit_count() % 2)
        out.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return out


def links(points: DataFrame, radius: int, small: int = 32) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, a > b, whose transitive closure joins all that are within the radius."""
    if radius not in (0, 1, 2):
        raise ValueError("the radius is 0, 1 or 2 bits")
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("p").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks(radius))])
    keyed = points.select(F.col("fingerprint").alias("p")).select("p", F.inline(tables))
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("size")).where("size > 1")
    crowded = written(keyed.join(sizes, ["t", "k"]), "buckets")
    few = crowded.where(F.col("size") <= small)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = (
        few.select("t", "k", F.col("p").alias("a"))
        .join(few.select("t", "k", F.col("p").alias("b")), ["t", "k"])
        .where((F.col("a") > F.col("b")) & near)
        .select("a", "b")
    )
    many = crowded.where(F.col("size") > small).select("p").distinct()
    return pairs.union(_through_centres(many, radius)).distinct()


def _through_centres(points: DataFrame, radius: int) -> DataFrame:
    flips = [1 << b if b < BITS - 1 else -(1 << b) for b in range(BITS)]
    if radius == 2:
        centres = F.array(F.col("p"), *[F.col("p").bitwiseXOR(F.lit(f)) for f in flips])
        keyed = points.select("p", F.explode(centres).alias("centre"))
        keys = ["centre"]
    else:  # one bit apart: equal once that bit is cleared
        cleared = F.array(*[F.struct(F.lit(i).alias("bit"), F.col("p").bitwiseAND(F.lit(~f)).alias("centre")) for i, f in enumerate(flips)])
        keyed = points.select("p", F.inline(cleared))
        keys = ["bit", "centre"]
    if radius == 0:
        keyed = keyed.limit(0)
    # A centre has at most 65 members, so a group is small by construction.
    least = keyed.groupBy(*keys).agg(F.min("p").alias("b"), F.count("*").alias("size")).where("size > 1").drop("size")
    return keyed.join(least, keys).where(F.col("p") > F.col("b")).select(F.col("p").alias("a"), "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b) of longs; the root is the least node of its component."""
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = written(small.distinct(), "small-star")
        # As long numbers can overflow, the hashes are summed as decimals.
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        seen = mark


def grouped(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """(doc_id, text_key, fingerprint, root): the group of every row, named by one of its fingerprints."""
    printed = written(fingerprints(docs, shingle), "fingerprints")
    roots = components(links(printed.select("fingerprint").distinct(), radius))
    return printed.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "doc_id", "text_key", "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id) of every row of (doc_id, text)."""
    rows = grouped(docs, shingle, radius)
    # Written, so that the join can split a component that many rows belong to.
    names = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    return rows.join(names, "root").select("doc_id", _hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group, with all its columns: that of the least doc_id (nulls last).

    Of rows that share both doc_id and text one stays, whichever.
    """
    rows = grouped(docs, shingle, radius)
    repeated = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    chosen = rows.groupBy("root").agg(first.alias("f")).select(F.col("f.doc_id").alias("__id"), F.col("f.text_key").alias("__key"))
    keyed = docs.withColumn("__text_key", F.xxhash64(text_of()))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    kept = keyed.join(chosen, same, "left_semi")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__text_key"])
    return kept.drop("__text_key")


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
