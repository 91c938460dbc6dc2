"""Document fingerprints by winnowing.

Every run of K code points is hashed by a rolling polynomial modulo 2^64 and mixed. Of each W consecutive hashes the least
is kept, of equal ones the rightmost, together with its position. So any span of K + W - 1 code points that two texts share
leaves at least one common hash in both fingerprints, and a fingerprint has about 2 / (W + 1) entries a character. The
likeness of two fingerprints is the share of their distinct hashes that both have (1 for two empty ones).

Hashes of a block of text come from one prefix sum of ``c * B^i``, whose differences are divided by ``B^i``: the rolling
update for all positions at once. Texts are worked through in blocks, so arrays do not grow with the text.

``beside_edited`` compares each document with an edited copy of itself and with the next document by id. Documents are dealt
into ranges of ids, one task each; the first document of each range is also sent to the range before it, that of the
first range to the last, so a task needs no other one and only a single document crosses each border.

Null text: empty, with an empty fingerprint. A text of fewer than K code points is one gram, and one of fewer than W grams
one window. Null ids come first; rows with equal ids are ordered by a hash of their text, and repeated rows are each
compared with the next copy. A single row is its own next one; no rows, no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.common import bytes_of, slices, text_of

K, W = 16, 48

# An odd multiplier and the multiplier of the mixing step, both modulo 2^64.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
BLOCK = 1 << 15


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class Winnower:
    """Winnowing with grams of ``k`` code points and windows of ``w`` grams."""

    def __init__(self, k: int = K, w: int = W):
        self.k, self.w = k, w
        self.up = _powers(BASE, BLOCK + w + k)
        self.down = _powers(pow(BASE, -1, 1 << 64), BLOCK + w + k)

    def _hashes(self, codes: np.ndarray, k: int) -> np.ndarray:
        """The mixed hash of ``sum((code[i + j] + 1) * BASE^j)`` at each i."""
        n = len(codes) - k + 1
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[: len(codes)], out=sums[1:])
        h = (sums[k:] - sums[:n]) * self.down[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(MIX)
        return h ^ (h >> np.uint64(32))

    @staticmethod
    def _least(h: np.ndarray, w: int) -> np.ndarray:
        """Where the least of each w consecutive hashes is, the rightmost of equal ones."""
        value, at, span = h, np.arange(len(h)), 1
        while span < w:
            step = min(span, w - span)
            take = value[step:] <= value[:-step]
            at = np.where(take, at[step:], at[:-step])
            value = np.where(take, value[step:], value[:-step])
            span += step
        return at

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Positions (code points, ascending) and hashes (unsigned) of a text."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        k = min(self.k, len(codes))
        grams = len(codes) - k + 1
        w = min(self.w, grams)
        positions, hashes = [], []
        for at in range(0, grams - w + 1, BLOCK):
            windows = min(BLOCK, grams - w + 1 - at)
            h = self._hashes(codes[at : at + windows + w + k - 2], k)
            kept = self._least(h, w)
            kept = kept[np.concatenate([[True], kept[1:] != kept[:-1]])]
            if positions and positions[-1][-1] == at + kept[0]:
                kept = kept[1:]
            positions.append(kept + at)
            hashes.append(h[kept])
            if not len(kept):
                positions.pop(), hashes.pop()
        return np.concatenate(positions), np.concatenate(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common distinct hashes over all distinct hashes."""
    one, other = set(a.tolist()), set(b.tolist())
    return len(one & other) / len(one | other) if one or other else 1.0


def rendered(positions: np.ndarray, hashes: np.ndarray) -> str:
    """``position:hash`` (16 hex digits) of each entry, joined by blanks."""
    return " ".join(f"{p}:{h:016x}" for p, h in zip(positions.tolist(), hashes.tolist()))


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id, and the positions and hashes (signed longs) of the fingerprint of every row of (doc_id, text); no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow = Winnower(k, w)
        for whole in batches:
            for batch in slices(whole, "text"):
                made = [winnow(t.decode()) for t in batch.column("text").to_pylist()]
                positions = pa.array([p for p, _ in made], pa.list_(pa.int64()))
                hashes = pa.array([h.view(np.int64) for _, h in made], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), positions, hashes], ["doc_id", "positions", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", bytes_of().alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, positions array<bigint>, hashes array<bigint>")


def shared_spans(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each hash that two sets of fingerprints share, with its first place in each document: (a_id, b_id, hash, a_at, b_at).

    Entries of one document with the same hash count once, and hashes that many documents of ``b`` have are joined
    like any other: salting is left to Spark's skew join.
    """

    def places(prints: DataFrame, side: str) -> DataFrame:
        each = prints.select(F.col("doc_id").alias(f"{side}_id"), F.inline(F.arrays_zip("hashes", "positions")))
        return each.groupBy(f"{side}_id", F.col("hashes").alias("hash")).agg(F.min("positions").alias(f"{side}_at"))

    return places(a, "a").join(places(b, "b"), "hash").select("a_id", "b_id", "hash", "a_at", "b_at")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many code points from the beginning of another."""
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


ORDER = ("__has_id", "doc_id", "__key", "__salt")


def _dealt(docs: DataFrame) -> DataFrame:
    """(block, last, doc_id, text): rows in ascending order within each block, then the first row of the block after it."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").isNotNull().alias("__has_id"),
        "doc_id",
        F.xxhash64(text_of()).alias("__key"),
        # Splits rows that are equal in all else, whose order does not matter.
        F.monotonically_increasing_id().alias("__salt"),
        text_of().alias("text"),
    )
    ranges = rows.select(*ORDER).repartitionByRange(parts, *ORDER)
    least = ranges.groupBy(F.spark_partition_id().alias("block")).agg(F.min(F.struct(*ORDER)).alias("first"))
    # One row a range: as many as there are shuffle partitions.
    firsts = sorted(tuple(r["first"]) for r in least.collect())

    def block_of(has_id: bool, doc_id, key: int, salt: int) -> int:
        return max(bisect_right(firsts, (has_id, doc_id, key, salt)) - 1, 0)

    own = rows.withColumn("block", F.udf(block_of, "int", useArrow=True)(*ORDER)).withColumn("last", F.lit(False))
    heads = [(doc_id, key, (i - 1) % len(firsts)) for i, (_, doc_id, key, _) in enumerate(firsts)]
    schema = T.StructType([T.StructField("__id", docs.schema["doc_id"].dataType), T.StructField("__of", T.LongType()), T.StructField("block", T.IntegerType())])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__of"))
    guards = rows.join(F.broadcast(spark.createDataFrame(heads, schema)), same).groupBy("block").agg(F.first("text").alias("text"))
    closing = guards.select(
        F.lit(None).cast("boolean").alias("__has_id"),
        F.lit(None).cast(schema["__id"].dataType).alias("doc_id"),
        F.lit(None).cast("bigint").alias("__key"),
        F.lit(None).cast("bigint").alias("__salt"),
        "text",
        "block",
        F.lit(True).alias("last"),
    )
    together = own.select(*closing.columns).union(closing)
    return together.repartitionById(parts, F.col("block")).sortWithinPartitions("block", "last", *ORDER).select("block", "last", "doc_id", bytes_of().alias("text"))


BESIDE = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def beside_edited(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Of every row of (doc_id, text): its fingerprint, that of its edited text (see ``edited``, with the next document by
    id), and the likeness of its fingerprint to the edited text's and to the next document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow = Winnower(k, w)
        before = None  # block, doc_id, text and fingerprint of the row whose next one comes now
        for whole in batches:
            for batch in slices(whole, "text"):
                out = []
                for block, last, doc_id, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "last", "doc_id", "text"))):
                    text = raw.decode()
                    mine = winnow(text)
                    if before is not None and before[0] == block:
                        _, named, previous, (places, hashes) = before
                        changed = edited(previous, text)
                        new_places, new_hashes = winnow(changed)
                        out.append(
                            (
                                named,
                                len(previous),
                                hashlib.sha256(changed.encode()).hexdigest(),
                                rendered(places, hashes),
                                rendered(new_places, new_hashes),
                                likeness(hashes, new_hashes),
                                likeness(hashes, mine[1]),
                            )
                        )
                    before = None if last else (block, doc_id, text, mine)
                kinds = [batch.column("doc_id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                names = ["doc_id", *[c.split()[0] for c in BESIDE.split(", ")]]
                columns = zip(*out) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _dealt(docs).mapInArrow(run, f"doc_id {kind}, {BESIDE}")


def common_share(a: Column, b: Column) -> Column:
    """``likeness`` of two columns of hashes, for use on the result of ``fingerprints``."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)
