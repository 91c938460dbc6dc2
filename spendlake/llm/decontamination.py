"""Benchmark decontamination by winnowing.

Words are runs of a-z, 0-9 and non-ASCII characters of the lowered text. A document is contaminated if it holds a
window of an item: ``window`` consecutive words of it, or all of a shorter item.

* Fingerprints: of every window the least of its K-word hashes is kept, on both sides; items shorter than a window have one,
  the hash of all their words, and it is looked for at every word. Equal windows have equal fingerprints, so none is missed.
* Fingerprints of documents and items are joined. Where one is shared, the document's windows that have it are hits; those
  are joined with the items' windows, word by word as bytes, and neighbouring ones make up the spans.

Nothing of a benchmark goes through the driver but its distinct fingerprints, and those only while there are at most
``MOST_PRINTS``, counted before: then tasks look them up as they read the documents. Beyond that both sides are
shuffled by fingerprint, and texts with hits are read again. Joins are of windows with distinct windows, never of places
with places, so a word repeated without end takes time in proportion to its text, and a passage that many documents or many
items share is one row of the smaller side. Copies of a text are judged once.

Null or empty text: no words, not contaminated. Items without words match nothing. Null item ids are not
counted or listed, but their windows hit. Rows that repeat an item_id count once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import byte_arrays, bytes_of, sent, slices
from spendlake.sources.scratch import written

K = 5
MOST_PRINTS = 1 << 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

# Multipliers of the rolling hashes and their inverses modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


class _Tables(dict):
    """What a worker has worked out; it is not sent along with the functions that use it."""

    def __reduce__(self) -> tuple:
        return _Tables, ()


TABLES = _Tables()


def _fold() -> np.ndarray:
    """Each byte lowered; 0 for bytes between words."""
    if "fold" in TABLES:
        return TABLES["fold"]
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 65 <= b <= 90 else b
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            out[b] = c
    TABLES["fold"] = out
    return out


def _powers(base: int, log2: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below 2**log2 or more."""
    if base in TABLES and len(TABLES[base][0]) >= 1 << log2:
        return TABLES[base]

    def up(b: int) -> np.ndarray:
        out = np.ones(1 << log2, np.uint64)
        for bit in range(log2):
            out[1 << bit : 2 << bit] = out[: 1 << bit] * np.uint64(pow(b, 1 << bit, 1 << 64))
        return out

    TABLES[base] = up(base), up(pow(base, -1, 1 << 64))
    return TABLES[base]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _rolled(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of value * base**i, and the inverse powers that take the offset out of a difference."""
    power, inverse = _powers(base, max(16, int(len(values) + 1).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return sums, inverse


@dataclass
class Words:
    """The words of some texts, in order: byte range, hash, and for each text where its words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def grams(self, n: int) -> np.ndarray:
        """The hash of n words from each word on; NONE where the text ends before."""
        out = np.full(len(self.hash), NONE)
        whole = len(self.hash) - n + 1
        if whole > 0:
            sums, inverse = self._sums()
            out[:whole] = _mixed((sums[n:] - sums[:-n]) * inverse[:whole])
        for back in range(1, n):  # the last words of each text begin no n-gram
            at = self.first[1:] - back
            out[at[at >= self.first[:-1]]] = NONE
        return out

    def spelled(self, at: np.ndarray, n: int) -> list[bytes]:
        """The ``n`` words from each place on, with one blank between them."""
        if not hasattr(self, "_plain"):
            inside = self.data > 0
            used = inside.copy()
            gaps = self.end[self.end < len(inside)]
            used[gaps] = True
            place = np.cumsum(used) - 1
            self._plain = np.where(inside, self.data, 32)[used].tobytes(), place[self.start], place[self.end - 1] + 1
        plain, start, end = self._plain
        return [plain[a:b] for a, b in zip(start[at].tolist(), end[at + n - 1].tolist())]

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_prefix"):
            self._prefix = _rolled(self.hash, WORD_BASE)
        return self._prefix


def words_in(data: np.ndarray, starts: np.ndarray) -> Words:
    data = _fold()[data]
    inside = data > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begin[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = starts[1:][starts[1:] > 0] - 1
    last[edges] = inside[edges]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    sums, inverse = _rolled(data.astype(np.uint64), BYTE_BASE)
    hashes = _mixed((sums[end] - sums[start]) * inverse[start])
    return Words(data, start, end, hashes, np.searchsorted(start, starts))


def winnowed(h: np.ndarray, run: int) -> np.ndarray:
    """The least of the ``run`` hashes from each one on; NONE counts beyond the last."""
    low = h.copy()
    for i in range(1, min(run, len(h))):
        np.minimum(low[:-i], h[i:], out=low[:-i])
    return low


def prints(words: Words, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the ``n`` words from each place on: their hash, NONE where the text ends before, and their fingerprint."""
    whole = words.grams(n)
    return whole, winnowed(words.grams(K), window - K + 1) if n == window else whole


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


ITEM_WINDOWS = "n int, print long, hash long, words binary"
DOC_WINDOWS = "n_words long, windows array<struct<at: int, n: int, hash: long, words: binary>>"


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, n, print, hash, words) of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                words = words_in(*byte_arrays(part.column("text")))
                sizes = np.diff(words.first)
                for n in sorted({min(int(x), window) for x in sizes if x}):
                    whole, least = prints(words, n, window)
                    owner = np.repeat(np.arange(len(sizes)), sizes)
                    at = np.flatnonzero((whole != NONE) & ((sizes[owner] == n) | (n == window)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(owner[at])), pa.array(np.full(len(at), n, np.int32)), _signed(least[at]),
                         _signed(whole[at]), pa.array(words.spelled(at, n), pa.binary())],
                        ["item_id", "n", "print", "hash", "words"],
                    )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), bytes_of().alias("text"))
    return rows.mapInArrow(run, f"item_id string, {ITEM_WINDOWS}")


def _hits(words: Words, wanted: dict[int, np.ndarray], window: int) -> pa.Array:
    """For each text the windows whose fingerprint is wanted; these are sorted, by number of words."""
    places, sizes, hashes, spelled = [], [], [], []
    for n, keys in wanted.items():
        whole, least = prints(words, n, window)
        near = np.minimum(np.searchsorted(keys, least), len(keys) - 1)
        at = np.flatnonzero((whole != NONE) & (keys[near] == least))
        places.append(at)
        sizes.append(np.full(len(at), n, np.int32))
        hashes.append(whole[at])
        spelled += words.spelled(at, n) if len(at) else []
    at = np.concatenate([np.zeros(0, np.int64), *places])
    order = np.argsort(at, kind="stable")
    owner = np.searchsorted(words.first, at[order], "right") - 1
    rows = pa.StructArray.from_arrays(
        [pa.array((at[order] - words.first[owner]).astype(np.int32)),
         pa.array(np.concatenate([np.zeros(0, np.int32), *sizes])[order]),
         _signed(np.concatenate([np.zeros(0, np.uint64), *hashes])[order]),
         pa.array(spelled, pa.binary()).take(pa.array(order))],
        ["at", "n", "hash", "words"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at[order], words.first).astype(np.int32)), rows)


def _by_size(n: np.ndarray, keys: np.ndarray) -> dict[int, np.ndarray]:
    keys = keys.astype(np.int64).view(np.uint64)
    return {int(size): np.unique(keys[n == size]) for size in np.unique(n)}


def _lookup(texts: DataFrame, wanted: Callable[[], dict[int, np.ndarray]], window: int) -> DataFrame:
    """(doc_id, __k1, __k2) with what DOC_WINDOWS names, all texts against the same fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = wanted()
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                words = words_in(*byte_arrays(part.column("__text")))
                found = [pa.array(np.diff(words.first)), _hits(words, keys, window)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *found], [*part.schema.names[:3], "n_words", "windows"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, __k1 long, __k2 long, {DOC_WINDOWS}")


def _joined(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """As ``_lookup``, by a join of the distinct fingerprints of both sides; texts with hits are read again."""
    sizes = [r["n"] for r in wanted.select("n").distinct().collect()]  # at most ``window`` numbers

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                words = words_in(*byte_arrays(part.column("__text")))
                owner = np.repeat(np.arange(part.num_rows), np.diff(words.first))
                for n in sizes:
                    whole, least = prints(words, n, window)
                    at = np.flatnonzero(whole != NONE)
                    at = at[np.unique(np.stack([owner[at], least[at].view(np.int64)]), axis=1, return_index=True)[1]]
                    whose = pa.array(owner[at])
                    columns = [part.column(1).take(whose), part.column(2).take(whose), pa.array(np.full(len(at), n, np.int32))]
                    yield pa.RecordBatch.from_arrays([*columns, _signed(least[at])], ["__k1", "__k2", "n", "print"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                words = words_in(*byte_arrays(row.column("__text")))
                keys = row.column("keys")[0].as_py() or []
                hits = _by_size(np.array([k["n"] for k in keys]), np.array([k["print"] for k in keys]))
                found = [pa.array(np.diff(words.first)), _hits(words, hits, window)]
                yield pa.RecordBatch.from_arrays([*row.columns[:3], *found], [*row.schema.names[:3], "n_words", "windows"])

    found = texts.mapInArrow(every, "__k1 long, __k2 long, n int, print long").distinct().join(wanted, ["n", "print"], "left_semi")
    keys = written(found.groupBy("__k1", "__k2").agg(F.collect_list(F.struct("n", "print")).alias("keys")), "hits")
    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.join(keys, ["__k1", "__k2"], "left").select("doc_id", "__k1", "__k2", "__text", "keys")
    return rows.mapInArrow(again, f"doc_id {kind}, __k1 long, __k2 long, {DOC_WINDOWS}")


def text_keys() -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(bytes_of()).alias("__k1"), F.xxhash64(F.lit(1), bytes_of()).alias("__k2")]


def found_windows(docs: DataFrame, benchmark: DataFrame, window: int, most_prints: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows with their text's keys and number of words; the windows of distinct texts that items have; those of items."""
    if window < K:
        raise ValueError(f"a window has {K} words or more")
    spark = docs.sparkSession
    items = written(item_windows(benchmark, window), "items")
    wanted = written(items.select("n", "print").distinct(), "prints")
    texts = docs.select("doc_id", *text_keys(), bytes_of().alias("__text"))
    if wanted.count() <= most_prints:
        known = wanted.toPandas()
        rows = _lookup(texts, sent(spark, _by_size(known["n"].to_numpy(), known["print"].to_numpy())), window)
    else:
        rows = _joined(texts, wanted, window)
    rows = written(rows, "windows")
    hits = rows.select("__k1", "__k2", F.inline("windows")).distinct()
    same = items.select("n", "hash", "words").distinct()
    return rows, written(hits.join(same, ["n", "hash", "words"], "left_semi"), "spans"), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_prints: int = MOST_PRINTS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of (doc_id, text)."""
    rows, hits, items = found_windows(docs, benchmark, window, most_prints)
    key = ["__k1", "__k2"]
    before = F.max(F.col("at") + F.col("n")).over(
        Window.partitionBy(*key).orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("at") + F.col("n")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("at"), F.coalesce(before, F.lit(0))))
    covered = hits.select(*key, new.alias("new")).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    same = ["n", "hash", "words"]
    owners = items.where("item_id is not null").select(*same, "item_id").distinct()
    owned = hits.select(*key, *same).distinct().join(owners, same).select(*key, "item_id").distinct()
    listed = owned.groupBy(*key).agg(
        F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item_id"))), 256).alias("items_sha256")
    )
    # Written, so that the join can split a text that many rows have.
    verdicts = written(covered.join(listed, key, "left"), "verdicts")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return rows.join(verdicts, key, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, most_prints: int = MOST_PRINTS) -> DataFrame:
    """The rows that hold no window of the benchmark, with all their columns."""
    _, hits, _ = found_windows(docs, benchmark, window, most_prints)
    dirty = written(hits.select("__k1", "__k2").distinct(), "dirty")
    return docs.select("*", *text_keys()).join(dirty, ["__k1", "__k2"], "left_anti").select(*docs.columns)
