"""Variable-capacity best-fit packing.

Texts become sequences of one of several permitted lengths. A text longer than the largest is cut into pieces of that
length and a rest. Pieces are placed longest first, each into the open bin with the least room that is enough. Where
none has room, a bin of the least cost a token is opened: the cost of a length over the tokens that it is filled with if it
gets, of the pieces still to be placed, always the longest that fits. At the end each bin gets the shortest permitted length that holds it.

Opening by opening that is greedy, so the lengths are chosen jointly: every set of permitted lengths that can hold the longest
piece is tried for the bins to be opened, the shortening at the end still has all of them, and the set of least total cost is
taken; of equals the one with fewest, then smallest lengths. So no block costs more than it would with any single length.

Rows are dealt by a hash into blocks of about ``block_rows``, packed independently: the bins a block leaves partly
filled are few against those it fills, and no task sees more than a block, of which it gets ids and lengths, not texts.
Rows that share a doc_id are dealt by their text as well, and rows that share both evenly over all blocks.

Null or empty text: length 1, its end. Extra columns are ignored; repeated rows are packed once each.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import WORD, text_of

CAPACITIES = (512, 1024, 2048, 4096)
BLOCK_ROWS = 20_000


def compute_cost(length: int) -> float:
    """Work on one sequence: a term for each token, one for each pair (attention), one for each sequence."""
    return length + length * length / 16_384 + 32


@dataclass
class Bin:
    capacity: int
    used: int = 0


def opened(
    piece: int,
    to_place: int,
    capacities: Sequence[int],
    cost: Callable[[int], float],
    filled: Callable[[int], int] | None = None,
) -> int:
    """The capacity with the least cost a token that it is filled with; of equals the smallest. Unless ``filled`` tells
    the tokens for a capacity, any number up to ``to_place`` is thought to fit."""
    fitting = [c for c in capacities if c >= piece]
    if len(fitting) == 1:
        return fitting[0]
    return min(fitting, key=lambda c: (cost(c) / min(c, to_place, filled(c) if filled else c), c))


def fill(capacity: int, at: int, shorter: Sequence[int]) -> int:
    """Tokens in a bin that gets the piece ``at`` and of those behind it always the longest that fits. ``shorter`` has
    the negative lengths of all pieces, longest first."""
    room = capacity + shorter[at]
    at += 1
    while (at := bisect_left(shorter, -room, lo=at)) < len(shorter):
        same = bisect_right(shorter, shorter[at], lo=at) - at
        taken = min(same, room // -shorter[at])
        room += taken * shorter[at]
        at += taken
    return capacity - room


def pack(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = compute_cost
) -> tuple[list[tuple[int, int, int, int, int]], list[Bin]]:
    """Pieces (text, start, length, bin, offset) and the bins."""
    capacities = sorted(capacities)
    largest = capacities[-1]
    pieces = [(min(largest, n - at), i, at) for i, n in enumerate(lengths) for at in range(0, n, largest)]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    sets = [s for k in range(1, len(capacities) + 1) for s in combinations(capacities, k) if not pieces or s[-1] >= pieces[0][0]]
    plans = (_placed(pieces, s, capacities, cost) for s in sets)
    return min(plans, key=lambda plan: sum(cost(b.capacity) for b in plan[1]))


def _placed(
    pieces: list[tuple[int, int, int]], opening: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float]
) -> tuple[list[tuple[int, int, int, int, int]], list[Bin]]:
    """The pieces (length, text, start) in bins opened with the ``opening`` lengths, then shortened to any capacity."""
    to_place = sum(p[0] for p in pieces)
    shorter = [-p[0] for p in pieces]
    bins: list[Bin] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    out = []
    for next_piece, (length, text, start) in enumerate(pieces):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            _, number = room.pop(at)
        else:
            number = len(bins)
            bins.append(Bin(opened(length, to_place, opening, cost, lambda c: fill(c, next_piece, shorter))))
        box = bins[number]
        out.append((text, start, length, number, box.used))
        box.used += length
        to_place -= length
        if box.used < box.capacity:
            insort(room, (box.capacity - box.used, number))
    for box in bins:
        box.capacity = next(c for c in capacities if c >= box.used)
    return out, bins


PACKED = "start long, length long, block long, bin long, capacity long, offset long"


def token_count(text: Column) -> Column:
    """Words, and an end."""
    return F.regexp_count(text, F.lit(WORD)).cast("long") + 1


def pack_texts(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    block_rows: int = BLOCK_ROWS,
    tokens: Callable[[Column], Column] = token_count,
) -> DataFrame:
    """Every piece of every row of (doc_id, text): doc_id, start and length in the text, block and bin, the bin's
    capacity, and the piece's offset in it. (block, bin) names a bin."""
    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("key"), tokens(F.col("text")).alias("n_tokens")
    )
    n_blocks = max(1, -(-docs.count() // block_rows))
    # Equal rows go to consecutive blocks in equal numbers, as a count for each.
    equal = rows.groupBy("doc_id", "key", "n_tokens").agg(F.count("*").alias("n"))
    parts = equal.select("*", F.explode(F.expr(f"sequence(0L, least(n, {n_blocks}L) - 1)")).alias("part"))
    dealt = parts.select(
        "doc_id",
        "key",
        "n_tokens",
        F.expr(f"n div {n_blocks} + int(part < n % {n_blocks})").alias("copies"),
        F.expr(f"pmod(pmod(key, {n_blocks}L) + part, {n_blocks}L)").alias("block"),
    )
    kind = docs.schema["doc_id"].dataType

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("key", "ascending"), ("n_tokens", "ascending")])
        table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table.column("copies").to_numpy())))
        pieces, bins = pack(table.column("n_tokens").to_pylist(), capacities)
        text, start, length, number, offset = zip(*pieces)
        columns = [start, length, [table.column("block")[0].as_py()] * len(text), number, [bins[b].capacity for b in number], offset]
        names = ["start", "length", "block", "bin", "capacity", "offset"]
        ids = table.column("doc_id").combine_chunks().take(pa.array(text, pa.int64()))
        return pa.table([ids, *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *names])

    return dealt.groupBy("block").applyInArrow(run, f"doc_id {kind.simpleString()}, {PACKED}")
