"""LM scoring with a probabilistic suffix tree over words.

The tree has two tiers, and a text's history ends in a context of one of them.

* Hot contexts. Symbols are the frequent words and the end of a text; a context is the last one, two, … symbols. Which
  contexts are hot and which next-symbol counts are stored with them depends on their share of all training tokens. As
  shares add up to 1, there are at most ``1 / share`` entries a level whatever the size of the corpus, which bounds what
  every task is sent.
* All other words that occur ``context_min`` times are contexts of length one, with every next word that follows
  ``pair_min`` times. These minima are the same at any size, so this tier grows with the corpus. It is a pair of
  distributed tables: counts are summed before and after one shuffle, and texts are joined with it. No key of it is hot,
  as a context that reached its share would belong to the first tier.

In both:

* A candidate context becomes a state if its next-symbol distribution diverges from its suffix's by more than
  sampling noise: count * KL >= ``ln(count) / 2`` for each stored symbol.
* P(w|s) = c(s,w) / (c(s)+m) + (m + unstored) / (c(s)+m) * P(w|suffix), with m the ``smoothing``. The root is the
  smoothed unigram model. So each state's probabilities, those of unseen words included, add up to 1.
* A token is scored by the longest suffix of its history that is a state. A text's history begins with an end.

Texts are split into words once: what is written of them is their symbols, four bytes each, and eight bytes of hash for
each word too rare to be one, which every level of the tree and the scoring read again. The vocabulary, which grows with the
corpus, stays distributed. States of the second tier are sent to tasks, to pass on only what they score, while they are
counted to be at most ``MOST_SENT``; beyond that every token behind a word of that tier is joined.

Null or empty text: one token, the end. Null id: a training row. No training rows: all counts are 0, every token
has probability 1 (a vocabulary of unseen words only). Repeated rows count as often as they occur. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import byte_arrays, bytes_of, sent, slices
from spendlake.sources.scratch import written

RARE = -1
END = 0
FLUSH = 1 << 20  # distinct pairs or words a task holds before it passes them on
MOST_SENT = 1 << 20  # states of the second tier that tasks are sent, of eight bytes each


@dataclass(frozen=True)
class TreeParams:
    """Shares are of all training tokens, minima are counts."""

    depth: int = 2
    word_share: float = 1e-6
    context_share: float = 2e-5
    pair_share: float = 5e-6
    smoothing: float = 5.0
    context_min: int = 8
    pair_min: int = 2


@dataclass
class Level:
    """All candidate contexts of one length, as sorted keys: index of the context without its last symbol, times
    the number of symbols, plus that symbol. The last four fields are known once the states are chosen."""

    keys: np.ndarray
    totals: np.ndarray
    suffix: np.ndarray  # index of the context without its first symbol, one level up
    state: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    back_off: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pair_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_probs: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class Tree:
    root: np.ndarray  # unigram probability by symbol
    frequent: np.ndarray  # by symbol: whether a pair that ends in it can be stored
    trained: bool  # whether there was a text to learn from
    levels: list[Level]


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in the sorted keys; -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def find_symbol(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """As ``find``, for keys that are symbols: by a table instead of a search."""
    place = np.full(keys[-1] + 2 if len(keys) else 1, -1, np.int64)  # the last is for all other symbols
    place[keys] = np.arange(len(keys))
    return np.where(wanted >= 0, place[np.clip(wanted, 0, len(place) - 1)], -1)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of binary texts, lower-cased; of all words in order, which of these each is; how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    offsets = split.offsets.to_numpy()
    coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).view(pa.binary()).dictionary_encode()
    words, index, sizes = coded.dictionary, coded.indices.to_numpy(), np.diff(offsets)
    empty = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:  # what stands before a text's first white space and after its last
        full = index != empty
        sizes = np.diff(np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]])
        index = index[full]
    return words, index, sizes


def symbols(texts: list[bytes] | pa.Array, words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all texts, each followed by an end; where each text begins; the ids of the rare words in order."""
    found, index, sizes = tokens(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
    distinct = found.to_numpy(zero_copy_only=False).tolist()
    known = np.array([words.get(w, RARE) for w in distinct], np.int64)
    ids = np.zeros(len(distinct), "<i8")
    rare = np.flatnonzero(known < 0)
    ids[rare] = [rare_id(distinct[i]) for i in rare.tolist()]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(starts[-1], END)
    is_word = np.ones(len(out), bool)
    is_word[starts[1:] - 1] = False
    of_word = known[index]
    out[is_word] = of_word
    return out, starts, ids[index[of_word < 0]]


def contexts(sym: np.ndarray, starts: np.ndarray, levels: list[Level], n_symbols: int) -> list[np.ndarray]:
    """By level, the index of the context before each token; -1 where it is no candidate."""
    before = np.concatenate([[END], sym[:-1]])
    before[starts[:-1]] = END
    found: list[np.ndarray] = []
    for depth, level in enumerate(levels):
        if depth == 0:
            found.append(find_symbol(level.keys, before))
            continue
        older = np.concatenate([[-1], found[-1][:-1]])
        older[starts[:-1]] = -1
        ok = (older >= 0) & (before >= 0)
        now = np.full(len(sym), -1, np.int64)
        now[ok] = find(level.keys, older[ok] * n_symbols + before[ok])
        found.append(now)
    return found


def probabilities(tree: Tree, found: list[np.ndarray], sym: np.ndarray) -> np.ndarray:
    """P(symbol | history), given the history's contexts by level. For a rare word only the weight with which its
    unigram probability counts."""
    n_symbols = len(tree.root)
    out = np.where(sym >= 0, tree.root[sym], 1.0)
    for level, index in zip(tree.levels, found):
        at = np.flatnonzero(index >= 0)
        at = at[level.state[index[at]]]
        if not len(at):
            continue
        context, symbol = index[at], sym[at]
        pair = np.where(symbol >= 0, find(level.pair_keys, context * n_symbols + symbol), -1)
        seen = np.where(pair >= 0, level.pair_probs[pair], 0.0)
        out[at] = seen + level.back_off[context] * out[at]
    return out


def choose_states(tree: Tree, level: Level, pairs: np.ndarray, counts: np.ndarray, smoothing: float) -> None:
    """Fit the level's distributions and keep as states those that diverge from their suffix's."""
    n_symbols, n = len(tree.root), len(level.keys)
    context, symbol = np.divmod(pairs, n_symbols)
    chain, index = [], context
    for upper in [level, *reversed(tree.levels)][: len(tree.levels)]:
        index = np.where(index >= 0, upper.suffix[index], -1)
        chain.append(index)
    above = probabilities(tree, chain[::-1], symbol)
    spread = level.totals + smoothing
    unstored = level.totals - np.bincount(context, counts, n)
    level.back_off = (smoothing + unstored) / spread
    level.pair_keys, level.pair_probs = pairs, counts / spread[context]
    gain = np.bincount(context, counts * np.log((level.pair_probs + level.back_off[context] * above) / above), n)
    gain = gain + unstored * np.log(level.back_off)
    n_stored = np.bincount(context, minlength=n)
    level.state = (n_stored > 0) & (gain >= 0.5 * np.log(np.maximum(level.totals, 2)) * n_stored)


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur, summed in the task before they leave it."""
    held: list[tuple[pa.Array, np.ndarray]] = []
    size = 0

    def weight(words: pa.Array) -> int:
        return len(words) + words.nbytes // 64  # a long word counts as several

    def merged() -> tuple[pa.Array, np.ndarray]:
        coded = pa.concat_arrays([w for w, _ in held]).dictionary_encode()
        return coded.dictionary, np.bincount(coded.indices.to_numpy(), np.concatenate([n for _, n in held]), len(coded.dictionary)).astype(np.int64)

    def batch_of(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"]).filter(pa.array(n > 0))

    for whole in batches:
        for batch in slices(whole, "text"):
            words, index, _ = tokens(batch.column("text"))
            held.append((words, np.bincount(index, minlength=len(words))))
            size += weight(words)
            if size > FLUSH:
                held = [merged()]
                size = weight(held[0][0])
                if size > FLUSH // 2:
                    yield batch_of(*held[0])
                    held, size = [], 0
    if held:
        yield batch_of(*merged())


# The id of a word that is no symbol, from Spark's hash of it; negative and never -1.
RARE_ID = "-2 - shiftrightunsigned(xxhash64(word), 2)"


def rare_id(word: bytes) -> int:
    return -2 - (xxhash.xxh64_intdigest(word, seed=42) >> 2)


def symbol_rows(words: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each text's symbols as consecutive integers of four bytes, and the ids of its rare words in their order, eight
    bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sym, starts, ids = symbols(batch.column("text"), words)
                n_rare = np.concatenate([[0], np.cumsum(sym < 0)])[starts]
                columns = [*batch.columns[:-1], _packed(sym.astype("<i4"), starts * 4), _packed(ids, n_rare * 8)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "symbols", "rare_ids"])

    return run


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def symbol_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of bounded size of the batches, with the symbols of all their texts and where each text begins."""
    for whole in batches:
        for batch in slices(whole, "symbols"):
            data, starts = byte_arrays(batch.column("symbols"))
            yield batch, data.view("<i4").astype(np.int64), starts // 4


def pair_counts(tree: Tree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of (context of the last level, next symbol), summed in the task before they leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_symbols, held, size = len(tree.root), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs, inverse = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return pairs, np.bincount(inverse, np.concatenate([c for _, c in held])).astype(np.int64)

        def batch_of(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

        for _, sym, starts in symbol_parts(batches):
            context = contexts(sym, starts, tree.levels, n_symbols)[-1]
            ok = (context >= 0) & (sym >= 0)
            ok[ok] = tree.frequent[sym[ok]]
            held.append(np.unique(context[ok] * n_symbols + sym[ok], return_counts=True))
            size += len(held[-1][0])
            if size > 2 * FLUSH:
                held = [merged()]
                if len(held[0][0]) > FLUSH:
                    yield batch_of(*held[0])
                    held = []
                size = sum(len(p) for p, _ in held)
        if held:
            yield batch_of(*merged())

    return run


def frequent_words(words: DataFrame, n_tokens: int, n_texts: int, params: TreeParams) -> tuple[dict[bytes, int], np.ndarray]:
    """The symbols of the words that reach their share of the training tokens, and the counts by symbol."""
    frequent = words.where(F.col("n") >= params.word_share * n_tokens).orderBy(F.desc("n"), "word").toArrow()
    counts = np.concatenate([[n_texts], frequent.column("n").to_numpy()]).astype(np.float64)
    return {w.encode(): i + 1 for i, w in enumerate(frequent.column("word").to_pylist())}, counts


def with_symbols(rows: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """``rows`` with ``symbols`` and ``rare_ids`` in place of ``text``, written."""
    words = sent(rows.sparkSession, ids)
    others = [c for c in rows.columns if c != "text"]
    schema = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in others]
    schema = ", ".join([*schema, "symbols binary", "rare_ids binary"])
    texts = rows.select(*others, bytes_of("text").alias("text"))
    return written(texts.mapInArrow(lambda it: symbol_rows(words())(it), schema), "symbols")


def grow(train: DataFrame, counts: np.ndarray, n_tokens: int, n_words: int, params: TreeParams) -> Tree:
    """The tree of the texts in ``symbols``. Only what reaches its share of the training tokens comes to the driver."""
    spark = train.sparkSession
    root = (counts + 0.1) / (n_tokens + 0.1 * (n_words + 1))
    tree = Tree(root, counts >= params.pair_share * n_tokens, counts[END] > 0, [])
    keys = np.flatnonzero(counts >= max(params.context_share * n_tokens, 1)).astype(np.int64)
    totals, suffix = counts[keys], np.full(len(keys), -1, np.int64)
    for _ in range(params.depth):
        if not len(keys):
            break
        level = Level(keys, totals, suffix)
        model = sent(spark, Tree(root, tree.frequent, tree.trained, [*tree.levels, level]))
        found = (
            train.select("symbols")
            .mapInArrow(lambda it, model=model: pair_counts(model())(it), "pair long, n long")
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= params.pair_share * n_tokens)
            .orderBy("pair")
            .toArrow()
        )
        pairs, n = found.column("pair").to_numpy(), found.column("n").to_numpy().astype(np.float64)
        choose_states(tree, level, pairs, n, params.smoothing)
        context, symbol = np.divmod(pairs, len(root))
        longer = (n >= params.context_share * n_tokens) & (symbol != END)
        # The suffix of "context + symbol" is "suffix of context + symbol".
        inner = np.zeros(longer.sum(), np.int64) if not tree.levels else suffix[context[longer]]
        tree.levels.append(level)
        suffix = np.where(inner >= 0, find(level.keys, inner * len(root) + symbol[longer]), -1)
        keys, totals = pairs[longer], n[longer]
    return tree


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _counted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct combination of the keys occurs first, and how often it does."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def cold_tokens(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple]:
    """Of parts of the batches, all tokens behind a word that is not among the ``hot`` symbols: the part, the row each
    stands in, the word before it and itself."""
    for batch, sym, starts in symbol_parts(batches):
        ids, _ = byte_arrays(batch.column("rare_ids"))
        sym[sym < 0] = ids.view("<i8")
        before = np.concatenate([[END], sym[:-1]])
        before[starts[:-1]] = END
        at = np.flatnonzero(find_symbol(hot, before) < 0)
        yield batch, np.searchsorted(starts, at, side="right") - 1, before[at], sym[at]


def cold_followers(hot: np.ndarray) -> Batches:
    """(context, symbols): what follows each word that is not hot, as often as it does, in lists by task and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, context, symbol in cold_tokens(batches, hot):
            order = np.argsort(context, kind="stable")
            distinct, begin = np.unique(context[order], return_index=True)
            offsets = pa.array(np.append(begin, len(order)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.ListArray.from_arrays(offsets, pa.array(symbol[order]))], ["context", "symbols"])

    return run


def cold_rows(hot: np.ndarray, states: tuple[np.ndarray, np.ndarray] | None) -> Batches:
    """(row, context, symbol, below) of each token behind a word that is not hot. With ``states``, sorted, and what an
    unseen symbol adds there, only of those behind a state; what all of a row's tokens would add if unseen then comes as
    ``below`` of one more line, whose context is the row and whose symbol, -1, is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, context, symbol in cold_tokens(batches, hot):
            rows = batch.column("row").to_numpy()
            extra = np.zeros(0, np.int64), np.zeros(0)
            if states is not None:
                state = find(states[0], context)
                row, context, symbol, state = (x[state >= 0] for x in (row, context, symbol, state))
                sums = np.bincount(row, states[1][state], len(rows))
                extra = rows[sums != 0], sums[sums != 0]
            columns = {
                "row": np.concatenate([rows[row], extra[0]]),
                "context": np.concatenate([context, extra[0]]),
                "symbol": np.concatenate([symbol, np.full(len(extra[0]), RARE)]),
                "below": np.concatenate([np.zeros(len(row)), extra[1]]),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def rare_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, n): how often each rare word stands in each text."""
    for whole in batches:
        for batch in slices(whole, "rare_ids"):
            data, starts = byte_arrays(batch.column("rare_ids"))
            ids, row = data.view("<i8"), np.repeat(np.arange(batch.num_rows), np.diff(starts) // 8)
            first, n = _counted(ids, row)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row").to_numpy()[row[first]], "id": ids[first], "n": n})


def grow_cold(train: DataFrame, words: DataFrame, counts: np.ndarray, hot: np.ndarray, n_tokens: int, n_words: int, params: TreeParams) -> DataFrame:
    """(context, symbol, more, unseen) of the second tier's states, written: how much the log10 probability of any symbol
    differs from that of the unigrams, and how much more that of a stored one does."""
    spark = train.sparkSession
    found = (
        train.select("symbols", "rare_ids")
        .mapInArrow(lambda it: cold_followers(hot)(it), "context long, symbols array<long>")
        .repartition("context")
        .select("context", F.explode("symbols").alias("symbol"))
        .groupBy("context", "symbol")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= params.pair_min)
    )
    pairs = written(found, "cold-pairs")
    frequent = spark.createDataFrame(pa.table({"id": np.arange(len(counts)), "c": counts.astype(np.int64)}))
    rare = words.where(F.col("n") < params.word_share * n_tokens).where(F.col("n") >= params.pair_min)
    rare = rare.select(F.expr(RARE_ID).alias("id"), F.col("n").alias("c"))
    # A word is followed as often as it occurs, so its total is its count.
    contexts_of = frequent.union(rare).where(F.col("c") >= params.context_min).withColumnsRenamed({"id": "context", "c": "total"})
    rows = pairs.join(contexts_of, "context")
    # Many pairs end in the same symbol, but symbols are few enough to be broadcast, and rare words are never hot.
    ends = F.broadcast(frequent.withColumnsRenamed({"id": "symbol"}))
    rows = rows.join(ends, "symbol").unionByName(rows.where("symbol < 0").join(rare.withColumnsRenamed({"id": "symbol"}), "symbol"))
    own = Window.partitionBy("context")
    rows = (
        rows.withColumn("root", (F.col("c") + 0.1) / F.lit(n_tokens + 0.1 * (n_words + 1)))
        .withColumn("unstored", F.col("total") - F.sum("n").over(own))
        .withColumn("n_stored", F.count("*").over(own))
        .withColumn("spread", F.col("total") + F.lit(params.smoothing))
        .withColumn("weight", (F.col("unstored") + F.lit(params.smoothing)) / F.col("spread"))
        .withColumn("ratio", F.col("n") / F.col("spread") / F.col("root") + F.col("weight"))
        .withColumn("gain", F.sum(F.col("n") * F.log("ratio")).over(own) + F.col("unstored") * F.log("weight"))
        .where(F.col("gain") >= 0.5 * F.log(F.greatest("total", F.lit(2))) * F.col("n_stored"))
    )
    return written(rows.select("context", "symbol", (F.log10("ratio") - F.log10("weight")).alias("more"), F.log10("weight").alias("unseen")), "cold-states")


def score_cold(texts: DataFrame, model: DataFrame, hot: np.ndarray) -> DataFrame:
    """(row, cold): what the second tier's states add to the log10 probability of each text."""
    states = written(model.groupBy("context").agg(F.max("unseen").alias("unseen")), "cold-contexts")
    sent_states = None
    if states.count() <= MOST_SENT:
        few = states.orderBy("context").toArrow()
        sent_states = sent(texts.sparkSession, (few.column("context").to_numpy(), few.column("unseen").to_numpy()))
    tokens = texts.select("row", "symbols", "rare_ids").mapInArrow(
        lambda it: cold_rows(hot, sent_states and sent_states())(it), "row long, context long, symbol long, below double"
    )
    if sent_states is None:
        tokens = tokens.drop("below").join(states.withColumnRenamed("unseen", "below"), "context")
    added = tokens.join(model.drop("unseen"), ["context", "symbol"], "left")
    return added.groupBy("row").agg(F.sum(F.col("below") + F.coalesce("more", F.lit(0.0))).alias("cold"))


SCORED = "n_tokens long, n_known long, base double, score double"


def score_rows(tree: Tree) -> Batches:
    """Each text's sums over its symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_root = np.log10(tree.root)
        for batch, sym, starts in symbol_parts(batches):
            found = contexts(sym, starts, tree.levels, len(tree.root))
            known = sym >= 0
            base = np.where(known, log_root[sym], 0.0)
            score = np.log10(probabilities(tree, found, sym))
            counted = known if tree.trained else np.zeros(len(sym), bool)
            sums = [np.add.reduceat(x, starts[:-1]) for x in (counted.astype(np.int64), base, score)]
            out = [*batch.columns[:3], pa.array(np.diff(starts)), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:3], "n_tokens", "n_known", "base", "score"])

    return run


def score_texts(docs: DataFrame, held_out: Column, params: TreeParams = TreeParams()) -> DataFrame:
    """Score every row of (doc_id, text) by a tree grown from the rows that are not ``held_out``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) for every row.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"
    )
    train = rows.where(~F.col("held_out"))
    counted = train.select(bytes_of("text").alias("text")).mapInArrow(word_counts, "word binary, n long")
    words = written(counted.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n")), "words")
    n_texts = train.count()
    sums = words.agg(F.sum("n"), F.count("*")).first()
    n_tokens, n_words = (sums[0] or 0) + n_texts, sums[1] + (n_texts > 0)
    ids, counts = frequent_words(words, n_tokens, n_texts, params)
    texts = with_symbols(rows, ids)
    training = texts.where(~F.col("held_out"))
    tree = grow(training, counts, n_tokens, n_words, params)
    hot = tree.levels[0].keys if tree.levels else np.zeros(0, np.int64)
    cold = score_cold(texts, grow_cold(training, words, counts, hot, n_tokens, n_words, params), hot)
    model = sent(spark, tree)
    total = n_tokens + 0.1 * (n_words + 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts.select("row", "doc_id", "held_out", "symbols").mapInArrow(
        lambda it: score_rows(model())(it), f"row long, doc_id {kind}, held_out boolean, {SCORED}"
    )
    logs = F.log10((F.coalesce(F.col("c"), F.lit(0)) + 0.1) / F.lit(total)) * F.col("n")
    below_share = words.where(F.col("n") < params.word_share * n_tokens).select(F.expr(RARE_ID).alias("id"), F.col("n").alias("c"))
    rare = (
        texts.select("row", "rare_ids")
        .mapInArrow(rare_counts, "row long, id long, n long")
        .join(below_share, "id", "left")
        .groupBy("row")
        .agg(F.sum(logs).alias("rare_base"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    )
    return scored.join(rare, "row", "left").join(cold, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_base", F.lit(0.0)) + F.coalesce("cold", F.lit(0.0))).alias("score"),
    )
