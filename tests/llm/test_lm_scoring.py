"""The tree against a brute-force one, the base against plain counting, held-out accuracy."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, SF_SMALL, awkward, clashing, documents, empty, read, rows
from pyspark.sql import functions as F

from spendlake.llm import lm_scoring
from spendlake.llm.lm_scoring import (
    RARE_ID,
    TreeParams,
    contexts,
    frequent_words,
    grow,
    probabilities,
    rare_counts,
    rare_id,
    score_texts,
    symbol_parts,
    symbol_rows,
    symbols,
    tokens,
    with_symbols,
    word_counts,
)
from spendlake.llm.queries import op1_lm_score

def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0


LOOSE = TreeParams(depth=3, word_share=0.001, context_share=0.002, pair_share=0.0005, smoothing=2.0, context_min=3, pair_min=2)


def tokens_of(text: str | None) -> list[bytes | None]:
    """Words and the end (None)."""
    return [*(text or "").encode().lower().split(), None]


def brute_force(train: list, texts: list, p: TreeParams) -> list[float]:
    """log10 probabilities, with dictionaries of tuples instead of arrays."""
    counts = Counter(t for text in train for t in tokens_of(text))
    total, vocabulary = sum(counts.values()), len(counts)
    base = lambda t: (counts[t] + 0.1) / (total + 0.1 * (vocabulary + 1))
    is_symbol = lambda t: t is None or (counts[t] > 0 and counts[t] >= p.word_share * total)
    following: dict[tuple, Counter] = defaultdict(Counter)
    for text in train:
        history = [None]
        for t in tokens_of(text):
            for n in range(1, p.depth + 1):
                if n <= len(history):
                    following[tuple(history[-n:])][t] += 1
            history.append(t)
    occurs = {s: sum(c.values()) for s, c in following.items()}
    candidates = {
        s for s in following
        if all(is_symbol(t) for t in s) and occurs[s] >= p.context_share * total and occurs[s] >= 1
        # Longer ones are reached through stored pairs of their front.
        and (len(s) == 1 or (s[-1] is not None and occurs[s] >= p.pair_share * total))
    }
    candidates = {s for s in candidates if all(s[:n] in candidates for n in range(1, len(s)))}
    hot = set(candidates)
    states: dict[tuple, tuple[dict, float]] = {}

    def prob(context: tuple, t: bytes | None) -> float:
        if not context:
            return base(t)
        below = prob(context[1:], t)
        if context not in states:
            return below
        stored, weight = states[context]
        return stored.get(t, 0.0) + weight * below

    for n in range(1, p.depth + 1):
        new = {}
        for s in (s for s in candidates if len(s) == n):
            stored = {t: c for t, c in following[s].items() if is_symbol(t) and c >= p.pair_share * total}
            spread, unstored = occurs[s] + p.smoothing, occurs[s] - sum(stored.values())
            weight = (p.smoothing + unstored) / spread
            gain = unstored * math.log(weight)
            for t, c in stored.items():
                above = prob(s[1:], t)
                gain += c * math.log((c / spread + weight * above) / above)
            if stored and gain >= 0.5 * math.log(max(occurs[s], 2)) * len(stored):
                new[s] = {t: c / spread for t, c in stored.items()}, weight
        states |= new
    # Words of the second tier: contexts of one word, by counts instead of shares.
    for s in [s for s in following if len(s) == 1 and s not in candidates and occurs[s] >= p.context_min]:
        stored = {t: c for t, c in following[s].items() if c >= p.pair_min}
        spread, unstored = occurs[s] + p.smoothing, occurs[s] - sum(stored.values())
        weight = (p.smoothing + unstored) / spread
        gain = unstored * math.log(weight) + sum(c * math.log(c / spread / base(t) + weight) for t, c in stored.items())
        if stored and gain >= 0.5 * math.log(max(occurs[s], 2)) * len(stored):
            candidates.add(s)
            states[s] = {t: c / spread for t, c in stored.items()}, weight
    assert p is not LOOSE or any(s not in hot for s in states)
    out = []
    for text in texts:
        history, score = [None], 0.0
        for t in tokens_of(text):
            # The contexts of the tree are found front to back: each needs its front to be a candidate.
            longest = max((tuple(history[-n:]) for n in range(1, min(p.depth, len(history)) + 1) if tuple(history[-n:]) in candidates), key=len, default=())
            score += math.log10(prob(longest, t))
            history.append(t)
        out.append(score)
    return out


def structured(n: int) -> list[str]:
    """Texts in which the next word follows from the last two."""
    rng = np.random.default_rng(3)
    out = []
    for _ in range(n):
        text = ["a", "b"]
        for _ in range(rng.integers(5, 60)):
            sure = {"a": "b", "b": "c" if text[-2] == "a" else "d", "c": "a", "d": "e", "e": "b", "z": "a"}[text[-1]]
            text.append(sure if rng.random() < 0.8 else str(rng.choice(list("abcdez"))))
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("most_sent", [1 << 20, 0])
def test_scores_equal_brute_force(spark, monkeypatch, most_sent):
    texts = [*structured(300), "rare unseen words only", "", None, "A b C\tunseen\n a B", "a a a b b b"]
    monkeypatch.setattr(lm_scoring, "MOST_SENT", most_sent)
    # Too few to be hot: some are symbols, some are not, and what follows them is one or the other.
    texts += [f"a {w} {n} b {w} {n}" for w, n in (("uno", "due"), ("tre", "a"), ("\u00e9t\u00e9", "UNO")) for _ in range(6)]
    texts += [f"seldom{i} b often" for i in range(12)] * 2
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in rows(score_texts(docs, held_out(), LOOSE))}
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    want = brute_force(train, texts, LOOSE)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i]["score"] == pytest.approx(w, abs=1e-6)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_every_context_sums_to_one(spark):
    texts = structured(200)
    docs = documents(spark, texts)
    counts = Counter(w for t in texts for w in t.split())
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    n = sum(counts.values()) + len(texts)
    ids, by_symbol = frequent_words(words, n, len(texts), LOOSE)
    tree = grow(with_symbols(docs.select("text"), ids), by_symbol, n, len(counts) + 1, LOOSE)
    assert sum(int(level.state.sum()) for level in tree.levels) > 5
    unseen = 0.1 / (n + 0.1 * (len(counts) + 2))
    every = np.arange(len(tree.root))
    for depth, level in enumerate(tree.levels):
        for context in range(len(level.keys)):
            chain, index = [], context
            for upper in reversed(tree.levels[: depth + 1]):
                chain.append(index)
                index = upper.suffix[index] if index >= 0 else -1
            found = [np.full(len(every), i) for i in chain[::-1]]
            weight = probabilities(tree, [f[:1] for f in found], np.array([-1]))[0]
            assert probabilities(tree, found, every).sum() + weight * unseen == pytest.approx(1.0)


def test_longest_context_is_found():
    sym, starts, _ = symbols([b"A b", b"", b"b zzz a"], {b"a": 1, b"b": 2})
    assert sym.tolist() == [1, 2, 0, 0, 2, -1, 1, 0]
    assert starts.tolist() == [0, 3, 4, 8]
    assert contexts(sym, starts, [], 3) == []


def test_stored_symbols_are_read_back():
    texts = [b"a b " * 700_000, b"", b"new B new\nother", b"b " * 1_300_000]
    words = {b"a": 1, b"b": 2}
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8, 9, 10]), pa.array(texts)], ["row", "text"])
    stored = list(symbol_rows(words)(iter([batch])))
    assert [r for part in stored for r in part.column("row").to_pylist()] == [7, 8, 9, 10]
    ids = [np.frombuffer(r, "<i8").tolist() for part in stored for r in part.column("rare_ids").to_pylist()]
    assert ids == [[], [], [rare_id(b"new"), rare_id(b"new"), rare_id(b"other")], []]
    rare = [tuple(r.values()) for r in pa.Table.from_batches(rare_counts(iter(stored))).to_pylist()]
    assert sorted(rare) == sorted([(9, rare_id(b"new"), 2), (9, rare_id(b"other"), 1)])
    parts = list(symbol_parts(iter(stored)))
    assert len(parts) > 1
    got = [sym[a:b].tolist() for _, sym, starts in parts for a, b in zip(starts[:-1], starts[1:])]
    sym, starts, _ = symbols(texts, words)
    assert got == [sym[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


def test_base_equals_plain_counting(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows(read(spark, "documents", SF_SMALL))]
    train = Counter(t for i, text in docs if zlib.crc32(str(i).encode()) % 10 for t in tokens_of(text))
    total, vocabulary = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in rows(op1_lm_score(spark, SF_SMALL))}
    assert len(got) == len(docs)
    for i, text in docs:
        own = tokens_of(text)
        want = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (vocabulary + 1))) for t in own)
        assert got[i]["base_score"] == pytest.approx(want, abs=1e-6)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(own), sum(train[t] > 0 for t in own), total)


def test_held_out_texts_score_above_the_unigrams(spark):
    held = read(spark, "documents").transform(lambda d: op1_lm_score(spark, SF)).where("held_out")
    score, base = held.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = rows(score_texts(clashing(docs), held_out(), LOOSE))
    assert len(got) == docs.count()
    assert all(r["n_tokens"] == 1 for r in got if r["doc_id"] in (1, 2, 3))
    assert all(math.isfinite(r["score"]) and not (r["doc_id"] is None and r["held_out"]) for r in got)


def test_no_rows_and_no_training_rows(spark):
    assert rows(score_texts(empty(spark), held_out())) == []
    got = rows(score_texts(documents(spark, ["a b", None]), F.lit(True)))
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(0, 0, 0.0, 0.0)] * 2


def test_ids_of_words_equal_those_of_sql(spark):
    words = ["a", "caf\u00e9", "x" * 100, "\U0001f600"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r["word"]: r["id"] for r in df.selectExpr("word", f"{RARE_ID} AS id").collect()} == {w: rare_id(w.encode()) for w in words}


def test_states_grow_with_the_corpus(spark):
    """Words that stay below every share are contexts all the same."""
    few, many = ([f"lead{i} follow{i}" for i in range(n)] * 10 for n in (50, 1000))
    shares = TreeParams(word_share=0.1, context_share=0.1, pair_share=0.1)
    for texts in (few, many):
        got = rows(score_texts(documents(spark, texts), F.lit(False), shares))
        assert all(r["score"] > r["base_score"] + 0.5 for r in got)


ODD = [b" a  B\tc ", b"", b"   ", b"x\n", b"\x0b\x0cq\x1cr\xff \xc3\x89t\xc3\x89\xc2\xa0z", b"A" * 10, b"a b A"]


@pytest.mark.parametrize("texts", [ODD, ODD[1:3], [b"one"], []])
def test_words_equal_those_of_split(texts):
    """Each distinct word of a part comes once, whatever stands around and before it."""
    column = pa.array([b"cut off ", *texts], pa.binary())[1:]
    words, index, sizes = tokens(column)
    words, left = words.to_pylist(), iter(index.tolist())
    assert [[words[next(left)] for _ in range(n)] for n in sizes.tolist()] == [t.lower().split() for t in texts]
    assert len(set(words)) == len(words)


def test_words_are_counted_past_a_flush(monkeypatch):
    monkeypatch.setattr(lm_scoring, "FLUSH", 8)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"]) for texts in (ODD, ODD[::-1], [], [b"x" * 5000, b" "], ODD)]
    got: Counter[bytes] = Counter()
    for batch in word_counts(iter(batches)):
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            got[word] += n
    assert got == Counter(w for b in batches for t in b.column("text").to_pylist() for w in t.lower().split())
    assert min(got.values()) > 0
