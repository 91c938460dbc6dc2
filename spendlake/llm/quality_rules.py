"""Quality rules as a short-circuit cascade.

Each rule says of a text whether it fails. On a sample of the rows every rule is tried by itself: the seconds it
takes and the share of rows it rejects. The rules then run in the order of rejections per second, and a text is
dropped at the first that rejects it. The order changes the cost only, never the verdict.

A rule looks at a ``Text``, which works out each of its features once, when first asked for.

Null or empty text: no words, so ``too_short`` rejects it. A text of any length is looked at whole. Extra columns
pass through ``keep_good`` untouched, repeated rows stay repeated, and an empty table gives an empty table.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import bytes_of

NOT_SYMBOL = bytes(b for b in range(256) if b not in b"#*$%&|<>")
CONTINUATION = bytes(range(0x80, 0xC0))
SHOUTED = re.compile(rb"[A-Z]{2,}")


class Text:
    """The features of one text."""

    def __init__(self, raw: bytes | None) -> None:
        self.raw = raw or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that begin a character."""
        return len(b"".join(self.words).translate(None, CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw.translate(None, NOT_SYMBOL))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that occur twice or more."""
        words = self.words
        if len(words) < 4:
            return 0
        seen = Counter(zip(words, words[1:], words[2:]))
        if len(seen) == len(words) - 2:
            return 0
        total = covered = 0
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if seen[window] > 1:
                total += at + 3 - max(covered, at)
                covered = at + 3
        return total

    @cached_property
    def n_shouted(self) -> int:
        return sum(1 for w in self.words if SHOUTED.match(w))


Rule = Callable[[Text], bool]

# The limits of the rules.
BASE_RULES: dict[str, Rule] = {
    "too_short": lambda t: t.n_words < 50,
    "repetitive": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
}
METHOD_RULES: dict[str, Rule] = {
    "symbols": lambda t: 100 * t.n_symbols > 20 * t.n_words,
    "repeated_lines": lambda t: 100 * t.n_dup_lines > 50 * len(t.lines),
    "short_words": lambda t: t.word_chars < 2 * t.n_words,
    "long_words": lambda t: t.word_chars > 20 * t.n_words,
    "shouted": lambda t: 100 * t.n_shouted > 40 * t.n_words,
}
RULES = BASE_RULES | METHOD_RULES


def profile(docs: DataFrame, rules: dict[str, Rule], fraction: float = 0.02, seed: int = 7) -> dict[str, tuple[float, float]]:
    """For each rule the seconds it takes a row, alone, and the share of rows it rejects, on a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seconds, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
            for raw in batch.column(0).to_pylist():
                for name, fails in rules.items():
                    began = time.perf_counter()
                    rejected[name] += fails(Text(raw))
                    seconds[name] += time.perf_counter() - began
            columns = [list(rules), list(seconds.values()), list(rejected.values()), [batch.num_rows] * len(rules)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rule", "seconds", "rejected", "rows"])

    sums = (
        docs.select(bytes_of().alias("text"))
        .sample(fraction=fraction, seed=seed)
        .mapInArrow(run, "rule string, seconds double, rejected long, rows long")
        .groupBy("rule")
        .agg(F.sum("seconds"), F.sum("rejected"), F.sum("rows"))
    )
    return {r[0]: (r[1] / r[3], r[2] / r[3]) for r in sums.collect() if r[3]}


def ordered(rules: dict[str, Rule], measured: dict[str, tuple[float, float]]) -> list[str]:
    """By rejections per second, most first; rules that were not measured keep their place behind."""
    gain = {name: rejected / max(seconds, 1e-9) for name, (seconds, rejected) in measured.items()}
    return sorted(rules, key=lambda name: -gain.get(name, -1.0))


def passes(text: Text, rules: list[Rule]) -> bool:
    return not any(fails(text) for fails in rules)


def keep_good(docs: DataFrame, rules: dict[str, Rule] = RULES, fraction: float = 0.02) -> DataFrame:
    """The rows whose text no rule rejects, with all their columns."""
    cascade = [rules[name] for name in ordered(rules, profile(docs, rules, fraction))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            mask = pa.array([passes(Text(raw), cascade) for raw in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(mask)

    return docs.withColumn("__text_bytes", bytes_of()).mapInArrow(run, docs.schema)


JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, fraction: float = 0.02) -> DataFrame:
    """doc_id, the base counts and both verdicts of every row of (doc_id, text)."""
    cascade = [METHOD_RULES[name] for name in ordered(METHOD_RULES, profile(docs, METHOD_RULES, fraction))]
    base = list(BASE_RULES.values())
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(1).to_pylist():
                text = Text(raw)
                failed = not passes(text, base)
                rows.append((*(getattr(text, c) for c in counts), failed, not failed and passes(text, cascade)))
            columns = zip(*rows) if rows else [()] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            found = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["doc_id", *counts, "base_failed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", bytes_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {JUDGED}")
