"""Secret scans over a trigram inverted index.

From each rule's regular expression follows a Boolean query of trigrams, which every match must satisfy: an OR of ANDs.
The index has a posting (trigram, text) for the trigrams that some query names. Intersecting the postings gives
each rule's candidate texts, and only those are searched with the expression. A rule without a mandatory trigram is searched for
in every text.

Texts are known in the index by a hash. Texts that share one would share candidates, which costs time but changes
nothing, as every candidate is searched. Copies of a text are one entry.

Null or empty text: no secrets. Repeated rows are each returned. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import lower_ascii, text_of
from spendlake.sources.scratch import written

sre, sre_constants = re._parser, re._constants

Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is valid in Java and in Python. Matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The kinds in the order in which they are listed. Where a minimum is part of a greedy run, {n,} finds
# the same matches as + and a later check.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
)


def _least(query: set[frozenset[str]]) -> Query:
    """Without the clauses that another one implies."""
    return frozenset(c for c in query if not any(other < c for other in query))


def _both(a: Query, b: Query) -> Query:
    return _least({x | y for x, y in product(a, b)})


def _of_strings(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _strings(op: object, value: object) -> set[str] | None:
    """All lowered strings that a node can match; None if they are many."""
    c = sre_constants
    if op is c.LITERAL:
        return {chr(value).lower()}
    if op is c.IN:
        if value[0][0] is c.NEGATE or any(o not in (c.LITERAL, c.RANGE) for o, _ in value):
            return None
        chars = [range(v, v + 1) if o is c.LITERAL else range(v[0], v[1] + 1) for o, v in value]
        return None if sum(map(len, chars)) > 8 else {chr(x).lower() for r in chars for x in r}
    if op is c.SUBPATTERN:
        return _of_sequence(value[-1])
    if op is c.BRANCH:
        parts = [_of_sequence(s) for s in value[1]]
        return None if None in parts else set().union(*parts)
    if op is c.MAX_REPEAT and value[1] is not c.MAXREPEAT and value[1] <= 4:
        inner = _of_sequence(value[2])
        if inner is None or sum(len(inner) ** n for n in range(value[0], value[1] + 1)) > MOST_STRINGS:
            return None
        return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(inner, repeat=n)}
    if op is c.AT:
        return {""}
    return None


def _of_sequence(items: object) -> set[str] | None:
    out = {""}
    for op, value in items:
        strings = _strings(op, value)
        if strings is None or len(out) * len(strings) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in strings}
    return out


def trigram_query(pattern: str | object) -> Query:
    """What every match has, as sets of trigrams of the lowered text, one of which must be there whole."""
    c = sre_constants
    items = sre.parse(pattern) if isinstance(pattern, str) else pattern
    needed, run = ALWAYS, {""}
    for op, value in items:
        strings = _strings(op, value)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        needed, run = _both(needed, _of_strings(run)), {""}
        if op is c.SUBPATTERN:
            needed = _both(needed, trigram_query(value[-1]))
        elif op is c.BRANCH:
            needed = _both(needed, _least(set().union(*(trigram_query(s) for s in value[1]))))
        elif op is c.MAX_REPEAT and value[0] >= 1:
            needed = _both(needed, trigram_query(value[2]))
    return _both(needed, _of_strings(run))


def trigram_index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of the (key, text) given."""
    # The lowered text is used by every test, so it is worked out once a row.
    lowered = texts.select("key", lower_ascii(F.col("text")).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select("key", F.explode(has).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): the rules whose query the key's postings satisfy."""
    have = index.groupBy("key").agg(F.collect_set("trigram").alias("have"))
    kinds = []
    for kind, query in queries.items():
        met = F.lit(False)
        for clause in query:
            met = met | (F.size(F.array_except(F.array(*map(F.lit, sorted(clause))), "have")) == 0)
        kinds.append(F.when(met, F.lit(kind)))
    return have.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


SPANS = "array<struct<start: int, rank: int, kind: string, end: int>>"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of a rule's matches, from the pieces between them and the lengths of both."""
    pattern = F.lit(rule.pattern)
    pieces = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )

    def step(so_far: Column, x: Column) -> Column:
        piece, match, part = (x[n] for n in ("piece", "match", "part"))
        start = so_far["at"] + F.length(piece)
        end = start + F.coalesce(F.length(match), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        keep = match.isNotNull() & (F.length(part) >= rule.least)
        found = F.when(keep, F.concat(so_far["found"], F.array(span))).otherwise(so_far["found"])
        return F.struct(end.alias("at"), found.cast(SPANS).alias("found"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))
    return F.aggregate(pieces, none, step, lambda x: x["found"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """doc_id and, for each rule, an array column named by its kind with the spans in every row of (doc_id, text)."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q != ALWAYS}
    trigrams = sorted({t for q in indexed.values() for clause in q for t in clause})
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("key", F.xxhash64("text"))
    # Written, so that the join can split a text that many rows have.
    found = written(candidates(trigram_index(rows, trigrams), indexed), "candidates")
    none = F.array().cast(SPANS)
    columns = []
    for rank, rule in enumerate(rules):
        wanted = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.col("text").rlike(rule.pattern)
        columns.append(F.when(wanted, spans_of(F.col("text"), rule, rank)).otherwise(none).alias(rule.kind))
    return rows.join(found, "key", "left").select("doc_id", *columns)


def listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then rank, joined by commas."""
    ordered = F.sort_array(F.concat(*map(F.col, kinds)))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The counts, the hash of the base spans and the list of all spans of every row of (doc_id, text)."""
    base, all_kinds = [r.kind for r in BASE_RULES], [r.kind for r in BASE_RULES + MORE_RULES]
    return scan(docs).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(all_kinds).alias("spans"),
    )
