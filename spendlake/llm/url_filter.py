"""URL filters by a cascade of Bloom filters.

The keys a list could name are known: every parent domain of a url's host, with every prefix of its path that is as
long as some listed path. The distinct ones over the whole corpus are the universe. Level 0 is a Bloom filter of the listed
keys, level 1 one of the universe's other keys that level 0 lets through, level 2 one of the listed keys that level 1 lets
through, and so on until nothing passes wrongly. A key of the universe is a member exactly if the first level that
rejects it is odd, or, if none does, if the last level is even. So the test is an expression on the row, without a join.

The filters are literals of the plan. Their size follows the lists, not the corpus; lists whose first filter would
exceed ``MOST_BITS`` are looked up by a join instead.

Null urls and urls without ``://`` have an empty host and path, and no rule fits them. Repeated rows are each
judged. An empty list has no members. Extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import lower_ascii
from spendlake.sources.scratch import written

BITS_PER_KEY = 10
HASHES = 4
MOST_BITS = 1 << 26


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.coalesce(F.regexp_extract(rest, "^([^/?#]*)", 1), F.lit("")))
    return host, F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key that could fit, longest first (of equally long ones that with the longer host)."""
    labels = F.split(host, r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parents = F.filter(parents, lambda p: p != "")
    fronts = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]))
    keys = F.flatten(F.transform(parents, lambda p: F.transform(fronts, lambda f: F.struct(
        (F.length(p) + F.length(f)).alias("size"), F.length(p).alias("host"), F.concat(p, f).alias("key")
    ))))
    return F.transform(F.sort_array(keys, asc=False), lambda k: k["key"])


@dataclass(frozen=True)
class Bloom:
    bits: int
    level: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return bloom_positions(key, self.bits, self.level)

    def has(self, key: Column) -> Column:
        # Folded into one literal array when the plan is optimised.
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        out = F.lit(True)
        for p in self.positions(key):
            word = F.get(words, F.floor(p / 64).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out


def bloom_positions(key: Column, bits: int, level: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def bloom(keys: DataFrame, size: int, level: int) -> Bloom:
    """The filter of ``size`` keys; the driver gets its words, never the keys."""
    bits = 64 * -(-max(size * BITS_PER_KEY, 64) // 64)
    spots = keys.select(F.explode(F.array(*bloom_positions(F.col("key"), bits, level))).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
    found = spots.groupBy(F.floor(F.col("p") / 64).alias("at")).agg(F.bit_or(bit).alias("word")).collect()
    words = [0] * (bits // 64)
    for at, word in found:
        words[at] = word
    return Bloom(bits, level, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def has(self, key: Column) -> Column:
        """Exact for keys of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].has(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def cascade(universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade | None:
    """Of (key, listed); None if the list is too long for a literal."""
    level_keys = {0: universe.where("listed"), 1: universe.where("not listed")}
    levels: list[Bloom] = []
    while True:
        now = len(levels)
        size = level_keys[now % 2].count()
        if not size:
            return Cascade(tuple(levels))
        if size * BITS_PER_KEY > most_bits:
            return None
        levels.append(bloom(level_keys[now % 2], size, now))
        passed = level_keys[(now + 1) % 2].where(levels[-1].has(F.col("key")))
        level_keys[(now + 1) % 2] = passed


def with_members(rows: DataFrame, universe: DataFrame, lists: list[str], most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` with one column ``in_<list>`` each: the members among the array column ``keys``, in its order.

    ``universe`` has ``key`` and a boolean column for each list.
    """
    for name in lists:
        found = cascade(universe.select("key", F.col(name).alias("listed")), most_bits)
        if found is None:
            member = universe.where(name).select("key")
            ids = rows.withColumn("__row", F.monotonically_increasing_id())
            ids = written(ids, "urls")
            hits = ids.select("__row", F.posexplode("keys").alias("at", "key")).join(member, "key", "left_semi")
            hits = hits.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("at", "key"))).alias("hits"))
            joined = ids.join(hits, "__row", "left").drop("__row")
            rows = joined.withColumn(f"in_{name}", F.coalesce(F.col("hits.key"), F.array().cast("array<string>"))).drop("hits")
        else:
            rows = rows.withColumn(f"in_{name}", F.filter("keys", found.has))
    return rows


def judge_urls(
    pages: DataFrame, allow: list[str], block: list[str], bad_labels: list[str], most_bits: int = MOST_BITS
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of (page_id, url).

    The longest fitting rule decides. Where none fits, a url is blocked if its host or a parent of it is on the list
    of bad hosts: the corpus's keys that begin with one of ``bad_labels``.
    """
    rules = allow + block
    lengths = sorted({0, *(len(r) - len(r.split("/")[0]) for r in rules)})
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    keys = rows.select(F.explode("keys").alias("key")).distinct()
    universe = written(
        keys.select(
            "key",
            F.col("key").isin(allow).alias("allow"),
            F.col("key").isin(block).alias("block"),
            (F.substring_index("key", ".", 1).isin(bad_labels) & ~F.col("key").contains("/")).alias("bad"),
        ),
        "url-keys",
    )
    rows = with_members(rows, universe, ["allow", "block", "bad"], most_bits)
    first_allow, first_block = F.get("in_allow", F.lit(0)), F.get("in_block", F.lit(0))
    at_allow, at_block = F.array_position("keys", first_allow), F.array_position("keys", first_block)
    allowed = first_block.isNull() | (at_allow < at_block)
    by_rule = F.when(first_allow.isNotNull() & allowed, F.lit("allow")).when(first_block.isNotNull(), F.lit("block"))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.when(by_rule == "allow", first_allow).when(by_rule == "block", first_block).alias("rule"),
        F.coalesce(by_rule, F.when(F.size("in_bad") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
