"""Line dedup by a deletion-neighbourhood join.

A line is its words; lines with equal words are one line, and of those the earliest, by (doc_id, line number), stays.
Two lines of ``min_near`` words or more are near if one word was replaced, inserted or deleted; of fewer words, one is more
than a fifth. A line goes if an earlier line is near it, whether that one stays or not, so the verdict depends on no order
of processing.

* Segments keep the neighbourhoods small. The shorter length s of a pair fixes segments of ``min(128, s/2)`` words;
  one edit lies in one segment k, so both lines agree on the words before k, counted from the left, and behind k,
  counted from the right. Lines that share (s, k, words before, words behind) with no other line have no near line
  there and emit nothing.
* The others emit their deletion variants in the segment: the hash of the line without one of its words. Lines of equal
  length that share a variant with the same position deleted differ in at most that word. A variant of a longer line
  that equals a whole shorter one is an insertion.
* Links are a star to the earliest line of a group, never all its pairs. Each is verified on the words.

Lines without a word are kept and not listed. Null or empty text: no lines. Null doc_ids come after all others. Rows
with the same doc_id and text are one document, and each returns its verdicts; of rows with the same doc_id and
different texts the order is that of the texts' hashes. Lines of any length are handled whole. Extra columns pass
through ``cleaned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import GAP, WORD, text_of
from spendlake.sources.scratch import written

MIN_NEAR = 5
SEGMENT = 128
MOST_BROADCAST = 64 << 20  # bytes

# A segment of a line of n words, as one of a pair whose shorter line has s words (s = n, or n - 1 if it is the longer
# one): the k-th of its segments, and how many words stand before and behind it.
SEGMENT_WORDS = f"least({SEGMENT}, ({{s}} + 1) div 2)"
SEGMENTS = f"""transform(sequence(0, ({{s}} + {SEGMENT_WORDS} - 1) div {SEGMENT_WORDS} - 1), k -> named_struct(
    's', {{s}}, 'k', k, 'before', k * {SEGMENT_WORDS}, 'behind', greatest({{s}} - (k + 1) * {SEGMENT_WORDS}, 0)))"""
# What surrounds a segment, hashed.
PLACE = """xxhash64({x}.s, {x}.k, slice(words, 1, {x}.before), slice(words, size(words) - {x}.behind + 1, {x}.behind))"""
# The same for lines that have two segments, without a lambda, which generated code does not cover.
TWO_PLACES = """
    xxhash64({s}, 0L, slice(words, size(words) - {s} div 2 + 1, {s} div 2)), xxhash64({s}, 1L, slice(words, 1, ({s} + 1) div 2))"""


def _position() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "line_no", "raw")


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, line_no (from 0), the line and its hash, of every line that has a word."""
    key = F.xxhash64(text_of()).alias("text_key")
    split = docs.select("doc_id", key, F.posexplode(F.split(text_of(), "\n", -1)).alias("line_no", "line"))
    return split.where(F.col("line").rlike(WORD)).withColumn("raw", F.xxhash64("line"))


def _words(line: str) -> Column:
    return F.array_remove(F.split(line, f"{GAP}+", -1), "")


def _segments(min_near: int) -> str:
    own, less = SEGMENTS.format(s="size(words)"), SEGMENTS.format(s="(size(words) - 1)")
    return f"concat(if(size(words) >= {min_near}, {own}, array()), if(size(words) > {min_near}, {less}, array()))"


def _places(min_near: int) -> Column:
    own, less = TWO_PLACES.format(s="size(words)"), TWO_PLACES.format(s="(size(words) - 1)")
    return (
        F.when(F.size("words") > 2 * SEGMENT, F.expr(f"transform({_segments(min_near)}, x -> {PLACE.format(x='x')})"))
        .when(F.size("words") > min_near, F.expr(f"array({own}, {less})"))
        .when(F.size("words") == min_near, F.expr(f"array({own})"))
        .otherwise(F.expr("cast(array() as array<bigint>)"))
    )


def _small(df: DataFrame, more: str = "0") -> DataFrame:
    """To be broadcast if its bytes, counted, are few; else joined as any other. A row is some hashes and numbers, and
    ``more`` bytes."""
    rows, extra = df.agg(F.count("*"), F.coalesce(F.sum(F.expr(f"cast({more} as bigint)")), F.lit(0))).first()
    return F.broadcast(df) if 200 * rows + extra <= MOST_BROADCAST else df


def _id_bytes(column: str) -> str:
    return f"coalesce(octet_length(cast({column} as string)), 0)"


def decide(docs: DataFrame, min_near: int = MIN_NEAR) -> DataFrame:
    """Every line with a word: doc_id, text_key, line_no, n_words, kept, the earliest equal line (first_doc_id,
    first_line_no) and, if one comes before that, the earliest near line (near_doc_id, near_line_no)."""
    hashed = written(
        lines_of(docs).withColumn("words", _words("line")).select(
            "doc_id",
            "text_key",
            "line_no",
            "raw",
            F.size("words").alias("n_words"),
            F.xxhash64("words").alias("h1"),
            F.xxhash64(F.lit(1), "words").alias("h2"),
            _places(min_near).alias("places"),
        ),
        "lines",
    )
    first = written(
        hashed.groupBy("h1", "h2").agg(F.min(_position()).alias("first"), F.first("places").alias("places")), "first-lines"
    )
    places = first.select("h1", "h2", F.explode("places").alias("place"))
    shared = written(places.groupBy("place").agg(F.count("*").alias("n")).where("n > 1").select("place"), "places")
    crowded = places.join(_small(shared), "place", "left_semi").groupBy("h1", "h2").agg(F.collect_set("place").alias("shared"))
    crowded = written(first.drop("places").join(crowded, ["h1", "h2"]).select("h1", "h2", "first.*", "shared"), "crowded")
    near = near_lines(docs, crowded, min_near)
    # Written tables on both sides, so that a line on very many rows can be split at run time.
    decided = hashed.drop("places").join(first.drop("places"), ["h1", "h2"]).join(_small(near, _id_bytes("near.doc_id")), ["h1", "h2"], "left")
    return decided.select(
        "doc_id",
        "text_key",
        F.col("line_no").cast("long").alias("line_no"),
        F.col("n_words").cast("long").alias("n_words"),
        (F.col("near").isNull() & (F.col("first") == _position())).alias("kept"),
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.line_no").cast("long").alias("first_line_no"),
        F.col("near.doc_id").alias("near_doc_id"),
        F.col("near.line_no").cast("long").alias("near_line_no"),
    )


def near_lines(docs: DataFrame, crowded: DataFrame, min_near: int) -> DataFrame:
    """(h1, h2, near): of the given lines (hashes, position, the places they share with others) those with an earlier
    near line, and the earliest such."""
    lines = lines_of(docs).withColumnRenamed("doc_id", "line_doc_id")
    own = F.col("line_doc_id").eqNullSafe(F.col("doc_id"))
    found = lines.join(_small(crowded, f"8 * size(shared) + {_id_bytes('doc_id')}"), ["raw", "text_key", "line_no"]).where(own)
    line_id = F.monotonically_increasing_id().alias("line_id")
    chosen = written(
        found.select("h1", "h2", line_id, _position().alias("first"), "shared", _words("line").alias("words")), "crowded-lines"
    )
    emitted = written(variants(chosen, min_near), "variants")
    common = written(emitted.groupBy("g1", "g2").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "common-variants")
    hits = emitted.join(_small(common), ["g1", "g2"], "left_semi").join(chosen.select("line_id", "h1", "h2", "first"), "line_id")
    hits = written(hits.drop("line_id"), "variant-hits")
    partner = {EITHER: EITHER, LONGER: SHORTER, SHORTER: LONGER}
    leasts = [F.min(F.when(F.col("role") == r, F.col("first"))).alias(f"least_{r}") for r in partner]
    groups = hits.groupBy("g1", "g2").agg(*leasts)
    other = F.coalesce(*[F.when(F.col("role") == r, F.col(f"least_{p}")) for r, p in partner.items()])
    linked = hits.join(written(groups, "variant-groups"), ["g1", "g2"]).select("h1", "h2", "first", other.alias("near"))
    words = chosen.select("first", "words")
    verified = (
        linked.where("near < first")
        .distinct()
        .join(words, "first")
        .join(words.select(F.col("first").alias("near"), F.col("words").alias("other")), "near")
        .where(within_one_edit("words", "other"))
    )
    return written(verified.groupBy("h1", "h2").agg(F.min("near").alias("near")), "near-lines")


EITHER, LONGER, SHORTER = 0, 1, 2


def variants(lines: DataFrame, min_near: int) -> DataFrame:
    """(line_id, role, g1, g2): the hashed deletion variants of (line_id, words, shared) in the places they share."""
    segment = lines.select("line_id", "words", "shared", F.explode(F.expr(_segments(min_near))).alias("x"))
    parts = segment.where(F.expr(f"array_contains(shared, {PLACE.format(x='x')})")).select(
        "line_id",
        F.expr("size(words)").alias("n"),
        "x",
        F.expr("slice(words, 1, x.before)").alias("a"),
        F.expr("slice(words, x.before + 1, size(words) - x.before - x.behind)").alias("m"),
        F.expr("slice(words, size(words) - x.behind + 1, x.behind)").alias("z"),
    )

    def keyed(rows: DataFrame, kind: str, role: int, middle: str, at: str) -> DataFrame:
        key = f"'{kind}', x.s, x.k, {at}, a, {middle}, z"
        return rows.selectExpr("line_id", f"cast({role} as tinyint) as role", f"xxhash64({key}) as g1", f"xxhash64(1, {key}) as g2")

    without = "concat(slice(m, 1, i), slice(m, i + 2, size(m)))"
    each = parts.select("*", F.explode(F.expr("sequence(0, size(m) - 1)")).alias("i"))
    replaced = keyed(each.where("n = x.s"), "replaced", EITHER, without, "i")
    inserted = keyed(each.where("n > x.s"), "inserted", LONGER, without, "0")
    whole = keyed(parts.where("n = x.s"), "inserted", SHORTER, "m", "0")
    return replaced.union(inserted).union(whole)


def within_one_edit(a: str, b: str) -> Column:
    """Whether two arrays of words differ by at most one word replaced, inserted or deleted: what follows their
    common front has to be equal once that one word is skipped."""
    front = f"coalesce(array_position(zip_with({a}, {b}, (x, y) -> not (x <=> y)), true), 0)"
    rest = f"slice({{0}}, {{1}}, size({{0}}))"
    same = lambda i, j: f"{rest.format(a, i)} = {rest.format(b, j)}"
    return F.expr(
        f"""aggregate(array({front}), false, (out, p) -> p = 0 or case
            when size({a}) = size({b}) then {same('cast(p + 1 as int)', 'cast(p + 1 as int)')}
            when size({a}) = size({b}) + 1 then {same('cast(p + 1 as int)', 'cast(p as int)')}
            when size({a}) + 1 = size({b}) then {same('cast(p as int)', 'cast(p + 1 as int)')}
            else false end)"""
    )


def cleaned(docs: DataFrame, min_near: int = MIN_NEAR) -> DataFrame:
    """The rows with the lines that go cut out of ``text``, and ``n_chars``, where there is one, counted again in these rows.

    Rows that had lines with words and have none left are gone, as all of them stand elsewhere.
    """
    gone = (
        decide(docs, min_near)
        .where("not kept")
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        .agg(F.collect_set(F.col("line_no").cast("int")).alias("__gone"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text_of()) == F.col("__key"))
    rows = docs.join(gone, same, "left")
    line_numbers = F.expr("array_except(sequence(0, size(split(text, '\n', -1)) - 1), __gone)")
    rest = F.transform(line_numbers, lambda i: F.get("__lines", i))
    rows = rows.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split("text", "\n", -1)))
    rows = rows.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")))
    rows = rows.where(F.col("__gone").isNull() | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(counted))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
