"""Conversation structure repair by a rank-convergence parallel Viterbi search.

A conversation is well-formed if its roles begin with ``(s?(ua)+)?``. Its turns are edited at least cost: a turn is kept,
given the role that may stand there, or deleted, and empty turns are inserted. Blank and repeated turns have to be
deleted. Among the cheapest edits the one whose letters come first in ASCII is chosen.

The search runs backward over the turns; its state is what the last turn left was, so a cost vector has four entries. A long
conversation is cut into chunks that all start at once, each from a speculative vector: that of a conversation's end. Vectors
that differ by a constant only lead to the same edits, so they are kept without it, and a chunk whose start turns out
otherwise is run again from the vector of its successor, side by side with the old one, only until both differ by a
constant; everything before that stands. Passes are repeated until no start changes. From pass to pass eight times as many
neighbouring chunks are run in one go, so a conversation that never converges still takes only a logarithmic number of passes.
Then the vectors are exact but for constants, and each chunk traces the least edits forward; chunks inside a conversation
first tell where each of the four states would lead them, which gives the state they start in.

Only hashes, codes and places of turns are sorted and searched. Texts are shuffled once, when edits are applied.

Null role or text: one blank. Turns are taken by number, nulls first; turns with equal numbers by a hash of role and text,
and equal ones are all taken. Null conversation: one conversation. Extra columns are ignored; no rows, no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spendlake.llm.common import slices
from spendlake.sources.scratch import written

# What an edit costs, and what a truncated turn costs that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"

# States: what the last turn left was.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWER = (USER, USER, ASSISTANT, USER)  # the state after the role that may stand next
INITIAL = {USER: "u", ASSISTANT: "a"}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}

# A turn's code: its role's initial (s, u, a or another), in capitals if truncated; what has to go: blank or repeated.
OTHER, BLANK, REPEATED = "x", "-", "="
# Turns of a chunk, as a power of two.
CHUNK_BITS = 12

type Vector = tuple[int, int, int, int]


def _with_insertions(base: list[int]) -> Vector:
    """Costs once turns may be inserted before going on."""
    user = min(base[USER], base[ASSISTANT] + INSERT)
    assistant = min(base[ASSISTANT], base[USER] + INSERT)
    return min(base[START], user + INSERT), min(base[SYSTEM], user + INSERT), user, assistant


# A conversation may end at its start or after an assistant.
END: Vector = _with_insertions([0, 99, 99, 0])


def _choices(code: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a turn, by letter; insertions aside."""
    found = [("D", DELETE, state)]
    if code not in (BLANK, REPEATED):
        fault = TRUNCATED if code.isupper() else 0
        if (code.lower(), state) in KEPT:
            found.append(("K", fault, KEPT[code.lower(), state]))
        found.append(("R", REROLE + fault, FOLLOWER[state]))
    return found


class Search:
    """The steps of the search. There are few different vectors, so each step is worked out once a task."""

    def __init__(self):
        self._befores: dict[tuple[Vector, str], tuple[Vector, int, Vector]] = {}
        self._edits: dict[tuple[Vector, str, int], tuple[str, str, int]] = {}

    def before(self, after: Vector, code: str) -> tuple[Vector, int, Vector]:
        """The least costs from before a turn: without their minimum, that minimum, and whole."""
        found = self._befores.get((after, code))
        if found is None:
            whole = _with_insertions([min(cost + after[to] for _, cost, to in _choices(code, s)) for s in range(4)])
            least = min(whole)
            found = self._befores[after, code] = tuple(c - least for c in whole), least, whole
        return found

    def edit(self, after: Vector, code: str, state: int) -> tuple[str, str, int]:
        """The least letters of a cheapest way past a turn, the initials of roles they give, and the state behind it."""
        found = self._edits.get((after, code, state))
        if found is None:
            found = self._edits[after, code, state] = self._edit(after, code, state)
        return found

    def _edit(self, after: Vector, code: str, state: int) -> tuple[str, str, int]:
        whole, letters, roles = self.before(after, code)[2], "", ""
        while True:
            ways = {letter: to for letter, cost, to in _choices(code, state) if cost + after[to] == whole[state]}
            if "D" not in ways and INSERT + whole[FOLLOWER[state]] == whole[state]:
                state = FOLLOWER[state]
                letters, roles = letters + "I", roles + INITIAL[state]
                continue
            letter = min(ways)
            return letters + letter, roles + (INITIAL[ways[letter]] if letter == "R" else ""), ways[letter]

    def head(self, codes: str, end: Vector) -> tuple[Vector, int]:
        """The vector before a chunk, and the constant that was left out of it."""
        total = 0
        for code in reversed(codes):
            end, least, _ = self.before(end, code)
            total += least
        return end, total

    def fixed_up(self, codes: str, end: Vector, used: Vector, head: Vector, cost: int) -> tuple[Vector, int]:
        """``head(codes, end)``, given what it was from ``used``: runs only until both differ by a constant."""
        for code in reversed(codes):
            if end == used:
                return head, cost
            end, new, _ = self.before(end, code)
            used, old, _ = self.before(used, code)
            cost += new - old
        return end, cost

    def trace(self, codes: str, end: Vector, state: int, last: bool) -> tuple[list[str], list[str], int]:
        """Letters and given initials of every turn, and the state behind the chunk; behind the last one the rest is inserted."""
        after = [end]
        for code in reversed(codes[1:]):
            after.append(self.before(after[-1], code)[0])
        letters, roles = [], []
        for code, vector in zip(codes, reversed(after)):
            letter, role, state = self.edit(vector, code, state)
            letters.append(letter)
            roles.append(role)
        while last and state not in (START, ASSISTANT):
            state = FOLLOWER[state]
            letters[-1] += "I"
            roles[-1] += INITIAL[state]
        return letters, roles, state


def _turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text without nulls, and a hash of both that orders equal turns."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", "turn", blank("role"), blank("text"))
    return rows.withColumn("key", F.xxhash64("role", "text"))


def _coded(turns: DataFrame, chunk_bits: int) -> DataFrame:
    """One row a chunk: conv_id, chunk (ascending within a conversation), codes, and (turn, key) of each of its turns."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = F.right(F.trim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    initial = F.left("role", F.lit(1))
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit(OTHER))
    rows = _turns(turns).select(
        "conv_id",
        "turn",
        "key",
        # Splits rows that are equal in all else, whose order does not matter.
        F.monotonically_increasing_id().alias("salt"),
        F.when(end != "", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))).alias("content"),
        F.when(end == "", F.lit(BLANK)).when(end.isin(".", "!", "?"), code).otherwise(F.upper(code)).alias("code"),
    )
    order = ["conv_id", "turn", "key", "salt"]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("salt")
    placed = written(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")
    contents = placed.where("content IS NOT NULL").groupBy("conv_id", "content")
    first = contents.agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    repeated = F.col("content").isNotNull() & F.col("first").isNull()
    marked = placed.join(first, "place", "left").withColumn("code", F.when(repeated, F.lit(REPEATED)).otherwise(F.col("code")))
    chunk = F.shiftright("place", chunk_bits).alias("chunk")
    # A chunk has at most 2^chunk_bits turns.
    gathered = marked.groupBy("conv_id", chunk).agg(F.array_sort(F.collect_list(F.struct("place", "turn", "key", "code"))).alias("turns"))
    codes = F.array_join(F.transform("turns", lambda t: t["code"]), "").alias("codes")
    return written(gathered.select("conv_id", "chunk", codes, "turns"), "chunks")


def _with_id(turns: DataFrame, columns: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", turns.schema["conv_id"].dataType), *T.StructType.fromDDL(columns).fields])


def _mapped(rows: DataFrame, reads: list[str], added: str, run: Callable[..., tuple]) -> DataFrame:
    """``rows`` with columns that ``run`` makes from a search and some columns of each row; the order stays."""
    more = T.StructType.fromDDL(added)
    schema = T.StructType([*rows.schema.fields, *more.fields])
    kinds = to_arrow_schema(more)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()
        for batch in batches:
            made = [run(search, *row) for row in zip(*(batch.column(c).to_pylist() for c in reads))]
            columns = zip(*made) if made else [()] * len(kinds)
            extra = [pa.array(c, f.type) for c, f in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *kinds.names])

    return rows.mapInArrow(mapped, schema)


def _same_conversation(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"])


def _ends(long: DataFrame) -> DataFrame:
    """(conv_id, chunk, end, cost) of the chunks of conversations with several: the vector behind each, once nothing changes."""
    of_conversation = "PARTITION BY conv_id ORDER BY chunk"  # of one row a chunk
    end = ", ".join(map(str, END))
    state = written(
        _mapped(
            long.withColumn("used", F.expr(f"array({end})")),
            ["codes"],
            "head array<int>, cost bigint",
            lambda search, codes: search.head(codes, END),
        ),
        "vectors",
    )
    together = 1
    while True:
        following = f"coalesce(lead(head) OVER ({of_conversation}), array({end})) AS end"
        known = state.selectExpr("*", following, f"row_number() OVER ({of_conversation}) - 1 AS number")
        known = known.withColumn("open", F.col("end") != F.col("used"))
        if known.where("open").isEmpty():
            return known.select("conv_id", "chunk", "end", "cost")
        # Chunks that are run in one go: the last of them starts from what is known, the others from their successor.
        runs = known.withColumn("run", F.expr(f"number div {together}"))
        parts = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = runs.repartition(parts, "conv_id", "run").sortWithinPartitions("conv_id", "run", F.desc("chunk"))
        state = written(dealt.mapInArrow(_fix_up, dealt.schema).select(*state.columns), "vectors")
        together *= 8


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search, run, now = Search(), None, END
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            if run != (row["conv_id"], row["run"]):
                run, now = (row["conv_id"], row["run"]), tuple(row["end"])
            used = tuple(row["used"])
            head, row["cost"] = search.fixed_up(row["codes"], now, used, tuple(row["head"]), row["cost"])
            row["used"], row["head"], now = now, head, head
        yield pa.RecordBatch.from_pylist(rows, batch.schema)


def _starts(ends: DataFrame) -> DataFrame:
    """(conv_id, chunk, end, state, last): the state each chunk starts in. ``ends`` has codes."""
    leads = _mapped(
        ends,
        ["codes", "end"],
        "to array<int>",
        lambda search, codes, end: ([search.trace(codes, tuple(end), s, False)[2] for s in range(4)],),
    )
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    following = leads.select("conv_id", "chunk", "end", "to").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, state = None, START
        for batch in batches:
            states = []
            for conv, to in zip(batch.column("conv_id").to_pylist(), batch.column("to").to_pylist()):
                if conversation != (conv,):
                    conversation, state = (conv,), START
                states.append(state)
                state = to[state]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(states, pa.int32())], ["conv_id", "chunk", "end", "state"])

    kind = ends.schema["conv_id"].dataType.simpleString()
    states = following.mapInArrow(run, f"conv_id {kind}, chunk bigint, end array<int>, state int")
    return states.selectExpr("*", "lead(chunk) OVER (PARTITION BY conv_id ORDER BY chunk) IS NULL AS last")


def least_edits(turns: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The edits of every row of (conv_id, turn, role, text), narrow: conv_id, turn, key (a hash of role and text), place
    (ascending within a conversation), code, letters and the initials of the roles that they give.

    Letters are I (inserted before), then K, R or D of the turn, then I (inserted behind the last turn).
    """
    chunks = _coded(turns, chunk_bits)
    numbers = chunks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    several = chunks.join(numbers, _same_conversation(chunks, numbers), "left_semi").select("conv_id", "chunk", "codes")
    long = written(several, "long-conversations")
    if long.isEmpty():
        known = chunks.selectExpr("*", f"array({', '.join(map(str, END))}) AS end", f"{START} AS state", "true AS last")
    else:
        ends = _ends(long).drop("cost").withColumnsRenamed({"conv_id": "of", "chunk": "at"})
        same = long["conv_id"].eqNullSafe(ends["of"]) & (long["chunk"] == ends["at"])
        starts = _starts(written(long.join(ends, same).drop("of", "at"), "ends")).withColumnsRenamed({"conv_id": "of", "chunk": "at"})
        same = chunks["conv_id"].eqNullSafe(starts["of"]) & (chunks["chunk"] == starts["at"])
        known = chunks.join(starts, same, "left").selectExpr(
            "conv_id",
            "chunk",
            "codes",
            "turns",
            f"coalesce(end, array({', '.join(map(str, END))})) AS end",
            f"coalesce(state, {START}) AS state",
            "coalesce(last, true) AS last",
        )
    traced = _mapped(
        known,
        ["codes", "end", "state", "last"],
        "letters array<string>, roles array<string>",
        lambda search, codes, end, state, last: search.trace(codes, tuple(end), state, last)[:2],
    )
    each = traced.select("conv_id", F.inline(F.arrays_zip("turns", "letters", "roles")))
    return each.select("conv_id", "turns.turn", "turns.key", "turns.place", "turns.code", "letters", "roles")


def _lined_up(turns: DataFrame, edits: DataFrame, keys: list[str]) -> DataFrame:
    """Turns and edits in one order, dealt by ``keys``: the copies of a turn, then their edits."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    null = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    texts = _turns(turns).select("conv_id", "turn", "key", *null("bigint", "place"), "role", "text", *null("string", "code", "letters", "roles"))
    marks = edits.select("conv_id", "turn", "key", "place", *null("string", "role", "text"), "code", "letters", "roles")
    return texts.union(marks).repartition(parts, *keys).sortWithinPartitions("conv_id", "turn", "key", "place")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[dict, str, str]]]:
    """The lined up edits by batch, each with the role and text of its turn."""
    role = text = ""
    for whole in batches:
        for batch in slices(whole, "text"):
            out = []
            for row in batch.to_pylist():
                if row["place"] is None:
                    role, text = row["role"], row["text"]
                else:
                    out.append((row, role, text))
            yield out


def _left(row: dict, role: str, text: str) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the turns that an edit leaves or makes."""
    given = iter(row["roles"])
    for letter in row["letters"]:
        if letter == "I":
            yield letter, ROLES[next(given)], ""
        elif letter == "R":
            yield letter, ROLES[next(given)], text
        elif letter == "K":
            yield letter, role, text


def repair(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place and step (their order), edit (K, R or I), role, text."""
    kind = _with_id(turns, "place long, step int, edit string, role string, text string")
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for edits in _applied(batches):
            rows = [(e["conv_id"], e["place"], i, *left) for e, r, t in edits for i, left in enumerate(_left(e, r, t))]
            yield _batch_of(rows, schema)

    return _lined_up(turns, least_edits(turns), ["conv_id", "turn", "key"]).mapInArrow(run, kind)


def _batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


REPORT = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PRICE = {"D": DELETE, "R": REROLE, "I": INSERT, "K": 0}
LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is told of a conversation, from its turns in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.hashed, self.lines, self.initial = hashlib.sha256(), 0, None

    def add(self, edit: dict, role: str, text: str) -> None:
        code, letters = edit["code"], edit["letters"]
        cut_off = code.isupper()
        self.blank += code == BLANK
        self.duplicate += code == REPEATED
        self.truncated += cut_off
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        self.cost += sum(PRICE[x] for x in letters) + (TRUNCATED if cut_off and "D" not in letters else 0)
        self.audit.append(letters)
        for _, r, t in _left(edit, role, text):
            self.hashed.update((("\n" if self.lines else "") + f"{r}:{t}").encode())
            self.lines += 1

    def row(self) -> tuple:
        counts = self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return *counts, "".join(self.audit), self.hashed.hexdigest()


def report(turns: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cost of its repair, the letters of all edits, and a hash of what is left.

    A hash of a whole conversation is sequential, so its turns stream through one task, in constant memory but for the
    letters, which are one value of the result.
    """
    kind = _with_id(turns, REPORT)
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, told = None, _Conversation()
        for edits in _applied(batches):
            done = []
            for edit, role, text in edits:
                if at != (edit["conv_id"],):
                    if at is not None:
                        done.append((*at, *told.row()))
                    at, told = (edit["conv_id"],), _Conversation()
                told.add(edit, role, text)
            yield _batch_of(done, schema)
        if at is not None:
            yield _batch_of([(*at, *told.row())], schema)

    return _lined_up(turns, least_edits(turns), ["conv_id"]).mapInArrow(run, kind)


def gaps(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps): how many numbers are missing between a conversation's first and last turn."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults that depend on the crc32 of their number: left out, emptied, without
    full stops, twice, or said by the user."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text, role = named("text"), named("role")
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def digest(turns: DataFrame) -> DataFrame:
    """What the repair of the damaged rows did, for every conversation that there was before."""
    hurt = damaged(turns)
    named = turns.select("conv_id").distinct()
    told = report(hurt).withColumnRenamed("conv_id", "of")
    apart = gaps(hurt).withColumnRenamed("conv_id", "at")
    joined = named.join(told, named["conv_id"].eqNullSafe(told["of"]), "left").join(apart, named["conv_id"].eqNullSafe(apart["at"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
