"""Reports that are one JSON document each, of any length, split among tasks.

A file is read in pieces that end at a closing brace, which Spark splits by byte ranges like lines of text. What a piece means
depends on all text before it: whether it begins inside a string, and what is open there. So there are two passes.

The first follows the structure of each split twice, once as if it began outside a string and once inside, and returns a
few bytes a split: how many containers it closes that it has not opened, and which it leaves open. Split by split these add
up to what is really open where each one begins. The second pass cuts each split into records, knowing that. A record on
the border of splits is put together from its parts, and what is left of a report without its records is checked as a
small report of its own. No task holds more than a record, or what one split has left of the envelope.

The splits of both passes have to be the same; a task that meets an unknown one fails instead of guessing. The driver
holds one entry a split, as it does for any scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.sources.registry import SourceSpec
from spendlake.sources.scratch import written

_STRING = r'"[^"\\]*(?:\\.[^"\\]*)*'
TOKEN = re.compile(rf'(?P<string>{_STRING}(?P<end>")?)|[{{}}\[\]:,]', re.DOTALL)
REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*(?P<end>")?', re.DOTALL)
# A piece that is a whole record without containers inside, and what stands before it.
FLAT = re.compile(rf'(?P<gap>[^"{{}}\[\]]*)(?P<record>\{{[^"{{}}\[\]]*(?:{_STRING}"[^"{{}}\[\]]*)*)', re.DOTALL)
# What may stand between records; a null is no record.
_S = r"[ \t\r\n]*"
FIRST_GAP, GAP = re.compile(rf"{_S}(null{_S},{_S})*"), re.compile(rf"{_S},{_S}(null{_S},{_S})*")
EMPTY_END, END = re.compile(rf"{_S}(null{_S}(,{_S}null{_S})*)?"), re.compile(rf"{_S}(,{_S}null{_S})*")

# The same for whole columns of pieces without their braces. A plain one has no containers inside and neither marks nor escapes
# in its strings, so it changes nothing that is open, whether it begins outside a string or inside one.
_PLAIN = r"""\{[^"{}\[\]\\]*("[^"{}\[\]\\]*"[^"{}\[\]\\]*)*$"""
PLAIN, PLAIN_RECORD = rf"""^[^"{{}}\[\]\\]*{_PLAIN}""", rf"^{_S},{_S}(null{_S},{_S})*{_PLAIN}"

PAIRS = {"}": "{", "]": "["}
Open = tuple[str, str | None]  # the opening character, and the key whose value it begins


class BadReport(ValueError):
    """What was read is no report."""


class Structure:
    """What pieces of a document close and leave open, whatever was open before them."""

    def __init__(self, in_string: bool):
        self.in_string = in_string
        self.closed = ""  # what was not opened here, in the order in which it is closed
        self.opened: list[Open] = []

    def feed(self, piece: str) -> None:
        if "\\" not in piece:
            parts = piece.split('"')
            outside = "".join(parts[1::2] if self.in_string else parts[::2])
            if len(parts) % 2 and self.in_string:
                if not re.search(r"[{}\[\]]", outside):
                    return
            elif len(parts) % 2 and re.fullmatch(r"[^{}\[\]]*\{[^{}\[\]]*\}", outside):
                return
        self._walk(piece)

    def _walk(self, piece: str) -> None:
        last, key = None, None
        for token, at in tokens(piece, self):
            if token[0] == '"':
                last = token
            elif token == ":":
                key = last
            elif token == ",":
                key = None
            elif token in "{[":
                self.opened.append((token, _name(key)))
                key = None
            elif not self.opened:
                self.closed += token
            elif self.opened.pop()[0] != PAIRS[token]:
                # Right for a split that begins elsewhere, wrong for this guess; nothing can follow from it.
                self.closed += "!"


def _name(key: str | None) -> str | None:
    try:
        return None if key is None else json.loads(key)
    except ValueError:
        return None


def tokens(piece: str, state) -> Iterator[tuple[str, int]]:
    """Strings and marks of a piece, and where they begin; ``state.in_string`` is kept up to date."""
    at = 0
    if state.in_string:
        rest = REST_OF_STRING.match(piece)
        if not rest["end"]:
            return
        at, state.in_string = rest.end(), False
    for found in TOKEN.finditer(piece, at):
        if found["string"] and not found["end"]:
            state.in_string = True
            return
        yield found[0], found.start()


@dataclass
class Begin:
    """What is known where a split begins."""

    in_string: bool = False
    opened: tuple[Open, ...] = ()
    began: int = -1  # the split in which the record began that is open, if one is
    length: int = 0  # of the split, in bytes
    last_piece: int = -1  # the number of its piece that no brace ends


def in_records(opened, key: str) -> bool:
    return len(opened) >= 2 and opened[0][0] == "{" and tuple(opened[1]) == ("[", key)


class Cutter:
    """Cuts the pieces of a split into records."""

    def __init__(self, begin: Begin, start: int, key: str):
        self.in_string, self.opened, self.key, self.start = begin.in_string, list(begin.opened), key, start
        self.record: list[str] | None = [] if in_records(self.opened, key) and len(self.opened) > 2 else None
        self.began = begin.began
        # A split begins behind a brace, so there was a record before, or the end of the report.
        self.some, self.done = start > 0, start > 0 and not begin.opened
        self.envelope: list[str] = []

    def between(self) -> bool:
        return len(self.opened) == 2 and in_records(self.opened, self.key)

    def expects_record(self) -> bool:
        """Whether a comma and a record may follow, or the end."""
        return self.record is None and not self.in_string and self.some and self.between()

    def feed(self, piece: str) -> Iterator[tuple[str, int]]:
        """(record, split in which it began, or -1 if that is this one) of each record that ends here."""
        if self.record is None and not self.in_string and self.between():
            flat = FLAT.fullmatch(piece, 0, len(piece) - 1)
            if flat and piece[-1] == "}":
                self._check(flat["gap"], GAP if self.some else FIRST_GAP)
                self.some = True
                yield flat["record"] + "}", -1
                return
        kept_from, last, key = 0, None, None
        for token, at in tokens(piece, self):
            if token[0] == '"':
                if self.between():
                    raise BadReport("a record that is no object")
                last = token
            elif token == ":":
                key = last
            elif token == ",":
                key = None
            elif token in "{[":
                if self.between():
                    self._check(piece[kept_from:at], GAP if self.some else FIRST_GAP)
                    if token == "[":
                        raise BadReport("a record that is no object")
                    self.record, self.began, kept_from = [], self.start, at
                elif not self.opened and (self.done or token == "[" or piece[:at].strip()):
                    raise BadReport("a report is one object")
                self.opened.append((token, _name(key)))
                key = None
                if self.record is None and self.between():
                    self.envelope.append(piece[kept_from : at + 1])
                    kept_from, self.some = at + 1, False
            else:
                if not self.opened or self.opened[-1][0] != PAIRS[token]:
                    raise BadReport(f"a {token} that closes nothing")
                if self.record is None and self.between():
                    self._check(piece[kept_from:at], END if self.some else EMPTY_END)
                    kept_from = at
                self.opened.pop()
                if self.record is not None and self.between():
                    self.record.append(piece[kept_from : at + 1])
                    yield "".join(self.record), -1 if self.began == self.start else self.began
                    self.record, kept_from, self.some = None, at + 1, True
                self.done = not self.opened
        if self.done and piece[kept_from:].rpartition("}")[2].strip():
            raise BadReport("text behind the report")
        (self.envelope if self.record is None else self.record).append(piece[kept_from:])

    @staticmethod
    def _check(gap: str, allowed: re.Pattern) -> None:
        if not allowed.fullmatch(gap):
            raise BadReport(f"not expected between records: {gap.strip()[:80]}")


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.Array]]:
    """The parts of a batch that belong to one split: the split, and the text of its pieces."""
    keys = [c.to_numpy() for c in batch.columns[1:]]
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield tuple(int(k[begin]) for k in keys), batch.column(0).slice(begin, end - begin)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text of all files, ended at closing braces; in order within a split."""
    files = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return files.selectExpr(
        "value",
        "xxhash64(_metadata.file_path) AS file",
        "_metadata.file_block_start AS start",
        "_metadata.file_block_length AS length",
        "_metadata.file_size AS size",
    )


SPLITS = "file long, start long, length long, size long, pieces long, bytes long, guesses string"


def _summaries(pieces: DataFrame) -> DataFrame:
    """One row a split, with what it closes and leaves open for both guesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, count, read, guesses = None, 0, 0, ()

        def row() -> pa.RecordBatch:
            told = json.dumps([[g.in_string, g.closed, g.opened] for g in guesses])
            return pa.RecordBatch.from_pylist([dict(zip(names, (*split, count, read, told)))], schema)

        names = [c.split()[0] for c in SPLITS.split(", ")]
        schema = pa.schema([(n, pa.string() if n == "guesses" else pa.int64()) for n in names])
        for batch in batches:
            for of, values in stretches(batch):
                if split != of:
                    if split is not None:
                        yield row()
                    split, count, read, guesses = of, 0, 0, (Structure(False), Structure(True))
                count, read = count + len(values), read + pc.sum(pc.binary_length(values)).as_py()
                for value in values.filter(pc.invert(pc.match_substring_regex(values, PLAIN))).to_pylist():
                    for guess in guesses:
                        guess.feed(value + "}")
        if split is not None:
            yield row()

    return pieces.mapInArrow(run, SPLITS)


def _begins(splits: list, key: str) -> dict[tuple[int, int], Begin]:
    """What is open where each split begins; fails for files that end too early."""
    out: dict[tuple[int, int], Begin] = {}
    files: dict[int, list] = {}
    for s in splits:
        files.setdefault(s["file"], []).append(s)
    for file, parts in files.items():
        parts.sort(key=lambda s: s["start"])
        # Every piece but the last one is ended by a brace; the last one may be.
        spare = parts[0]["size"] - sum(s["bytes"] + s["pieces"] for s in parts)
        spare -= 3 if spare in (2, 3) else 0  # a byte order mark, which Spark leaves out
        if spare not in (0, -1):
            raise BadReport("a report that is compressed or not UTF-8 cannot be split")
        in_string, opened, began = False, [], -1
        for s in parts:
            begin = out[file, s["start"]] = Begin(in_string, tuple(opened), began, s["length"])
            if s is parts[-1] and spare == -1:
                begin.last_piece = s["pieces"] - 1
            in_string, closed, left = json.loads(s["guesses"])[in_string]
            if begin.last_piece >= 0:  # was followed as if a brace ended it, too
                if closed[-1:] != "}":
                    raise BadReport("a report that ends too early")
                closed = closed[:-1]
            for mark in closed:
                if not opened or opened.pop()[0] != PAIRS.get(mark):
                    raise BadReport("brackets that do not match")
            known = len(opened)
            opened = [*opened, *map(tuple, left)]
            if not in_records(opened, key) or len(opened) < 3:
                began = -1
            elif known < 3:
                began = s["start"]
        if in_string or opened:
            raise BadReport("a report that ends too early")
    return out


CUT = "file long, start long, kind string, began long, text string"


def _cut(pieces: DataFrame, begins: dict[tuple[int, int], Begin], key: str) -> DataFrame:
    """Records (kind r), parts of records on a border (p), and what each split has of the envelope (e)."""
    sent = pieces.sparkSession.sparkContext.broadcast(begins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = [c.split()[0] for c in CUT.split(", ")]
        schema = pa.schema([(n, pa.string() if n in ("kind", "text") else pa.int64()) for n in names])
        split, number, cutter, begin = None, 0, None, None
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = zip(*out) if out else [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return batch

        def close() -> None:
            if cutter.record is not None:
                out.append((*split[:2], "p", cutter.began, "".join(cutter.record)))
            if cutter.envelope:
                out.append((*split[:2], "e", -1, "".join(cutter.envelope)))

        def plain(values: pa.Array) -> pa.RecordBatch:
            records = pc.binary_join_element_wise(pc.replace_substring_regex(values, r"^[^{]*", ""), "}", "")
            of = [pa.repeat(pa.scalar(v, f.type), len(values)) for v, f in zip((*split[:2], "r", -1), schema)]
            return pa.RecordBatch.from_arrays([*of, records], schema=schema)

        for batch in batches:
            for of, values in stretches(batch):
                if split != of:
                    if split is not None:
                        close()
                    split, number, begin = of, 0, known.get((of[0], of[1]))
                    if begin is None or begin.length != of[2]:
                        raise RuntimeError("the splits of the reports have changed; read them again")
                    cutter = Cutter(begin, of[1], key)
                is_plain = pc.match_substring_regex(values, PLAIN_RECORD).to_numpy(zero_copy_only=False)
                if 0 <= begin.last_piece - number < len(values):
                    is_plain[begin.last_piece - number] = False
                others, at = np.append(np.flatnonzero(~is_plain), len(values)), 0
                while at < len(values):
                    end = int(others[np.searchsorted(others, at)])
                    if end > at and cutter.expects_record():
                        yield plain(values.slice(at, end - at))
                        number, at = number + end - at, end
                        continue
                    value = values[at].as_py()
                    text = value if number == begin.last_piece else value + "}"
                    number, at = number + 1, at + 1
                    for record, began in cutter.feed(text):
                        out.append((*of[:2], "r" if began < 0 else "p", began, record))
            yield flushed()
        if split is not None:
            close()
            yield flushed()

    return pieces.mapInArrow(run, CUT)


def report_records(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    """``_record``, the text of each record of the reports below a path, one JSON document a file."""
    pieces = _pieces(spark, path)
    # A split is one row, as it is one entry of the scan's plan on the driver.
    begins = _begins(_summaries(pieces).collect(), spec.envelope_key)
    cut = written(_cut(pieces, begins, spec.envelope_key), "records")

    def joined(rows: DataFrame, *keys: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("start", "text")))
        return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"))

    envelopes = joined(cut.where("kind = 'e'"), "file").where("trim(BOTH ' \t\r\n' FROM text) <> ''")
    parsed = envelopes.select(F.from_json("text", spec.envelope_schema(), {"mode": "FAILFAST"}).alias("report"))
    fields = [f"report.`{f}`" for f in spec.envelope_schema().names]
    parsed.agg(F.max(F.xxhash64(*fields))).collect()  # reads every field, which fails for one of another type
    # A record on a border has one part in each of its splits.
    parts = joined(cut.where("kind = 'p'"), "file", "began")
    return cut.where("kind = 'r'").select(F.col("text").alias("_record")).union(parts.select("text"))
