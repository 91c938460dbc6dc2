"""Round trips, digests against the rows themselves, the escape against a plain parser."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from helpers import SF, read, rows

from spendlake.llm.chat_format import FOOTER, HEADER, assemble, format_turns, parse_piece, read_back
from spendlake.llm.queries import FORGED, op10_chat_format

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["\\", "#", "##", "###", "####", "#######", "</turn>", "</turn", "<", ">", "\n", "\\\\", "### assistant: ", "</turn>\n", ":", " ", "é", "\U0001f600", "", "ok", "\\</turn>", "\x00"]


def nasty(rng: random.Random) -> str:
    return "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 12)))


def digests(turns: list[tuple]) -> tuple:
    """Of turns (role, text) in order."""
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()


def split_turns(conversation: bytes) -> list[bytes]:
    """Pieces of a whole conversation: an end mark counts unless a backslash stands before it, left to right."""
    out, at, begin = [], 0, 0
    while at < len(conversation):
        if conversation[at : at + 1] == b"\\":
            at += 2
        elif conversation.startswith(FOOTER, at):
            at += len(FOOTER)
            out.append(conversation[begin:at])
            begin = at
        else:
            assert conversation[at : at + 3] != b"###" or at == begin
            at += 1
    assert begin == len(conversation)
    return out


def test_round_trip_of_whole_conversations():
    rng = random.Random(1)
    for _ in range(200):
        turns = [(nasty(rng), nasty(rng)) for _ in range(rng.randint(1, 20))]
        roles, texts = (pa.array([x.encode() for x in column], pa.binary()) for column in zip(*turns))
        pieces, begin, end = assemble(roles, texts)
        made = [p.as_py() for p in pieces]
        assert split_turns(b"".join(made)) == made
        assert [tuple(x.decode() for x in parse_piece(p)) for p in made] == turns
        for piece, a, b in zip(made, begin.tolist(), end.tolist()):
            assert piece.startswith(HEADER) and piece[b:] == FOOTER and piece[a - 2 : a] == b": "


def test_plain_turns_are_readable():
    pieces, _, _ = assemble(pa.array([b"user", b""]), pa.array([b"# Hi <b>#1</b>", b""]))
    assert [p.as_py() for p in pieces] == [b"### user: # Hi <b>#1</b></turn>\n", b"### : </turn>\n"]


def test_slices_of_arrays():
    roles, texts = pa.array([b"a", b"b", b"c"]), pa.array([b"1###", b"2\\", b"</turn>3"])
    whole, _, _ = assemble(roles, texts)
    part, _, _ = assemble(roles.slice(1), texts.slice(1))
    assert part.to_pylist() == whole.to_pylist()[1:]


def test_digests_of_given_conversations(spark):
    turns = rows(read(spark, "conversations"))
    want: dict = {}
    for r in sorted(turns, key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    want[-7] = [(role, text) for _, _, role, text in FORGED]
    got = {r["conv_id"]: r for r in rows(op10_chat_format(spark, SF))}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digests(want[i])
        assert r["formatted_chars"] >= sum(len(role) + len(text) for role, text in want[i])


def test_read_back_from_storage(spark, tmp_path):
    """Pieces written, read in small splits, and shuffled."""
    turns = read(spark, "conversations")
    made = format_turns(turns)
    want = {tuple(r) for r in read_back(made).collect()}
    made.repartition(7).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/pieces")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        stored = spark.read.parquet(f"{tmp_path}/pieces")
        assert stored.rdd.getNumPartitions() > 7
        assert {tuple(r) for r in read_back(stored).collect()} == want
        assert {tuple(r) for r in read_back(stored.orderBy("piece")).collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(want) == turns.select("conv_id").distinct().count()


def test_awkward_rows(spark):
    rng = random.Random(2)
    turns = [(i % 5, t // 3, rng.choice(["assistant", "user", None, "a:b"]), rng.choice([None, nasty(rng)])) for i in range(5) for t in range(40)]
    turns += [(None, 1, "assistant", "x"), (None, None, "assistant", "y"), (6, 0, "assistant", "é" * 3_000_000), (6, 0, "assistant", "b")]
    turns += [(7, i, "assistant", "z") for i in range(30_000)]
    df = spark.createDataFrame(turns, TURNS).selectExpr("*", "'x' as piece", "1 as text_from", "true as learned")
    want: dict = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for r in sorted(turns, key=key):
        want.setdefault(r[0], []).append(r[2:])
    got = {r["conv_id"]: r for r in rows(read_back(format_turns(df)))}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digests(want[i])
    assert rows(read_back(format_turns(df.limit(0)))) == []


def test_what_is_no_piece_is_refused():
    with pytest.raises(ValueError):
        parse_piece(b"### user: x")
