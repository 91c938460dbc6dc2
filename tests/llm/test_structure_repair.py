"""Edits against a search over all of them, chunked searches against whole ones, reports against a plain version."""

from __future__ import annotations

import hashlib
import heapq
import random
import re

import pytest
from helpers import SF_SMALL, read, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlake.llm import structure_repair as sr
from spendlake.llm.queries import op12_structure_repair

TURNS = "conv_id long, turn long, role string, text string"
CODES = "suaxSUAX-="


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and letters, by trying all edits in the order of (cost, letters)."""
    queue, done = [(0, "", 0, "")], set()
    while True:
        cost, letters, i, roles = heapq.heappop(queue)
        if i == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters
        tail = roles[-2:] if roles != "s" else "s"
        if (i, tail, bool(roles)) in done or not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        done.add((i, tail, bool(roles)))
        for r in "ua":
            heapq.heappush(queue, (cost + 2, letters + "I", i, roles + r))
        if i < len(codes):
            heapq.heappush(queue, (cost + 3, letters + "D", i + 1, roles))
            if codes[i] not in "-=":
                fault = codes[i].isupper()
                heapq.heappush(queue, (cost + fault, letters + "K", i + 1, roles + codes[i].lower()))
                for r in "ua":
                    heapq.heappush(queue, (cost + 2 + fault, letters + "R", i + 1, roles + r))


def price(letters: str, codes: str) -> int:
    plain = iter(codes)
    return sum(2 if x == "I" else {"D": 3, "K": 0, "R": 2}[x] + (next(plain).isupper() and x != "D") for x in letters)


def whole(codes: str) -> str:
    return "".join(sr.Search().trace(codes, sr.END, sr.START, True)[0])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=CODES, min_size=1, max_size=9))
def test_cheapest_and_least(codes):
    cost, letters = cheapest(codes)
    assert whole(codes) == letters
    assert price(letters, codes) == cost
    vector, left_out = sr.Search().head(codes, sr.END)
    assert vector[sr.START] + left_out == cost


@given(st.text(alphabet=CODES, max_size=30), st.text(alphabet=CODES, max_size=12))
def test_fixing_up_equals_running_again(codes, behind):
    search = sr.Search()
    end, _ = search.head(behind, sr.END)
    speculative = search.head(codes, sr.END)
    assert search.fixed_up(codes, end, sr.END, *speculative) == search.head(codes, end)


def coded(turns: list[tuple]) -> str:
    """Codes of (role, text) in order."""
    seen, out = set(), ""
    for role, text in turns:
        stripped = text.rstrip(sr.BLANKS)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not stripped:
            out += "-"
            continue
        out += "=" if (role, text) in seen else initial if stripped[-1] in ".!?" else initial.upper()
        seen.add((role, text))
    return out


def told(turns: list[tuple]) -> dict:
    """The report of (role, text) in order."""
    codes = coded(turns)
    letters = whole(codes)
    lines, i, roles = [], 0, ""
    for x in letters:
        needed = "a" if roles.endswith("u") else "u"
        if x == "I":
            lines.append(f"{sr.ROLES[needed]}:")
            roles += needed
            continue
        role, text = turns[i]
        i += 1
        if x != "D":
            lines.append(f"{sr.ROLES[needed] if x == 'R' else role}:{text}")
            roles += needed if x == "R" else role[0]
    assert re.fullmatch("(s?(ua)+)?", roles)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
    return {
        "blank": codes.count("-"),
        "duplicate": codes.count("="),
        "truncated": sum(c.isupper() for c in codes),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": price(letters, codes),
        "audit": letters,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def by_conversation(turns: list[tuple]) -> dict:
    """{conv_id: [(role, text)]} of rows with distinct or equal (turn, role, text)."""
    out: dict = {}
    for c, t, role, text in sorted(turns, key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((" " if role is None else role, " " if text is None else text))
    return out


def random_turns(rng: random.Random, conversation, n: int, roles: list, texts: list) -> list[tuple]:
    return [(conversation, i, rng.choice(roles), rng.choice(texts)) for i in range(n)]


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
TEXTS = ["Yes.", "no", " \t\n", "", None, "Why? \n", "é!", *[f"text {i}." for i in range(40)], *[f"cut {i}" for i in range(40)]]


def test_reports_of_awkward_rows(spark):
    rng = random.Random(4)
    turns = [t for c in [*range(30), None] for t in random_turns(rng, c, rng.randint(1, 12), ROLES, TEXTS)]
    turns += [(40, None, "user", "a"), (40, 3, "assistant", "b."), (40, 3, "assistant", "b."), (41, 0, "user", "x" * 3_000_000 + ".")]
    df = spark.createDataFrame(turns, TURNS).selectExpr("*", "1 as place", "'x' as code", "2L as key", "'q' as letters", "3 as chunk")
    want = {c: told(t) for c, t in by_conversation(turns).items()}
    got = {r.pop("conv_id"): r for r in rows(sr.report(df))}
    assert got == want
    assert rows(sr.report(df.limit(0))) == [] == rows(sr.digest(df.limit(0)))


def test_repaired_turns(spark):
    rng = random.Random(6)
    turns = [t for c in range(20) for t in random_turns(rng, c, rng.randint(1, 9), ROLES, TEXTS)]
    got: dict = {}
    for r in sorted(rows(sr.repair(spark.createDataFrame(turns, TURNS))), key=lambda r: (r["place"], r["step"])):
        got.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for c, t in by_conversation(turns).items():
        assert hashlib.sha256("\n".join(got.get(c, [])).encode()).hexdigest() == told(t)["repaired_sha256"]


@pytest.mark.parametrize("roles", [["user", "assistant"], ["tool"], ROLES])
def test_long_conversations_in_chunks(spark, roles, monkeypatch):
    """Chunks of four turns; the roles of the second case never let vectors converge."""
    rng = random.Random(8)
    turns = random_turns(rng, 1, 150, roles, [f"text {i}." for i in range(1000)]) + random_turns(rng, None, 61, roles, TEXTS)
    turns += [t for c in range(2, 12) for t in random_turns(rng, c, 3, roles, TEXTS)]
    df = spark.createDataFrame(turns, TURNS).repartition(5)
    passes = []
    monkeypatch.setattr(sr, "written", lambda d, label, f=sr.written: passes.append(label) or f(d, label))
    edits = rows(sr.least_edits(df, chunk_bits=2))
    got: dict = {}
    for r in sorted(edits, key=lambda r: r["place"]):
        got[r["conv_id"]] = got.get(r["conv_id"], "") + r["letters"]
    assert got == {c: told(t)["audit"] for c, t in by_conversation(turns).items()}
    assert passes.count("vectors") <= 5


def test_costs_of_chunks_add_up(spark):
    rng = random.Random(10)
    turns = random_turns(rng, 1, 100, ROLES, [f"text {i}" for i in range(1000)])
    chunks = sr._coded(spark.createDataFrame(turns, TURNS), 3).select("conv_id", "chunk", "codes")
    ends = rows(sr._ends(chunks))
    first = min(rows(chunks), key=lambda r: r["chunk"])
    end = next(tuple(r["end"]) for r in ends if r["chunk"] == first["chunk"])
    vector, _ = sr.Search().head(first["codes"], end)
    assert len(ends) > 10
    assert sum(r["cost"] for r in ends) + vector[sr.START] == told(by_conversation(turns)[1])["cost"]


def test_given_conversations(spark):
    got = rows(op12_structure_repair(spark, SF_SMALL))
    named = {r["conv_id"] for r in rows(read(spark, "conversations", SF_SMALL))}
    assert {r["conv_id"] for r in got} == named and len(got) == len(named)
    assert {x for r in got for x in r["audit"]} == set("DIKR")
    for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "gaps")):
        assert any(r[name] for r in got), (i, name)


def test_conversations_of_which_nothing_is_left(spark):
    """A row whose number has the fault that leaves it out."""
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = rows(sr.digest(spark.createDataFrame([(gone, 0, "user", "x")], TURNS)))
    nothing = hashlib.sha256().hexdigest()
    assert got == [dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"conv_id": gone, "audit": "", "repaired_sha256": nothing}]
