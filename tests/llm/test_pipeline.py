"""The stages one by one, the whole run against them, and the registration."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from compare import connect, rows_of
from helpers import SF, SF_SMALL, awkward, clashing, empty, read, rows
from test_decontamination import brute_force as contaminated
from test_line_dedup import brute_force as repeated
from test_near_dup import grouped, plain_fingerprint, signed

import __spark_entry__ as driver
from spendlake.llm import chat_format
from spendlake.llm.packing import pack
from spendlake.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES
from spendlake.llm.quality_rules import RULES, Text, passes


def by_hand(docs: list[dict], items: list[tuple]) -> dict[int, str]:
    """What the first four stages leave, on few documents with distinct ids."""
    docs = sorted((d for d in docs if passes(Text(d["text"].encode()), list(RULES.values()))), key=lambda d: d["doc_id"])
    verdicts = repeated([d["text"] for d in docs])
    left = {}
    for n, d in enumerate(docs):
        lines = [line for i, line in enumerate(d["text"].split("\n")) if verdicts.get((n, i), (True,))[0]]
        if re.search(r"[^\x20\x09-\x0d]", "\n".join(lines)):
            left[d["doc_id"]] = "\n".join(lines)
    prints = {i: signed(plain_fingerprint(t)) for i, t in left.items()}
    root, first = grouped(list(set(prints.values())), 2), {}
    for i in sorted(left):
        first.setdefault(root[prints[i]], i)
    left = {i: left[i] for i in sorted(first.values())}
    return {i: t for (i, t), w in zip(left.items(), contaminated(list(left.values()), items)) if not w[-1]}


def test_run_equals_the_stages_by_hand(spark):
    want = by_hand(rows(read(spark, "documents", SF_SMALL)), [tuple(r.values()) for r in rows(read(spark, "benchmark", SF_SMALL))])
    lengths = {i: len(re.findall(r"[^\x20\x09-\x0d]+", t)) + 1 for i, t in want.items()}
    ids = sorted(lengths)
    pieces, bins = pack([lengths[i] for i in ids])
    made = {(ids[text], start, n, number, bins[number].capacity, offset) for text, start, n, number, offset in pieces}
    got = rows(corpus_pipeline.run(spark, SF_SMALL))
    assert {(r["doc_id"], r["start"], r["length"], r["bin"], r["capacity"], r["offset"]) for r in got} == made
    assert len(got) == len(made)


def test_stages_keep_all_columns(spark):
    docs = clashing(read(spark, "documents"))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.simpleString() == before.schema.simpleString()
            assert 0 < docs.count() <= before.count()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_awkward_rows_in_every_stage(spark, name, stage):
    docs = clashing(awkward(spark))
    assert len(rows(stage(spark, docs, SF))) > 0
    assert rows(stage(spark, empty(spark), SF)) == []


def test_queries_are_registered():
    names = [n for n in driver.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names
    assert driver.oracle_sql().keys() >= LLM_ORACLE_SQL.keys() <= LLM_QUERIES.keys()


@pytest.mark.parametrize("name", list(LLM_ORACLE_SQL))
def test_query_equals_sql(spark, name):
    cursor = connect(SF).execute(LLM_ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    df = LLM_QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())
    assert chat_format
