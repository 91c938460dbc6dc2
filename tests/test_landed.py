"""What the queries land before they ingest it: how large it is, and that no task writes or reads more than its part."""

from __future__ import annotations

import json
import random
import re
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from spendlake.catalog import derive, queries
from spendlake.plans.ingest import ingest
from spendlake.sources import documents
from spendlake.sources.documents import Begin, Cutter, Structure
from spendlake.sources.registry import SOURCES
from spendlake.sources.snapshots import write_snapshot

RUN = "20260312_090000"


def lines_of(spark, n: int, flags: str = "ANR"):
    return spark.range(0, n, 1, 4).selectExpr(
        "id AS l_orderkey", "id % 100 AS l_suppkey", "cast(id % 7 + 1 AS int) AS l_linenumber",
        "cast(id % 50 + 1 AS double) AS l_quantity", "id % 11 / 100D AS l_discount", "id % 9 / 100D AS l_tax",
        "900D + id % 1000 AS l_extendedprice", f"substr('{flags}', cast(id % {len(flags)} AS int) + 1, 1) AS l_returnflag",
        "'O' AS l_linestatus", "timestamp_ntz'1996-01-01' + make_dt_interval(cast(id % 300 AS int)) AS l_shipdate",
    )


def test_landed_reports_are_compressed_in_files_of_bounded_size(spark, root, monkeypatch):
    monkeypatch.setattr(queries, "REPORTS_A_FILE", 500, raising=False)
    lines = lines_of(spark, 12_000)
    queries._land(spark, lines, f"{root}/landing", RUN, ("struct(*, 1 AS copy)", "struct(*, 2 AS copy)"))
    for name, spec in SOURCES.items():
        run = Path(root, "landing", name, f"landed={RUN}")
        found = spark.read.text(str(run)).selectExpr("value", "_metadata.file_path AS file")
        text = found.selectExpr("sum(length(value) + 1) AS n").first()["n"]
        assert sum(f.stat().st_size for f in run.glob("part-*")) < text / 3
        assert found.groupBy("file").count().agg({"count": "max"}).first()[0] == 500
    rows = ingest(spark, f"{root}/landing", f"{root}/bronze", at=datetime(2026, 3, 12)).complete()
    assert {name: done.rows for name, done in rows.items()} == {name: 8_000 for name in SOURCES}


def test_snapshots_are_written_in_zstd(spark, root):
    path = write_snapshot(spark.range(10), root, "numbers").path
    meta = pq.ParquetFile(next(Path(path).glob("part-*.parquet"))).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_a_document_is_one_file_with_all_records(spark, root):
    lines = lines_of(spark, 25_000, "AN")
    queries._land_document(spark, lines, f"{root}/landing", RUN)
    for name, spec in SOURCES.items():
        (file,) = Path(root, "landing", name, f"landed={RUN}").glob("part-*")
        records = json.loads(file.read_text())[spec.envelope_key]
        raw = derive.raw_report(derive.own_lines(lines, name), spec).selectExpr("to_json(struct(*)) AS r").collect()
        assert sorted(map(json.dumps, records[1:])) == sorted(json.dumps(json.loads(r["r"])) for r in raw)
        assert records[0] is None and len(records) == 1 + {"google_ads": 12_500, "meta_ads": 12_500}.get(name, 0)


def test_text_crosses_to_the_one_writer_in_few_small_rows():
    text = [f', {{"date": "2026-03-{i % 28 + 1:02}", "campaign_name": "Campaign {i}"}}' for i in range(10_000)]
    (block,) = queries._packed(iter([pa.RecordBatch.from_pydict({"value": text})]))
    assert block.num_rows == 1 and block.nbytes < sum(map(len, text)) / 4
    out = [r["value"] for b in queries._unpacked("[", "]")(iter([block])) for r in b.to_pylist()]
    assert out == ["[", "\n".join(text), "]"]


def test_plain_pieces_are_those_that_change_nothing():
    rng, marks = random.Random(1), ['"', "{", ",", ":", " ", "\n", "a", "é", '"k"', '{"k": "v"', "null", "[", "]", "}", "\\", '\\"']
    pieces = ["".join(rng.choices(marks, range(len(marks), 0, -1), k=rng.randint(1, 6))) for _ in range(20_000)]
    values = pa.array(pieces)
    plain = pc.match_substring_regex(values, documents.PLAIN).to_pylist()
    record = pc.match_substring_regex(values, documents.PLAIN_RECORD).to_pylist()
    assert sum(plain) > 500 and sum(record) > 50
    for piece, changes_nothing, is_record in zip(pieces, plain, record):
        if changes_nothing:
            for in_string in (False, True):
                state = Structure(in_string)
                state.feed(piece + "}")
                assert (state.in_string, state.closed, state.opened) == (in_string, "", [])
        if is_record:
            cutter = Cutter(Begin(False, (("{", None), ("[", "rows"))), 5, "rows")
            assert cutter.expects_record()
            assert list(cutter.feed(piece + "}")) == [(re.sub(r"^[^{]*", "", piece) + "}", -1)]
            assert changes_nothing and cutter.expects_record()
