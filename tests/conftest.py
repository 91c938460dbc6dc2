from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spendlake.plans.session import session  # noqa: E402
from spendlake.schemas import GOLD_TABLES, SILVER_SCHEMA  # noqa: E402
from spendlake.sources.registry import SOURCES  # noqa: E402

AT = datetime(2026, 3, 12, 10, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


RAW_ROWS = {
    "google_ads": [
        ("2026-03-01", "Garden tools", "Spades", 7300, 410, 1234500000, 31.0, "BRL"),
        ("2026-03-02", "Balcony pots", "Clay", 5100, 260, 845250000, 12.0, "BRL"),
    ],
    "meta_ads": [
        ("01/03/2026", "01/03/2026", "Winter boots", "Size 40 up", 9400, 655, 310.75, 48, "TRAFFIC", "BRL"),
        ("02/03/2026", "02/03/2026", "Sandals", "Beach", 2200, 120, 99.5, 7, "REACH", "BRL"),
    ],
    "tiktok_ads": [
        ("2026-03-01 00:00:00", "Bike bells", "Riders", 15800, 930, "412.6", 55, "VIEWS", "BR"),
        ("2026-03-02 00:00:00", "Bike lamps", "Commuters", 8700, 333, "208.15", 21, "VIEWS", "BR"),
    ],
}


@pytest.fixture
def raw(spark):
    """Raw rows of a platform, with single values replaced by keyword."""

    def build(name, **changes):
        spec = SOURCES[name]
        rows = [dict(zip(spec.raw_schema.names, row)) | changes for row in RAW_ROWS[name]]
        return spark.createDataFrame([tuple(r.values()) for r in rows], spec.raw_schema)

    return build


SILVER_ROWS = [
    (date(2026, 3, 1), "google_ads", "Garden", "Spades", 6000, 300, 750.0, 30),
    (date(2026, 3, 1), "google_ads", "Balcony", "Pots", 2000, 60, 120.0, 6),
    (date(2026, 3, 2), "google_ads", "Garden", "Spades", 5000, 200, 500.0, 25),
    (date(2026, 3, 1), "meta_ads", "Garden", "Boots", 4000, 160, 240.0, 16),
    (date(2026, 3, 2), "meta_ads", "Shoes", "Kids", 3000, 90, 135.0, 5),
]


@pytest.fixture
def silver(spark):
    """Silver rows; pass rows, or values that replace those of every row."""

    def build(rows=None, **changes):
        names = SILVER_SCHEMA.names
        full = [(*r, "file.parquet", "2026-03-12T10:00:00") for r in (SILVER_ROWS if rows is None else rows)]
        changed = [tuple((dict(zip(names, r)) | changes).values()) for r in full]
        return spark.createDataFrame(changed, SILVER_SCHEMA)

    return build


GOLD_ROWS = {
    "daily_summary": [
        (date(2026, 3, 1), "google_ads", 8000, 360, 870.0, 36, 4.5, 2.4167, 108.75, 24.1667),
        (date(2026, 3, 2), "meta_ads", 3000, 90, 135.0, 5, 3.0, 1.5, 45.0, 27.0),
    ],
    "campaign_summary": [
        ("google_ads", "Garden", 11000, 500, 1250.0, 55, 4.5455, 2.5, 113.6364, 22.7273),
        ("meta_ads", "Shoes", 3000, 90, 135.0, 5, 3.0, 1.5, 45.0, 27.0),
    ],
    "source_comparison": [
        ("google_ads", 13000, 560, 1370.0, 61, 4.3077, 2.4464, 105.3846, 22.459),
        ("meta_ads", 7000, 250, 375.0, 21, 3.5714, 1.5, 53.5714, 17.8571),
    ],
}


@pytest.fixture
def gold(spark):
    kinds = {"date": "date", "source": "string", "campaign_name": "string", "impressions": "bigint",
             "clicks": "bigint", "conversions": "bigint"}

    def build(table, rows=None, **changes):
        names = GOLD_TABLES[table].columns
        full = [tuple((dict(zip(names, r)) | changes).values()) for r in (rows or GOLD_ROWS[table])]
        return spark.createDataFrame(full, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names))

    return build
