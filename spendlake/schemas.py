"""Table schemas, keys and the closed set of platforms."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from spendlake.sources.registry import SOURCES

# The platforms every layer knows, in load order.
KNOWN_SOURCES = tuple(SOURCES)

# The silver columns, and the gold tables' keys and orders further below.

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("ad_group_name", T.StringType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("cost_brl", T.DoubleType()),
        T.StructField("conversions", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("transformed_at", T.StringType()),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.names

METRICS = ("impressions", "clicks", "cost_brl", "conversions")
RATIOS = ("ctr_pct", "cpc_brl", "cpm_brl", "cpa_brl")

INGEST_COLUMNS = ("_source", "_ingested_at")


@dataclass(frozen=True)
class GoldTable:
    """One aggregate table: its natural key and its sort order."""

    keys: tuple[str, ...]
    order: tuple[tuple[str, str], ...]  # (column, "asc" | "desc")

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + METRICS + RATIOS


GOLD_TABLES = {
    "daily_summary": GoldTable(("date", "source"), (("date", "asc"), ("source", "asc"))),
    "campaign_summary": GoldTable(
        ("source", "campaign_name"), (("source", "asc"), ("campaign_name", "asc"))
    ),
    "source_comparison": GoldTable(("source",), (("cost_brl", "desc"),)),
}

@dataclass(frozen=True)
class ServedTypes:
    """Decimal types of the served tables; a value that does not fit fails the load.

    The defaults are fixed values. They hold costs below 10^8 and ratios below
    10^6 per key; larger businesses pass wider types.
    """

    money: T.DecimalType = field(default_factory=lambda: T.DecimalType(14, 6))
    ratio: T.DecimalType = field(default_factory=lambda: T.DecimalType(10, 4))


# Longest texts a served table takes.
SERVED_TEXT_LENGTH = {"source": 50, "campaign_name": 255}


def gold_table(name: str) -> GoldTable:
    if name not in GOLD_TABLES:
        raise KeyError(f"unknown gold table {name!r}; expected one of {list(GOLD_TABLES)}")
    return GOLD_TABLES[name]


def served_schema(name: str, types: ServedTypes = ServedTypes()) -> T.StructType:
    """Declared types of a served table; everything but ``loaded_at`` is NOT NULL."""
    kinds = {
        "date": T.DateType(),
        "source": T.StringType(),
        "campaign_name": T.StringType(),
        "impressions": T.LongType(),
        "clicks": T.LongType(),
        "cost_brl": types.money,
        "conversions": T.LongType(),
    }
    fields = [T.StructField(c, kinds.get(c, types.ratio), False) for c in gold_table(name).columns]
    return T.StructType(fields + [T.StructField("loaded_at", T.TimestampNTZType(), True)])
