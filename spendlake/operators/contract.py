"""The row contract of silver, as an opt-in split into valid and quarantined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spendlake.functions.casts import rounded
from spendlake.schemas import KNOWN_SOURCES

TEXTS = ("source", "campaign_name", "ad_group_name", "source_file", "transformed_at")
COUNTS = ("impressions", "clicks", "conversions")

# What counts as white space around a source name (code points of the
# Unicode White_Space property plus the four separator controls).
_BLANKS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)


def clean_source(source: str = "source") -> str:
    blanks = "".join(f"\\u{point:04X}" for point in _BLANKS)
    return f"lower(btrim({source}, '{blanks}'))"


def fits_contract() -> str:
    """TRUE or FALSE, never NULL: does the row satisfy every rule?"""
    rules = ["date IS NOT NULL"]
    rules += [f"{c} <> ''" for c in TEXTS]
    rules += [f"{c} >= 0" for c in COUNTS]
    rules += ["cost_brl >= 0 AND NOT isnan(cost_brl)"]
    rules += [f"{clean_source()} IN ({', '.join(map(repr, KNOWN_SOURCES))})"]
    return f"coalesce({' AND '.join(rules)}, false)"


def contract_valid(silver: DataFrame) -> DataFrame:
    """Rows that fit, with the source normalized and the cost rounded to six decimals."""
    changed = {"source": clean_source(), "cost_brl": rounded("cost_brl", 6)}
    return silver.where(fits_contract()).selectExpr(
        *[f"{changed[c]} AS {c}" if c in changed else f"`{c}`" for c in silver.columns]
    )


def contract_quarantine(silver: DataFrame) -> DataFrame:
    """Rows that break the contract, unchanged."""
    return silver.where(f"NOT {fits_contract()}")
