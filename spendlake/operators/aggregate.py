"""Gold tables: additive totals per key and ratios of the totals.

Sums are kept in additive parts (see ``functions.cost``) until a table is
finished. So totals can be computed straight from silver, or from totals at a
finer grain, with identical results. Every aggregate is a partial plus a final
hash aggregate; a hot key shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions.casts import rounded
from spendlake.functions.cost import cost_parts, joined_cost, summed_parts
from spendlake.schemas import GOLD_TABLES, METRICS, RATIOS, gold_table

COUNTERS = ("impressions", "clicks", "conversions")

# Ratio -> (numerator, denominator, factor).
_RATIO_OF = {
    "ctr_pct": ("clicks", "impressions", 100),
    "cpc_brl": ("cost_brl", "clicks", 1),
    "cpm_brl": ("cost_brl", "impressions", 1000),
    "cpa_brl": ("cost_brl", "conversions", 1),
}


def require_silver(silver: DataFrame, columns: Iterable[str]) -> None:
    missing = sorted(set(columns) - set(silver.columns))
    if missing:
        raise ValueError(f"silver lacks the columns {missing}")


def metric_parts(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level metrics in additive form; reads the keys and the four metrics only."""
    require_silver(silver, [*keys, *METRICS])
    return silver.selectExpr(*keys, *COUNTERS, *cost_parts("cost_brl"))


def sum_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add parts up to a coarser grain. A NULL key is a group of its own."""
    counters = [F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in COUNTERS]
    return parts.groupBy(*keys).agg(*counters, *map(F.expr, summed_parts()))


def with_ratios(totals: DataFrame) -> DataFrame:
    """Add CTR, CPC, CPM and CPA of the totals; 0.0 where the denominator is not positive."""
    ratios = []
    for name in RATIOS:
        numerator, denominator, factor = _RATIO_OF[name]
        quotient = f"{numerator} / {denominator}" + (f" * {factor}D" if factor != 1 else "")
        ratios.append(f"CASE WHEN {denominator} > 0 THEN {rounded(quotient, 4)} ELSE 0D END AS {name}")
    return totals.selectExpr("*", *ratios)


def finish(parts: DataFrame, table: str) -> DataFrame:
    """Summed parts as the rows of a gold table."""
    totals = parts.selectExpr(
        *gold_table(table).keys, "impressions", "clicks", f"{joined_cost()} AS cost_brl", "conversions"
    )
    return with_ratios(totals)


def summarize(silver: DataFrame, table: str) -> DataFrame:
    """A gold table from silver, in no order: one shuffle, partitioned by the table's key."""
    keys = gold_table(table).keys
    return finish(sum_parts(metric_parts(silver, keys), keys), table)


def in_order(gold: DataFrame, table: str) -> DataFrame:
    """Gold rows in the table's order; a further, range-partitioned shuffle of the totals."""
    order = [
        F.col(c).desc_nulls_first() if way == "desc" else F.col(c).asc_nulls_first()
        for c, way in gold_table(table).order
    ]
    return gold.orderBy(*order)


def daily_summary(silver: DataFrame) -> DataFrame:
    """Totals and ratios per day and source."""
    return in_order(summarize(silver, "daily_summary"), "daily_summary")


def campaign_summary(silver: DataFrame) -> DataFrame:
    """Totals and ratios per source and campaign."""
    return in_order(summarize(silver, "campaign_summary"), "campaign_summary")


def source_comparison(silver: DataFrame) -> DataFrame:
    """Totals and ratios per source, the costliest first."""
    return in_order(summarize(silver, "source_comparison"), "source_comparison")


def shared_grain(tables: Iterable[str]) -> list[str]:
    """The keys from which all of ``tables`` can be rolled up."""
    return list(dict.fromkeys(k for t in tables for k in GOLD_TABLES[t].keys))


def distinct_sources(silver: DataFrame) -> DataFrame:
    """Number of distinct sources; NULL counts as one."""
    return silver.select("source").distinct().agg(F.count(F.lit(1)).alias("sources"))
