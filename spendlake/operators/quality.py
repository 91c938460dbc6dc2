"""The silver quality suite: 18 rules, counted in one aggregate pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.errors import QualityGateError
from spendlake.functions.casts import quoted
from spendlake.schemas import KNOWN_SOURCES, SILVER_COLUMNS, SILVER_SCHEMA

# Rule type names, as they appear in reports.
COLUMNS_PRESENT = "expect_table_columns_to_match_set"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
PAIR_ORDER = "expect_column_pair_values_a_to_be_greater_than_b"
READ_ERROR = "file_read_error"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("rule", T.IntegerType()),
        T.StructField("expectation_type", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("unexpected_percent", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    expectation_type: str
    description: str
    columns: tuple[str, ...] = ()

    @property
    def column(self) -> str | None:
        return self.columns[0] if self.columns else None

    def violated(self) -> str:
        """TRUE where a row breaks the rule."""
        first = self.columns[0]
        if self.expectation_type == NOT_NULL:
            return is_missing(first)
        if self.expectation_type == IN_SET:
            return f"{first} NOT IN ({', '.join(map(repr, KNOWN_SOURCES))})"
        if self.expectation_type == BETWEEN:
            return f"{first} < 0"
        return f"{self.considered()} AND NOT coalesce({first} >= {self.columns[1]}, false)"

    def considered(self) -> str | None:
        """TRUE where the rule applies to a row; None if it applies to all rows."""
        if self.expectation_type == NOT_NULL:
            return None
        return f"NOT ({' AND '.join(map(is_missing, self.columns))})"


def is_missing(column: str) -> str:
    """NULL, or NaN in a floating-point column."""
    if SILVER_SCHEMA[column].dataType == T.DoubleType():
        return f"({column} IS NULL OR isnan({column}))"
    return f"{column} IS NULL"


RULES: tuple[Rule, ...] = (
    Rule(COLUMNS_PRESENT, "all silver columns are present"),
    *(Rule(NOT_NULL, f"{c} is never null", (c,)) for c in SILVER_COLUMNS),
    Rule(IN_SET, "source is a known platform", ("source",)),
    *(Rule(BETWEEN, f"{c} is at least 0", (c,)) for c in ("impressions", "clicks", "conversions", "cost_brl")),
    Rule(PAIR_ORDER, "impressions are at least clicks", ("impressions", "clicks")),
    Rule(PAIR_ORDER, "clicks are at least conversions", ("clicks", "conversions")),
)


def counted_by(columns: Iterable[str], where: str | None = None) -> list[str]:
    """The counters of all rules on rows with these columns, as SQL aggregates: ``_rows``, and what breaks each rule and what
    each rule applies to. ``where`` chooses the rows that count."""
    have, also = set(columns), f"{where} AND " if where else ""
    counters = [f"count_if({where}) AS _rows" if where else "count(1) AS _rows"]
    for i, rule in enumerate(RULES):
        if rule.columns and have.issuperset(rule.columns):
            counters.append(f"count_if({also}{rule.violated()}) AS _bad_{i}")
            if rule.considered() is not None:
                counters.append(f"count_if({also}{rule.considered()}) AS _seen_{i}")
    return counters


def report_of_counts(counted: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The report that the counters stand for: one row per rule for each row of (source_file, counters)."""
    have, outcomes = set(columns), []
    for i, rule in enumerate(RULES):
        if rule.columns and have.issuperset(rule.columns):
            seen = "_rows" if rule.considered() is None else f"_seen_{i}"
            success, count = f"_bad_{i} = 0", f"_bad_{i}"
            percent = f"CASE WHEN {seen} > 0 THEN _bad_{i} / {seen} * 100D END"
        else:
            passed = not rule.columns and have.issuperset(SILVER_COLUMNS)
            success, count, percent = str(passed).lower(), "cast(NULL AS bigint)", "cast(NULL AS double)"
        column = quoted(rule.column) if rule.column else "cast(NULL AS string)"
        outcomes.append(
            f"{i + 1}, '{rule.expectation_type}', {column}, {quoted(rule.description)}, "
            f"{success}, {count}, {percent}"
        )
    names = ", ".join(f"`{c}`" for c in REPORT_SCHEMA.names[1:])
    return counted.selectExpr("source_file", f"stack({len(RULES)}, {', '.join(outcomes)}) AS ({names})")


def quality_report(silver: DataFrame, source_file: str | Column) -> DataFrame:
    """One row per source file and rule.

    One scan and one aggregate hold all counters, so the shuffle carries one row
    per task and source file. A rule on a missing column fails without a count.
    ``source_file`` names the report, or is the expression to group by.
    """
    counters = map(F.expr, counted_by(silver.columns))
    if isinstance(source_file, str):
        counted = silver.agg(*counters).withColumn("source_file", F.lit(source_file))
    else:
        counted = silver.groupBy(source_file.alias("source_file")).agg(*counters)
    return report_of_counts(counted, silver.columns)


def unreadable_report(spark: SparkSession, source_file: str, error: str) -> DataFrame:
    """The report of a file that cannot be read."""
    row = (source_file, None, READ_ERROR, None, error, False, None, None)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def quality_failures(report: DataFrame) -> DataFrame:
    """The failed rules of a report."""
    return report.where(~F.col("success")).drop("success", "rule")


def quality_summary(report: DataFrame) -> DataFrame:
    """One row per source file: overall verdict and rule counts.

    A file that could not be read evaluated no rule but has one failure.
    """
    return report.groupBy("source_file").agg(
        F.bool_and("success").alias("success"),
        F.count("rule").alias("total_expectations"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def with_missing_sources(summary: DataFrame, sources: Sequence[str] = KNOWN_SOURCES) -> DataFrame:
    """The summary with a row for every known source; all-NULL where none was validated.

    The summary holds one row per source, so the known set is the larger side at most by three.
    """
    known = summary.sparkSession.createDataFrame([(s,) for s in sources], "source_file string")
    return known.join(summary, "source_file", "left")


def gate(summary: DataFrame, mode: str = "fail") -> list[str]:
    """Names of the sources that failed; raises on any if ``mode`` is "fail".

    Sources without a report are tolerated. Collects one row per failed source.
    """
    if mode not in ("fail", "warn"):
        raise ValueError(f"gate mode must be 'fail' or 'warn', not {mode!r}")
    failed = sorted(r.source_file for r in summary.where(~F.col("success")).select("source_file").collect())
    if failed and mode == "fail":
        raise QualityGateError(f"quality rules failed for {failed}")
    return failed
