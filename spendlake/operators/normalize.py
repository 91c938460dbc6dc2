"""Raw platform rows -> silver rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spendlake.errors import ReportLacksFields
from spendlake.functions.casts import or_fail, quoted
from spendlake.schemas import SILVER_COLUMNS
from spendlake.sources.registry import SOURCES, SourceSpec

MEASURES = [c for c in SILVER_COLUMNS if c not in ("source", "source_file", "transformed_at")]
NAMES = ("campaign_name", "ad_group_name")


def require_columns(raw: DataFrame, required: Iterable[str], spec: SourceSpec, source_file: str = "") -> None:
    """Fail at plan time if a raw column is missing; no job runs."""
    missing = set(required) - set(raw.columns)
    if missing:
        raise ReportLacksFields(spec.name, list(missing), source_file)


# Fixed value: what a text that is read as a number consists of. A cast alone also takes blanks and line ends around it, and
# the suffixes, names and hexadecimal forms of a Java literal. Of these characters it takes decimal numbers only.
NUMBER_CHARACTERS = "0123456789+-.eE"
LARGEST = "1.7976931348623157e308D"


def _parsed(spec: SourceSpec, column: str, frame: DataFrame) -> str:
    """One silver column from its raw column; NULL where the raw value does not parse.

    Fractional counts are truncated toward zero.
    """
    raw = f"`{spec.columns[column]}`"
    text = isinstance(frame.schema[spec.columns[column]].dataType, T.StringType)
    if column not in ("date", *NAMES) and text:
        raw = f"CASE WHEN translate({raw}, '{NUMBER_CHARACTERS}', '') = '' THEN {raw} END"
    if column == "date":
        return spec.parse_date(raw)
    if column in NAMES:
        return f"cast({raw} AS string)"
    if column == "cost_brl":
        cost = f"try_cast({raw} AS double)"
        if text:  # one too large for a double would turn into infinity
            cost = f"CASE WHEN abs({cost}) <= {LARGEST} THEN {cost} END"
        return cost if spec.cost_divisor == 1 else f"({cost}) / {spec.cost_divisor}D"
    return f"try_cast({raw} AS bigint)"


def _always_parses(spec: SourceSpec, column: str, raw: DataFrame) -> bool:
    """Can no value of the raw column's type fail? Then no check is generated."""
    kind = raw.schema[spec.columns[column]].dataType
    return column in NAMES or (
        column != "date"
        and isinstance(kind, T.NumericType if column == "cost_brl" else T.IntegralType)
    )


def _strict(spec: SourceSpec, column: str, raw: DataFrame) -> str:
    parsed, name = _parsed(spec, column, raw), spec.columns[column]
    return parsed if _always_parses(spec, column, raw) else or_fail(parsed, f"`{name}`", f"{spec.name}.{name}")


def _silver(source: str, measures: dict[str, str], source_file: str, at: datetime) -> list[str]:
    """Select list in the order of the silver schema."""
    columns = measures | {
        "source": source,
        "source_file": quoted(source_file),
        "transformed_at": quoted(at.isoformat(timespec="seconds")),
    }
    return [f"{columns[c]} AS {c}" for c in SILVER_COLUMNS]


def normalize(raw: DataFrame, spec: SourceSpec, source_file: str, at: datetime) -> DataFrame:
    """One platform's raw rows as silver. A value that does not parse fails the job."""
    require_columns(raw, spec.required, spec, source_file)
    measures = {c: _strict(spec, c, raw) for c in MEASURES}
    return raw.selectExpr(*_silver(quoted(spec.name), measures, source_file, at))


def normalize_lenient(raw: DataFrame, spec: SourceSpec, source_file: str, at: datetime) -> DataFrame:
    """As ``normalize``, but unreadable values become NULL and are named in ``unparsed``."""
    require_columns(raw, spec.required, spec, source_file)
    measures = {c: _parsed(spec, c, raw) for c in MEASURES}
    silver = raw.selectExpr(
        *_silver(quoted(spec.name), measures, source_file, at),
        *[f"`{spec.columns[c]}` IS NOT NULL AS _has_{c}" for c in MEASURES],
    )
    failed = ", ".join(f"CASE WHEN _has_{c} AND {c} IS NULL THEN '{c}' END" for c in MEASURES)
    return silver.selectExpr(*SILVER_COLUMNS, f"array_compact(array({failed})) AS unparsed")


def normalize_mixed(raw: DataFrame, source_file: str, at: datetime) -> DataFrame:
    """Raw rows of all platforms in one wide frame, told apart by ``_source``.

    One narrow projection over one scan. Each row is read by its own platform's
    rules; a ``_source`` that is not known fails the job.
    """
    for spec in SOURCES.values():
        require_columns(raw, [*spec.required, "_source"], spec, source_file)

    def by_platform(column: str) -> str:
        cases = " ".join(f"WHEN {quoted(s.name)} THEN {_strict(s, column, raw)}" for s in SOURCES.values())
        return f"CASE _source {cases} END"

    known = ", ".join(quoted(name) for name in SOURCES)
    unknown = "raise_error(concat('unknown source ', coalesce(_source, 'NULL')))"
    source = f"CASE WHEN _source IN ({known}) THEN _source ELSE {unknown} END"
    return raw.selectExpr(*_silver(source, {c: by_platform(c) for c in MEASURES}, source_file, at))
