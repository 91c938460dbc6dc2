"""Exact, order-independent sums of money held in doubles.

A plain ``sum(double)`` depends on the order in which partitions arrive, and
``sum(decimal)`` takes three times as long because every row builds a BigDecimal.
A finite cost is therefore split, without rounding, into digits of 24 bits from
2^40 and up down to 2^-56, BIGINTs whose sums are exact and stay in whole-stage
codegen, and what lies below 2^-57, a double. The parts add up again at every
level, so partial totals can be rolled up without losing exactness.

A digit has room for 2^39 rows of any size below 2^64; a sum that would
overflow fails the job, whatever ``spark.sql.ansi.enabled`` says. NaN and the
infinities are summed as doubles.
"""

from __future__ import annotations

_DIGITS = ("cost_40", "cost_16", "cost_m8", "cost_m32", "cost_m56")
_EXPONENTS = (40, 16, -8, -32, -56)
_BASE = "16777216"
COST_PARTS = (*_DIGITS, "cost_rest", "cost_loose")


def _scaled(cost: str, exponent: int) -> str:
    """The nearest whole number of units of 2^exponent, as a double; scaling by a power of two is exact."""
    return f"rint({cost} * {2.0 ** -exponent!r}D)"


def cost_parts(cost: str) -> list[str]:
    """The parts of a DOUBLE column, named as in ``COST_PARTS``."""
    finite = f"abs({cost}) < 1e30D"
    parts, above = [], None
    for name, exponent in zip(_DIGITS, _EXPONENTS):
        units = _scaled(cost, exponent)
        digit = units if above is None else f"{units} - {above} * {_BASE}D"
        parts.append(f"CASE WHEN {finite} THEN cast({digit} AS bigint) END AS {name}")
        above = units
    parts.append(f"CASE WHEN {finite} THEN {cost} - {above} * {2.0 ** _EXPONENTS[-1]!r}D END AS cost_rest")
    loose = f"isnan({cost}) OR abs({cost}) = double('infinity')"
    too_large = f"raise_error(concat('cost out of range: ', {cost}))"
    parts.append(f"CASE WHEN {finite} THEN NULL WHEN {loose} THEN {cost} WHEN {cost} IS NOT NULL THEN {too_large} END AS cost_loose")
    return parts


def summed_parts() -> list[str]:
    """The aggregates that add parts up; a digit's overflow fails."""
    digits = [
        f"coalesce(try_sum({c}), CASE WHEN count({c}) > 0 THEN raise_error('cost total out of range') END) AS {c}"
        for c in _DIGITS
    ]
    return [*digits, "sum(cost_rest) AS cost_rest", "sum(cost_loose) AS cost_loose"]


def joined_cost() -> str:
    """The DOUBLE that the (summed) parts stand for; 0.0 where nothing was summed."""
    whole = f"cast(coalesce({_DIGITS[0]}, 0) AS decimal(38, 0))"
    for digit in _DIGITS[1:]:
        whole = f"try_add(try_multiply({whole}, {_BASE}BD), cast(coalesce({digit}, 0) AS decimal(38, 0)))"
    total = f"cast(coalesce({whole}, raise_error('cost total out of range')) AS double) * {2.0 ** _EXPONENTS[-1]!r}D"
    return f"{total} + coalesce(cost_rest, 0D) + coalesce(cost_loose, 0D)"
