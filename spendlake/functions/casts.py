"""Casts that fail loudly whatever ``spark.sql.ansi.enabled`` says, and rounding."""

from __future__ import annotations


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def or_fail(parsed: str, raw: str, what: str) -> str:
    """``parsed``, raising where it is NULL although ``raw`` holds a value."""
    message = f"concat({quoted(f'{what}: cannot read ')}, cast({raw} AS string))"
    return f"coalesce({parsed}, CASE WHEN {raw} IS NOT NULL THEN raise_error({message}) END)"


def rounded(value: str, digits: int) -> str:
    """Round to ``digits`` decimals, ties to even, on double arithmetic.

    ``round`` on a double goes through BigDecimal and the printed digits, which
    is slow and decides ties by the spelling of the number.
    """
    scale = f"{10**digits}D"
    return f"rint(({value}) * {scale}) / {scale}"
