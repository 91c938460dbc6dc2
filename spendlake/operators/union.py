"""Union of per-source silver frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns must agree in name, order and type.

    Spark alone would widen differing types without a word. Duplicates stay.
    """
    first = frames[0]
    for other in frames[1:]:
        if other.dtypes != first.dtypes:
            raise ValueError(f"schemas differ: {first.dtypes} and {other.dtypes}")
    return reduce(DataFrame.unionByName, frames)
