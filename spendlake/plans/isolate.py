"""Run the items of a stage side by side; the failure of one does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from spendlake.errors import NothingToWrite

R = TypeVar("R")
log = logging.getLogger("spendlake")


class Results(dict[str, R | None]):
    """What each item gave, None where there is nothing; why, in ``errors`` for those that failed and in ``skipped`` for
    those that had nothing to do."""

    def __init__(self, done: dict[str, R | None], errors: dict[str, str] | None = None, skipped: dict[str, str] | None = None):
        super().__init__(done)
        self.errors, self.skipped = errors or {}, skipped or {}

    def complete(self) -> Results[R]:
        """Itself, if every item gave something; else an error with all reasons."""
        lost = [f"{item}: {(self.errors | self.skipped).get(item, 'nothing')}" for item, r in self.items() if r is None]
        if lost:
            raise RuntimeError("; ".join(lost))
        return self


def each(
    spark: SparkSession, stage: str, items: Iterable[str], work: Callable[[str], R | None]
) -> Results[R]:
    """``work`` per item, None where it failed or had nothing to do.

    The items' jobs are submitted together, so that one's last tasks do not leave
    the cluster idle. Spark raises most errors at the write, so ``work`` has to
    include the action.
    """
    errors: dict[str, str] = {}
    skipped: dict[str, str] = {}

    def guarded(item: str) -> R | None:
        try:
            result = work(item)
        except NothingToWrite as nothing:
            skipped[item] = str(nothing)
            log.warning("%s | %s skipped: %s", stage, item, nothing)
            return None
        except Exception as error:  # any failure stays with its item
            errors[item] = str(error).split("\n\tat ")[0]
            log.error("%s | %s failed: %s", stage, item, error)
            return None
        if result is None:
            skipped[item] = "no input"
        log.info("%s | %s -> %s", stage, item, result)
        return result

    names = list(items)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        done = dict(zip(names, pool.map(inheritable_thread_target(spark)(guarded), names)))
    return Results(done, errors, skipped)
