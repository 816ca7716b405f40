"""Steps that an institution adds behind extraction."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOOKS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_hook(institution: str) -> Callable:
    """Registers a function from DataFrame to DataFrame for an institution's records; the last one holds."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        HOOKS[institution] = f
        return f

    return add


def apply_hooks(records: DataFrame) -> DataFrame:
    """Records with each institution's hook applied to its slice; others as they are."""
    if not HOOKS:
        return records
    rest = records.where(~F.coalesce(F.col("institution_id").isin(list(HOOKS)), F.lit(False)))
    done = [records.where(F.col("institution_id") == name).transform(hook).select(records.columns) for name, hook in HOOKS.items()]
    return reduce(DataFrame.unionByName, done, rest)
