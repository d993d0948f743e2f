"""Join helpers: duplicate keys, checked one-to-one joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expressions import require_columns


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count.

    NULLs compare equal here (as in a GROUP BY).  Partial aggregation runs
    before the shuffle, so a hot key costs one row per map task.
    """
    require_columns(df, keys, "Identifier columns")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def validate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless ``keys`` uniquely identify each row; return ``df`` unchanged."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"more than one row shares a value of the keys {list(keys)}")
    return df


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str],
                    how: str = "left", check: bool = True) -> DataFrame:
    """Left join on ``keys`` after checking both sides are unique on them.

    NULL keys match each other (``<=>``), as a pandas merge does.
    """
    if check:
        validate_keys(left, keys)
        validate_keys(right, keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
