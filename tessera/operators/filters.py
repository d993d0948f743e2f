"""Row filters.  Plain predicates, so Catalyst pushes what it can to the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expressions import is_aggregate_group, require_columns


def filter_min(df: DataFrame, min_value: float = 30, col: str = "G") -> DataFrame:
    """Rows with ``col >= min_value``; NULL fails the test."""
    require_columns(df, [col], "filter_min input")
    return df.where(F.col(col) >= F.lit(min_value))


def drop_components(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                    team_col: str = "Team") -> DataFrame:
    """In periods with more than one distinct non-null group, keep only aggregate rows.

    A split period without an aggregate row disappears altogether, as in the
    reference.  Rows with a NULL id are kept.  ``min <> max`` over the
    (id, period) window is the cheap form of "more than one distinct value".
    """
    require_columns(df, [id_col, period_col, team_col], "drop_components input")
    w = Window.partitionBy(id_col, period_col)
    multi = F.col(id_col).isNotNull() & F.coalesce(F.min(team_col).over(w) != F.max(team_col).over(w), F.lit(False))
    return (df.withColumn("__drop", multi & ~is_aggregate_group(team_col))
            .where(~F.col("__drop")).drop("__drop"))


def drop_components_split(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                          team_col: str = "Team") -> DataFrame:
    """As :func:`drop_components`, from one aggregated row per split (id, period), joined back.

    The groups' least and greatest names are combined before the shuffle, and
    AQE splits a hot (id, period) on the large side of the join; rows without
    id take no part in either.
    """
    require_columns(df, [id_col, period_col, team_col], "drop_components input")
    ends = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__i"), F.col(period_col).alias("__p")).agg(
        F.min(team_col).alias("__lo"), F.max(team_col).alias("__hi"))
    split = ends.where("__lo <> __hi").select("__i", "__p", F.lit(True).alias("__split"))
    out = df.join(split, (F.col(id_col) == F.col("__i")) & F.col(period_col).eqNullSafe(F.col("__p")), "left")
    return out.where(F.col("__split").isNull() | is_aggregate_group(team_col)).drop("__i", "__p", "__split")


def filter_not_equal_keep_null(df: DataFrame, col: str = "years_in_nba", value=0) -> DataFrame:
    """Rows where ``col`` is not ``value``; NULL is kept (``NOT (c <=> v)``)."""
    require_columns(df, [col], "filter_not_equal_keep_null input")
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


# The ids the reference's eye-test filter keeps.
EYE_TEST_IDS = ["jamesle01", "curryst01", "duranke01"]


def filter_in_list(df: DataFrame, ids: Iterable | DataFrame, col: str = "Player-additional") -> DataFrame:
    """Rows whose ``col`` is in ``ids``: a literal IN list, or a left-semi join for a DataFrame.

    A semi join never multiplies rows, whatever the duplicates on the right.
    """
    require_columns(df, [col], "filter_in_list input")
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias("__k"))
        return df.join(keys, df[col] == keys["__k"], "left_semi")
    return df.where(F.col(col).isin(list(ids)))
