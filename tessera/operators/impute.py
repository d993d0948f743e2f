"""Panel imputation: gap periods, static attributes, linear anchors.

All three are window computations partitioned by the entity id, so after a
single ``repartition(id)`` they run without further shuffles.  Nothing is
collected; no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import require_columns


def fill_gap_periods(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                     games_col: str = "G", flag_col: str = "did_play",
                     ord_col: str = "ord") -> DataFrame:
    """Add one row per missing integer period between an id's first and last.

    New rows carry only the id and the period; every other column is NULL.
    ``games_col`` NULL becomes 0 on every row (observed rows too) and
    ``flag_col = games_col > 0``.  Rows with a NULL id are dropped.  All rows
    of a split period are kept.

    Plan: one ``lead`` over (id ORDER BY period, ord), then ``posexplode`` of
    the gap sequence -- no grid, no join, no union.  Only the last row of a
    period sees the next period, so each gap is emitted once.
    """
    require_columns(df, [id_col, period_col, games_col], "fill_gap_periods input")
    others = [c for c in df.columns if c not in (id_col, period_col)]
    w = Window.partitionBy(id_col).orderBy(F.col(period_col), F.col(ord_col)) \
        if ord_col in df.columns else Window.partitionBy(id_col).orderBy(period_col)
    p = F.col(period_col)
    nxt = F.lead(p).over(w)
    gaps = F.when(nxt > p + 1, F.sequence(p + 1, nxt - 1)).otherwise(F.array())
    exploded = (
        df.where(F.col(id_col).isNotNull())
        .withColumn("__periods", F.concat(F.array(p), gaps).cast(T.ArrayType(df.schema[period_col].dataType)))
        .select(id_col, F.posexplode("__periods").alias("__pos", "__period"), *others)
    )
    keep = F.col("__pos") == 0
    out = exploded.select(
        id_col,
        F.col("__period").alias(period_col),
        *[F.when(keep, F.col(c)).alias(c) for c in others],
    )
    g = F.coalesce(F.col(games_col), F.lit(0).cast(df.schema[games_col].dataType))
    return out.withColumn(games_col, g).withColumn(flag_col, g > 0)


def fill_static(df: DataFrame, static_cols: Sequence[str], id_col: str = "id",
                period_col: str = "season_start", ord_col: str = "ord",
                as_of: bool = False) -> DataFrame:
    """Give every row of an id the id's latest non-null value of each column.

    The default reproduces the reference: the value is taken over the whole
    history, so earlier rows see later values.  ``as_of=True`` only looks at
    rows up to the current one (no future knowledge).  NULL ids stay NULL.
    """
    require_columns(df, [id_col, period_col, *static_cols], "fill_static input")
    order = [F.col(period_col)] + ([F.col(ord_col)] if ord_col in df.columns else [])
    w = Window.partitionBy(id_col).orderBy(*order)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if as_of else Window.unboundedFollowing)
    has_id = F.col(id_col).isNotNull()
    return df.withColumns({
        c: F.when(has_id, F.last(c, ignorenulls=True).over(w)) for c in static_cols
    })


def anchor_linear(df: DataFrame, value_col: str = "Age", id_col: str = "id",
                  period_col: str = "season_start", ord_col: str = "ord") -> DataFrame:
    """Rewrite ``value_col`` as anchor value + (period - anchor period).

    The anchor is the id's first row (by period, then ord) with a non-null
    value.  Every row is overwritten, earlier rows count back; an id with no
    known value gets NULL.  ``min_by`` as a window aggregate skips rows whose
    ordering key is NULL, so no join or filter is needed.
    """
    require_columns(df, [id_col, period_col, value_col], "anchor_linear input")
    v = F.col(value_col)
    o = F.col(ord_col) if ord_col in df.columns else F.lit(0)
    key = F.when(v.isNotNull(), F.struct(F.col(period_col).alias("p"), o.alias("o")))
    anchor = F.min_by(F.struct(F.col(period_col).alias("p"), v.alias("v")), key) \
        .over(Window.partitionBy(id_col))
    value = anchor["v"] + (F.col(period_col) - anchor["p"])
    return df.withColumn(value_col, F.when(F.col(id_col).isNotNull(), value.cast(df.schema[value_col].dataType)))
