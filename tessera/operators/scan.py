"""Running sums and positions by a two-level prefix scan, without a window over a key's rows.

Rows are dealt into blocks by range of (keys, order) and written with their
block.  A window inside each block gives what comes before a row there, one
row per (block, key) what comes before the block.  Since the order is part of
the range, a key that holds half of all rows -- an id, a period of an id, the
rows without id -- is spread over as many blocks as its share of the data, and
no task, window or join ever meets it whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expressions import require_columns, safe_divide
from tessera.session import scratch_dir

BLOCK = "__block"


def deal_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` with ``__block``, ascending by (keys, order), as a written table: block numbers must not change between its readers."""
    number = [blocks] if blocks else []
    dealt = df.repartitionByRange(*number, *[F.col(c) for c in (*keys, *order)]).withColumn(BLOCK, F.spark_partition_id())
    path = scratch_dir(df.sparkSession, "blocks")
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def plus(a: Column, b: Column) -> Column:
    """Sum of the known parts, NULL when both are."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column] | None = None,
                position: str | None = None, blocks: int | None = None) -> DataFrame:
    """``df`` with sums over, and the number of, the rows of the same keys that come before each row.

    ``sums`` maps output columns to expressions; a sum is NULL where no earlier
    row has a known value.  ``position`` names a column for the row's number
    within its keys, from 0.  NULL keys are keys like any other.  Rows of equal
    keys and order come in any order.  At most one row per block, the sums
    before a key that goes on from one block to the next, is broadcast.
    """
    require_columns(df, [*keys, *order], "prefix_scan input")
    sums = dict(sums or {})
    work = {f"__v{i}": e for i, e in enumerate(sums.values())}
    rows = deal_blocks(df.withColumns(work) if work else df, keys, order, blocks)

    totals = rows.groupBy(BLOCK, *keys).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(v) for v in work])
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(BLOCK).alias("__b"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)],
                           F.sum("__n").over(earlier).alias("__n0"), *[F.sum(v).over(earlier).alias(f"{v}0") for v in work])
    before = F.broadcast(before.where("__n0 is not null"))  # keys that began in an earlier block: one a block at most

    inside = Window.partitionBy(BLOCK, *keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"__at": F.row_number().over(inside) - 1, **{v: F.sum(v).over(upto) for v in work}})
    same = F.col(BLOCK) == F.col("__b")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    out = rows.join(before, same, "left")
    found = {name: plus(F.col(f"{v}0"), F.col(v)) for name, v in zip(sums, work)}
    if position:
        found[position] = (F.coalesce("__n0", F.lit(0)) + F.col("__at")).cast("long")
    kept = [F.col(c) for c in df.columns if c not in found]
    return out.select(*kept, *[e.alias(name) for name, e in found.items()])


def experience_clock(df: DataFrame, id_col: str = "id", period_col: str = "season_start", ord_col: str = "ord",
                     out_col: str = "years_in_nba") -> DataFrame:
    """As ``features.experience_clock``: the row's position in its id, by prefix scan."""
    order = [period_col, *([ord_col] if ord_col in df.columns else [])]
    out = prefix_scan(df, [id_col], order, position="__pos")
    return out.withColumn(out_col, F.when(F.col(id_col).isNotNull(), F.col("__pos").cast("int"))).drop("__pos")


def career_rate_to_date(df: DataFrame, stat_cols: Sequence[str], games_col: str = "G", id_col: str = "id",
                        period_col: str = "season_start", ord_col: str = "ord") -> DataFrame:
    """As ``features.career_rate_to_date``: sums over all earlier rows of the id, by prefix scan."""
    require_columns(df, [games_col, *stat_cols], "career_rate_to_date input")
    g = F.col(games_col)
    out = df.withColumns({f"total_{c}": F.col(c) * g for c in stat_cols})
    order = [period_col, *([ord_col] if ord_col in df.columns else [])]
    out = prefix_scan(out, [id_col], order, {"__g": g, **{f"__t_{c}": F.col(f"total_{c}") for c in stat_cols}})
    has_id, cols = F.col(id_col).isNotNull(), {}
    for c in stat_cols:
        rate = safe_divide(F.coalesce(F.col(f"__t_{c}"), F.lit(0.0)), F.col("__g"))
        cols[f"career_{c}_pg"] = F.when(has_id & F.col(f"total_{c}").isNotNull() & g.isNotNull(), rate)
    return out.withColumns(cols).drop("__g", *[f"__t_{c}" for c in stat_cols])
