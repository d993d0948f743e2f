"""Approximate quantiles from mergeable sketches with a stated rank error.

A sketch (KLL, one of Spark's aggregates) has a fixed size whatever it sums
up, so no task ever holds a column: a task sends one sketch a column, and
sketches written for parts of a table (a day, a period) merge into that of
the whole without reading the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: its rank error is about 0.07 %.
SKETCH_SIZE = 4096


def rank_error(k: int = SKETCH_SIZE) -> float:
    """Share of the rows by which the rank of a value that a sketch of size ``k`` returns may be off, 99 times in 100."""
    return 2.296 / k ** 0.9723


def _known(c: str) -> Column:
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per column, named like it, for each group of ``by``; NULL and NaN don't count."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(_known(c), F.lit(k)).alias(c) for c in cols])


def merge_sketches(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger groups from those of smaller ones, without the rows."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(F.col(f"`{c}`")).alias(c) for c in cols])


def sketch_count(c: str) -> Column:
    """Number of values that a sketch sums up."""
    return F.kll_sketch_get_n_double(F.col(f"`{c}`"))


def sketch_quantile(c: str, share: float) -> Column:
    """The value that ``share`` of the values reach at most; NULL without values."""
    return F.when(sketch_count(c) > 0, F.kll_sketch_get_quantile_double(F.col(f"`{c}`"), F.lit(float(share))))


def approx_medians(df: DataFrame, cols: Sequence[str], k: int = SKETCH_SIZE) -> dict[str, float | None]:
    """Median of each column up to :func:`rank_error`, in one pass; None without values.  One row reaches the driver."""
    if not cols:
        return {}
    row = quantile_sketches(df, cols, (), k).select(*[sketch_quantile(c, 0.5).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def quantile_cuts(df: DataFrame, cols: Sequence[str], n: int, k: int = SKETCH_SIZE) -> list[list[float]]:
    """At most ``n`` ascending cuts of each column: its least value, so that rare larger ones are told apart, and quantiles.

    The largest value is no cut.  As many cuts reach the driver as there are
    columns times ``n``.
    """
    if not cols:
        return []
    shares = [i / n for i in range(1, n)]
    sk = quantile_sketches(df, cols, (), k)
    low = df.agg(*[F.min(_known(c)).alias(f"l{i}") for i, c in enumerate(cols)], *[F.max(_known(c)).alias(f"h{i}") for i, c in enumerate(cols)])
    values = sk.select(*[F.when(sketch_count(c) > 0, F.kll_sketch_get_quantile_double(
        F.col(f"`{c}`"), F.array(*[F.lit(s) for s in shares]))).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    ends, out = low.first(), []
    for i in range(len(cols)):
        lo, hi = ends[f"l{i}"], ends[f"h{i}"]
        out.append([] if lo is None else sorted(x for x in {lo, *(values[f"q{i}"] or [])} if x < hi))
    return out
