"""Column expressions shared by the operators.

All of these are built-in Spark SQL expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "DataFrame") -> None:
    """Raise KeyError listing every missing column (driver-side, no job)."""
    present = set(df.columns)
    missing = sorted({c for c in cols if c not in present})
    if missing:
        raise KeyError(f"{what} missing required columns: {missing}")


def is_aggregate_group(team: ColumnOrName) -> Column:
    """True for a row that sums a multi-group period ('2TM', '3tm', 'TOT').

    Case-insensitive; NULL is false.
    """
    t = F.upper(col(team))
    return F.coalesce(t.endswith("TM") | (t == F.lit("TOT")), F.lit(False))


def to_number(c: ColumnOrName) -> Column:
    """Coerce to DOUBLE; anything that does not parse, and NaN, becomes NULL."""
    return F.nanvl(col(c).try_cast("double"), F.lit(None).cast("double"))


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL for x/0 and 0/0 instead of raising or NaN."""
    return F.try_divide(col(num), col(den))


def round_half_even(c: ColumnOrName, decimals: int = 1) -> Column:
    """Round like numpy: scale, round half to even, unscale.

    Spark's ``round`` rounds half up on the decimal representation
    (0.25 -> 0.3); ``rint`` on the scaled double gives 0.2 as numpy does.
    A result of zero is always +0.0.
    """
    if decimals < 0:
        raise ValueError("decimals must be non-negative")
    scale = float(10 ** decimals)
    # "+ 0.0" turns a rounded -0.0 into 0.0 (equal values, one canonical sign)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def two_digit_year(label: ColumnOrName) -> Column:
    """First two characters of a label as a year: below 50 -> 20xx, else 19xx."""
    yy = F.substring(col(label), 1, 2).try_cast("int")
    return F.when(yy < 50, yy + 2000).otherwise(yy + 1900)


def parse_season_label(label: ColumnOrName, strict: bool = True) -> Column:
    """Season label to its starting year.

    Trimmed, '-' read as '_', first part taken: four characters are the year
    itself; otherwise a number, 50 and up -> 19xx, else 20xx.  '22_23' ->
    2022, '2021_22' -> 2021, '99_00' -> 1999, '2005-06' -> 2005.  Empty, NULL
    or non-numeric labels raise when ``strict`` (the default), else give NULL.
    """
    raw = col(label)
    first = F.split(F.replace(F.trim(raw), F.lit("-"), F.lit("_")), "_").getItem(0)
    num = first.try_cast("int")
    year = (F.when(F.length(first) == 4, num)
            .when(num >= 50, num + 1900)
            .otherwise(num + 2000))
    if not strict:
        return year
    return F.when(year.isNotNull(), year).otherwise(
        F.raise_error(F.concat(F.lit("Invalid season label: "), F.coalesce(raw.cast("string"), F.lit("NULL")))))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """sum(w * to_number(c)) in the mapping's order; one NULL input -> NULL."""
    expr = None
    for name, w in weights.items():
        term = to_number(name) * F.lit(float(w))
        expr = term if expr is None else expr + term
    if expr is None:
        raise ValueError("weights must not be empty")
    return expr
