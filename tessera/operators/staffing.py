"""Staffing dimension: who held a group (team) in each period.

Input rows are (group, period label, person, games, ord) in file order.
Everything is a grouped aggregate with partial (map-side) aggregation, so a
group-period holding a third of all rows still costs one row per map task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expressions import parse_season_label, require_columns


def distinct_by_first(df: DataFrame, keys=("Tm", "Season", "Coach"), ord_col: str = "ord") -> DataFrame:
    """Keep the first row (by ``ord``) of each key; later repeats are dropped.

    Expressed as an aggregate (``min_by`` over the key) rather than a window,
    so repeats are collapsed map-side before the shuffle.
    """
    keys = list(keys)
    require_columns(df, [*keys, ord_col], "distinct_by_first input")
    rest = [c for c in df.columns if c not in keys and c != ord_col]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(ord_col)) if rest else None
    aggs = [F.min(ord_col).alias(ord_col)] + ([first.alias("__r")] if rest else [])
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col("__r")[c].alias(c) for c in rest], ord_col)


def staff_listing(df: DataFrame, group_col: str = "Tm", period_col: str = "Season",
                  person_col: str = "Coach", ord_col: str = "ord") -> DataFrame:
    """The summary in long form: one row per person, globally sorted by group,
    period and first appearance.  A range-partitioned sort, so any group size
    is spread over many tasks."""
    require_columns(df, [group_col, period_col, person_col, ord_col], "staff_listing input")
    return df.select(group_col, period_col, ord_col, person_col).orderBy(group_col, period_col, ord_col)


def staff_summary(df: DataFrame, group_col: str = "Tm", period_col: str = "Season",
                  person_col: str = "Coach", ord_col: str = "ord",
                  out_col: str = "Coaches", sep: str = ", ") -> DataFrame:
    """One row per (group, period): the people in first-seen order, joined by ``sep``.

    Each output value holds a whole group's names; for groups whose joined
    string would not fit a task, ``staff_listing`` has the same content in
    long form.
    """
    require_columns(df, [group_col, period_col, person_col, ord_col], "staff_summary input")
    entries = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(person_col).alias("p"))))
    return df.groupBy(group_col, period_col).agg(
        F.array_join(F.transform(entries, lambda e: e["p"]), sep).alias(out_col))


def staff_summary_split(df: DataFrame, group_col: str = "Tm", period_col: str = "Season",
                        person_col: str = "Coach", ord_col: str = "ord",
                        out_col: str = "Coaches", sep: str = ", ", block: int = 4096) -> DataFrame:
    """As :func:`staff_summary`, a hot group in two levels: names are numbered by a prefix scan, ``block`` of them
    joined to a string, and a group's strings, a ``block``-th of its rows, joined in order.

    No task sorts or holds a group's rows; the joined string itself is one value.
    """
    from tessera.operators.scan import prefix_scan
    keys = [group_col, period_col]
    rows = prefix_scan(df.select(*keys, person_col, ord_col), keys, [ord_col], position="__at").where(F.col(person_col).isNotNull())

    def joined(value: str, order: str):
        entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("p"))))
        return F.array_join(F.transform(entries, lambda e: e["p"]), sep)
    parts = rows.withColumn("__part", F.floor(F.col("__at") / block)).groupBy(*keys, "__part").agg(joined(person_col, "__at").alias("__s"))
    found = parts.groupBy(*keys).agg(joined("__s", "__part").alias(out_col))
    groups = df.select(*keys).distinct()  # also those without a known name
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"g.{c}").eqNullSafe(F.col(f"f.{c}"))
    return groups.alias("g").join(found.alias("f"), same, "left").select(
        *[F.col(f"g.{c}").alias(c) for c in keys], F.coalesce(F.col(f"f.{out_col}"), F.lit("")).alias(out_col))


def first_by_group(df: DataFrame, group_col: str = "Tm", period_col: str = "Season",
                   person_col: str = "Coach", ord_col: str = "ord") -> DataFrame:
    """The first person (by ``ord``) of each (group, period)."""
    require_columns(df, [group_col, period_col, person_col, ord_col], "first_by_group input")
    return df.groupBy(group_col, period_col).agg(F.min_by(person_col, ord_col).alias(person_col))


def max_by_group(df: DataFrame, group_col: str = "Tm", period_col: str = "Season",
                 person_col: str = "Coach", games_col: str = "Games", ord_col: str = "ord") -> DataFrame:
    """The person with the most games in each (group, period); ties go to the earlier row."""
    require_columns(df, [group_col, period_col, person_col, games_col, ord_col], "max_by_group input")
    best = F.min_by(F.struct(F.col(person_col).alias("p"), F.col(games_col).alias("g")),
                    F.struct((-F.col(games_col)).alias("ng"), F.col(ord_col).alias("o")))
    return (df.groupBy(group_col, period_col).agg(best.alias("__b"))
            .select(group_col, period_col, F.col("__b.p").alias(person_col), F.col("__b.g").alias(games_col)))


def staffing_dimensions(staff: DataFrame, group_col: str = "Tm", label_col: str = "Season",
                        person_col: str = "Coach", games_col: str = "G", ord_col: str = "ord",
                        materialize: bool = True):
    """(current, previous) lookups for ``changed_attribute_flag``.

    current = first person per (group, period), previous = most-games person
    (ties to the earlier row); both keyed by (Tm, season_year) with the year
    parsed from the label; ``ord`` is the label, so of labels that parse to the
    same year the last one counts.  Both come out of one aggregation, which is
    written once (when ``materialize``) to the shared checkpoint folder: the raw
    staffing rows are read once however many joins use the lookups, and the
    planner knows the table's size.
    """
    dedup = distinct_by_first(staff.select(group_col, label_col, person_col, games_col, ord_col),
                              (group_col, label_col, person_col), ord_col)
    both = dedup.groupBy(group_col, label_col).agg(
        F.min_by(person_col, ord_col).alias("__cur"),
        F.min_by(person_col, F.struct((-F.col(games_col)).alias("ng"), F.col(ord_col).alias("o"))).alias("__prev"))
    both = both.select(F.col(group_col).alias("Tm"), parse_season_label(label_col).alias("season_year"),
                       F.col(label_col).alias("ord"), "__cur", "__prev")
    if materialize:
        from tessera.session import scratch_dir
        path = scratch_dir(both.sparkSession, "staffing-dimensions")
        both.write.parquet(path)
        both = both.sparkSession.read.schema(both.schema).parquet(path)
    cur = both.select("Tm", "season_year", F.col("__cur").alias("Coach"), "ord")
    prev = both.select("Tm", "season_year", F.col("__prev").alias("Coach"), "ord")
    return cur, prev


def lookup_from_labels(df: DataFrame, group_col: str = "Tm", label_col: str = "Season",
                       value_col: str = "Coach") -> DataFrame:
    """(Tm, season_year, Coach) lookup from a (group, period label, value) table."""
    return df.select(F.col(group_col).alias("Tm"), parse_season_label(label_col).alias("season_year"),
                     F.col(value_col).alias("Coach"), F.col(label_col).alias("ord"))
