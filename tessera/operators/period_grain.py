"""Skew-resistant forms of the per-id history operators.

The default operators (``impute``, ``features``) window over all rows of an
id after one exchange by id: the cheapest plan when ids are small, but an
id holding a third of all rows then sits in one task.  The forms here never
window over an id's rows:

* per-id work runs on a per-(id, period) summary built with partial
  aggregation (one row per id and period, so a hot id costs as many rows as
  it has periods);
* row-level work is partitioned by (id, period) and joined back on
  (id, period), so a hot id is spread over as many tasks as it has periods
  (and AQE's skew-join splitting applies to the join);
* per-id constants (latest static value, age anchor) are grouped aggregates
  joined back on the id -- the small side has one row per id, so AQE can
  split the hot id on the large side.

Each costs one or two more exchanges than the default form; results are the
same (float sums may differ in the last bits, as they are added per period
first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import is_aggregate_group, require_columns, safe_divide


def _ord(df: DataFrame, ord_col: str):
    return [F.col(ord_col)] if ord_col in df.columns else []


def _join_back(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(summary, list(keys), "left")


def _shared(df: DataFrame, id_col: str, period_col: str) -> DataFrame:
    """Hash by (id, period) once at the operator's entry.

    The operator reads its input twice (summary and join back); starting
    both from one exchange lets Spark reuse it, so a chain of these
    operators costs one shuffle each instead of re-running every upstream
    operator twice.  Hashing by (id, period) also spreads a hot id.
    """
    return df.repartition(id_col, period_col)


def fill_gap_periods(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                     games_col: str = "G", flag_col: str = "did_play", ord_col: str = "ord") -> DataFrame:
    """As ``impute.fill_gap_periods``; gaps found on the distinct (id, period) set, rows unioned."""
    require_columns(df, [id_col, period_col, games_col], "fill_gap_periods input")
    rows = df.where(F.col(id_col).isNotNull())
    periods = rows.select(id_col, period_col).distinct()
    p = F.col(period_col)
    nxt = F.lead(p).over(Window.partitionBy(id_col).orderBy(p))
    gaps = (periods.withColumn("__next", nxt)
            .where(F.col("__next") > p + 1)
            .select(id_col, F.explode(F.sequence(p + 1, F.col("__next") - 1)).alias(period_col)))
    gap_rows = gaps.select(*[F.col(c) if c in (id_col, period_col)
                             else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    out = rows.unionByName(gap_rows)
    g = F.coalesce(F.col(games_col), F.lit(0).cast(df.schema[games_col].dataType))
    return out.withColumn(games_col, g).withColumn(flag_col, g > 0)


def fill_static(df: DataFrame, static_cols: Sequence[str], id_col: str = "id",
                period_col: str = "season_start", ord_col: str = "ord") -> DataFrame:
    """As ``impute.fill_static`` (whole-history form): latest non-null per id, joined back."""
    require_columns(df, [id_col, period_col, *static_cols], "fill_static input")
    df = _shared(df, id_col, period_col)
    key = F.struct(F.col(period_col), *_ord(df, ord_col))
    latest = (df.where(F.col(id_col).isNotNull()).groupBy(id_col)
              .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"__s_{c}") for c in static_cols]))
    out = _join_back(df, latest, [id_col])
    return out.withColumns({c: F.col(f"__s_{c}") for c in static_cols}).drop(*[f"__s_{c}" for c in static_cols])


def anchor_linear(df: DataFrame, value_col: str = "Age", id_col: str = "id",
                  period_col: str = "season_start", ord_col: str = "ord") -> DataFrame:
    """As ``impute.anchor_linear``: the anchor is a grouped ``min_by`` joined back on the id."""
    require_columns(df, [id_col, period_col, value_col], "anchor_linear input")
    df = _shared(df, id_col, period_col)
    v = F.col(value_col)
    key = F.when(v.isNotNull(), F.struct(F.col(period_col), *_ord(df, ord_col)))
    anchors = (df.where(F.col(id_col).isNotNull()).groupBy(id_col)
               .agg(F.min_by(F.struct(F.col(period_col).alias("p"), v.alias("v")), key).alias("__a")))
    out = _join_back(df, anchors, [id_col])
    value = F.col("__a.v") + (F.col(period_col) - F.col("__a.p"))
    return out.withColumn(value_col, value.cast(df.schema[value_col].dataType)).drop("__a")


def experience_clock(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                     ord_col: str = "ord", out_col: str = "years_in_nba",
                     distinct_periods: bool = False) -> DataFrame:
    """As ``features.experience_clock``: rows of earlier periods + position inside the period."""
    require_columns(df, [id_col, period_col], "experience_clock input")
    df = _shared(df, id_col, period_col)
    per = df.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(id_col).orderBy(period_col)
    if distinct_periods:
        per = per.select(id_col, period_col, (F.row_number().over(w) - 1).alias("__clock"))
        return _join_back(df, per, [id_col, period_col]).withColumnRenamed("__clock", out_col)
    before = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select(id_col, period_col, before.alias("__before"))
    out = _join_back(df, per, [id_col, period_col])
    inside = F.row_number().over(Window.partitionBy(id_col, period_col).orderBy(*_ord(df, ord_col) or [F.lit(0)]))
    clock = (F.col("__before") + inside - 1).cast("int")
    return out.withColumn(out_col, F.when(F.col(id_col).isNotNull(), clock)).drop("__before")


def career_rate_to_date(df: DataFrame, stat_cols: Sequence[str], games_col: str = "G", id_col: str = "id",
                        period_col: str = "season_start", ord_col: str = "ord") -> DataFrame:
    """As ``features.career_rate_to_date``: earlier periods' sums + earlier rows of the period."""
    df = _shared(df, id_col, period_col)
    out = df.withColumns({f"total_{c}": F.col(c) * F.col(games_col) for c in stat_cols})
    require_columns(out, [id_col, period_col], "career_rate_to_date input")
    aggs = [F.sum(games_col).alias("__g")] + [F.sum(f"total_{c}").alias(f"__t_{c}") for c in stat_cols]
    per = out.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col).agg(*aggs)
    w = Window.partitionBy(id_col).orderBy(period_col).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(id_col, period_col, F.sum("__g").over(w).alias("__gb"),
                     *[F.sum(f"__t_{c}").over(w).alias(f"__tb_{c}") for c in stat_cols])
    out = _join_back(out, per, [id_col, period_col])
    wi = (Window.partitionBy(id_col, period_col).orderBy(*_ord(df, ord_col) or [F.lit(0)])
          .rowsBetween(Window.unboundedPreceding, -1))

    def plus(a, b):  # sum of the non-null parts, NULL when both are NULL
        return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))

    games_before = plus(F.col("__gb"), F.sum(games_col).over(wi))
    g = F.col(games_col)
    has_id = F.col(id_col).isNotNull()
    cols = {}
    for c in stat_cols:
        t = F.col(f"total_{c}")
        total_before = F.coalesce(plus(F.col(f"__tb_{c}"), F.sum(t).over(wi)), F.lit(0.0))
        cols[f"career_{c}_pg"] = F.when(has_id & t.isNotNull() & g.isNotNull(), safe_divide(total_before, games_before))
    return out.withColumns(cols).drop("__gb", *[f"__tb_{c}" for c in stat_cols])


def _rep(c: str, team_col: str, ord_col: str, df: DataFrame):
    key = F.struct(F.when(is_aggregate_group(team_col), 0).otherwise(1).alias("a"), *_ord(df, ord_col))
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), key))


def previous_period_lag(df: DataFrame, lag_cols: Sequence[str], id_col: str = "id",
                        period_col: str = "season_start", team_col: str = "Team",
                        ord_col: str = "ord", prefix: str = "lag1_") -> DataFrame:
    """As ``features.previous_period_lag``: representatives per (id, period), ``lag`` over periods."""
    if not lag_cols:
        return df
    require_columns(df, [id_col, period_col, team_col, *lag_cols], "previous_period_lag input")
    df = _shared(df, id_col, period_col)
    per = (df.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col)
           .agg(*[_rep(c, team_col, ord_col, df).alias(f"__r_{c}") for c in lag_cols]))
    w = Window.partitionBy(id_col).orderBy(period_col)
    per = per.select(id_col, period_col, *[F.lag(f"__r_{c}").over(w).alias(f"{prefix}{c}") for c in lag_cols])
    return _join_back(df, per, [id_col, period_col])


def changed_group_flag(df: DataFrame, id_col: str = "id", team_col: str = "Team",
                       period_col: str = "season_start", ord_col: str = "ord",
                       out_col: str = "new_team") -> DataFrame:
    """As ``features.changed_group_flag``: period group and previous group on the summary."""
    require_columns(df, [id_col, team_col, period_col], "changed_group_flag input")
    df = _shared(df, id_col, period_col)
    per = (df.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col)
           .agg(_rep(team_col, team_col, ord_col, df).alias("__st"), F.count(team_col).alias("__n_team")))
    w = Window.partitionBy(id_col).orderBy(period_col).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(id_col, period_col, "__n_team", F.last("__st", ignorenulls=True).over(w).alias("__prev"))
    out = _join_back(df, per, [id_col, period_col])
    team, prev = F.col(team_col), F.col("__prev")
    has_prev = F.col(id_col).isNotNull() & prev.isNotNull()
    flag = (F.when(has_prev & is_aggregate_group(team_col), F.lit(False))
            .when(has_prev & (F.col("__n_team") == 1) & team.isNotNull(), team != prev))
    return out.withColumn(out_col, flag).drop("__prev", "__n_team")


def changed_attribute_flag(df: DataFrame, current_dim: DataFrame, previous_dim: DataFrame,
                           team_col: str = "Team", period_col: str = "season_start",
                           id_col: str | None = "id", ord_col: str = "ord", out_col: str = "new_coach",
                           **kw) -> DataFrame:
    """As ``features.changed_attribute_flag``: team sets and previous sets on the (id, period)
    summary, previous period per (id, comparison team) on the distinct (id, team, period) set."""
    from tessera.operators import features as fe
    if not (id_col and id_col in df.columns) or not isinstance(
            df.schema[period_col].dataType, (T.IntegerType, T.LongType, T.ShortType)):
        return fe.changed_attribute_flag(df, current_dim, previous_dim, team_col, period_col, id_col,
                                         ord_col, out_col, **kw)
    df = _shared(df, id_col, period_col)
    team = F.col(team_col)
    is_agg = team.isNotNull() & is_aggregate_group(team_col)
    real = ~is_agg & team.isNotNull()
    per = (df.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col)
           .agg(F.collect_set(F.when(real, team)).alias("__set"),
                F.min_by(team, F.when(real, F.struct(*_ord(df, ord_col) or [F.lit(0)]))).alias("__first")))
    w = Window.partitionBy(id_col).orderBy(period_col).rowsBetween(Window.unboundedPreceding, -1)
    lst = F.when(F.size("__set") > 0, F.col("__set"))
    per = per.withColumn("__list", lst).select(
        id_col, period_col, "__first",
        F.when(F.col("__list").isNotNull(), F.last("__list", ignorenulls=True).over(w)).alias("__prev_list"))
    out = _join_back(df, per, [id_col, period_col])
    out = out.withColumn("__comp", F.when(is_agg & F.col("__first").isNotNull(), F.col("__first")).otherwise(team))
    hist = (out.where(F.col(id_col).isNotNull() & F.col("__comp").isNotNull())
            .select(id_col, "__comp", period_col).distinct())
    hist = hist.withColumn("__prev_p", F.lag(period_col).over(Window.partitionBy(id_col, "__comp").orderBy(period_col)))
    out = _join_back(out, hist, [id_col, "__comp", period_col])
    return fe.attach_attribute_flag(out, current_dim, previous_dim, period_col, True, out_col=out_col,
                                    keep=list(df.columns), **kw)


def history_features(df: DataFrame, current_dim: DataFrame, previous_dim: DataFrame,
                     stat_cols: Sequence[str], lag_cols: Sequence[str], id_col: str = "id",
                     period_col: str = "season_start", team_col: str = "Team", ord_col: str = "ord",
                     games_col: str = "G", clock_col: str = "years_in_nba", weights=None,
                     score_col: str = "fantasy_points_per_game", scan: bool = False) -> DataFrame:
    """Clock, career rates, weighted score, lags, coach flag and team flag in one fused plan.

    Same results as chaining ``experience_clock``, ``career_rate_to_date``,
    ``weighted_score``, ``previous_period_lag``, ``changed_attribute_flag``
    and ``changed_group_flag``, but the rows are shuffled once, by
    (id, period), and every per-id quantity comes from windows over a
    one-row-per-(id, period) summary:

    * rows: position and running totals inside the (id, period) -- windows
      that follow the row exchange;
    * summary S (windows over the whole (id, period) on the same partitioning,
      of which one row stays): counts, sums, representatives, team sets;
    * per-id windows on S: rows before, sums before, previous
      representatives (the previous period's clock is rebuilt as
      ``before - lag(n) + lag(rep_pos) - 1``), previous team, previous team
      set;
    * (id, comparison team) history on the narrow table of distinct
      (id, period, team), folded back per (id, period);
    * one join of the summary back to the rows on (id, period).

    An id holding a third of all rows is spread over its periods; no window
    or collection spans an id's rows.  With ``scan`` position and running
    totals come from a prefix scan (``scan.prefix_scan``) and the rest of the
    summary from partial aggregation, so that no task meets the rows of one
    (id, period) either, nor all rows without id.
    """
    from tessera.operators import features as fe
    from tessera.operators.scan import prefix_scan

    require_columns(df, [id_col, period_col, team_col, games_col, *stat_cols], "history_features input")
    lag_base = [c for c in lag_cols if c != clock_col]
    team = F.col(team_col)
    is_agg = team.isNotNull() & is_aggregate_group(team_col)
    real = ~is_agg & team.isNotNull()
    o = _ord(df, ord_col) or [F.lit(0)]
    key = F.struct(F.when(is_aggregate_group(team_col), 0).otherwise(1).alias("a"), *o)

    totals = {f"total_{c}": F.col(c) * F.col(games_col) for c in stat_cols}
    if scan:
        order = [ord_col] if ord_col in df.columns else []
        rows = prefix_scan(df.withColumns(totals), [id_col, period_col], order,
                           {"__gw": F.col(games_col), **{f"__tw_{c}": F.col(f"total_{c}") for c in stat_cols}}, "__pos")
        rows = rows.withColumn("__pos", F.col("__pos") + 1)
        summary = rows.where(F.col(id_col).isNotNull()).groupBy(id_col, period_col).agg(
            F.count(F.lit(1)).alias("__n"),
            F.sum(games_col).alias("__g"),
            *[F.sum(f"total_{c}").alias(f"__t_{c}") for c in stat_cols],
            *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"__r_{c}") for c in lag_base],
            F.min_by("__pos", key).alias("__rep_pos"),
            F.min_by(team, F.when(team.isNotNull(), key)).alias("__st"),
            F.count(team_col).alias("__n_team"),
            F.collect_set(F.when(real, team)).alias("__set"),
            F.min_by(team, F.when(real, F.struct(*o))).alias("__first"))
    else:
        # ``__a`` is a column, or every window expression would get a sort of its own
        rank = F.when(is_aggregate_group(team_col), 0).otherwise(1)
        shared = _shared(df, id_col, period_col).withColumns({**totals, "__a": rank})
        w_in = Window.partitionBy(id_col, period_col).orderBy(*o, "__a")  # equal ords: aggregate rows first
        w_in_before = w_in.rowsBetween(Window.unboundedPreceding, -1)
        rows = shared.withColumns({
            "__pos": F.row_number().over(w_in),
            "__gw": F.sum(games_col).over(w_in_before),
            **{f"__tw_{c}": F.sum(f"total_{c}").over(w_in_before) for c in stat_cols},
        })
        # the summary is the first row by (aggregate first, ord) with what the window's frame holds: one sort and
        # no grouped aggregate, whose collections and structs Spark would sort once more
        w_key = Window.partitionBy(id_col, period_col).orderBy("__a", *o)
        w_all = w_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        at = F.struct(*o, "__a")  # the order of ``w_in``
        summary = (shared.where(F.col(id_col).isNotNull())
                   .withColumns({"__at": F.row_number().over(w_key), "__rep": F.first(at).over(w_all)})
                   .withColumns({
                       "__n": F.count(F.lit(1)).over(w_all),
                       "__g": F.sum(games_col).over(w_all),
                       **{f"__t_{c}": F.sum(f"total_{c}").over(w_all) for c in stat_cols},
                       **{f"__r_{c}": F.first(c, ignorenulls=True).over(w_all) for c in lag_base},
                       "__rep_pos": F.count_if(at <= F.col("__rep")).over(w_all),
                       "__st": F.first(team, ignorenulls=True).over(w_all),
                       "__n_team": F.count(team_col).over(w_all),
                       "__set": F.collect_set(F.when(real, team)).over(w_all),
                       "__first": F.first(F.when(real, team), ignorenulls=True).over(w_all)})
                   .where(F.col("__at") == 1))

    w = Window.partitionBy(id_col).orderBy(period_col)
    wb = w.rowsBetween(Window.unboundedPreceding, -1)
    lst = F.when(F.size("__set") > 0, F.col("__set"))
    per = summary.select(
        id_col, period_col, "__n_team", "__first",
        F.coalesce(F.sum("__n").over(wb), F.lit(0)).alias("__before"),
        F.sum("__g").over(wb).alias("__gb"),
        *[F.sum(f"__t_{c}").over(wb).alias(f"__tb_{c}") for c in stat_cols],
        *[F.lag(f"__r_{c}").over(w).alias(f"lag1_{c}") for c in lag_base],
        (F.coalesce(F.sum("__n").over(wb), F.lit(0)) - F.lag("__n").over(w) + F.lag("__rep_pos").over(w) - 1)
        .cast("int").alias("__lag_clock"),
        F.last("__st", ignorenulls=True).over(wb).alias("__prev_team"),
        F.when(lst.isNotNull(), F.last(lst, ignorenulls=True).over(wb)).alias("__prev_list"))

    # comparison teams of each (id, period): its real teams, or its aggregate
    # teams when it has none, from the distinct (id, period, team); the previous
    # period of each (id, team) is folded back to one array per (id, period).
    # All of it is narrow and apart from the summary, which is computed once.
    teams = df.where(F.col(id_col).isNotNull() & team.isNotNull()).select(id_col, period_col, team.alias("__comp"), is_agg.alias("__agg"))
    w_all = Window.partitionBy(id_col, period_col)
    teams = teams.distinct().withColumn("__none", F.min("__agg").over(w_all)).where(F.col("__agg") == F.col("__none"))
    hist = teams.withColumn("__prev_p", F.lag(period_col).over(Window.partitionBy(id_col, "__comp").orderBy(period_col)))
    entry = F.struct(F.col("__comp").alias("c"), F.col("__prev_p").alias("p"))
    hist = (hist.withColumns({"__hist": F.collect_list(entry).over(w_all), "__at": F.row_number().over(w_all.orderBy(period_col))})
            .where(F.col("__at") == 1).select(id_col, period_col, "__hist"))
    per = per.join(hist, [id_col, period_col], "left")

    out = rows.join(per, [id_col, period_col], "left")

    def plus(a, b):
        return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))

    has_id = F.col(id_col).isNotNull()
    g = F.col(games_col)
    games_before = plus(F.col("__gb"), F.col("__gw"))
    cols = {clock_col: F.when(has_id, (F.col("__before") + F.col("__pos") - 1).cast("int"))}
    for c in stat_cols:
        t = F.col(f"total_{c}")
        total_before = F.coalesce(plus(F.col(f"__tb_{c}"), F.col(f"__tw_{c}")), F.lit(0.0))
        cols[f"career_{c}_pg"] = F.when(has_id & t.isNotNull() & g.isNotNull(), safe_divide(total_before, games_before))
    out = out.withColumns(cols)
    out = fe.weighted_score(out, weights, score_col)
    if clock_col in lag_cols:
        out = out.withColumn(f"lag1_{clock_col}", F.col("__lag_clock"))
    prev = F.col("__prev_team")
    has_prev = has_id & prev.isNotNull()
    out = out.withColumn("new_team", F.when(has_prev & is_aggregate_group(team_col), F.lit(False))
                         .when(has_prev & (F.col("__n_team") == 1) & team.isNotNull(), team != prev))
    comp = F.when(is_agg & F.col("__first").isNotNull(), F.col("__first")).otherwise(team)
    out = out.withColumn("__comp", comp)
    prev_p = F.try_element_at(F.filter(F.col("__hist"), lambda e: e["c"] == F.col("__comp")), F.lit(1))["p"]
    out = out.withColumn("__prev_p", F.when(has_id & F.col("__comp").isNotNull(), prev_p))
    return fe.attach_attribute_flag(out, current_dim, previous_dim, period_col, True, out_col="new_coach",
                                    keep=list(df.columns))


def impute_panel(df: DataFrame, static_cols: Sequence[str], anchor_col: str = "Age", id_col: str = "id",
                 period_col: str = "season_start", games_col: str = "G", flag_col: str = "did_play",
                 ord_col: str = "ord") -> DataFrame:
    """Gap fill, static fill and linear anchor in one plan.

    Same result as ``fill_gap_periods`` -> ``fill_static`` -> ``anchor_linear``.
    Gap rows carry only id and period, so the per-id latest static values
    and the anchor are aggregates of the input rows alone: one grouped
    aggregate per id (partial aggregation), joined once on the id to the
    observed and gap rows (AQE splits a hot id on the large side of that
    join).  ``df`` is read three times; pass a checkpointed or cached frame.
    """
    require_columns(df, [id_col, period_col, games_col, anchor_col, *static_cols], "impute_panel input")
    rows = df.where(F.col(id_col).isNotNull())
    p = F.col(period_col)
    nxt = F.lead(p).over(Window.partitionBy(id_col).orderBy(p))
    gaps = (rows.select(id_col, period_col).distinct().withColumn("__next", nxt)
            .where(F.col("__next") > p + 1)
            .select(id_col, F.explode(F.sequence(p + 1, F.col("__next") - 1)).alias(period_col)))
    gap_rows = gaps.select(*[F.col(c) if c in (id_col, period_col)
                             else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    key = F.struct(F.col(period_col), *_ord(df, ord_col))
    v = F.col(anchor_col)
    per_id = rows.groupBy(id_col).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"__s_{c}") for c in static_cols],
        F.min_by(F.struct(F.col(period_col).alias("p"), v.alias("v")), F.when(v.isNotNull(), key)).alias("__a"))
    out = rows.unionByName(gap_rows).join(per_id, [id_col], "left")
    g = F.coalesce(F.col(games_col), F.lit(0).cast(df.schema[games_col].dataType))
    age = (F.col("__a.v") + (F.col(period_col) - F.col("__a.p"))).cast(df.schema[anchor_col].dataType)
    out = out.withColumns({games_col: g, flag_col: g > 0, anchor_col: age,
                           **{c: F.col(f"__s_{c}") for c in static_cols}})
    return out.drop("__a", *[f"__s_{c}" for c in static_cols])
