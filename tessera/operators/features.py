"""History features over an entity-period panel.

Every window here is partitioned by the entity id (optionally with the
period or group), so a panel hash-partitioned by id computes all of them
after one exchange.  "Previous period" frames are RANGE frames on the
integer period ending at -1, which skip the current period's peer rows
without a self-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import (
    is_aggregate_group,
    require_columns,
    safe_divide,
    weighted_sum,
)

# The scoring weights of the reference's weighted score
# (points 1.0, assists 1.5, rebounds 1.2, blocks 2.0, steals 2.0,
# turnovers -1.0), applied in this order.
FANTASY_WEIGHTS = {"PTS": 1.0, "AST": 1.5, "TRB": 1.2, "BLK": 2.0, "STL": 2.0, "TOV": -1.0}


def _order(df: DataFrame, period_col: str, ord_col: str) -> list[Column]:
    return [F.col(period_col)] + ([F.col(ord_col)] if ord_col and ord_col in df.columns else [])


def _prev_period_frame(id_cols: Sequence[str], period_col: str):
    """All rows of strictly earlier periods of the same id."""
    return (Window.partitionBy(*id_cols).orderBy(F.col(period_col))
            .rangeBetween(Window.unboundedPreceding, -1))


def experience_clock(df: DataFrame, id_col: str = "id", period_col: str = "season_start",
                     ord_col: str = "ord", out_col: str = "years_in_nba",
                     distinct_periods: bool = False) -> DataFrame:
    """Number of earlier rows of the id (0 on its first row).

    Counts rows, not periods: gap rows and every row of a split period
    advance the clock.  ``distinct_periods=True`` counts periods instead.
    """
    require_columns(df, [id_col, period_col], "experience_clock input")
    if distinct_periods:
        n = F.dense_rank().over(Window.partitionBy(id_col).orderBy(F.col(period_col))) - 1
    else:
        n = F.row_number().over(Window.partitionBy(id_col).orderBy(*_order(df, period_col, ord_col))) - 1
    return df.withColumn(out_col, F.when(F.col(id_col).isNotNull(), n))


def weighted_total(df: DataFrame, stat_cols: Sequence[str], games_col: str = "G",
                   prefix: str = "total_") -> DataFrame:
    """``total_<c> = c * games`` for each stat (a per-game rate back to a total)."""
    require_columns(df, [games_col, *stat_cols], "weighted_total input")
    return df.withColumns({f"{prefix}{c}": F.col(c) * F.col(games_col) for c in stat_cols})


def career_rate_to_date(df: DataFrame, stat_cols: Sequence[str], games_col: str = "G",
                        id_col: str = "id", period_col: str = "season_start",
                        ord_col: str = "ord", exclude_components: bool = False,
                        team_col: str = "Team") -> DataFrame:
    """Career per-game rate over all earlier rows of the id.

    ``career_<c>_pg = sum(total_c) / sum(games)`` over the rows before the
    current one (ROWS frame), with ``total_c = c * games`` kept in the output.
    A NULL stat or games value gives NULL; no earlier games gives NULL.
    Like the reference, a split period is counted twice by later rows
    (aggregate row + components); ``exclude_components=True`` leaves the
    component rows of split periods out of the sums.
    """
    out = weighted_total(df, stat_cols, games_col)
    require_columns(out, [id_col, period_col], "career_rate_to_date input")
    w = (Window.partitionBy(id_col).orderBy(*_order(out, period_col, ord_col))
         .rowsBetween(Window.unboundedPreceding, -1))
    g = F.col(games_col)
    if exclude_components:
        comp = ~is_aggregate_group(team_col) & (
            F.min(team_col).over(Window.partitionBy(id_col, period_col))
            != F.max(team_col).over(Window.partitionBy(id_col, period_col)))
        g_in = F.when(~F.coalesce(comp, F.lit(False)), g)
    else:
        comp, g_in = None, g
    games_before = F.sum(g_in).over(w)
    has_id = F.col(id_col).isNotNull()
    cols = {}
    for c in stat_cols:
        t = F.col(f"total_{c}")
        t_in = t if comp is None else F.when(~F.coalesce(comp, F.lit(False)), t)
        total_before = F.coalesce(F.sum(t_in).over(w), F.lit(0.0))
        cols[f"career_{c}_pg"] = F.when(has_id & t.isNotNull() & g.isNotNull(),
                                        safe_divide(total_before, games_before))
    return out.withColumns(cols)


def weighted_score(df: DataFrame, weights: Mapping[str, float] | None = None,
                   out_col: str = "fantasy_points_per_game") -> DataFrame:
    """Weighted sum of numeric-coerced columns; defaults to the fixed weights."""
    weights = dict(weights or FANTASY_WEIGHTS)
    require_columns(df, weights.keys(), "weighted_score input")
    return df.withColumn(out_col, weighted_sum(weights))


def _representative(df: DataFrame, c: str, id_col: str, period_col: str, team_col: str,
                    ord_col: str) -> Column:
    """First non-null value of ``c`` in the (id, period), aggregate row first, then row order.

    An order-free ``min_by`` over (id, period): its only ordering requirement
    is (id, period), a prefix of the panel's (id, period, ord) sort, so it
    shares that sort with the other windows instead of adding its own.
    """
    agg_rank = F.when(is_aggregate_group(team_col), 0).otherwise(1)
    key = F.struct(agg_rank.alias("a"), *([F.col(ord_col).alias("o")] if ord_col in df.columns else []))
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), key)).over(Window.partitionBy(id_col, period_col))


def previous_period_lag(df: DataFrame, lag_cols: Sequence[str], id_col: str = "id",
                        period_col: str = "season_start", team_col: str = "Team",
                        ord_col: str = "ord", prefix: str = "lag1_") -> DataFrame:
    """``lag1_<c>``: the value of the id's previous existing period, any distance back.

    A period's value is its representative: aggregate row first, then row
    order, taking the first non-null per column.  All rows of a period get
    the same lag; the first period gets NULL.
    """
    if not lag_cols:
        return df
    require_columns(df, [id_col, period_col, team_col, *lag_cols], "previous_period_lag input")
    reps = {f"__rep_{c}": _representative(df, c, id_col, period_col, team_col, ord_col) for c in lag_cols}
    w_prev = _prev_period_frame([id_col], period_col)
    has_id = F.col(id_col).isNotNull()
    return (df.withColumns(reps)
            .withColumns({f"{prefix}{c}": F.when(has_id, F.last(f"__rep_{c}").over(w_prev)) for c in lag_cols})
            .drop(*reps))


def changed_group_flag(df: DataFrame, id_col: str = "id", team_col: str = "Team",
                       period_col: str = "season_start", ord_col: str = "ord",
                       out_col: str = "new_team") -> DataFrame:
    """Three-valued "group changed since the previous period" flag.

    previous = last non-null period group strictly before (period group =
    first non-null group, aggregate row first).  NULL without a previous
    group; false on aggregate rows; ``team <> previous`` on the only team
    row of a period; NULL on components of split periods and NULL teams.
    """
    require_columns(df, [id_col, team_col, period_col], "changed_group_flag input")
    is_agg = is_aggregate_group(team_col)
    out = df.withColumn("__season_team", _representative(df, team_col, id_col, period_col, team_col, ord_col))
    prev = F.last("__season_team", ignorenulls=True).over(_prev_period_frame([id_col], period_col))
    n_team = F.count(team_col).over(Window.partitionBy(id_col, period_col))
    team = F.col(team_col)
    has_prev = F.col(id_col).isNotNull() & prev.isNotNull()
    flag = (F.when(has_prev & is_agg, F.lit(False))
            .when(has_prev & (n_team == 1) & team.isNotNull(), team != prev))
    return out.withColumn(out_col, flag).drop("__season_team")


def changed_attribute_flag(df: DataFrame, current_dim: DataFrame, previous_dim: DataFrame,
                           team_col: str = "Team", period_col: str = "season_start",
                           id_col: str | None = "id", ord_col: str = "ord",
                           out_col: str = "new_coach", dim_team: str = "Tm",
                           dim_period: str = "season_year", dim_value: str = "Coach",
                           dim_ord: str = "ord") -> DataFrame:
    """Did the group's attribute (e.g. a team's coach) change since the id was last there?

    ``current_dim``/``previous_dim`` map (group, period) to the attribute:
    the period's first and its most-games holder.  The comparison group is
    the row's own group; an aggregate row borrows the period's first real
    group.  The previous period is the id's previous period in that same
    group; when there is none (or its key is not in ``previous_dim``) the
    group's immediately preceding period is used, but only if the group was
    among the id's groups in the id's previous period.  The flag is
    ``current <> previous`` when both are known, else NULL.  Without an id
    column the history is per group and the fallback is always allowed.

    Of lookup rows that repeat a key the last one by ``dim_ord`` counts (the
    largest value, without that column); a blank value is an unknown one.  The
    lookups are joined three times with a ``matched`` marker, since "key found"
    and "value known" differ in the fallback rule.
    """
    require_columns(df, [team_col, period_col], "changed_attribute_flag input")
    has_id = bool(id_col) and id_col in df.columns
    team = F.col(team_col)
    is_agg = team.isNotNull() & is_aggregate_group(team_col)
    if isinstance(df.schema[period_col].dataType, (T.IntegerType, T.LongType, T.ShortType)):
        out, pc = df, period_col   # keep the panel's sort on (id, period, ord) usable
    else:
        out, pc = df.withColumn("__p", F.col(period_col).cast("int")), "__p"
    if ord_col not in out.columns:
        out = out.withColumn(ord_col, F.monotonically_increasing_id())
        drop_ord = True
    else:
        drop_ord = False

    if has_id:
        real = ~is_agg & team.isNotNull()
        w_season = (Window.partitionBy(id_col, pc)
                    .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        # The period's real groups as a set (bounded by distinct groups, order-free:
        # it is only used for membership) and its first real group by row order.
        teams = F.collect_set(F.when(real, team)).over(w_season)
        first_team = F.min_by(team, F.when(real, F.col(ord_col))).over(w_season)
        out = out.withColumn("__list", F.when(F.size(teams) > 0, teams)).withColumn("__first", first_team)
        prev_list = F.last("__list", ignorenulls=True).over(_prev_period_frame([id_col], pc))
        out = out.withColumn("__prev_list", F.when(F.col("__list").isNotNull() & F.col(id_col).isNotNull(), prev_list))
        comp = F.when(is_agg & F.col("__first").isNotNull(), F.col("__first")).otherwise(team)
        out = out.withColumn("__comp", comp)
        hist_keys = [id_col, "__comp"]
        valid_hist = F.col(id_col).isNotNull() & F.col("__comp").isNotNull()
    else:
        out = out.withColumn("__comp", team).withColumn("__prev_list", F.lit(None).cast("array<string>"))
        hist_keys = ["__comp"]
        valid_hist = F.col("__comp").isNotNull()

    prev_season = F.max(pc).over(_prev_period_frame(hist_keys, pc))
    out = out.withColumn("__prev_p", F.when(valid_hist, prev_season))

    return attach_attribute_flag(out, current_dim, previous_dim, pc, has_id, out_col=out_col,
                                 dim_team=dim_team, dim_period=dim_period, dim_value=dim_value,
                                 dim_ord=dim_ord, keep=[c for c in df.columns],
                                 drop=[ord_col] if drop_ord else [])


def attach_attribute_flag(out: DataFrame, current_dim: DataFrame, previous_dim: DataFrame, pc: str,
                          has_id: bool, out_col: str = "new_coach", dim_team: str = "Tm",
                          dim_period: str = "season_year", dim_value: str = "Coach",
                          dim_ord: str = "ord", keep=(), drop=()) -> DataFrame:
    """Lookups and flag of ``changed_attribute_flag`` given ``__comp``, ``__prev_list``, ``__prev_p``.

    Helper columns (two leading underscores) go, but for those in ``keep``.
    """
    def checked(d: DataFrame) -> DataFrame:
        # one row per (group, period): labels that parse to the same year must
        # not multiply panel rows in the joins below
        o = F.col(dim_ord) if dim_ord in d.columns else F.lit(0)
        d = d.select(F.col(dim_team).alias("t"), F.col(dim_period).cast("int").alias("p"), F.struct(
            o.alias("o"), F.when(F.trim(F.col(dim_value)) != "", F.col(dim_value)).alias("v")).alias("r"))
        return d.groupBy("t", "p").agg(F.max("r")["v"].alias("v"), F.lit(True).alias("m"))

    def tag(d: DataFrame, t: str) -> DataFrame:
        return d.select(*[F.col(c).alias(f"__{t}_{c}") for c in ("t", "p", "v", "m")])

    cur_d, prev_d = checked(current_dim), checked(previous_dim)
    cur, prv, fb = tag(cur_d, "c"), tag(prev_d, "p"), tag(prev_d, "f")
    out = (out
           .join(cur, (F.col("__comp") == F.col("__c_t")) & (F.col(pc) == F.col("__c_p")), "left")
           .join(prv, (F.col("__comp") == F.col("__p_t")) & (F.col("__prev_p") == F.col("__p_p")), "left")
           .join(fb, (F.col("__comp") == F.col("__f_t")) & ((F.col(pc) - 1) == F.col("__f_p")), "left"))
    if has_id:
        allowed = F.coalesce(F.array_contains(F.col("__prev_list"), F.col("__comp")), F.lit(False))
    else:
        allowed = F.lit(True)
    previous = (F.when(F.col("__p_m"), F.col("__p_v"))
                .when(F.col("__comp").isNotNull() & allowed & F.col("__f_m"), F.col("__f_v")))
    current = F.col("__c_v")
    flag = F.when(current.isNotNull() & previous.isNotNull(), current != previous)
    out = out.withColumn(out_col, flag)
    return out.drop(*([c for c in out.columns if c.startswith("__") and c not in keep] + list(drop)))
