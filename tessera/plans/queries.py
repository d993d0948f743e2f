"""Driver queries: one per operator, each over the whole driver tables.

Every query starts from the season panel built from ``orders``,
``lineitem`` and ``customer`` (or the staffing table from ``lineitem``,
``orders`` and ``supplier``), so its work grows with the data.  The oracle
SQL rebuilds the same inputs independently (see ``oracle.py``).

Float outputs that come out of window sums are rounded half-even to 6
decimals on both sides: the engines sum in different orders, which only
changes the last bits.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expressions import is_aggregate_group, parse_season_label, round_half_even
from tessera.operators import features as fe
from tessera.operators import filters as flt
from tessera.operators import impute as imp
from tessera.operators import model as mdl
from tessera.operators import period_grain as pg
from tessera.operators import shape as shp
from tessera.operators import staffing as stf
from tessera.plans import oracle as osql
from tessera.plans.oracle import PANEL_CTES, STAFF_CTES, STATS, with_ctes
from tessera.plans.pipeline import MODEL_FEATURES, RENAME_MAP, feature_pipeline, modelling_columns
from tessera.plans.registry import REGISTRY, register
from tessera.session import scratch_dir
from tessera.sources import io as tio
from tessera.sources.testdata_panel import season_label, season_panel, staffing_rows

CAREER_STATS = ["PTS", "AST", "TRB", "BLK", "STL", "TOV"]
LAG_COLS = ["FTA", "PTS", "AST", "TRB", "BLK", "STL", "TOV", "G", "Age", "years_in_nba"]


def r6(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: round_half_even(c, 6) for c in cols})


def sql_r6(expr: str) -> str:
    return f"round_even(({expr}) * 1000000.0, 0) / 1000000.0"


def sql_is_agg(team: str = "Team") -> str:
    return f"coalesce(ends_with(upper({team}), 'TM') OR upper({team}) = 'TOT', false)"


# ---------------------------------------------------------------- shared SQL
FILLED_CTES = PANEL_CTES + """,
ranges AS (
  SELECT id, min(season_start) AS lo, max(season_start) AS hi FROM panel WHERE id IS NOT NULL GROUP BY id),
grid AS (
  SELECT id, CAST(unnest(range(CAST(lo AS BIGINT), CAST(hi AS BIGINT) + 1)) AS INTEGER) AS season_start FROM ranges),
filled AS (
  SELECT g.id, g.season_start, p.Team, p.ord, p.Player, p.Pos, p.Age, coalesce(p.G, 0.0) AS G,
         p.FTA, p.PTS, p.AST, p.TRB, p.BLK, p.STL, p.TOV, coalesce(p.G, 0.0) > 0 AS did_play
  FROM grid g LEFT JOIN panel p ON p.id = g.id AND p.season_start = g.season_start)"""

CLOCKED_CTES = FILLED_CTES + """,
clocked AS (
  SELECT f.*, CAST(row_number() OVER (PARTITION BY id ORDER BY season_start, ord) - 1 AS INTEGER) AS years_in_nba
  FROM filled f)"""


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return imp.fill_gap_periods(season_panel(spark, sf))


def clocked(spark: SparkSession, sf: str) -> DataFrame:
    return fe.experience_clock(filled(spark, sf))


# ---------------------------------------------------------------- panel / imputation
@register("season_panel", with_ctes(PANEL_CTES, body="SELECT * FROM panel"))
def q_season_panel(spark, sf):
    return season_panel(spark, sf)


@register("fill_gap_periods", with_ctes(FILLED_CTES, body="SELECT * FROM filled"))
def q_fill_gap_periods(spark, sf):
    return filled(spark, sf)


@register("fill_static", with_ctes(FILLED_CTES, """
statics AS (
  SELECT id,
         arg_max(Player, struct_pack(s := season_start, o := ord)) FILTER (WHERE Player IS NOT NULL) AS s_player,
         arg_max(Pos, struct_pack(s := season_start, o := ord)) FILTER (WHERE Pos IS NOT NULL) AS s_pos
  FROM filled GROUP BY id)""", body="""
SELECT f.* EXCLUDE (Player, Pos), s.s_player AS Player, s.s_pos AS Pos
FROM filled f LEFT JOIN statics s ON s.id = f.id"""))
def q_fill_static(spark, sf):
    return imp.fill_static(filled(spark, sf), ["Player", "Pos"])


@register("anchor_linear", with_ctes(FILLED_CTES, """
anchors AS (
  SELECT id,
         arg_min(season_start, struct_pack(s := season_start, o := ord)) FILTER (WHERE Age IS NOT NULL) AS a_season,
         arg_min(Age, struct_pack(s := season_start, o := ord)) FILTER (WHERE Age IS NOT NULL) AS a_age
  FROM filled GROUP BY id)""", body="""
SELECT f.* EXCLUDE (Age), a.a_age + (f.season_start - a.a_season) AS Age
FROM filled f LEFT JOIN anchors a ON a.id = f.id"""))
def q_anchor_linear(spark, sf):
    return imp.anchor_linear(filled(spark, sf), "Age")


# ---------------------------------------------------------------- row features
@register("experience_clock", with_ctes(CLOCKED_CTES, body="SELECT * FROM clocked"))
def q_experience_clock(spark, sf):
    return clocked(spark, sf)


@register("weighted_total", with_ctes(FILLED_CTES, body="SELECT f.*, " + ", ".join(
    f"{c} * G AS total_{c}" for c in CAREER_STATS) + " FROM filled f"))
def q_weighted_total(spark, sf):
    return fe.weighted_total(filled(spark, sf), CAREER_STATS)


_CAREER_SQL = ", ".join(
    f"CASE WHEN id IS NOT NULL AND {c} * G IS NOT NULL THEN "
    + sql_r6(f"coalesce(sum({c} * G) OVER w, 0) / nullif(sum(G) OVER w, 0)")
    + f" END AS career_{c}_pg" for c in CAREER_STATS)


@register("career_rate_to_date", with_ctes(FILLED_CTES, body="SELECT f.*, "
          + ", ".join(f"{c} * G AS total_{c}" for c in CAREER_STATS) + ", " + _CAREER_SQL
          + " FROM filled f WINDOW w AS (PARTITION BY id ORDER BY season_start, ord "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
def q_career_rate_to_date(spark, sf):
    out = fe.career_rate_to_date(filled(spark, sf), CAREER_STATS)
    return r6(out, [f"career_{c}_pg" for c in CAREER_STATS])


_SCORE_SQL = ("PTS * 1.0 + AST * 1.5 + TRB * 1.2 + BLK * 2.0 + STL * 2.0 + TOV * -1.0"
              " AS fantasy_points_per_game")


@register("weighted_score", with_ctes(PANEL_CTES, body=f"SELECT p.*, {_SCORE_SQL} FROM panel p"))
def q_weighted_score(spark, sf):
    return fe.weighted_score(season_panel(spark, sf))


def _rep_sql(c: str) -> str:
    return (f"arg_min({c}, struct_pack(a := CASE WHEN agg THEN 0 ELSE 1 END, o := ord)) "
            f"FILTER (WHERE {c} IS NOT NULL) AS r_{c}")


@register("previous_period_lag", with_ctes(CLOCKED_CTES, f"""
tagged AS (SELECT c.*, {sql_is_agg()} AS agg FROM clocked c)""", f"""
reps AS (SELECT id, season_start, {", ".join(_rep_sql(c) for c in LAG_COLS)}
         FROM tagged GROUP BY id, season_start)""", f"""
lagged AS (SELECT id, season_start, {", ".join(
    f"lag(r_{c}) OVER (PARTITION BY id ORDER BY season_start) AS lag1_{c}" for c in LAG_COLS)} FROM reps)""",
    body=f"""
SELECT c.*, {", ".join(f"l.lag1_{c}" for c in LAG_COLS)}
FROM clocked c LEFT JOIN lagged l ON l.id = c.id AND l.season_start = c.season_start"""))
def q_previous_period_lag(spark, sf):
    return fe.previous_period_lag(clocked(spark, sf), LAG_COLS)


@register("changed_group_flag", with_ctes(FILLED_CTES, f"""
tagged AS (SELECT f.*, {sql_is_agg()} AS agg FROM filled f)""", f"""
season_team AS (
  SELECT id, season_start, {_rep_sql("Team").replace(" AS r_Team", " AS st")}, count(Team) AS n_team
  FROM tagged GROUP BY id, season_start)""", """
prev AS (
  SELECT id, season_start, n_team,
         last_value(st IGNORE NULLS) OVER (PARTITION BY id ORDER BY season_start
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_team
  FROM season_team)""", body="""
SELECT t.* EXCLUDE (agg),
       CASE WHEN p.prev_team IS NULL THEN NULL
            WHEN t.agg THEN false
            WHEN p.n_team = 1 AND t.Team IS NOT NULL THEN t.Team <> p.prev_team END AS new_team
FROM tagged t JOIN prev p ON p.id = t.id AND p.season_start = t.season_start"""))
def q_changed_group_flag(spark, sf):
    return fe.changed_group_flag(filled(spark, sf))


@register("is_aggregate_group", with_ctes(PANEL_CTES, body=f"SELECT p.*, {sql_is_agg()} AS is_aggregate FROM panel p"))
def q_is_aggregate_group(spark, sf):
    return season_panel(spark, sf).withColumn("is_aggregate", is_aggregate_group("Team"))


def _round_sql(cols, d=1) -> str:
    s = 10 ** d
    return ", ".join(f"round_even({c} * {s}.0, 0) / {s}.0 AS {c}" for c in cols)


@register("round_floats", with_ctes(PANEL_CTES, body=f"""
SELECT id, season_start, Team, ord, Player, Pos, {_round_sql(["Age", "G", *STATS])} FROM panel"""))
def q_round_floats(spark, sf):
    return shp.round_floats(season_panel(spark, sf), 1)


# ---------------------------------------------------------------- staffing dimension


def staff_dedup(spark, sf):
    return stf.distinct_by_first(staffing_rows(spark, sf))


def staff_dims(spark, sf):
    return stf.staffing_dimensions(staffing_rows(spark, sf))


@register("parse_season_label", with_ctes(STAFF_CTES, body=f"""
SELECT Coach, Tm, G, Season, {osql.season_year_sql("Season")} AS season_year FROM staff_raw"""))
def q_parse_season_label(spark, sf):
    return staffing_rows(spark, sf).select("Coach", "Tm", "G", "Season",
                                           parse_season_label("Season").alias("season_year"))


@register("distinct_by_first", with_ctes(STAFF_CTES, body="SELECT Tm, Season, Coach, G FROM staff"))
def q_distinct_by_first(spark, sf):
    return staff_dedup(spark, sf).select("Tm", "Season", "Coach", "G")


@register("staff_summary", with_ctes(STAFF_CTES, body="""
SELECT Tm, Season, string_agg(Coach, ', ' ORDER BY k, Coach, ls) AS Coaches FROM staff GROUP BY Tm, Season"""))
def q_staff_summary(spark, sf):
    return stf.staff_summary(staff_dedup(spark, sf))


@register("first_by_group", with_ctes(STAFF_CTES, body="SELECT Tm, Season, Coach FROM staff_first"))
def q_first_by_group(spark, sf):
    return stf.first_by_group(staff_dedup(spark, sf))


@register("max_by_group", with_ctes(STAFF_CTES, body="SELECT Tm, Season, Coach, Games FROM staff_max"))
def q_max_by_group(spark, sf):
    return stf.max_by_group(staff_dedup(spark, sf), games_col="G").withColumnRenamed("G", "Games")


@register("read_staffing", with_ctes(STAFF_CTES, body="SELECT Coach, Tm, G, Season FROM staff_raw"))
def q_read_staffing(spark, sf):
    path = scratch_dir(spark, "staffing")
    tio.write_table(staffing_rows(spark, sf).select("Coach", "Tm", "G", "Season"), path,
                    partition_by=["Season"])
    return tio.read_staffing(spark, path, filename="*.csv").select("Coach", "Tm", "G", "Season")


@register("changed_attribute_flag", with_ctes(FILLED_CTES, STAFF_CTES, osql.coach_flag_sql("filled", "flagged"),
                                              body="SELECT * FROM flagged"))
def q_changed_attribute_flag(spark, sf):
    cur, prev = staff_dims(spark, sf)
    return fe.changed_attribute_flag(filled(spark, sf), cur, prev)


# ---------------------------------------------------------------- filters
@register("filter_min", with_ctes(PANEL_CTES, body="SELECT * FROM panel WHERE G >= 2"))
def q_filter_min(spark, sf):
    return flt.filter_min(season_panel(spark, sf), 2, "G")


@register("drop_components", with_ctes(PANEL_CTES, osql.drop_components_sql("panel", "kept"),
                                       body="SELECT * FROM kept"))
def q_drop_components(spark, sf):
    return flt.drop_components(season_panel(spark, sf))


@register("filter_not_equal_keep_null", with_ctes(CLOCKED_CTES, body="""
SELECT * FROM clocked WHERE years_in_nba IS DISTINCT FROM 0"""))
def q_filter_not_equal_keep_null(spark, sf):
    return flt.filter_not_equal_keep_null(clocked(spark, sf), "years_in_nba")


@register("filter_in_list", with_ctes(PANEL_CTES, body="""
SELECT * FROM panel WHERE id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""))
def q_filter_in_list(spark, sf):
    ids = spark.read.parquet(f"{sf}/customer.parquet").where(F.col("c_mktsegment") == "BUILDING") \
        .select("c_custkey")
    return flt.filter_in_list(season_panel(spark, sf), ids, "id")


# ---------------------------------------------------------------- shape / keys
@register("rename_strict", with_ctes(PANEL_CTES, body="""
SELECT * EXCLUDE (Pos, G), Pos AS position, G AS games FROM panel"""))
def q_rename_strict(spark, sf):
    return shp.rename_strict(season_panel(spark, sf), {"Pos": "position", "G": "games"})


@register("select_features", with_ctes(PANEL_CTES, body="""
SELECT id, season_start, Team, Age, Pos, G, PTS FROM panel"""))
def q_select_features(spark, sf):
    return shp.select_features(season_panel(spark, sf), ["id", "season_start", "Team", "Age", "Pos", "G", "PTS"])


@register("split_features_target", with_ctes(PANEL_CTES, body=f"""
SELECT * EXCLUDE (id, season_start), {osql.SCORE_EXPR} AS fantasy_points_per_game FROM panel"""))
def q_split_features_target(spark, sf):
    kept, _features, _target = shp.split_features_target(
        fe.weighted_score(season_panel(spark, sf)), "fantasy_points_per_game", ["id", "season_start", "unknown"])
    return kept


@register("validate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_validate_keys(spark, sf):
    from tessera.operators.joins import duplicate_keys
    return duplicate_keys(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@register("join_one_to_one", with_ctes(PANEL_CTES, body=f"""
SELECT p.*, s.fantasy_points_per_game FROM panel p
LEFT JOIN (SELECT id, season_start, Team, {osql.SCORE_EXPR} AS fantasy_points_per_game FROM panel) s
ON p.id IS NOT DISTINCT FROM s.id AND p.season_start IS NOT DISTINCT FROM s.season_start
   AND p.Team IS NOT DISTINCT FROM s.Team"""))
def q_join_one_to_one(spark, sf):
    from tessera.operators.joins import join_one_to_one
    path = scratch_dir(spark, "join-input")  # both sides and both key checks read it
    tio.write_table(season_panel(spark, sf), path, fmt="parquet")
    p = spark.read.parquet(path)
    right = fe.weighted_score(p).select("id", "season_start", "Team", "fantasy_points_per_game")
    return join_one_to_one(p, right, ["id", "season_start", "Team"])


# ---------------------------------------------------------------- sources / sinks (round trips)
_PANEL_NO_ORD = "SELECT * EXCLUDE (ord) FROM panel"


@register("read_seasons", with_ctes(PANEL_CTES, body=_PANEL_NO_ORD))
def q_read_seasons(spark, sf):
    p = season_panel(spark, sf)
    path = scratch_dir(spark, "seasons")
    tio.write_table(p.withColumn("label", season_label("season_start")).drop("season_start", "ord"),
                    path, partition_by=["label"])
    return tio.read_seasons(spark, path, filename="*.csv", schema=p.schema).drop("ord")


@register("write_table", with_ctes(PANEL_CTES, body="SELECT * FROM panel"))
def q_write_table(spark, sf):
    path = scratch_dir(spark, "table")
    tio.write_table(season_panel(spark, sf), path, fmt="parquet")
    return spark.read.parquet(path)


@register("read_model_table", with_ctes(PANEL_CTES, body="SELECT * FROM panel"))
def q_read_model_table(spark, sf):
    p = season_panel(spark, sf)
    path = scratch_dir(spark, "model_table")
    tio.write_table(p, path, fmt="csv")
    return tio.read_model_table(spark, path, schema=p.schema)


# ---------------------------------------------------------------- the composed pipeline
PIPELINE_MIN_GAMES = 2


def _pipeline_sql() -> str:
    blocks = [PANEL_CTES, STAFF_CTES,
              osql.gap_fill_sql("panel", "f1"), osql.static_sql("f1", "f2"), osql.anchor_sql("f2", "f3"),
              osql.clock_sql("f3", "f4"), osql.career_sql("f4", "f5", CAREER_STATS), osql.score_sql("f5", "f6"),
              osql.lag_sql("f6", "f7", LAG_COLS), osql.coach_flag_sql("f7", "f8"), osql.team_flag_sql("f8", "f9"),
              osql.drop_components_sql("f9", "f10"),
              f"f11 AS (SELECT * FROM f10 WHERE years_in_nba IS DISTINCT FROM 0 AND G >= {PIPELINE_MIN_GAMES})"]
    doubles = {"lag1_Age", "lag1_G", "lag1_FTA", "lag1_PTS", "lag1_AST", "lag1_TRB", "lag1_BLK", "lag1_STL",
               "lag1_TOV", "fantasy_points_per_game", *[f"career_{c}_pg" for c in CAREER_STATS]}
    sel = []
    for c in modelling_columns("id", "season_start"):
        e = osql.round_even_sql(c) if c in doubles else c
        sel.append(f"{e} AS {RENAME_MAP.get(c, c)}")
    return with_ctes(*blocks, body="SELECT " + ", ".join(sel) + " FROM f11")


def pipeline_outputs(spark, sf, **kw):
    cur, prev = staff_dims(spark, sf)
    return feature_pipeline(season_panel(spark, sf), cur, prev, min_games=PIPELINE_MIN_GAMES, **kw)


@register("feature_pipeline", _pipeline_sql())
def q_feature_pipeline(spark, sf):
    return pipeline_outputs(spark, sf).modelling


# ---------------------------------------------------------------- model layer

NUM_IMPUTE = ["Age", "FTA", "PTS", "AST"]
NUM_SCALE = ["Age", "G", "PTS", "AST"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FIXED_PREDICTION = "10.0 + 0.5 * PTS"
# Small boosting settings for the driver check only (the library default is the reference's 500 trees, which the query
# gbt_pipeline fits).
CHECK_GBT = dict(maxIter=10, maxDepth=3)


@register("impute_numeric", with_ctes(FILLED_CTES, body="SELECT * REPLACE (" + ", ".join(
    f"{sql_r6(f'coalesce({c}, (SELECT median({c}) FROM filled))')} AS {c}" for c in NUM_IMPUTE) + ") FROM filled"))
def q_impute_numeric(spark, sf):
    return r6(mdl.impute_numeric(filled(spark, sf), NUM_IMPUTE), NUM_IMPUTE)


@register("standardize", with_ctes(PANEL_CTES, body="SELECT * REPLACE (" + ", ".join(
    sql_r6(f"({c} - (SELECT avg({c}) FROM panel)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 "
           f"ELSE stddev_pop({c}) END FROM panel)") + f" AS {c}" for c in NUM_SCALE) + ") FROM panel"))
def q_standardize(spark, sf):
    return r6(mdl.standardize(season_panel(spark, sf), NUM_SCALE), NUM_SCALE)


@register("impute_categorical", with_ctes(FILLED_CTES, body="""
SELECT * REPLACE (coalesce(Pos, (SELECT Pos FROM filled WHERE Pos IS NOT NULL GROUP BY Pos
                                 ORDER BY count(*) DESC, Pos LIMIT 1)) AS Pos) FROM filled"""))
def q_impute_categorical(spark, sf):
    return mdl.impute_categorical(filled(spark, sf), ["Pos"])


@register("one_hot", with_ctes(PANEL_CTES, body="SELECT * EXCLUDE (Pos), " + ", ".join(
    f"CAST(CASE WHEN Pos = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS Pos_{v}" for v in SEGMENTS) + " FROM panel"))
def q_one_hot(spark, sf):
    return mdl.one_hot(season_panel(spark, sf), "Pos")


def _fold_sql() -> str:
    p = 2147483647
    h = "CAST(42 AS BIGINT)"
    for i, c in enumerate(["id", "season_start"]):
        h = f"(({h}) * 48271 + (CAST({c} AS BIGINT) % {p}) * {16807 + i}) % {p}"
    return f"CAST(({h}) % 5 AS INTEGER)"


@register("assign_folds", with_ctes(PANEL_CTES, body=f"SELECT p.*, {_fold_sql()} AS fold FROM panel p"))
def q_assign_folds(spark, sf):
    return mdl.assign_folds(season_panel(spark, sf), ["id", "season_start"], 5, 42, method="arith")


@register("regression_metrics", with_ctes(PANEL_CTES, f"""
scored AS (SELECT {osql.SCORE_EXPR} AS y, {FIXED_PREDICTION} AS prediction FROM panel)""", body=f"""
SELECT {sql_r6("sqrt(avg((y - prediction) * (y - prediction)))")} AS rmse,
       {sql_r6("avg(abs(y - prediction))")} AS mae,
       {sql_r6("1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(y))")} AS r2,
       count(*) AS n_rows
FROM scored WHERE y IS NOT NULL AND prediction IS NOT NULL"""))
def q_regression_metrics(spark, sf):
    scored = fe.weighted_score(season_panel(spark, sf), out_col="y") \
        .withColumn("prediction", F.expr(FIXED_PREDICTION))
    return r6(mdl.regression_metrics(scored, "y"), ["rmse", "mae", "r2"])


@register("score_with_residual", with_ctes(PANEL_CTES, f"""
scored AS (SELECT p.*, {osql.SCORE_EXPR} AS fantasy_points_per_game FROM panel p)""", body=f"""
SELECT s.*, {FIXED_PREDICTION} AS prediction, fantasy_points_per_game - ({FIXED_PREDICTION}) AS residual
FROM scored s"""))
def q_score_with_residual(spark, sf):
    model = SQLTransformer(statement=f"SELECT *, {FIXED_PREDICTION} AS prediction FROM __THIS__")
    return mdl.score_with_residual(model, fe.weighted_score(season_panel(spark, sf)), "fantasy_points_per_game")


TARGET = "fantasy_points_per_game"


def modelling_table(spark, sf):
    """The modelling table, written once: the model queries read it many times."""
    path = scratch_dir(spark, "modelling")
    tio.write_table(pipeline_outputs(spark, sf).modelling, path, fmt="parquet")
    return spark.read.parquet(path)


def _features_of(table):
    return [c for c in table.columns if c not in ("id", "season_start", TARGET)]


def _fitted(table, **params):
    return mdl.gbt_pipeline(table, _features_of(table), TARGET, 42, **params).fit(
        table.where(F.col(TARGET).isNotNull()))


def _better_than_mean(scored):
    """(rmse below that of predicting the mean) as a one-row column."""
    return scored.agg((F.sqrt(F.avg((F.col(TARGET) - F.col("prediction")) ** 2)) < F.stddev_pop(TARGET)).alias("better"))


_MODELLING = _pipeline_sql()
CATEGORY_COLUMNS = ["new_team", "new_coach", "position"]


@register("gbt_pipeline", f"""
SELECT id, season_start, {TARGET}, true AS predicted, true AS better FROM ({_MODELLING})""")
def q_gbt_pipeline(spark, sf):
    table = modelling_table(spark, sf)
    scored = _fitted(table).transform(table)
    return scored.crossJoin(F.broadcast(_better_than_mean(scored))).select(
        "id", "season_start", TARGET, F.col("prediction").isNotNull().alias("predicted"), "better")


@register("cross_validate", f"""
SELECT CAST(f.i AS INTEGER) AS fold, count(*) FILTER (m.{TARGET} IS NOT NULL AND m.fold = f.i) AS n_rows,
  true AS known, true AS consistent
FROM (SELECT *, {_fold_sql()} AS fold FROM ({_MODELLING})) m, (SELECT unnest(range(5)) AS i) f GROUP BY f.i""")
def q_cross_validate(spark, sf):
    table = modelling_table(spark, sf)
    known = table.where(F.col(TARGET).isNotNull())
    feats, keys = _features_of(table), ["id", "season_start"]
    cv = mdl.cross_validate(known, lambda d: mdl.gbt_pipeline(d, feats, TARGET, 42, **CHECK_GBT), TARGET, keys, k=5,
                            seed=42, fold_method="arith")
    folds = mdl.assign_folds(known, keys, 5, 42, method="arith").groupBy("fold").agg(
        F.count("*").alias("n_rows"))
    scores = spark.createDataFrame([(i, float(r)) for i, r in enumerate(cv["fold_rmse"])], "fold int, rmse double")
    right = abs(sum(cv["fold_rmse"]) / 5 - cv["rmse_mean"]) < 1e-9
    return folds.join(scores, "fold").select("fold", "n_rows", (F.col("rmse") >= 0).alias("known"),
                                             F.lit(right).alias("consistent"))


@register("feature_importance", f"""
WITH m AS ({_MODELLING})
SELECT feature, true AS in_order, true AS sums_to_one FROM (
  SELECT unnest([{", ".join(repr(RENAME_MAP.get(c, c)) for c in MODEL_FEATURES
                            if c not in (TARGET, "Pos") and RENAME_MAP.get(c, c) not in CATEGORY_COLUMNS)}]) AS feature
  {" ".join(f"UNION SELECT DISTINCT '{c}_' || CAST({c} AS VARCHAR) FROM m WHERE {c} IS NOT NULL" for c in CATEGORY_COLUMNS)})""")
def q_feature_importance(spark, sf):
    table = modelling_table(spark, sf)
    imp = mdl.feature_importance(_fitted(table, **CHECK_GBT), len(table.columns) * 20)
    total = imp.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
    return imp.crossJoin(F.broadcast(total)).select("feature", (F.col("importance") >= 0).alias("in_order"), "sums_to_one")


@register("train_and_export", f"""
SELECT id, season_start, {TARGET}, {TARGET} AS y_true, true AS predicted, true AS residual_right FROM ({_MODELLING})""")
def q_train_and_export(spark, sf):
    from tessera.plans.training import train_and_export
    out = train_and_export(modelling_table(spark, sf), gbt_params=CHECK_GBT, k=5)["pred_df"]
    right = F.col("residual").eqNullSafe(F.col(TARGET) - F.col("prediction")) & (F.col("y_pred") == F.col("prediction"))
    return out.select("id", "season_start", TARGET, "y_true", F.col("prediction").isNotNull().alias("predicted"),
                      right.alias("residual_right"))


@register("save_model_and_metrics", with_ctes(PANEL_CTES, body=f"""
SELECT {sql_r6("avg(PTS)")} AS mean_pts, count(PTS)::DOUBLE AS n_pts FROM panel"""))
def q_save_model_and_metrics(spark, sf):
    p = season_panel(spark, sf).agg(F.avg("PTS").alias("m"), F.count("PTS").alias("n")).first()
    path = scratch_dir(spark, "metrics")
    mdl.save_model_and_metrics(None, {"mean_pts": p["m"], "n_pts": p["n"]}, None, path)
    return r6(spark.read.schema("mean_pts double, n_pts double").json(path), ["mean_pts"])


@register("build_preprocessor", with_ctes(PANEL_CTES, f"""
s AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in NUM_SCALE)} FROM panel),
f AS (SELECT p.id, p.season_start, p.Team,
             {", ".join(f"coalesce(p.{c}, s.m_{c}) AS {c}" for c in NUM_SCALE)},
             coalesce(p.Pos, (SELECT Pos FROM panel WHERE Pos IS NOT NULL GROUP BY Pos ORDER BY count(*) DESC, Pos LIMIT 1)) AS Pos
      FROM panel p, s)""", body="SELECT id, season_start, Team, " + ", ".join(
    sql_r6(f"({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f)") + f" AS {c}" for c in NUM_SCALE) + ", " + ", ".join(
    f"CAST(CASE WHEN Pos = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS Pos_{v}" for v in SEGMENTS) + " FROM f"))
def q_build_preprocessor(spark, sf):
    from pyspark.ml.functions import vector_to_array
    p = season_panel(spark, sf)
    model = mdl.build_preprocessor(p, [*NUM_SCALE, "Pos"]).fit(p)
    names = model.feature_names()
    x = model.transform(p).select("id", "season_start", "Team", vector_to_array("features").alias("x"))
    return r6(x.select("id", "season_start", "Team", *[F.col("x")[i].alias(n) for i, n in enumerate(names)]), NUM_SCALE)


@register("feature_pipeline_skew_safe", _pipeline_sql())
def q_feature_pipeline_skew_safe(spark, sf):
    """The same modelling table, from the panel and the imputed table as written tables."""
    return pipeline_outputs(spark, sf, imputed_path=scratch_dir(spark, "imputed")).modelling


@register("feature_pipeline_windowed", _pipeline_sql())
def q_feature_pipeline_windowed(spark, sf):
    """The same modelling table through the per-id windows."""
    return pipeline_outputs(spark, sf, skew_safe=False).modelling


def _messy_sql(d: str) -> str:
    """The lookup with blank holders in every third year, and in every fourth another holder from a later label."""
    return f"""
{d}_m AS (SELECT Tm, season_year, CASE WHEN season_year % 4 = 1 THEN upper(Coach) || ' B'
                 WHEN season_year % 3 = 0 THEN NULL ELSE Coach END AS Coach FROM {d})"""


@register("changed_attribute_flag_messy", with_ctes(
    FILLED_CTES, STAFF_CTES, _messy_sql("cur_dim"), _messy_sql("prev_dim"),
    osql.coach_flag_sql("filled", "flagged").replace("JOIN cur_dim", "JOIN cur_dim_m").replace("JOIN prev_dim", "JOIN prev_dim_m"),
    body="SELECT * FROM flagged"))
def q_changed_attribute_flag_messy(spark, sf):
    """The flag with blank names and repeated keys of different values in the lookups."""
    def messy(d):
        year = F.col("season_year")
        blank = d.withColumn("Coach", F.when(year % 3 == 0, F.lit(" ")).otherwise(F.col("Coach")))
        later = d.where(year % 4 == 1).withColumn("Coach", F.concat(F.upper("Coach"), F.lit(" B")))
        return blank.unionByName(later.withColumn("ord", F.concat("ord", F.lit("_later"))))
    cur, prev = staff_dims(spark, sf)
    return fe.changed_attribute_flag(filled(spark, sf), messy(cur), messy(prev))


# ---------------------------------------------------------------- the period-grain forms: same answers, no window over an id's rows
def _by_period(name: str):
    return register(f"{name}_by_period", REGISTRY[name].sql)


@_by_period("fill_gap_periods")
def q_fill_gap_periods_by_period(spark, sf):
    return pg.fill_gap_periods(season_panel(spark, sf))


@_by_period("experience_clock")
def q_experience_clock_by_period(spark, sf):
    return pg.experience_clock(filled(spark, sf))


@_by_period("previous_period_lag")
def q_previous_period_lag_by_period(spark, sf):
    return pg.previous_period_lag(clocked(spark, sf), LAG_COLS)


@_by_period("changed_group_flag")
def q_changed_group_flag_by_period(spark, sf):
    return pg.changed_group_flag(filled(spark, sf))


@_by_period("changed_attribute_flag")
def q_changed_attribute_flag_by_period(spark, sf):
    cur, prev = staff_dims(spark, sf)
    return pg.changed_attribute_flag(filled(spark, sf), cur, prev)


@_by_period("fill_static")
def q_fill_static_by_period(spark, sf):
    return pg.fill_static(filled(spark, sf), ["Player", "Pos"])


@_by_period("anchor_linear")
def q_anchor_linear_by_period(spark, sf):
    return pg.anchor_linear(filled(spark, sf), "Age")


@_by_period("career_rate_to_date")
def q_career_rate_to_date_by_period(spark, sf):
    return r6(pg.career_rate_to_date(filled(spark, sf), CAREER_STATS), [f"career_{c}_pg" for c in CAREER_STATS])
