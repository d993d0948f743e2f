"""Driver queries of the newer model and scan operators, each over the whole driver tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.operators import boosting as bst
from tessera.operators import encode as enc
from tessera.operators import filters as flt
from tessera.operators import model as mdl
from tessera.operators import scan
from tessera.operators import sketch as sk
from tessera.operators import staffing as stf
from tessera.plans import oracle as osql
from tessera.plans.jobs import list_importances
from tessera.plans.oracle import PANEL_CTES, with_ctes
from tessera.plans.queries import (CAREER_STATS, TARGET, _features_of, filled, modelling_table, pipeline_outputs, r6, sql_r6,
                                   staff_dedup)
from tessera.plans.registry import REGISTRY, register
from tessera.session import scratch_dir
from tessera.sources import io as tio
from tessera.sources.testdata_panel import season_label, season_panel, staffing_rows, table

BOOST_FEATURES = ["Age", "G", "FTA", "AST", "TRB", "season_start"]
BOOST_KEYS = ["id", "season_start", "Team"]
BOOST_BINS, BOOST = 32, dict(trees=3, depth=3, rate=0.3, rows=1.0, columns=1.0, l2=1.0)


def stored_panel(spark, sf):
    """The panel, written once: the model queries read it many times."""
    path = scratch_dir(spark, "panel")
    season_panel(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _boosting_body(l1: float) -> str:
    return with_ctes(PANEL_CTES, *osql.boosting_sql("panel", BOOST_KEYS, BOOST_FEATURES, "PTS", BOOST_BINS, BOOST["trees"], BOOST["depth"],
                                                    BOOST["rate"], BOOST["l2"], l1),
                     body=f"SELECT {', '.join(BOOST_KEYS)}, {sql_r6('prediction')} AS prediction FROM boosted")


def _boosted(spark, sf, l1: float):
    panel = stored_panel(spark, sf)
    cuts = bst.fixed_cuts(panel, BOOST_FEATURES, BOOST_BINS)
    scored = bst.boosted_columns(panel, BOOST_FEATURES, "PTS", cuts, **BOOST, l1=l1).where("PTS is not null")
    return r6(scored, ["prediction"]).select(*BOOST_KEYS, "prediction")


@register("boosted_trees", _boosting_body(0.0))
def q_boosted_trees(spark, sf):
    """Second-order boosting of the whole panel: what SQL gets level by level over the same bins."""
    return _boosted(spark, sf, 0.0)


@register("boosted_trees_l1", _boosting_body(40.0))
def q_boosted_trees_l1(spark, sf):
    """The same with an L1 penalty."""
    return _boosted(spark, sf, 40.0)


# ---------------------------------------------------------------- running sums by prefix scan
@register("experience_clock_by_scan", REGISTRY["experience_clock"].sql)
def q_experience_clock_by_scan(spark, sf):
    return scan.experience_clock(filled(spark, sf))


@register("career_rate_to_date_by_scan", REGISTRY["career_rate_to_date"].sql)
def q_career_rate_to_date_by_scan(spark, sf):
    return r6(scan.career_rate_to_date(filled(spark, sf), CAREER_STATS), [f"career_{c}_pg" for c in CAREER_STATS])


@register("drop_components_by_join", REGISTRY["drop_components"].sql)
def q_drop_components_by_join(spark, sf):
    return flt.drop_components_split(season_panel(spark, sf))


@register("feature_pipeline_scan", REGISTRY["feature_pipeline"].sql)
def q_feature_pipeline_scan(spark, sf):
    """The same modelling table without a window over an (id, period)'s rows."""
    return pipeline_outputs(spark, sf, scan=True).modelling


_HOT = """
hot AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 0 WHEN l_orderkey % 16 = 1 THEN NULL ELSE l_suppkey END AS id,
               CASE WHEN l_orderkey % 2 = 0 THEN 1995 ELSE CAST(year(l_shipdate) AS INTEGER) END AS season_start,
               row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord, l_partkey, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS games, l_orderkey, l_linenumber
        FROM lineitem)"""


@register("hot_period_scan", with_ctes(_HOT, body="""
SELECT l_orderkey, l_linenumber, l_partkey, id, season_start, sum(games) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS games_before,
       CAST(row_number() OVER w - 1 AS BIGINT) AS place
FROM hot WINDOW w AS (PARTITION BY id, season_start ORDER BY ord)"""))
def q_hot_period_scan(spark, sf):
    """Running sums in a table of which one (id, period) holds half of all rows, and rows without id a sixteenth."""
    key = F.col("l_orderkey")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(key % 2 == 0, F.lit(0)).when(key % 16 == 1, F.lit(None)).otherwise(F.col("l_suppkey")).alias("id"),
        F.when(key % 2 == 0, F.lit(1995)).otherwise(F.year("l_shipdate")).alias("season_start"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("ord"), F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("games"))
    out = scan.prefix_scan(rows, ["id", "season_start"], ["ord"], {"games_before": F.col("games")}, "place")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "id", "season_start", "games_before", "place")


# ---------------------------------------------------------------- files with quoted line breaks, read in splits
#: So small that the borders of splits cut records and quoted values.
SMALL_SPLITS = "16384"


def _in_small_splits(spark, read):
    """What ``read()`` returns, read with small splits and written."""
    name, path = "spark.sql.files.maxPartitionBytes", scratch_dir(spark, "split-read")
    before = spark.conf.get(name)
    spark.conf.set(name, SMALL_SPLITS)
    try:
        read().write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(path)


_SAID = """chr(10) || 'says "' || {0} || '",' || chr(13) || chr(10) || chr(10) || 'twice'"""


@register("read_seasons_split", with_ctes(PANEL_CTES, body=f"""
SELECT id, season_start, Team, Player || {_SAID.format("coalesce(Pos, '-')")} AS Player, Pos, Age,
       CASE WHEN id % 7 = 0 OR id % 11 = 0 THEN NULL ELSE G END AS G, {", ".join(osql.STATS)},
       CASE WHEN season_start % 2 = 1 THEN 'x' || chr(10) || id::VARCHAR END AS note
FROM panel"""))
def q_read_seasons_split(spark, sf):
    """Season files of two layouts with quoted line breaks, bad numbers and spelt-out missing values, cut by the splits' borders."""
    p = stored_panel(spark, sf)
    said = F.concat(F.lit('\nsays "'), F.coalesce("Pos", F.lit("-")), F.lit('",\r\n\ntwice'))
    games = F.when(F.col("id") % 7 == 0, F.lit("n/a")).when(F.col("id") % 11 == 0, F.lit("12x")).otherwise(F.col("G").cast("string"))
    rows = p.withColumns({"Player": F.concat("Player", said), "G": games, "note": F.concat(F.lit("x\n"), F.col("id").cast("string")),
                          "label": season_label("season_start")}).drop("ord")
    path, odd = scratch_dir(spark, "seasons"), F.col("season_start") % 2 == 1
    names = [c for c in rows.columns if c not in ("label", "season_start", "note")]
    for part, cols in ((rows.where(~odd), names), (rows.where(odd), ["note", *names[::-1]])):
        part.select("label", *cols).write.mode("append").partitionBy("label").options(header=True, escape='"').csv(path)
    schema = season_panel(spark, sf).schema
    out = _in_small_splits(spark, lambda: tio.read_seasons(spark, path, "*.csv", schema, multi_line="split").drop("ord"))
    return out.select("id", "season_start", "Team", "Player", "Pos", "Age", "G", *osql.STATS, "note")


@register("read_staffing_split", with_ctes(osql.STAFF_CTES, body="""
SELECT Coach || chr(10) || '"' || Tm || '"' AS Coach, Tm, G, Season FROM staff_raw"""))
def q_read_staffing_split(spark, sf):
    path = scratch_dir(spark, "staffing")
    rows = staffing_rows(spark, sf).select(F.concat("Coach", F.lit('\n"'), "Tm", F.lit('"')).alias("Coach"), "Tm", "G", "Season")
    rows.write.partitionBy("Season").options(header=True, escape='"').csv(path)
    return _in_small_splits(spark, lambda: tio.read_staffing(spark, path, "*.csv", multi_line="split").select("Coach", "Tm", "G", "Season"))


# ---------------------------------------------------------------- encoders, sketches, folds, a saved model, hot groups
ENCODED = ["Pos", "Player", "Team"]


@register("one_hot_sparse", with_ctes(PANEL_CTES, *[f"""
d_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS at, count(*) OVER () AS n FROM (SELECT DISTINCT {c} FROM panel WHERE {c} IS NOT NULL))"""
    for c in ENCODED], body="""
SELECT p.id, p.season_start, p.Team, CAST(2 + (SELECT count(*) FROM d_Pos) + (SELECT count(*) FROM d_Player) + (SELECT count(*) FROM d_Team) AS INTEGER) AS size,
  concat_ws(',', 2 + a.at, 2 + (SELECT count(*) FROM d_Pos) + b.at,
    2 + (SELECT count(*) FROM d_Pos) + (SELECT count(*) FROM d_Player) + c.at) AS hot, p.G AS first_value
FROM panel p LEFT JOIN d_Pos a USING (Pos) LEFT JOIN d_Player b USING (Player) LEFT JOIN d_Team c ON c.Team = p.Team"""))
def q_one_hot_sparse(spark, sf):
    """Sparse vectors of two numeric and three text columns, one of which has as many categories as there are customers, unpacked again."""
    panel = stored_panel(spark, sf)
    out = enc.sparse_one_hot(panel, ENCODED, numeric=["G", "season_start"])
    x = enc.sparse_entries(out).select("id", "season_start", "Team", "features.*")
    entries = F.filter(F.arrays_zip("indices", "values"), lambda e: (e["indices"] >= 2) & (e["values"] == 1.0))
    first = F.coalesce(F.get("values", F.array_position("indices", F.lit(0)).cast("int") - 1), F.lit(0.0))  # an entry that isn't stored is 0
    return x.select("id", "season_start", "Team", "size",
                    F.array_join(F.transform(entries, lambda e: e["indices"].cast("string")), ",").alias("hot"),
                    first.alias("first_value"))


SKETCHED = ["Age", "G", "FTA", "PTS"]


@register("approximate_medians", with_ctes(PANEL_CTES, body=" UNION ALL ".join(
    f"SELECT '{c}' AS col, count({c}) AS n, true AS within FROM panel" for c in SKETCHED)))
def q_approximate_medians(spark, sf):
    """Medians from sketches of each season merged into one: their ranks, counted over all rows, are within the stated error."""
    panel, k = stored_panel(spark, sf), 512
    whole = sk.merge_sketches(sk.quantile_sketches(panel, SKETCHED, ["season_start"], k), SKETCHED)
    mid = whole.select(*[sk.sketch_quantile(c, 0.5).alias(f"m_{c}") for c in SKETCHED], *[sk.sketch_count(c).alias(f"n_{c}") for c in SKETCHED])
    ranks = panel.crossJoin(F.broadcast(mid)).groupBy(*mid.columns).agg(*[e for c in SKETCHED for e in (
        F.count_if(F.col(c) < F.col(f"m_{c}")).alias(f"b_{c}"), F.count_if(F.col(c) <= F.col(f"m_{c}")).alias(f"u_{c}"))])
    off = lambda c: F.greatest(F.col(f"b_{c}") - F.col(f"n_{c}") / 2, F.col(f"n_{c}") / 2 - F.col(f"u_{c}"), F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"n_{c}").alias("n"),
                              (off(c) <= 2 * sk.rank_error(k) * F.col(f"n_{c}")).alias("within")) for c in SKETCHED])
    return ranks.select(F.explode(rows).alias("r")).select("r.*")


def _equal_fold_sql() -> str:
    from tessera.plans.queries import _fold_sql
    mixed = _fold_sql().removeprefix("CAST((").removesuffix(") % 5 AS INTEGER)")
    return f"CAST((row_number() OVER (ORDER BY {mixed}, id NULLS FIRST, season_start NULLS FIRST, Team NULLS FIRST, ord) - 1) % 5 AS INTEGER)"


@register("assign_equal_folds", with_ctes(PANEL_CTES, body=f"SELECT p.*, {_equal_fold_sql()} AS fold FROM panel p"))
def q_assign_equal_folds(spark, sf):
    """Folds whose sizes differ by one at most."""
    return mdl.assign_folds(season_panel(spark, sf), ["id", "season_start"], 5, 42, method="arith", equal=True, ties=["Team", "ord"])


@register("staff_summary_split", REGISTRY["staff_summary"].sql)
def q_staff_summary_split(spark, sf):
    return stf.staff_summary_split(staff_dedup(spark, sf), block=16)


@register("staff_summary_hot", with_ctes(osql.STAFF_CTES, body="""
SELECT Tm, 'all' AS Season, md5(string_agg(Coach, ', ' ORDER BY Season, k, Coach, ls)) AS digest FROM (
  SELECT CASE WHEN Tm < '3' THEN 'hot' ELSE Tm END AS Tm, Season, k, Coach, ls FROM staff) GROUP BY Tm"""))
def q_staff_summary_hot(spark, sf):
    """The same of groups of which one holds two fifths of all rows."""
    rows = staff_dedup(spark, sf).select(F.when(F.col("Tm") < "3", "hot").otherwise(F.col("Tm")).alias("Tm"), F.lit("all").alias("Season"),
                                         "Coach", F.struct("Season", "ord").alias("ord"))
    return stf.staff_summary_split(rows, block=256).select("Tm", "Season", F.md5("Coaches").alias("digest"))


SAVED = dict(trees=8, depth=3, rate=0.3)


@register("saved_model", f"""
SELECT id, season_start, {TARGET}, true AS alike, true AS metrics_alike FROM ({REGISTRY["feature_pipeline"].sql})""")
def q_saved_model(spark, sf):
    """A fitted pipeline and its metrics, saved and loaded again: every prediction and metric is the same."""
    data = modelling_table(spark, sf)
    model = bst.boosted_pipeline(data, _features_of(data), TARGET, **SAVED).fit(data.where(F.col(TARGET).isNotNull()))
    found = mdl.regression_metrics(model.transform(data), TARGET).first().asDict()
    path = scratch_dir(spark, "saved")
    mdl.save_model_and_metrics(model, found, f"{path}/model", f"{path}/metrics")
    again = PipelineModel.load(f"{path}/model").transform(model.transform(data).withColumnsRenamed(
        {"prediction": "before", "features": "features_before"}))
    read = spark.read.schema("mae double, n_rows double, r2 double, rmse double").json(f"{path}/metrics").first().asDict()
    same = all(float(found[k]) == read[k] for k in read)
    return again.select("id", "season_start", TARGET, F.col("prediction").eqNullSafe(F.col("before")).alias("alike"),
                        F.lit(same).alias("metrics_alike"))


@register("loaded_model_importance", REGISTRY["feature_importance"].sql)
def q_loaded_model_importance(spark, sf):
    """The importances that a job lists which knows only where the fitted pipeline was saved."""
    data = modelling_table(spark, sf)
    path = scratch_dir(spark, "saved")
    bst.boosted_pipeline(data, _features_of(data), TARGET, **SAVED).fit(data.where(F.col(TARGET).isNotNull())).write().save(path)
    imp = list_importances(spark, path, len(data.columns) * 20)
    total = imp.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
    return imp.crossJoin(F.broadcast(total)).select("feature", (F.col("importance") >= 0).alias("in_order"), "sums_to_one")
