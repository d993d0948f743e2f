"""Second-order boosting and quantile sketches against plain Python versions."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import boosting as bst
from tessera.operators import model as mdl
from tessera.operators import sketch


def slow_boost(bins, y, trees, depth, rate, l2, l1=0.0, least=1.0):
    """Predictions by the textbook rules, row sets as Python lists."""
    def score(rows, g):
        s = sum(g[r] for r in rows)
        s = s - l1 if s > l1 else s + l1 if s < -l1 else 0.0
        return s * s / (len(rows) + l2), s

    def grow(rows, g, left):
        best = (0.0, None)
        if left:
            for f in range(len(bins[0])):
                for b in sorted({bins[r][f] for r in rows}):
                    lo, hi = [r for r in rows if bins[r][f] <= b], [r for r in rows if bins[r][f] > b]
                    if len(lo) >= least and len(hi) >= least and lo and hi:
                        gain = 0.5 * (score(lo, g)[0] + score(hi, g)[0] - score(rows, g)[0])
                        if gain > best[0] + 1e-9:
                            best = (gain, (lo, hi))
        if best[1] is None:
            return {r: -score(rows, g)[1] / (len(rows) + l2) for r in rows}
        return {**grow(best[1][0], g, left - 1), **grow(best[1][1], g, left - 1)}
    guess = [sum(y) / len(y)] * len(y)
    for _ in range(trees):
        step = grow(range(len(y)), [p - t for p, t in zip(guess, y)], depth)
        guess = [p + rate * step[r] for r, p in enumerate(guess)]
    return guess


def rows_of(rng, n):
    out = []
    for i in range(n):
        a, b = rng.randrange(9), rng.choice([None, float("nan"), 1.0, 2.0, 3.5])
        out.append((i, float(a), b, float(rng.randrange(3)), 3.0 * (a > 4) + (b == 2.0) + rng.random()))
    return out


def panel(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(parts)


@pytest.mark.parametrize("l1, l2, least", [(0.0, 1.0, 1.0), (2.0, 0.5, 4.0)])
def test_trees_equal_the_textbook(spark, l1, l2, least):
    rows = rows_of(random.Random(1), 70)
    cuts = [[0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], [1.0, 2.0], [0.0, 1.0]]
    got = bst.boosted_columns(panel(spark, rows), ["a", "b", "c"], "y", cuts, trees=3, depth=2, rate=0.4, rows=1.0, columns=1.0,
                              l1=l1, l2=l2, least_hessian=least).sort("id").collect()
    known = lambda x: x is not None and not math.isnan(x)
    bins = [[1 + sum(e < x for e in c) if known(x) else 0 for x, c in zip(r[1:4], cuts)] for r in rows]
    want = slow_boost(bins, [r[4] for r in rows], 3, 2, 0.4, l2, l1, least)
    assert np.allclose([r.prediction for r in got], want, atol=1e-9)


def test_folds_fitted_together_equal_folds_fitted_alone_and_written_trees_change_nothing(spark, tmp_path):
    rows = rows_of(random.Random(2), 90)
    cuts = [[float(i) for i in range(8)], [1.0, 2.0], [0.0, 1.0]]
    x = F.array("a", F.coalesce("b", F.lit(float("nan"))), "c")
    bst.binned_rows(panel(spark, rows), x, F.col("y"), cuts, F.col("id") % 3).write.parquet(f"{tmp_path}/b")
    binned = spark.read.parquet(f"{tmp_path}/b")
    size = dict(trees=3, depth=2, rate=0.3, columns=0.7)
    together = bst.boost(binned, 3, [-2, 0, 1], **size)
    for fold in (0, 1):
        assert together[fold][1] == bst.boost(binned, 3, [fold], **size)[fold][1]
    assert together[-2][1] == bst.boost(binned, 3, [-2], refresh=1, **size)[-2][1]
    assert together[-2][1] == bst.boost(binned.repartition(5), 3, [-2], **size)[-2][1]
    assert together[0][1] != together[1][1] and together[-2][2][1].sum() > 0


def test_no_rows_one_label_and_bad_settings(spark, tmp_path):
    cuts = [[1.0]] * 3
    schema = "id long, a double, b double, c double, y double"
    none = bst.binned_rows(spark.createDataFrame([], schema), F.array("a", "b", "c"), F.col("y"), cuts)
    assert bst.boost(none, 3, trees=2)[-2][:2] == (0.0, [])
    same = bst.binned_rows(panel(spark, [(i, float(i), 0.0, 1.0, 5.0) for i in range(9)]), F.array("a", "b", "c"), F.col("y"), cuts)
    base, trees, gain = bst.boost(same, 3, trees=2)[-2]
    assert base == 5.0 and [list(t) for t in trees] == [[0], [0]] and gain.sum() == 0
    with pytest.raises(ValueError):
        bst.boost(same, 3, trees=1, deep=3)


def test_pipeline_saved_and_loaded_predicts_and_explains_alike(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, float(i % 7), rng.choice(["x", "y", None]), rng.random() + 4.0 * (i % 7 > 3), 1) for i in range(160)] + [(500, 1.0, "x", None, 1)]
    df = spark.createDataFrame(rows, "id long, a double, s string, y double, one int").cache()
    model = bst.boosted_pipeline(df, ["a", "s", "one"], "y", trees=6, depth=2, rate=0.5).fit(df)
    mdl.save_model_and_metrics(model, {"m": 1.0}, f"{tmp_path}/model", None)
    again = PipelineModel.load(f"{tmp_path}/model")
    mine, its = (m.transform(df).sort("id").select("prediction").collect() for m in (model, again))
    assert mine == its and len(mine) == 161 and all(r.prediction is not None for r in mine)
    assert mdl.regression_metrics(model.transform(df), "y").first().rmse < 0.6
    top = mdl.feature_importance(again).collect()
    assert top[0].feature == "a" and {r.feature for r in top} == {"a", "one", "s_x", "s_y"}
    assert abs(sum(r.importance for r in top) - 1) < 1e-9


def test_cross_validation_over_shared_passes(spark):
    df = panel(spark, rows_of(random.Random(4), 120)).withColumn("fold", (F.col("id") % 3).cast("int"))
    cv = bst.cross_validate_boosted(df, ["a", "b", "c"], "y", "fold", k=3, trees=5, depth=2, rate=0.5)
    assert len(cv["fold_rmse"]) == 3 and abs(sum(cv["fold_rmse"]) / 3 - cv["rmse_mean"]) < 1e-12
    spread = df.agg(F.stddev_pop("y")).first()[0]
    assert all(0 < r < spread for r in cv["fold_rmse"])
    assert cv["model"].transform(df).where("prediction is null").count() == 0
    with pytest.raises(ValueError, match="fold 2"):
        bst.cross_validate_boosted(df.where("fold < 2"), ["a", "b", "c"], "y", "fold", k=3, trees=1, depth=1)


def test_samples_of_rows_and_cuts_of_vectors(spark):
    chosen = [bst.sampled(np.arange(20000), 42, t, 0.8) for t in (0, 1)]
    assert all(abs(c.mean() - 0.8) < 0.02 for c in chosen) and (chosen[0] != chosen[1]).any()
    df = spark.createDataFrame([(float(i), float(i == 7)) for i in range(5000)], "u double, rare double")
    cuts = bst.feature_cuts(VectorAssembler(inputCols=["u", "rare"], outputCol="f").transform(df), "f")
    assert cuts[1] == [0.0] and len(cuts[0]) == 254


# sketches ------------------------------------------------------------------------------------------

def rank_off(values, x, share):
    below, upto = sum(v < x for v in values), sum(v <= x for v in values)
    want = share * len(values)
    return max(0.0, below - want, want - upto) / len(values)


def test_sketch_quantiles_stay_within_the_stated_rank_error_merged_or_not(spark):
    rng = random.Random(5)
    rows = [(i % 5, rng.gauss(0, 1), float(rng.randrange(4)), None) for i in range(6000)] + [(1, float("nan"), None, None)] * 50
    df = spark.createDataFrame(rows, "g int, x double, few double, none double").repartition(7)
    k = 256
    whole = sketch.quantile_sketches(df, ["x", "few", "none"], k=k)
    parts = sketch.quantile_sketches(df, ["x", "few", "none"], ["g"], k)
    merged = sketch.merge_sketches(parts, ["x", "few", "none"])
    for sk in (whole, merged):
        for share in (0.01, 0.25, 0.5, 0.9):
            row = sk.select(*[sketch.sketch_quantile(c, share).alias(c) for c in ("x", "few", "none")], sketch.sketch_count("x").alias("n")).first()
            assert row.n == 6000 and row.none is None
            assert rank_off([r[1] for r in rows[:6000]], row.x, share) <= 2 * sketch.rank_error(k)
            assert rank_off([r[2] for r in rows[:6000]], row.few, share) <= 2 * sketch.rank_error(k)


def test_approximate_medians_and_imputation(spark):
    df = spark.createDataFrame([(float(i), None if i % 3 else 5.0) for i in range(101)], "x double, y double")
    assert sketch.approx_medians(df, ["x", "y"]) == {"x": 50.0, "y": 5.0}
    filled = mdl.impute_numeric(df, ["x", "y"], sketch.approx_medians(df, ["x", "y"]))
    assert filled.where("y is null").count() == 0 and sketch.approx_medians(df, []) == {}
    assert sketch.quantile_cuts(df.where("false"), ["x", "y"], 4) == [[], []]
