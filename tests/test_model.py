import numpy as np
import pytest

from tessera.operators import model as mdl


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=5001).round(3).tolist() + [None] * 7
    df = spark.createDataFrame([(v, float(i % 4)) for i, v in enumerate(vals)], "x double, y double")
    med = mdl.exact_medians(df, ["x", "y"])
    finite = [v for v in vals if v is not None]
    assert med["x"] == pytest.approx(float(np.median(finite)), abs=0)
    assert med["y"] == float(np.median([i % 4 for i in range(len(vals))]))


def test_exact_median_even_count_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "x double, z double")
    assert mdl.exact_medians(df, ["x", "z"]) == {"x": 2.5, "z": None}
    out = mdl.impute_numeric(df, ["x", "z"], report=lambda *_: None)
    assert "z" not in out.columns


def test_modes_and_one_hot(spark):
    df = spark.createDataFrame([("b", True), ("a", None), ("b", False), ("a", False), (None, True)],
                               "c string, f boolean")
    m = mdl.modes(df, ["c", "f"])
    assert m == {"c": "a", "f": False}  # ties -> lowest value
    filled = mdl.impute_categorical(df, ["c"])
    assert sorted(r.c for r in filled.collect()) == ["a", "a", "a", "b", "b"]
    oh = mdl.one_hot(df, "c", ["a", "b"]).collect()
    assert [(r.c_a, r.c_b) for r in oh] == [(0.0, 1.0), (1.0, 0.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)]


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = mdl.standardize(df, ["x", "k"]).collect()
    std = np.std([1, 2, 3])
    assert [r.x for r in out] == pytest.approx([(v - 2) / std for v in (1, 2, 3)])
    assert [r.k for r in out] == [0.0, 0.0, 0.0]  # constant column divided by 1


def test_folds_deterministic_and_balanced(spark):
    df = spark.range(2000).selectExpr("id", "CAST(id % 7 AS INT) AS s")
    a = mdl.assign_folds(df, ["id", "s"], 5, 42).groupBy("fold").count().collect()
    b = mdl.assign_folds(df.repartition(3), ["id", "s"], 5, 42).groupBy("fold").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(300 < r["count"] < 500 for r in a)
    arith = mdl.assign_folds(df, ["id", "s"], 5, 42, method="arith").groupBy("fold").count().collect()
    assert len(arith) == 5


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (None, 1.0)], "y double, prediction double")
    m = mdl.regression_metrics(df, "y").first()
    r = np.array([-0.5, 0.5, -0.5])
    y = np.array([1.0, 2.0, 3.0])
    assert m.rmse == pytest.approx(np.sqrt((r ** 2).mean()))
    assert m.mae == pytest.approx(0.5)
    assert m.r2 == pytest.approx(1 - (r ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m.n_rows == 3


@pytest.fixture(scope="module")
def train_df(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        a, b = float(rng.normal()), float(rng.normal())
        cat = ["x", "y", "z"][i % 3]
        flag = [True, False, None][i % 3]
        y = 3 * a - 2 * b + (1.5 if cat == "x" else 0.0) + float(rng.normal(scale=0.1))
        rows.append((i, 2000 + i % 5, a if i % 17 else None, b, cat, flag, y))
    return spark.createDataFrame(rows, "id long, season_start int, a double, b double, cat string, flag boolean, "
                                       "y double")


def test_preprocessor_and_gbt_invariants(spark, train_df, tmp_path):
    feats = ["a", "b", "cat", "flag"]
    pre = mdl.build_preprocessor(train_df, feats)
    assert pre.getOrDefault("numericCols") == ["a", "b"]
    assert pre.getOrDefault("categoricalCols") == ["cat", "flag"]
    pm = pre.fit(train_df)
    assert pm.feature_names() == ["a", "b", "cat_x", "cat_y", "cat_z", "flag_false", "flag_true"]
    pipe = mdl.gbt_pipeline(train_df, feats, "y", 42, maxIter=15, maxDepth=3)
    model = pipe.fit(train_df)
    scored = mdl.score_with_residual(model, train_df, "y")
    assert scored.where("prediction IS NULL").count() == 0
    m = mdl.regression_metrics(scored, "y").first()
    base = float(np.std([r.y for r in train_df.collect()]))
    assert m.rmse < base
    again = mdl.gbt_pipeline(train_df, feats, "y", 42, maxIter=15, maxDepth=3).fit(train_df)
    assert mdl.regression_metrics(mdl.score_with_residual(again, train_df, "y"), "y").first().rmse == m.rmse
    top = mdl.feature_importance(model, 25).collect()
    assert top[0].feature in ("a", "b") and len(top) <= 7
    mdl.save_model_and_metrics(model, {"cv_fold_rmse": [1.0, 2.0], "train_rmse": m.rmse},
                               f"{tmp_path}/model", f"{tmp_path}/metrics")
    from pyspark.ml import PipelineModel
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert loaded.transform(train_df).count() == 300
    js = spark.read.json(f"{tmp_path}/metrics").first()
    assert js.cv_fold_rmse == [1.0, 2.0]
    with pytest.raises(ValueError):
        mdl.build_preprocessor(train_df.selectExpr("array(1) AS arr"), ["arr"])


def test_cross_validate(spark, train_df):
    feats = ["a", "b", "cat", "flag"]
    cv = mdl.cross_validate(train_df, lambda d: mdl.gbt_pipeline(d, feats, "y", 42, maxIter=5, maxDepth=2),
                            "y", ["id", "season_start"], k=3, seed=42)
    assert len(cv["fold_rmse"]) == 3
    assert cv["rmse_mean"] == pytest.approx(float(np.mean(cv["fold_rmse"])))
    assert cv["rmse_std"] == pytest.approx(float(np.std(cv["fold_rmse"])))


def test_medians_ignore_nan_and_null_keys_get_folds(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, None), (4.0, None)], "x double, y double")
    assert mdl.exact_medians(df, ["x", "y"]) == {"x": 2.0, "y": None}
    folds = mdl.assign_folds(spark.createDataFrame([(None, 1), (2, None)], "a long, b long"), ["a", "b"], 5, 1, method="arith")
    assert folds.where("fold is null").count() == 0


def test_training_fits_folds_side_by_side(spark, monkeypatch):
    """A fit's small jobs leave cores idle, so several folds are fitted at a time, with the result of one after another."""
    from tessera.plans.training import train_and_export
    seen, real = [], mdl.cross_validate

    def spy(*a, parallelism=1, **kw):
        seen.append((parallelism, real(*a, **kw), real(*a, parallelism=parallelism, **kw)))
        return seen[-1][2]
    monkeypatch.setattr(mdl, "cross_validate", spy)
    rows = [(f"p{i}", 2000, float(i % 7), float(i % 7) * 2 + i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, season_start int, x double, fantasy_points_per_game double")
    train_and_export(df, gbt_params=dict(maxIter=2, maxDepth=2), k=3)
    assert seen[0][0] > 1 and seen[0][1] == seen[0][2]


def test_the_gbt_query_fits_the_librarys_trees(spark, monkeypatch):
    """The query's fit has the library's number of trees, depth, rate and samples; only this test makes it smaller."""
    from tessera.plans import queries
    seen, real = [], mdl.gbt_pipeline

    def spy(*a, **overrides):
        gbt = real(*a, **overrides).getStages()[-1]
        seen.append({k: gbt.getOrDefault(k) for k in mdl.GBT_DEFAULTS})
        return real(*a, **{**overrides, "maxIter": 3, "maxDepth": 2})
    rows = [(f"p{i}", 2000, float(i % 7), float(i % 7) * 2 + i % 3 if i % 9 else None) for i in range(60)]
    table = spark.createDataFrame(rows, f"id string, season_start int, x double, {queries.TARGET} double")
    monkeypatch.setattr(mdl, "gbt_pipeline", spy)
    monkeypatch.setattr(queries, "modelling_table", lambda *_: table)
    out = queries.q_gbt_pipeline(spark, "").collect()
    assert seen == [mdl.GBT_DEFAULTS]
    assert len(out) == 60 and all(r.predicted and r.better for r in out)
