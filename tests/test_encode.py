"""Sparse one-hot vectors, equal folds, folds side by side, hot groups' summaries, saved models' importances."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import boosting as bst
from tessera.operators import encode
from tessera.operators import model as mdl
from tessera.operators import staffing as stf
from tessera.plans.jobs import list_importances


def test_sparse_vectors_equal_one_hot_columns(spark):
    rows = [(1, "b", True, 2.0), (2, "a", None, None), (3, None, False, 1.0), (4, "é", True, 0.0), (5, "a", True, 7.0)]
    df = spark.createDataFrame(rows, "id long, s string, `b.c` boolean, x double")
    out = encode.sparse_one_hot(df, ["s", "b.c"], numeric=["x"]).sort("id").collect()
    assert out[0].features.size == 6 and [list(map(int, r.features.indices)) for r in out] == [
        [0, 2, 5], [0, 1], [0, 4], [0, 3, 5], [0, 1, 5]]
    assert out[0].features.values.tolist() == [2.0, 1.0, 1.0] and str(out[1].features.values[0]) == "nan"
    dense = mdl.one_hot(df, "s").sort("id").collect()
    assert [[r[f"s_{v}"] for v in ("a", "b", "é")] for r in dense] == [r.features.toArray()[1:4].tolist() for r in out]


def test_vectors_of_many_categories_are_unpacked_without_their_zeros(spark):
    rows = [(1, Vectors.sparse(2_000_000_000, [0, 7, 1_999_999_999], [5.0, 1.0, 2.0])), (2, Vectors.dense([0.0, 3.0])), (3, None),
            (4, Vectors.sparse(3, [], [])), (5, Vectors.dense([]))]
    got = encode.sparse_entries(spark.createDataFrame(rows, T.StructType().add("id", "long").add("f.x", VectorUDT())), "f.x").sort("id").collect()
    assert [r["f.x"] and tuple(r["f.x"]) for r in got] == [
        (2_000_000_000, [0, 7, 1_999_999_999], [5.0, 1.0, 2.0]), (2, [0, 1], [0.0, 3.0]), None, (3, [], []), (0, [], [])]


def test_unknown_categories_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([("a", 1.0), ("z", 2.0)], "s string, x double")
    index = encode.category_index(df.where("s = 'a'"), ["s"])
    got = encode.sparse_one_hot(df, ["s"], index).collect()
    assert [r.features.toArray().tolist() for r in got] == [[1.0], [0.0]]
    assert [r.features.toArray().tolist() for r in encode.sparse_one_hot(df, [], numeric=["x"]).sort("x").collect()] == [[1.0], [2.0]]
    assert encode.sparse_one_hot(df.where("false"), ["s"]).count() == 0
    with pytest.raises((KeyError, ValueError)):
        encode.category_index(df, ["nobody"])


def test_many_categories_leave_schema_and_plan_small(spark):
    n = 400_000
    many = spark.range(n, numPartitions=8).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("s"), "id")
    index = encode.category_index(many, ["s"])
    out = encode.sparse_one_hot(many, ["s"], index)
    few = encode.sparse_one_hot(many.limit(3), ["s"], index)
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert out.columns == ["s", "id", "features"] and size(out) < size(few) + 2000
    got = out.where(F.col("id").isin(0, 7, n - 1)).sort("id").collect()
    assert [(r.features.size, int(r.features.indices[0])) for r in got] == [(n, 0), (n, 7), (n, n - 1)]


@pytest.mark.parametrize("method", ["hash", "arith"])
def test_folds_of_equal_size(spark, method):
    rows = [(i % 50 if i % 9 else None, i // 50) for i in range(503)]
    df = spark.createDataFrame(rows, "id long, season int").repartition(4)
    got = mdl.assign_folds(df, ["id", "season"], 5, method=method, equal=True)
    sizes = sorted(r["count"] for r in got.groupBy("fold").count().collect())
    assert sizes == [100, 100, 101, 101, 101] and got.columns == ["id", "season", "fold"]
    again = mdl.assign_folds(df.repartition(3), ["id", "season"], 5, method=method, equal=True)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, again.collect()), key=key)
    assert sorted(r.fold for r in mdl.assign_folds(df.limit(3), ["id"], 5, equal=True).collect()) == [0, 1, 2]


def test_folds_side_by_side_give_the_same_scores(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, float(i % 7), 2.0 * (i % 7) + rng.random()) for i in range(200)], "id long, x double, y double")

    def factory(_):
        from pyspark.ml.feature import VectorAssembler
        return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")])
    one = mdl.cross_validate(df, factory, "y", ["id"], k=4)
    assert mdl.cross_validate(df, factory, "y", ["id"], k=4, parallelism=3) == one
    with pytest.raises(ValueError, match="fold"):
        mdl.cross_validate(df.limit(2), lambda _: SQLTransformer(statement="SELECT *, y AS prediction FROM __THIS__") and Pipeline(
            stages=[SQLTransformer(statement="SELECT *, y AS prediction FROM __THIS__")]), "y", ["id"], k=4, parallelism=2)


def test_summaries_of_a_hot_group_in_blocks(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 2 else f"t{i % 8}", None if i % 5 else "98_99", None if i % 11 == 0 else f"p{i}", i) for i in range(600)]
    rows += [("empty", "98_99", None, 9999)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "Tm string, Season string, Coach string, ord long")
    key = lambda r: (str(r[0]), str(r[1]))
    want = sorted(map(tuple, stf.staff_summary(df).collect()), key=key)
    for block in (7, 4096):
        assert sorted(map(tuple, stf.staff_summary_split(df, block=block).collect()), key=key) == want


def test_importances_of_a_saved_model(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 5), "ab"[i % 2], 3.0 * (i % 5 > 2)) for i in range(80)], "x double, s string, y double")
    path = f"{tmp_path}/m"
    bst.boosted_pipeline(df, ["x", "s"], "y", trees=2, depth=1).fit(df).write().save(path)
    assert [r.feature for r in list_importances(spark, path, 1).collect()] == ["x"]
    with pytest.raises(FileNotFoundError):
        list_importances(spark, f"{tmp_path}/none")
