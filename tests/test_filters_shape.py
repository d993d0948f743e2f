import pytest
from conftest import frame

from tessera.operators.filters import drop_components, filter_in_list, filter_min, filter_not_equal_keep_null
from tessera.operators.joins import duplicate_keys, join_one_to_one, validate_keys
from tessera.operators.shape import rename_strict, round_floats, select_features, split_features_target


def test_drop_components(spark):
    rows = [("u", 7, "mill"), ("u", 7, "dock"), ("u", 7, "4tm"), ("u", 8, "mill"), ("v", 7, "tot"), ("v", 7, "yard")]
    df = frame(spark, rows, "id string, season_start int, Team string")
    assert sorted((r.season_start, r.Team) for r in drop_components(df).collect()) == [(7, "4tm"), (7, "tot"), (8, "mill")]


def test_drop_components_without_aggregate_row_and_null_id(spark):
    df = frame(spark, [("p", 2020, "A"), ("p", 2020, "B"), (None, 2020, "A"), (None, 2020, "B")],
               "id string, season_start int, Team string")
    assert sorted(r.Team for r in drop_components(df).collect()) == ["A", "B"]  # only the NULL-id rows


def test_non_zero_filter_keeps_null(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 0, None, -1, 0])], "row int, years_in_nba int")
    assert sorted(r.row for r in filter_not_equal_keep_null(df).collect()) == [0, 2, 3]
    with pytest.raises(KeyError):
        filter_not_equal_keep_null(df.drop("years_in_nba"))


def test_filter_min_drops_null(spark):
    df = spark.createDataFrame([(29.0,), (30.0,), (None,)], "G double")
    assert [r.G for r in filter_min(df, 30).collect()] == [30.0]
    with pytest.raises(KeyError):
        filter_min(df.withColumnRenamed("G", "x"))


def test_filter_in_list(spark):
    df = spark.createDataFrame([("p",), ("q",), ("r",), (None,)], "`Player-additional` string")
    assert sorted(r[0] for r in filter_in_list(df, ["r", "p", "zz"]).collect()) == ["p", "r"]
    ids = spark.createDataFrame([("q",), ("q",)], "k string")
    assert [r[0] for r in filter_in_list(df, ids).collect()] == ["q"]  # semi join: no duplication


def test_round_floats(spark):
    df = spark.createDataFrame([(10.06, 7, "1.26"), (-3.14159, 8, None), (None, 9, "x")], "x double, n int, t string")
    assert [tuple(r) for r in round_floats(df, 1).collect()] == [(10.1, 7, "1.26"), (-3.1, 8, None), (None, 9, "x")]
    assert round_floats(df, 3).collect()[1].x == -3.142 and df.first().x == 10.06


def test_round_half_even_edges(spark):
    vals = [0.25, 0.35, -0.25, 7.15, 1.45]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    import numpy as np
    assert [r.x for r in round_floats(df, 1).collect()] == [float(np.round(v, 1)) for v in vals]
    with pytest.raises(ValueError):
        round_floats(df, -1)


def test_rename_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_strict(df, {"a": "x"}).columns == ["x", "b"]
    assert rename_strict(df, {}) is df
    with pytest.raises(KeyError, match="missing"):
        rename_strict(df, {"a": "x", "zz": "y"})


def test_select_and_split(spark):
    df = spark.createDataFrame([("w1", "spring", 3, 0.5, 9.0)], "well string, part string, depth int, flow double, yield_ double")
    assert select_features(df, ["yield_", "well"]).columns == ["yield_", "well"]
    with pytest.raises(KeyError):
        select_features(df, ["nope"])
    kept, feats, target = split_features_target(df, "yield_", ["well", "absent"])
    assert (feats, target, kept.columns) == (["part", "depth", "flow"], "yield_", ["part", "depth", "flow", "yield_"])
    for bad, drop, kind in ((df, ["well"], KeyError), (df, ["yield_"], ValueError), (df.select("yield_"), [], ValueError)):
        with pytest.raises(kind):
            split_features_target(bad, "absent" if kind is KeyError else "yield_", drop)


def test_keys_and_one_to_one_join(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), (None, 1, 3.0)], "k string, s int, v double")
    right = spark.createDataFrame([("a", 1, 10.0), (None, 1, 30.0)], "k string, s int, w double")
    out = {(r.k, r.s): r.w for r in join_one_to_one(left, right, ["k", "s"]).collect()}
    assert out == {("a", 1): 10.0, ("b", 1): None, (None, 1): 30.0}  # NULL keys match, as in a merge
    dup = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2)], "k string, s int")
    assert duplicate_keys(dup, ["k", "s"]).count() == 2
    with pytest.raises(ValueError):
        validate_keys(dup, ["k", "s"])
    with pytest.raises(KeyError):
        validate_keys(dup, ["k", "zz"])
