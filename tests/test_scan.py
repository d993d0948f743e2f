"""Prefix scans against windows, on tables with a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_period_grain import panel, rows  # noqa: F401

from tessera.operators import features as fe
from tessera.operators import filters as flt
from tessera.operators import impute as imp
from tessera.operators import period_grain as pg
from tessera.operators import scan


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(9)
    data = []
    for i in range(3000):
        k, p = ("hot", 2000) if i % 2 else (None, 2001) if i % 10 == 0 else (f"s{rng.randrange(40)}", 1990 + rng.randrange(6))
        data.append((k, p, i, None if rng.random() < 0.2 else float(rng.randrange(50))))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id string, season_start int, ord long, x double").repartition(5)


@pytest.mark.parametrize("keys, order", [(["id", "season_start"], ["ord"]), (["id"], ["season_start", "ord"]), ([], ["ord"])])
def test_scan_equals_windows(hot, keys, order):
    got = scan.prefix_scan(hot, keys, order, {"s": F.col("x"), "n": F.when(F.col("x") > 20, 1)}, "place", blocks=16)
    w = Window.partitionBy(*keys or [F.lit(1)]).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    want = hot.withColumns({"s": F.sum("x").over(upto), "n": F.sum(F.when(F.col("x") > 20, 1)).over(upto), "place": F.row_number().over(w) - 1})
    cols = ["id", "season_start", "ord", "x", "s", "n", "place"]
    assert got.columns == cols and rows(got, cols) == rows(want, cols)


def test_a_period_with_half_of_all_rows_is_in_many_blocks(hot):
    dealt = scan.deal_blocks(hot, ["id", "season_start"], ["ord"], 16)
    sizes = [r["count"] for r in dealt.groupBy(scan.BLOCK).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 3000 / 16
    assert dealt.where("id = 'hot'").select(scan.BLOCK).distinct().count() >= 6
    assert dealt.where("id is null").select(scan.BLOCK).distinct().count() >= 1
    plan = scan.prefix_scan(hot, ["id", "season_start"], ["ord"], {"s": F.col("x")}, "place")._jdf.queryExecution().optimizedPlan().toString()
    assert all(scan.BLOCK in line for line in plan.splitlines() if "Window [" in line and "__v0" in line and "__at" in line)


def test_scan_of_nothing_of_clashing_columns_and_of_no_sums(spark, hot):
    empty = hot.where("false")
    assert scan.prefix_scan(empty, ["id"], ["ord"], {"s": F.col("x")}, "place").count() == 0
    assert rows(scan.prefix_scan(hot, ["id"], ["ord"]), hot.columns) == rows(hot, hot.columns)
    replaced = scan.prefix_scan(hot, ["id"], ["ord"], {"x": F.col("x")})
    assert sorted(replaced.columns) == sorted(hot.columns) and replaced.count() == 3000
    with pytest.raises((KeyError, ValueError)):
        scan.prefix_scan(hot, ["nobody"], ["ord"])


def test_clock_career_components_and_history_equal_the_default_forms(panel, spark):  # noqa: F811
    a = imp.fill_gap_periods(panel)
    base = ["id", "season_start", "Team", "ord"]
    assert rows(scan.experience_clock(a), [*base, "years_in_nba"]) == rows(fe.experience_clock(a), [*base, "years_in_nba"])
    cols = [*base, "career_PTS_pg", "career_AST_pg", "total_PTS"]
    assert rows(scan.career_rate_to_date(a, ["PTS", "AST"]), cols) == rows(fe.career_rate_to_date(a, ["PTS", "AST"]), cols)
    for df in (panel, a):
        assert rows(flt.drop_components_split(df), base) == rows(flt.drop_components(df), base)
    dim = spark.createDataFrame([("AAA", 1995, "x"), ("AAA", 1994, "y"), ("BBB", 2003, "z")], "Tm string, season_year int, Coach string")
    args = (dim, dim, ["PTS", "AST"], ["PTS", "years_in_nba"])
    weights = {"weights": {"PTS": 1.0, "AST": 2.0}}
    mine, default = pg.history_features(a, *args, **weights, scan=True), pg.history_features(a, *args, **weights)
    assert sorted(mine.columns) == sorted(default.columns)
    assert rows(mine, sorted(default.columns)) == rows(default, sorted(default.columns))
