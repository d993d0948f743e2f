"""The period-grain (hot-id resistant) forms give the default forms' results."""

import math

import pytest

from tessera.operators import features as fe
from tessera.operators import impute as imp
from tessera.operators import period_grain as pg


def rows(df, cols):
    def norm(v):
        if isinstance(v, float):
            return round(v, 9)
        if isinstance(v, list):
            return tuple(sorted(v))
        return v
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def panel(spark):
    data = []
    k = 0
    # a hot id with many periods, split periods and gaps, plus a few small ids and a NULL id
    for season in range(1990, 2030):
        if season % 7 == 3:
            continue  # gap
        teams = ["AAA"] if season % 4 else ["2TM", "AAA", "BBB"]
        for t in teams:
            k += 1
            pts = None if season % 11 == 0 else float(season % 13)
            age = None if season % 3 else float(season - 1970)
            data.append(("hot", season, t, k, "Name" if season % 5 else None, None if season % 6 else "C",
                         age, float(1 + season % 9), pts, float(season % 5)))
    for i in range(5):
        for season in (2000, 2001, 2003):
            k += 1
            data.append((f"s{i}", season, "CCC" if season < 2003 else "DDD", k, None, "G", 20.0 + i, 10.0, 1.0 * i,
                         2.0))
    data.append((None, 2000, "EEE", k + 1, None, None, None, 5.0, 1.0, 1.0))
    return spark.createDataFrame(data, "id string, season_start int, Team string, ord long, Player string, "
                                       "Pos string, Age double, G double, PTS double, AST double")


def test_gap_static_anchor(panel):
    cols = ["id", "season_start", "Team", "ord", "Player", "Pos", "Age", "G", "PTS", "did_play"]
    a = imp.fill_gap_periods(panel)
    b = pg.fill_gap_periods(panel)
    assert rows(a, cols) == rows(b, cols)
    assert rows(imp.fill_static(a, ["Player", "Pos"]), cols) == rows(pg.fill_static(a, ["Player", "Pos"]), cols)
    assert rows(imp.anchor_linear(a, "Age"), cols) == rows(pg.anchor_linear(a, "Age"), cols)


def test_clock_career_lag_team(panel):
    a = imp.fill_gap_periods(panel)
    base = ["id", "season_start", "Team", "ord"]
    assert rows(fe.experience_clock(a), base + ["years_in_nba"]) == rows(pg.experience_clock(a), base + ["years_in_nba"])
    assert (rows(fe.experience_clock(a, distinct_periods=True), base + ["years_in_nba"])
            == rows(pg.experience_clock(a, distinct_periods=True), base + ["years_in_nba"]))
    cc = base + ["career_PTS_pg", "career_AST_pg", "total_PTS"]
    assert rows(fe.career_rate_to_date(a, ["PTS", "AST"]), cc) == rows(pg.career_rate_to_date(a, ["PTS", "AST"]), cc)
    c = fe.experience_clock(a)
    lc = base + ["lag1_PTS", "lag1_G", "lag1_years_in_nba"]
    assert (rows(fe.previous_period_lag(c, ["PTS", "G", "years_in_nba"]), lc)
            == rows(pg.previous_period_lag(c, ["PTS", "G", "years_in_nba"]), lc))
    assert rows(fe.changed_group_flag(a), base + ["new_team"]) == rows(pg.changed_group_flag(a), base + ["new_team"])


def test_coach_flag(spark, panel):
    a = imp.fill_gap_periods(panel)
    seasons = range(1985, 2035)
    dim = spark.createDataFrame([(t, y, f"{t}-{y // 4}") for t in ("AAA", "BBB", "CCC", "DDD") for y in seasons],
                                "Tm string, season_year int, Coach string")
    prev = spark.createDataFrame([(t, y, f"{t}-{y // 4}") for t in ("AAA", "BBB", "CCC", "DDD") for y in seasons
                                  if y % 5], "Tm string, season_year int, Coach string")
    cols = ["id", "season_start", "Team", "ord", "new_coach"]
    got = rows(pg.changed_attribute_flag(a, dim, prev), cols)
    assert got == rows(fe.changed_attribute_flag(a, dim, prev), cols)
    assert any(r[-1] is True for r in got) and any(r[-1] is False for r in got)
    assert not math.isnan(len(got))


def test_fused_history_features(spark, panel):
    from tessera.operators.features import weighted_score
    a = imp.fill_gap_periods(panel)
    seasons = range(1985, 2035)
    dim = spark.createDataFrame([(t, y, f"{t}-{y // 4}") for t in ("AAA", "BBB", "CCC", "DDD") for y in seasons],
                                "Tm string, season_year int, Coach string")
    prev = spark.createDataFrame([(t, y, f"{t}-{y // 4}") for t in ("AAA", "BBB", "CCC", "DDD") for y in seasons
                                  if y % 5], "Tm string, season_year int, Coach string")
    w = {"PTS": 1.0, "AST": 1.5}
    lags = ["PTS", "G", "Age", "years_in_nba"]
    ref = fe.experience_clock(a)
    ref = fe.career_rate_to_date(ref, ["PTS", "AST"])
    ref = weighted_score(ref, w)
    ref = fe.previous_period_lag(ref, lags)
    ref = fe.changed_attribute_flag(ref, dim, prev)
    ref = fe.changed_group_flag(ref)
    got = pg.history_features(a, dim, prev, ["PTS", "AST"], lags, weights=w)
    cols = ["id", "season_start", "Team", "ord", "years_in_nba", "total_PTS", "career_PTS_pg", "career_AST_pg",
            "fantasy_points_per_game", "lag1_PTS", "lag1_G", "lag1_Age", "lag1_years_in_nba", "new_coach", "new_team"]
    assert sorted(got.columns) == sorted(ref.columns)
    assert rows(got, cols) == rows(ref, cols)


def test_fused_imputation(panel):
    cols = ["id", "season_start", "Team", "ord", "Player", "Pos", "Age", "G", "PTS", "did_play"]
    ref = imp.anchor_linear(imp.fill_static(imp.fill_gap_periods(panel), ["Player", "Pos"]), "Age")
    got = pg.impute_panel(panel, ["Player", "Pos"], "Age")
    assert sorted(got.columns) == sorted(ref.columns)
    assert rows(got, cols) == rows(ref, cols)


def test_summary_is_computed_once_without_grouped_collections(spark, panel):
    """Grouped collections and structs are sorted once more for every (id, period), so the summary is made by windows, and once."""
    a = imp.fill_gap_periods(panel)
    dim = spark.createDataFrame([("AAA", 2000, "x")], "Tm string, season_year int, Coach string")
    got = pg.history_features(a, dim, dim, ["PTS", "AST"], ["PTS", "G"], weights={"PTS": 1.0})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by(" not in plan and "collect_set(" in plan
    assert plan.count("Aggregate [id") == 1  # the distinct (id, period, team)
    assert sum("Window" in line and "sum(total_PTS" in line for line in plan.split("\n")) == 2  # the rows and, once, the summary


def test_clock_of_the_representative_row(spark):
    """An aggregate row that doesn't stand first gives the next period its own position; equal ranks count to the last of them."""
    rows_ = [("i", 2000, "AAA", 1, 1.0, 5.0), ("i", 2000, "2TM", 2, 2.0, 6.0), ("i", 2000, "BBB", 3, 3.0, None), ("i", 2001, "BBB", 4, 1.0, 1.0),
             ("i", 2001, "BBB", 4, 1.0, 1.0), ("i", 2002, "BBB", 5, 1.0, 2.0), ("j", 2001, None, 6, 1.0, None), ("j", 2002, "TOT", 7, 1.0, 3.0)]
    df = spark.createDataFrame(rows_, "id string, season_start int, Team string, ord long, G double, PTS double")
    dim = spark.createDataFrame([("AAA", 2000, "x")], "Tm string, season_year int, Coach string")
    got = pg.history_features(df, dim, dim, ["PTS"], ["PTS", "years_in_nba"], weights={"PTS": 1.0})
    clocks = {(r["id"], r["season_start"]): (r["lag1_years_in_nba"], r["lag1_PTS"], r["new_team"]) for r in got.collect()}
    assert clocks == {("i", 2000): (None, None, None), ("i", 2001): (1, 6.0, None), ("i", 2002): (4, 1.0, False),
                      ("j", 2001): (None, None, None), ("j", 2002): (0, None, None)}


@pytest.mark.parametrize("with_ord", [True, False])
def test_lagged_clock_is_the_representative_rows_own(spark, with_ord):
    """Also where rows share an ord, have none, or the table has none."""
    rows_ = [("i", 2000 + y, t, None if y % 2 else 7, 1.0, 1.0) for y in range(4) for t in ("AAA", "BBB", "3TM", "CCC")]
    df = spark.createDataFrame(rows_, "id string, season_start int, Team string, ord long, G double, PTS double")
    df = df if with_ord else df.drop("ord")
    dim = spark.createDataFrame([("AAA", 2000, "x")], "Tm string, season_year int, Coach string")
    got = pg.history_features(df, dim, dim, ["PTS"], ["years_in_nba"], weights={"PTS": 1.0}).collect()
    own = {r["season_start"] + 1: r["years_in_nba"] for r in got if r["Team"] == "3TM"}
    assert len(own) == 4 and all(r["lag1_years_in_nba"] == own.get(r["season_start"]) for r in got)
    assert sorted(r["years_in_nba"] for r in got) == list(range(16))
