import pytest
from conftest import by, frame
from pyspark.sql import functions as F

from tessera.functions.expressions import parse_season_label
from tessera.operators.features import (
    career_rate_to_date,
    changed_attribute_flag,
    changed_group_flag,
    experience_clock,
    previous_period_lag,
    weighted_score,
)
from tessera.operators.staffing import lookup_from_labels


def test_career_rate_weights_earlier_rows_by_games(spark):
    # a courier's parcels per trip: 6 trips of 3.5, none, 2 of 8, then 4 more
    df = frame(spark, [("c7", 1981, 3.5, 6.0), ("c7", 1984, None, 0.0), ("c7", 1985, 8.0, 2.0), ("c7", 1990, 1.0, 4.0)],
               "id string, season_start int, PTS double, G double")
    out = by(career_rate_to_date(df, ["PTS"]), "season_start")
    assert [out[y]["career_PTS_pg"] for y in (1981, 1984, 1985)] == [None, None, 3.5]
    assert out[1990]["career_PTS_pg"] == pytest.approx((21 + 16) / 8)
    assert [out[y]["total_PTS"] for y in (1981, 1985)] == [21.0, 16.0]


def test_career_rate_counts_split_season_twice(spark):
    rows = [("A", 2010, "2TM", 10.0, 10.0), ("A", 2010, "X", 20.0, 5.0), ("A", 2010, "Y", 0.0, 5.0),
            ("A", 2011, "X", 0.0, 1.0)]
    df = frame(spark, rows, "id string, season_start int, Team string, PTS double, G double")
    out = by(career_rate_to_date(df, ["PTS"]), "season_start", "Team")
    assert out[(2011, "X")]["career_PTS_pg"] == pytest.approx((100 + 100 + 0) / 20)
    fixed = by(career_rate_to_date(df, ["PTS"], exclude_components=True), "season_start", "Team")
    assert fixed[(2011, "X")]["career_PTS_pg"] == pytest.approx(100 / 10)


def test_weighted_score(spark):
    names = ["PTS", "TRB", "AST", "STL", "BLK", "TOV"]
    unit = spark.createDataFrame([[int(i == j) for j in range(6)] for i in range(6)] + [[2] * 6],
                                 ", ".join(f"{n} int" for n in names))
    got = [r.fantasy_points_per_game for r in weighted_score(unit).collect()]
    assert got[-1] == pytest.approx(2 * sum(got[:6]))  # linear, and each column has a weight of its own
    assert got[0] == 1 and got[5] < 0 and all(got)
    assert weighted_score(unit, {"AST": 0.25, "TOV": -4}).collect()[-1][-1] == pytest.approx(-7.5)


def test_weighted_score_coerces_and_requires(spark):
    df = spark.createDataFrame([(" 3 ", "x", "1", "1", "1", "1")], "PTS string, AST string, TRB string, "
                               "BLK string, STL string, TOV string")
    assert weighted_score(df).first().fantasy_points_per_game is None
    with pytest.raises(KeyError):
        weighted_score(df.drop("TOV"))


def test_lag_skips_missing_periods(spark):
    df = frame(spark, [("s1", y, "north", v, v and -v) for y, v in ((1950, 4.25), (1957, 0.5), (1958, None), (1970, 9.0))],
               "id string, season_start int, Team string, PTS double, FTA double")
    out = by(previous_period_lag(df, ["PTS", "FTA"]), "season_start")
    assert [out[y]["lag1_PTS"] for y in (1950, 1957, 1958, 1970)] == [None, 4.25, 0.5, None]
    assert out[1957]["lag1_FTA"] == -4.25


def test_lag_takes_the_summary_row_wherever_it_stands(spark):
    parts = [("east", 3.0), ("west", 5.0)]
    for at in range(3):
        rows = [("k", 1901, t, v, v) for t, v in parts]
        rows.insert(at, ("k", 1901, "tot", 4.5, 44.0))
        df = frame(spark, [*rows, ("k", 1902, "west", 1.0, 1.0), ("k", 1902, "3tm", 2.0, 2.0), ("k", 1903, "west", 6.0, 6.0)],
                   "id string, season_start int, Team string, PTS double, FTA double")
        got = previous_period_lag(df, ["PTS", "FTA"]).collect()
        assert {(r.lag1_PTS, r.lag1_FTA) for r in got if r.season_start == 1902} == {(4.5, 44.0)}
        assert [r.lag1_PTS for r in got if r.season_start == 1903] == [2.0]


def test_lag_first_non_null_per_column(spark):
    df = frame(spark, [("a", 2020, "2TM", None, 5.0), ("a", 2020, "X", 7.0, 6.0), ("a", 2021, "X", 1.0, 1.0)],
               "id string, season_start int, Team string, PTS double, FTA double")
    out = by(previous_period_lag(df, ["PTS", "FTA"]), "season_start", "Team")
    assert out[(2021, "X")]["lag1_PTS"] == 7.0 and out[(2021, "X")]["lag1_FTA"] == 5.0


def test_lag_empty_list_returns_input(spark):
    df = frame(spark, [("a", 2020, "X")], "id string, season_start int, Team string")
    assert previous_period_lag(df, []) is df


def test_experience_clock_counts_rows(spark):
    df = frame(spark, [("a", 2020, "X"), ("a", 2021, "2TM"), ("a", 2021, "X"), ("a", 2021, "Y"), ("a", 2022, "Y"),
                       (None, 2020, "Z")], "id string, season_start int, Team string")
    rows = experience_clock(df).collect()
    clock = {(r.season_start, r.Team): r.years_in_nba for r in rows if r.id}
    assert clock[(2022, "Y")] == 4
    assert [r.years_in_nba for r in rows if r.id is None] == [None]
    periods = {(r.season_start, r.Team): r.years_in_nba for r in experience_clock(df, distinct_periods=True).collect()
               if r.id}
    assert periods[(2022, "Y")] == 2


@pytest.mark.parametrize("label,expected", [("22_23", 2022), ("2021_22", 2021), ("99_00", 1999), ("2005-06", 2005)])
def test_season_label(spark, label, expected):
    df = spark.createDataFrame([(label,)], "s string")
    assert df.select(parse_season_label("s").alias("y")).first().y == expected


@pytest.mark.parametrize("label", ["", None, "_23"])
def test_season_label_invalid(spark, label):
    df = spark.createDataFrame([(label,)], "s string")
    with pytest.raises(Exception):
        df.select(parse_season_label("s").alias("y")).collect()
    assert df.select(parse_season_label("s", strict=False).alias("y")).first().y is None


def dims(spark, max_rows, first_rows):
    prev = lookup_from_labels(spark.createDataFrame(max_rows, "Tm string, Season string, Coach string"))
    cur = lookup_from_labels(spark.createDataFrame(first_rows, "Tm string, Season string, Coach string"))
    return cur, prev


LABELS = {1961: "61_62", 1962: "62_63", 1963: "63_64", 1964: "64_65"}


def holders(**groups):
    """Lookup rows: group=[(year, holder), ...]."""
    return [(g, LABELS[y], who) for g, rows in groups.items() for y, who in rows]


def test_flag_without_id_compares_with_the_period_before(spark):
    df = frame(spark, [(g, 1963) for g in ("mill", "dock", "yard", "farm")], "Team string, season_start int")
    cur, prev = dims(spark, holders(mill=[(1962, "Ida")], dock=[(1962, "Ben")], farm=[(1962, "Una")]),
                     holders(mill=[(1963, "Ida")], dock=[(1963, "Cy")], yard=[(1963, "Dov")]))
    out = by(changed_attribute_flag(df, cur, prev), "Team")
    assert {g: r["new_coach"] for g, r in out.items()} == {"mill": False, "dock": True, "yard": None, "farm": None}


def test_flag_uses_most_games_holder_before_and_first_holder_now(spark):
    df = frame(spark, [("mill", y) for y in (1962, 1963, 1964)], "Team string, season_start int")
    cur, prev = dims(spark, holders(mill=[(1961, "Ida"), (1962, "Ned"), (1963, "Ida")]),
                     holders(mill=[(1962, "Ida"), (1963, "Ida"), (1964, "Ida")]))
    out = by(changed_attribute_flag(df, cur, prev), "season_start")
    assert [out[y]["new_coach"] for y in (1962, 1963, 1964)] == [False, True, False]


def test_flag_looks_back_to_the_groups_own_last_period(spark):
    df = frame(spark, [(g, y) for y in (1961, 1964) for g in ("mill", "dock")], "Team string, season_start int")
    rows = holders(mill=[(1961, "Ida"), (1963, "Ned"), (1964, "Ned")], dock=[(1961, "Ben"), (1963, "Eve"), (1964, "Ben")])
    out = by(changed_attribute_flag(df, *dims(spark, rows, rows)), "Team", "season_start")
    assert [out[(g, 1961)]["new_coach"] for g in ("mill", "dock")] == [None, None]
    assert [out[(g, 1964)]["new_coach"] for g in ("mill", "dock")] == [True, False]


def test_flag_in_split_periods(spark):
    df = frame(spark, [("h", "mill", 1962), ("h", "mill", 1963), ("h", "TOT", 1963), ("h", "dock", 1963), ("h", "dock", 1964)],
               "id string, Team string, season_start int")
    cur, prev = dims(spark, holders(mill=[(1961, "Ida"), (1962, "Ida")], dock=[(1962, "Ben"), (1963, "Ben")]),
                     holders(mill=[(1962, "Ida"), (1963, "Ned")], dock=[(1963, "Ben"), (1964, "Cy")]))
    out = by(changed_attribute_flag(df, cur, prev), "Team", "season_start")
    assert out[("mill", 1962)]["new_coach"] is None  # the group is new to the id
    assert out[("mill", 1963)]["new_coach"] is True and out[("TOT", 1963)]["new_coach"] is True  # first real group's
    assert out[("dock", 1963)]["new_coach"] is None
    assert out[("dock", 1964)]["new_coach"] is True


def test_new_coach_fallback_needs_key_found_not_value(spark):
    # previous season exists in the lookup with a NULL coach: no fallback to season - 1
    df = frame(spark, [("a", "X", 2020), ("a", "X", 2022)], "id string, Team string, season_start int")
    prev = spark.createDataFrame([("X", 2020, None), ("X", 2021, "Old")], "Tm string, season_year int, Coach string")
    cur = spark.createDataFrame([("X", 2022, "New")], "Tm string, season_year int, Coach string")
    out = by(changed_attribute_flag(df, cur, prev), "season_start")
    assert out[2022]["new_coach"] is None


def test_group_change(spark):
    walks = {"u": [(1930, "mill"), (1931, "mill"), (1935, "dock"), (1936, "mill")], "v": [(1931, "yard")]}
    df = frame(spark, [(i, y, t) for i, w in walks.items() for y, t in w], "id string, season_start int, Team string")
    out = by(changed_group_flag(df), "id", "season_start")
    assert [out[("u", y)]["new_team"] for y, _ in walks["u"]] == [None, False, True, True]
    assert out[("v", 1931)]["new_team"] is None


def test_group_change_skips_unknown_groups(spark):
    df = frame(spark, [("u", 1930, None), ("u", 1931, "mill"), ("u", 1932, None), ("u", 1940, "mill"), ("u", 1941, "dock")],
               "id string, season_start int, Team string")
    out = by(changed_group_flag(df), "season_start")
    assert [out[y]["new_team"] for y in (1930, 1931, 1932, 1940, 1941)] == [None, None, None, False, True]


def test_group_change_in_split_periods(spark):
    df = frame(spark, [("u", 1931, "mill"), ("u", 1932, "dock"), ("u", 1932, "tot"), ("u", 1932, "mill"), ("u", 1933, "dock")],
               "id string, season_start int, Team string")
    out = by(changed_group_flag(df), "season_start", "Team")
    assert out[(1932, "tot")]["new_team"] is False
    assert out[(1932, "dock")]["new_team"] is None and out[(1932, "mill")]["new_team"] is None
    assert out[(1933, "dock")]["new_team"] is True  # what came before is the summary row's group


def test_no_python_udf_in_feature_plan(spark):
    df = frame(spark, [("a", 2020, "X", 1.0, 1.0)], "id string, season_start int, Team string, PTS double, G double")
    out = previous_period_lag(career_rate_to_date(df, ["PTS"]), ["PTS"]).transform(changed_group_flag)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


def test_last_lookup_row_of_a_key_counts_and_rows_do_not_multiply(spark):
    df = frame(spark, [("a", "mill", 1961), ("a", "mill", 1962)], "id string, Team string, season_start int")
    cur, prev = dims(spark, [("mill", "1961_62", "Zoe"), ("mill", "61_62", "Abe")],
                     [("mill", "1962_63", "Zoe"), ("mill", "62_63", "Abe")])
    out = changed_attribute_flag(df, cur, prev).collect()
    assert {r.season_start: r.new_coach for r in out} == {1961: None, 1962: False} and len(out) == 2
    cur2, prev2 = dims(spark, [("mill", "1961_62", "Zoe"), ("mill", "61_62", "Abe")], [("mill", "62_63", "Zoe")])
    assert by(changed_attribute_flag(df, cur2, prev2), "season_start")[1962]["new_coach"] is True


def test_blank_holder_is_unknown(spark):
    df = frame(spark, [("a", "mill", 1961), ("a", "mill", 1962)], "id string, Team string, season_start int")
    for before, now in (("Ida", " "), ("", "Ida")):
        cur, prev = dims(spark, holders(mill=[(1961, before)]), holders(mill=[(1962, now)]))
        assert by(changed_attribute_flag(df, cur, prev), "season_start")[1962]["new_coach"] is None


def test_own_columns_with_leading_underscores_stay(spark):
    df = frame(spark, [("a", "mill", 1961, 5)], "id string, Team string, season_start int, __mine int")
    cur, prev = dims(spark, holders(mill=[(1961, "Ida")]), holders(mill=[(1961, "Ida")]))
    out = changed_attribute_flag(df, cur, prev)
    assert out.columns == [*df.columns, "new_coach"] and out.first()["__mine"] == 5


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([("NaN", "1", "1", "1", "1", "1")], "PTS string, AST string, TRB string, BLK string, "
                               "STL string, TOV string")
    assert weighted_score(df).first().fantasy_points_per_game is None
