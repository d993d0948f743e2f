from conftest import by, frame

from tessera.operators.impute import anchor_linear, fill_gap_periods, fill_static


def test_gap_fill_adds_the_periods_between(spark):
    df = frame(spark, [("z9", 1700, 3.0), ("z9", 1704, 0.0), ("y1", 1702, 1.0)], "id string, season_start int, G double")
    out = by(fill_gap_periods(df), "id", "season_start")
    assert sorted(out) == [("y1", 1702)] + [("z9", y) for y in range(1700, 1705)]
    assert {y: (out[("z9", y)]["G"], out[("z9", y)]["did_play"]) for y in range(1700, 1705)} == {
        1700: (3.0, True), **{y: (0.0, False) for y in range(1701, 1705)}}


def test_gap_fill_keeps_the_period_type(spark):
    df = frame(spark, [("z", 5, 1.0), ("z", 8, 1.0)], "id string, season_start long, G double")
    out = fill_gap_periods(df)
    assert out.schema["season_start"].dataType == df.schema["season_start"].dataType and out.count() == 4


def test_gap_fill_keeps_split_rows_and_drops_null_id(spark):
    df = frame(spark, [("q", 1800, "mill", 2.0), ("q", 1800, "TOT", 9.0), ("q", 1800, "dock", 7.0), ("q", 1802, "dock", None),
                       (None, 1801, "mill", 4.0)], "id string, season_start int, Team string, G double")
    got = sorted((r.season_start, r.Team or "", r.G) for r in fill_gap_periods(df).collect())
    assert got == [(1800, "TOT", 9.0), (1800, "dock", 7.0), (1800, "mill", 2.0), (1801, "", 0.0), (1802, "dock", 0.0)]


def test_static_fill(spark):
    df = frame(spark, [("m", 1810, None, "oak"), ("m", 1811, "Iris", None), ("m", 1815, None, None), ("n", 1811, None, "elm")],
               "id string, season_start int, Player string, Pos string")
    rows = fill_static(df, ["Player", "Pos"]).collect()
    assert {(r.id, r.Player, r.Pos) for r in rows} == {("m", "Iris", "oak"), ("n", None, "elm")}


def test_static_fill_takes_latest_value_for_all_rows(spark):
    df = frame(spark, [("m", y, c, n, n) for y, c, n in ((1, "red", None), (2, None, 4), (3, "blue", None), (4, None, None))],
               "id string, season_start int, colour string, size int, other int")
    out = by(fill_static(df, ["colour", "size"]), "season_start")
    assert {(r["colour"], r["size"]) for r in out.values()} == {("blue", 4)}
    assert [out[y]["other"] for y in range(1, 5)] == [None, 4, None, None]  # not asked for
    asof = by(fill_static(df, ["colour"], as_of=True), "season_start")
    assert [asof[y]["colour"] for y in range(1, 5)] == ["red", "red", "blue", "blue"]


def test_age_counts_on_from_the_anchor(spark):
    df = frame(spark, [("m", 1850, 41.5), ("m", 1853, None), ("m", 1860, None)], "id string, season_start int, Age double")
    out = by(anchor_linear(df, "Age"), "season_start")
    assert {y: r["Age"] for y, r in out.items()} == {1850: 41.5, 1853: 44.5, 1860: 51.5}


def test_age_counts_back_and_unknown_stays(spark):
    df = frame(spark, [("m", 1850, None), ("m", 1856, 12.0), ("m", 1858, 80.0), ("n", 1850, None)],
               "id string, season_start int, Age double")
    out = by(anchor_linear(df, "Age"), "id", "season_start")
    assert [out[("m", y)]["Age"] for y in (1850, 1856, 1858)] == [6.0, 12.0, 14.0]
    assert out[("n", 1850)]["Age"] is None
