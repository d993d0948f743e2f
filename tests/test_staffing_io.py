import os

import pytest

from tessera.operators.staffing import distinct_by_first, first_by_group, max_by_group, staff_summary
from tessera.sources.io import read_model_table, read_seasons, read_staffing, write_table


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_load_seasons(spark, tmp_path):
    write(f"{tmp_path}/09_10/players.csv", "Player,FP\nA,1\nB,2\n")
    write(f"{tmp_path}/10_11/players.csv", "Player,FP\nC,3\nD,4\n")
    df = read_seasons(spark, str(tmp_path))
    rows = df.orderBy("ord").collect()
    assert len(rows) == 4
    assert sorted({r.season_start for r in rows}) == [2009, 2010]
    assert [r.Player for r in rows] == ["A", "B", "C", "D"]  # file order kept by ord


def test_load_seasons_different_layouts_and_bad_folder(spark, tmp_path):
    from pyspark.sql import types as T
    write(f"{tmp_path}/98_99/players.csv", "Player,G,PTS\nA,10,5.5\n")
    write(f"{tmp_path}/99_00/players.csv", "PTS,Player,AST\n7.5,B,2\n")
    write(f"{tmp_path}/misc/players.csv", "Player\nZ\n")
    write(f"{tmp_path}/00_01/other.csv", "Player\nY\n")
    schema = T.StructType([T.StructField("Player", T.StringType()), T.StructField("G", T.DoubleType()),
                           T.StructField("PTS", T.DoubleType()), T.StructField("AST", T.DoubleType())])
    seen = []
    rows = {r.Player: r for r in read_seasons(spark, str(tmp_path), schema=schema, report=seen.append).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].season_start == 1998 and rows["B"].season_start == 1999
    assert rows["B"].PTS == 7.5 and rows["B"].G is None and rows["A"].AST is None
    assert any("misc" in s for s in seen)


def test_load_seasons_empty_raises(spark, tmp_path):
    with pytest.raises(ValueError):
        read_seasons(spark, str(tmp_path))


def test_staffing_reader_and_tables(spark, tmp_path):
    header = "Coach,Tm,G,W,L,G,W,L,G,W,L,W%\n"
    write(f"{tmp_path}/21_22/coaches.csv",
          header + " Kerr ,GSW,82,53,29,875,500,375,1,1,1,.6\n"
          "Ham,LAL,82.0,33,49,1,1,1,1,1,1,.4\n"
          "\n"
          "Vogel,LAL,,1,1,1,1,1,1,1,1,.5\n"
          "Ham,LAL,50,1,1,1,1,1,1,1,1,.5\n")
    staff = read_staffing(spark, str(tmp_path))
    rows = staff.orderBy("ord").collect()
    assert [(r.Coach, r.Tm, r.G, r.Season) for r in rows] == [
        ("Kerr", "GSW", 82, "21_22"), ("Ham", "LAL", 0, "21_22"), ("Vogel", "LAL", 0, "21_22"),
        ("Ham", "LAL", 50, "21_22")]
    dedup = distinct_by_first(staff)
    assert {(r.Coach, r.G) for r in dedup.where("Tm = 'LAL'").collect()} == {("Ham", 0), ("Vogel", 0)}
    assert {r.Tm: r.Coaches for r in staff_summary(dedup).collect()} == {"GSW": "Kerr", "LAL": "Ham, Vogel"}
    assert {r.Tm: r.Coach for r in first_by_group(dedup).collect()} == {"GSW": "Kerr", "LAL": "Ham"}
    # tie on games (0, 0): the earlier row wins
    mx = {r.Tm: (r.Coach, r.G) for r in max_by_group(dedup, games_col="G").collect()}
    assert mx == {"GSW": ("Kerr", 82), "LAL": ("Ham", 0)}


def test_model_table_reader_and_writer(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_model_table(spark, f"{tmp_path}/missing.csv")
    empty = f"{tmp_path}/empty.csv"
    write(empty, "a,b\n")
    with pytest.raises(ValueError):
        read_model_table(spark, empty)
    df = spark.createDataFrame([(1, None, True)], "a int, b string, c boolean")
    assert write_table(df, None) is None
    path = write_table(df, f"{tmp_path}/out")
    back = read_model_table(spark, path, schema=df.schema).collect()
    assert [tuple(r) for r in back] == [(1, None, True)]


def test_staff_summary_and_listing(spark):
    from tessera.operators.staffing import staff_listing
    rows = [("T", "21_22", f"c{i}", 1, (i,)) for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, "Tm string, Season string, Coach string, G int, ord struct<k:int>")
    assert staff_summary(df).first().Coaches == "c1, c2, c3"
    assert [r.Coach for r in staff_listing(df).collect()] == ["c1", "c2", "c3"]


def test_readers_skip_and_report_and_spell_missing(spark, tmp_path):
    from pyspark.sql import types as T

    from tessera.sources.io import read_seasons
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("n", T.IntegerType())])
    texts = {"21_22": "name,x,n\nIda,NaN,5\nN/A,1.5,null\n", "22_23": "name,x,n,more\nBen,oops,x9,7\n", "23_24": "",
             "notes": "name,x,n\nz,1,1\n", "2019_20": 'name,x,n\n"a\nb",2,3\n'}
    for label, text in texts.items():
        (tmp_path / label).mkdir()
        (tmp_path / label / "players.csv").write_text(text)
    said = []
    rows = read_seasons(spark, str(tmp_path), schema=schema, report=said.append, two_digit=False, multi_line=True).collect()
    got = {(r.season_start, r.name, r.x, r.n, r.more) for r in rows}
    assert got == {(2021, "Ida", None, 5, None), (2021, None, 1.5, None, None), (2022, "Ben", None, None, "7"), (2019, "a\nb", 2.0, 3, None)}
    assert len(said) == 2 and any("notes" in m for m in said) and any("header" in m for m in said)
    for label in texts:
        (tmp_path / label / "players.csv").write_text("")
    with pytest.raises(ValueError):
        read_seasons(spark, str(tmp_path), report=said.append)
