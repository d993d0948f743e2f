"""CSV files with quoted line breaks, read in splits of a few bytes, against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import quoted
from tessera.sources.io import read_seasons, read_staffing


@pytest.fixture(params=["61", "1m"])
def splits(spark, request):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return f"file:{path}"


def values(rng):
    long = "x" * rng.randrange(200) + "\n" + "y" * rng.randrange(200)
    return rng.choice(["plain", "with,comma", "line\nbreak", 'two\n\nbreaks "quoted" x', '"', "", "a\r\nb", long, "é\nß"])


def read(spark, files):
    rows, headers = quoted.read_quoted(spark, files, lambda *_: None)
    names = sorted({c for h in headers for c in h})
    got = rows.select(*[quoted.by_name(headers, c).alias(c) for c in names], "ord").sort("ord").drop("ord").collect()
    return [{c: r[c] for c in names} for r in got]


def test_records_equal_those_of_the_csv_module(spark, tmp_path, splits):
    rng, files, want = random.Random(3), [], []
    for f in range(3):
        names = rng.sample(["n", "v", "w"], 3)
        rows = [{"n": f"{f}-{i}", "v": values(rng), "w": values(rng)} for i in range(50)]
        out = io.StringIO()
        w = csv.DictWriter(out, names, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        w.writeheader()
        w.writerows(rows)
        files.append(write(tmp_path / f"f{f}.csv", "﻿" * (f == 1) + out.getvalue()))
        want += rows
    assert [{k: v or "" for k, v in r.items()} for r in read(spark, files)] == want


def test_blank_lines_no_last_line_break_a_value_over_many_splits_and_odd_quotes(spark, tmp_path, splits):
    a = write(tmp_path / "a.csv", "\n \nn,v\n\n1,x\n\n" + '2,"' + "long\n" * 100 + '"\n3,z')
    b = write(tmp_path / "b.csv", 'n,v\n1,x\n2,5\'6" tall\n3,y\n')  # one quote: lines are the records
    c = write(tmp_path / "c.csv", "n,v")
    d = write(tmp_path / "d.csv", "")
    got = read(spark, [a, b, c, d])
    assert [r["n"] for r in got] == ["1", "2", "3", "1", "2", "3"]
    assert got[1]["v"] == "long\n" * 100 and got[2]["v"] == "z" and got[4]["v"] == "5'6\" tall"
    said = []
    assert quoted.read_quoted(spark, [d], said.append)[1] == [] and said


def test_only_cut_records_are_shuffled(spark, tmp_path, splits):
    path = write(tmp_path / "p.csv", "n,v\n" + "".join(f'{i},"a\n{i}"\n' for i in range(200)))
    lines = quoted._lines(spark, [path])
    parities = quoted.split_parities(lines).collect()
    assert len(parities) == (1 if splits == "1m" else len({r.block for r in parities})) and all(r.whole for r in parities)
    if splits == "61":
        assert any(r.inside for r in parities) and len(parities) > 20
    records = quoted.split_records(spark, [path])
    assert records.count() == 201 and records.where(F.col("record").contains("\n")).count() == 200


def test_small_splits_share_tasks_and_are_walked_once(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "61")
    try:
        path = write(tmp_path / "p.csv", "n,v\n" + "".join(f'{i},"a\n{i}"\n' for i in range(400)))
        lines = quoted._lines(spark, [path])
        most = quoted.TASKS_A_CORE * spark.sparkContext.defaultParallelism
        assert quoted.split_bytes(spark) == 61 and lines.select("file", "block").distinct().count() > 2 * most
        assert lines.rdd.getNumPartitions() <= most
        records = quoted.split_records(spark, [path])
        assert records.count() == 401 and "mapinarrow" not in records._jdf.queryExecution().toString().lower()
        for text, size in (("16384", 1 << 14), ("1m", 1 << 20), ("134217728b", 1 << 27), ("2GB", 1 << 31)):
            spark.conf.set(name, text)
            assert quoted.split_bytes(spark) == size
    finally:
        spark.conf.set(name, before)


def test_seasons_and_staffing_as_one_task_a_file_reads_them(spark, tmp_path, splits):
    write(tmp_path / "s/98_99/players.csv", 'Player-additional,Player,G,Age\na1,"A\nB",5,NA\nb1,"C, ""D""",7x,30\n')
    write(tmp_path / "s/99_00/players.csv", 'Age,Player-additional,extra,Player\n31,a1,"x\ny","A\nB"\n')
    write(tmp_path / "s/notes/players.csv", "a\n1\n")
    schema = "G double, Age double"
    from pyspark.sql.types import _parse_datatype_string
    args = dict(schema=_parse_datatype_string(schema), report=lambda *_: None)
    one = read_seasons(spark, str(tmp_path / "s"), multi_line=True, **args)
    split = read_seasons(spark, str(tmp_path / "s"), multi_line="split", **args)
    cols = ["Player-additional", "Player", "G", "Age", "extra", "season_start"]
    key = lambda r: (r[-1], r[0])
    assert sorted(map(tuple, split.select(*[f"`{c}`" for c in cols]).collect()), key=key) == sorted(
        map(tuple, one.select(*[f"`{c}`" for c in cols]).collect()), key=key)
    write(tmp_path / "t/98_99/coaches.csv", 'Coach,Tm,Season,G,W,G\n" Ann\nB ",LAL,x,82,1,2\n\nCy,BOS,x,82.0,1,2\n')
    write(tmp_path / "t/99_00/coaches.csv", "Coach,Tm,Games\nDi,NYK,7\n")
    got = read_staffing(spark, str(tmp_path / "t"), multi_line="split").drop("ord").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, read_staffing(spark, str(tmp_path / "t"), multi_line=True).drop("ord").collect()))
    assert ("Ann\nB", "LAL", 82, "98_99") in set(map(tuple, got))
    for reader in (read_seasons, read_staffing):
        with pytest.raises(ValueError):
            reader(spark, str(tmp_path / "none"), multi_line="split")
