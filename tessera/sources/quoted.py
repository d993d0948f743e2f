"""CSV files with line breaks inside quotes, read in splits.

Spark's own reader splits a CSV file only where no value holds a line break;
with ``multiLine`` a file is one task.  Here a file's lines are read in splits, and a
scan of quote parities tells which line breaks end a record:

1. each split's quotes are counted (one small row a split), and a running sum
   over a file's splits tells whether a split begins inside quotes;
2. every split's lines are then walked from that parity and the lines of a
   record joined; what the walk finds is written once, and only the pieces of
   records that a split border cuts, two a split at most, are put together by a
   shuffle.

A task takes several splits where they are small.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_dir

#: Largest size of a table that is broadcast, and of one of its rows.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 512
#: Bytes of splits that a task takes at least, as long as there are TASKS_A_CORE tasks for each core.
TASK_BYTES, TASKS_A_CORE = 32 << 20, 4
_PIECES = "file string, block long, row long, begins boolean, ends boolean, record string"


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a split at most."""
    number, unit = re.match(r"\s*(\d+)\s*([kmgtp]?)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def by_few_tasks(df: DataFrame) -> DataFrame:
    """``df`` as read, small splits side by side in a task: each stays whole and its rows in order."""
    splits = max(1, TASK_BYTES // split_bytes(df.sparkSession))
    if splits == 1:
        return df
    least = TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-df.rdd.getNumPartitions() // splits)))


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    text = spark.read.options(lineSep="\n", ignoreCorruptFiles=True, ignoreMissingFiles=True).text(files)
    return by_few_tasks(text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def split_parities(lines: DataFrame) -> DataFrame:
    """(file, block, inside, whole): whether a split begins inside quotes, and whether the file's quotes are even in number."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("q"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
                         (F.sum("q").over(Window.partitionBy("file")) % 2 == 0).alias("whole"))


def walk(batches: Iterable[pa.RecordBatch]):
    """The records, and the pieces of records, in lines (file, block, inside, whole, value) that come split by split in order.

    A piece that began in an earlier split has row -1.  Blank records are left
    out; the others of a split are numbered from 0.
    """
    at, open_lines, inside, row = None, [], False, 0  # the split; lines of the record not ended yet; in a record of an earlier split
    out: list[tuple] = []

    def end(ends: bool):
        nonlocal open_lines, inside, row
        text = "\n".join(open_lines)
        if inside or not ends or text.strip():
            out.append((*at, -1 if inside else row, not inside, ends, text))
            row += not inside
        open_lines, inside = [], False

    for batch in batches:
        files, blocks, insides, wholes = (batch.column(i).to_pylist() for i in range(4))
        odd = (pc.count_substring(batch.column(4), '"').to_numpy(zero_copy_only=False) & 1).astype(bool)
        for i, line in enumerate(batch.column(4).to_pylist()):
            if (files[i], blocks[i]) != at:
                if at and open_lines:
                    end(False)
                at, row, inside = (files[i], blocks[i]), 0, insides[i] and wholes[i]
                quoted = inside
            open_lines.append(line)
            quoted ^= bool(odd[i]) and wholes[i]
            if not quoted:
                end(True)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()))], ["file", "block", "row", "begins", "ends", "record"])
        out = []
    if at and open_lines:
        end(False)
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "row", "begins", "ends", "record"), r)) for r in out])


def split_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, block, row, record) of the non-blank records of CSV files, in splits; (block, row) is a file's order.

    Quotes are doubled inside quoted values.  A file with an odd number of
    quotes has none that can be trusted: its lines are its records.  Values that
    aren't quoted must not hold quotes.  Files that can't be read have no records.
    """
    lines = _lines(spark, files)
    path = scratch_dir(spark, "parities")
    split_parities(lines).write.parquet(path)
    parities = spark.read.schema("file string, block long, inside boolean, whole boolean").parquet(path)
    unusual = parities.where("inside or not whole")
    known = lines.withColumn("id", F.monotonically_increasing_id())
    if unusual.count() * ROW_BYTES <= BROADCAST_BYTES:
        known = known.join(F.broadcast(unusual), ["file", "block"], "left")  # keeps the lines' order
    else:
        known = known.join(unusual, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "id")
    known = known.select("file", "block", F.coalesce("inside", F.lit(False)).alias("inside"),
                         F.coalesce("whole", F.lit(True)).alias("whole"), "value")
    path = scratch_dir(spark, "records")
    known.mapInArrow(walk, _PIECES).write.parquet(path)
    found = by_few_tasks(spark.read.schema(_PIECES).parquet(path))
    whole = found.where("begins and ends").select("file", "block", "row", "record")
    pieces = found.where("not (begins and ends)")
    if pieces.isEmpty():
        return whole
    order = Window.partitionBy("file").orderBy("block", "row")
    pieces = pieces.withColumn("nth", F.sum(F.col("begins").cast("int")).over(order))
    joined = pieces.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "row", "record"))).alias("p"))
    joined = joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["row"].alias("row"),
                           F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.union(joined.where(F.trim("record") != ""))


def parse_header(line: str | None) -> list[str]:
    return next(csv.reader(io.StringIO(line or "")), [])


def read_quoted(spark: SparkSession, files: list[str], report=print) -> tuple[DataFrame, list[list[str]]]:
    """(file, ord, layout, values: array of texts) of the files' rows, and the header of each layout.

    A file's first record is its header.  Headers are found by a Spark job; one
    row a distinct header reaches the driver, however many files there are.
    Files without one are reported by their number.
    """
    records = split_records(spark, files)
    first = (F.col("block") == 0) & (F.col("row") == 0)
    heads = records.where(first).select("file", F.regexp_replace("record", "^\ufeff|\r$", "").alias("header"))
    path = scratch_dir(spark, "headers")
    heads.write.parquet(path)
    heads = spark.read.schema("file string, header string").parquet(path)
    layouts = sorted(r.header for r in heads.select("header").distinct().collect())
    n = heads.count()
    if n < len(files):
        report(f"Skipping {len(files) - n} files that can't be read or have no header")
    headers = [parse_header(h) for h in layouts]
    width = max([1, *map(len, headers)])
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    number = F.array_position(F.array(*[F.lit(h) for h in layouts]), F.col("header")) - 1 if layouts else F.lit(0)
    numbered = heads.select("file", number.cast("int").alias("layout"))
    if n * ROW_BYTES <= BROADCAST_BYTES:
        numbered = F.broadcast(numbered)
    rows = records.where(~first).join(numbered, "file")
    parsed = F.from_csv(F.regexp_replace("record", r"\r$", ""), schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                        {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    values = F.array(*[F.col(f"r.c{i}") for i in range(width)])
    rows = rows.withColumn("r", parsed).select(
        "file", F.struct("file", "block", "row").alias("ord"), "layout", values.alias("values"))
    return rows, headers


def by_name(headers: list[list[str]], name: str) -> Column:
    """The value of the column of that name, wherever a row's layout has it; NULL where it hasn't."""
    cases = [(k, h.index(name)) for k, h in enumerate(headers) if name in h]
    return F.coalesce(*[F.when(F.col("layout") == k, F.get(F.col("values"), F.lit(i))) for k, i in cases])
