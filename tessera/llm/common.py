"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

#: Runs of the characters that are not in a word (digits, ASCII letters of either case and everything beyond ASCII are).
NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A side is broadcast only if its written table has at most so many bytes.
BROADCAST_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new table in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs no more than the tasks that
    read the table.  The table's columns must have distinct names.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`saved` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._tessera_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def packed(df: DataFrame) -> Column:
    """A row's columns as one struct, so that columns added beside it can't clash with any of them."""
    return F.struct(*columns(df)).alias("row")


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a saved table whose counted rows take at most ``limit`` bytes.

    Beyond it the table is joined without a hint: by a shuffle, whose skewed
    partitions AQE splits.  ``row_bytes`` is a row's largest size.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def text_key(text: Column) -> Column:
    """SHA-256 of a text: names a distinct text, and joins copies to the work done once for all."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    return sys.__dict__.setdefault("_tessera_llm_cache", {})
