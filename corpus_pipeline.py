"""The corpus pipeline: quality filter, near-dedup, substring dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import read_table, saved
from tessera.llm.decontaminate import remove_contaminated
from tessera.llm.passages import remove_repeats
from tessera.llm.pieces import piece_digests
from tessera.llm.quality import reject_low_quality
from tessera.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return reject_low_quality(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of a smaller id holds too are cut out."""
    return remove_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and digests of what is left."""
    return piece_digests(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
                                   ("decontaminated", decontaminated), ("encoded", encoded)]

#: SQL can express neither the fitted classifier nor the alignment of passages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
