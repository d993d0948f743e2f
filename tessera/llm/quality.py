"""Quality classifier: Naive Bayes support vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.llm.linear import MAX_FIT, Model, broadcast_models, count_classes, fit, held_out, labelled, sample, shared_models, style_grams

#: Documents that score less are rejected.
THRESHOLD = 0.7


def fit_quality(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> Model:
    """The model that tells ``quality`` 1 from 0.

    Log-count ratios come from all labelled rows that may be learnt from.
    They scale the n-gram indicators of the ``max_fit`` rows with the smallest
    id hashes, on which the hinge loss is fitted by dual coordinate descent;
    out-of-fold margins give the slope and offset of the probability.  Labels
    that are NULL or without a document don't count.  Without labels of both
    classes, every text scores the share of class 1, or 0.5.
    """
    train = labelled(docs, labels, {"good": F.when(F.col("quality").isNotNull(), (F.col("quality") > 0).cast("long"))})
    counts = count_classes(train, ["good"], style_grams)
    x, y, _ = sample(train, ["good"], style_grams, max_fit)
    return fit(x, y, 0, counts, np.zeros((len(x), 0)))[0]


def quality_score(model: Model, docs: DataFrame, text_col: str = "text"):
    """Column of each text's probability of quality 1; NULL and empty texts score what the constant gives."""
    shared = broadcast_models(docs.sparkSession, [model])

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = shared_models(shared)[0]
        return pd.Series([m.score(style_grams(t or "")) for t in texts], dtype="float64")
    return run(docs[text_col])


def reject_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score under ``threshold``."""
    return docs.where(quality_score(fit_quality(docs, labels), docs) >= threshold)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(model, docs).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
