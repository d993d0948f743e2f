"""Toxicity: a classifier chain over categories."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NON_WORD, read_table
from tessera.llm.linear import (MAX_FIT, Model, broadcast_models, count_classes, fit, held_out, labelled, sample,
                                shared_models, word_grams)

#: Categories before the last, which is ``toxic`` itself; a toxic document is of one if it says one of its words.
CATEGORIES = {
    "insult": ["idiot", "moron", "clown", "loser", "stupid", "dumb", "fool", "jerk"],
    "contempt": ["worthless", "pathetic", "disgusting", "useless", "hate", "despise"],
    "abuse": ["trash", "scum", "garbage", "vermin", "filth", "parasite"],
}
THRESHOLD = 0.5


def category_labels(train: DataFrame) -> DataFrame:
    """``train`` (id, text, toxic) with a 0/1 column for each category."""
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), NON_WORD, " "), F.lit(" "))

    def says(terms: list[str]) -> Column:
        hit = F.lit(False)
        for t in terms:
            hit = hit | words.contains(f" {t} ")
        return (hit & (F.col("toxic") > 0)).cast("long")
    return train.select("*", *[says(t).alias(c) for c, t in CATEGORIES.items()])


def fit_chain(train: DataFrame, targets: list[str], max_fit: int = MAX_FIT, folds: int = 3) -> list[Model]:
    """One linear model a target, in order; each sees the text and the probabilities of the targets before it.

    Those are out-of-fold probabilities while training, so that a later model
    meets inputs as good as it will meet in use.  Class counts cover all rows,
    the fit takes the ``max_fit`` rows with the smallest id hashes.
    """
    counts = count_classes(train, targets, word_grams)
    x, y, _ = sample(train, targets, word_grams, max_fit)
    models, earlier = [], np.zeros((len(x), 0))
    for k in range(len(targets)):
        model, oof = fit(x, y, k, counts, earlier, folds)
        models.append(model)
        earlier = np.column_stack([earlier, oof])
    return models


def chain_scores(models: list[Model], targets: list[str], docs: DataFrame, text_col: str = "text") -> Column:
    """Struct column with each target's probability; NULL and empty texts score what the constants give."""
    shared = broadcast_models(docs.sparkSession, models)

    @F.pandas_udf(", ".join(f"{t} double" for t in targets))
    def run(texts: pd.Series) -> pd.DataFrame:
        out, chain = np.zeros((len(texts), len(targets))), shared_models(shared)
        for i, text in enumerate(texts):
            ids = word_grams(text or "")
            for k, m in enumerate(chain):
                out[i, k] = m.score(ids, out[i, :k])
        return pd.DataFrame(out, columns=targets)
    return run(docs[text_col])


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, toxic, score, probability of each category) for every document.

    Learns from labels whose document isn't held out.  ``toxic`` is a score of
    at least 0.5.  Without labels of both classes no text is told apart.
    """
    docs, targets = read_table(spark, sf_dir, "documents"), [*CATEGORIES, "toxic"]
    label = F.when(F.col("toxic").isNotNull(), (F.col("toxic") > 0).cast("long"))
    train = category_labels(labelled(docs, read_table(spark, sf_dir, "labels"), {"toxic": label}))
    scores = chain_scores(fit_chain(train, targets), targets, docs)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores.alias("p"))
    return out.select("doc_id", "held_out", (F.col("p.toxic") >= THRESHOLD).alias("toxic"),
                      F.col("p.toxic").alias("score"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES])
