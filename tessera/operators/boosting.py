"""Second-order gradient boosting over binned features, a level of all trees a pass.

Spark ML's ``GBTRegressor`` fits each tree to the residuals and has neither
L1 nor L2 penalties nor a column sample per tree.  This booster has them: it
sums gradients and hessians per (tree, node, feature, bin), and splits where
the regularised gain is largest.

* Rows are binned once and written: a byte a feature, the target, the sum of
  the trees so far.  Nothing else of a row is ever read again.
* One pass over them is one level of one tree -- of several models at once,
  such as the folds of a cross-validation.  A task adds up its rows in arrays
  of fixed size and sends one row for each (node, feature, bin) that it met;
  Spark sums these, and window functions over a feature's bins (BINS at most)
  find each node's best split.  Only the splits of a level reach the driver.
* Gradients are added as integers, in units that are a power of two.  Sums
  don't depend on the order of the rows then, so a task that runs again, or a
  table dealt otherwise, gives the same trees.
* Every ``refresh`` trees the rows are written again with the trees added, which
  bounds both the lineage and what a pass has to recompute.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.model import build_preprocessor
from tessera.operators.sketch import quantile_cuts
from tessera.session import scratch_dir

#: Bins of a feature; a bin is a byte, 0 holds missing values.
BINS = 256

# The reference's boosting settings (500 trees, rate 0.05, depth 6,
# row and column sampling 0.8, L2 penalty 1, L1 penalty 0; a leaf's least
# hessian sum and a split's least gain are its library's defaults, 1 and 0).
SETTINGS = dict(trees=500, rate=0.05, depth=6, rows=0.8, columns=0.8, l2=1.0, l1=0.0, least_hessian=1.0, least_gain=0.0)

Tree = dict[int, tuple[int, int, float]]  # node -> (feature or -1 for a leaf, last bin of the left side, weight)


# ------------------------------------------------------------------ gains
def shrunk(g, l1: float):
    """The gradient sum after the L1 penalty."""
    return F.when(g > l1, g - l1).when(g < -l1, g + l1).otherwise(F.lit(0.0)) if l1 else g


def split_gains(hist: DataFrame, keys: Sequence[str], l2: float = 1.0, l1: float = 0.0, least_hessian: float = 1.0) -> DataFrame:
    """``hist`` (keys, feature, bin, g, h: sums of a bin) with the gain of a split behind each bin.

    Adds ``gl``, ``hl``, ``gr``, ``hr``, the sums on both sides, and ``gain``:
    half of what the scores g * g / (h + l2) of the sides exceed that of the
    node, NULL where a side has less than ``least_hessian``.  The windows span a
    feature's bins in a node, however many rows these hold.
    """
    part = Window.partitionBy(*keys, "feature")
    upto = part.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = hist.withColumns({"gl": F.sum("g").over(upto), "hl": F.sum("h").over(upto),
                            "g_all": F.sum("g").over(part), "h_all": F.sum("h").over(part)})
    out = out.withColumns({"gr": F.col("g_all") - F.col("gl"), "hr": F.col("h_all") - F.col("hl")})

    def score(g, h):
        s = shrunk(F.col(g), l1)
        return s * s / (F.col(h) + F.lit(float(l2)))
    gain = F.lit(0.5) * (score("gl", "hl") + score("gr", "hr") - score("g_all", "h_all"))
    able = (F.col("hl") >= least_hessian) & (F.col("hr") >= least_hessian) & (F.col("hl") > 0) & (F.col("hr") > 0)
    return out.withColumn("gain", F.when(able, gain))


def best_splits(gains: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, feature, bin, gain, gl, hl, gr, hr): each node's split of the largest gain, ties to the first feature and bin.

    A node without a possible split comes with a NULL gain and its sums.
    """
    pick = F.max_by(F.struct("feature", "bin", "gain", "gl", "hl", "gr", "hr", "g_all", "h_all"),
                    F.struct(F.col("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    return gains.groupBy(*keys).agg(pick.alias("s")).select(*keys, "s.*")


def leaf_weight(g: float, h: float, l2: float, l1: float) -> float:
    s = g - l1 if g > l1 else g + l1 if g < -l1 else 0.0
    return -s / (h + l2)


# ------------------------------------------------------------------ binned rows
def binned_rows(df: DataFrame, features: Column, label: Column, cuts: list[list[float]], fold: Column | None = None) -> DataFrame:
    """(bins, label, fold, row): one byte a feature, 1 + the number of cuts below the value, 0 for a missing one."""
    edges = [np.asarray(c, float) for c in cuts]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = np.asarray(batch.column(0).flatten()).reshape(n, len(edges)) if n else np.zeros((0, len(edges)))
            out = np.empty((n, len(edges)), np.uint8)
            for i, e in enumerate(edges):
                out[:, i] = np.where(np.isnan(x[:, i]), 0, 1 + np.searchsorted(e, x[:, i], side="left"))
            bins = [r.tobytes() for r in out]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), batch.column(1), batch.column(2)], ["bins", "label", "fold"])
    rows = df.select(features.cast("array<double>"), label.cast("double"), (F.lit(-1) if fold is None else fold).cast("int"))
    return rows.mapInArrow(run, "bins binary, label double, fold int").withColumn("row", F.monotonically_increasing_id())


def _written(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "boosting")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def _deleted(df: DataFrame) -> None:
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._tessera_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _bins_of(column: pa.Array, features: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].reshape(-1, features)


def sampled(rows: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree is built from: a mix of row number, seed and tree, so a row's part never depends on where it is read."""
    if share >= 1:
        return np.ones(len(rows), bool)
    x = rows.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * float(1 << 64)))


def _table(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree as arrays by node: feature (-1: none), last bin of the left side, weight."""
    n = max(tree, default=0) + 1
    feature, last, weight = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n)
    for node, (f, b, w) in tree.items():
        feature[node], last[node], weight[node] = f, b, w
    return feature, last, weight


def _nodes(bins: np.ndarray, tree: tuple, depth: int) -> np.ndarray:
    """The node that each row reaches; children of node i are 2 i + 1 and 2 i + 2."""
    feature, last, _ = tree
    node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        goes = f >= 0
        if not goes.any():
            break
        right = bins[at, np.where(goes, f, 0)] > last[node]
        node = np.where(goes, 2 * node + 1 + right, node)
    return node


# ------------------------------------------------------------------ fitting
def _histogram(rows: DataFrame, models: list[int], pending: list[list[Tree]], growing: list[Tree], columns: list[int], features: int,
               settings: dict, tree_no: int, seed: int, unit: float) -> DataFrame:
    """(model, node, feature, bin, g, h): sums over each model's rows in the nodes of its tree's last level."""
    depth, rate = settings["depth"], settings["rate"]
    past = [[_table(t) for t in trees] for trees in pending]
    now = [_table(t) for t in growing]
    fresh = [sorted(n for n, (f, _, _) in t.items() if f == -2) for t in growing]  # nodes to be split
    cols = np.asarray(columns)

    def run(batches):
        sums: list[np.ndarray | None] = [None] * len(models)
        slots = [np.full(max(f, default=0) + 1, -1, np.int64) for f in fresh]
        for s, f in zip(slots, fresh):
            s[f] = np.arange(len(f))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins_of(batch.column(0), features)
            label, fold, row = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            margin = np.asarray(batch.column(4).flatten()).reshape(len(bins), -1)
            chosen = sampled(row, seed, tree_no, settings["rows"])
            for i, model in enumerate(models):
                use = np.flatnonzero(chosen & (fold != model))
                if not len(use) or not fresh[i]:
                    continue
                own = bins[use]
                guess = margin[use, i]
                for t in past[i]:
                    guess = guess + rate * t[2][_nodes(own, t, depth)]
                node = _nodes(own, now[i], depth)
                slot = np.where(node < len(slots[i]), slots[i][np.minimum(node, len(slots[i]) - 1)], -1)
                stays = slot >= 0
                own, slot = own[stays], slot[stays]
                grad = np.rint((guess - label[use])[stays] / unit).astype(np.int64)
                if sums[i] is None:
                    sums[i] = np.zeros((2, len(cols), len(fresh[i]) * BINS), np.int64)
                # np.bincount adds doubles, so gradients go in two halves whose sums are exact.
                high, low = grad >> 24, grad & 0xFFFFFF
                for j, c in enumerate(cols):
                    key = slot * BINS + own[:, c]
                    size = len(fresh[i]) * BINS
                    sums[i][0, j] += (np.bincount(key, high, size).astype(np.int64) << 24) + np.bincount(key, low, size).astype(np.int64)
                    sums[i][1, j] += np.bincount(key, minlength=size)
        for i, model in enumerate(models):
            if sums[i] is None:
                continue
            j, key = np.nonzero(sums[i][1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(j), model, np.int32)), pa.array(np.asarray(fresh[i], np.int32)[key // BINS]),
                 pa.array(cols[j].astype(np.int32)), pa.array((key % BINS).astype(np.int32)),
                 pa.array(sums[i][0][j, key]), pa.array(sums[i][1][j, key])], ["model", "node", "feature", "bin", "g", "h"])
    sent = rows.select("bins", "label", "fold", "row", "margin").mapInArrow(
        run, "model int, node int, feature int, bin int, g long, h long")
    # One exchange: sums, windows and the choice of a feature's best bin all lie within (model, node, feature).
    dealt = sent.repartition("model", "node", "feature")
    return dealt.groupBy("model", "node", "feature", "bin").agg(
        (F.sum("g") * F.lit(unit)).alias("g"), F.sum("h").cast("double").alias("h"))


def _with_trees(rows: DataFrame, pending: list[list[Tree]], features: int, depth: int, rate: float) -> DataFrame:
    """The rows with the trees added to their margins."""
    past = [[_table(t) for t in trees] for trees in pending]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins_of(batch.column(0), features)
            margin = np.array(batch.column(4).flatten()).reshape(len(bins), -1)
            for i, trees in enumerate(past):
                for t in trees:
                    margin[:, i] += rate * t[2][_nodes(bins, t, depth)]
            flat = pa.array(margin.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, margin.size + 1, margin.shape[1]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], lists], ["bins", "label", "fold", "row", "margin"])
    return rows.select("bins", "label", "fold", "row", "margin").mapInArrow(
        run, "bins binary, label double, fold int, row long, margin array<double>")


def boost(binned: DataFrame, features: int, models: Sequence[int] = (-2,), seed: int = 42, refresh: int = 10,
          **settings) -> dict[int, tuple[float, list[Tree], np.ndarray]]:
    """Fit one booster for each of ``models`` over the same passes; model f leaves out the rows of fold f.

    ``binned`` is a written table of :func:`binned_rows`; rows without a label
    must be gone.  Returns, by model, the mean label it starts from, its trees, and the
    summed gain and number of splits of each feature.  Each tree is built from
    the same sampled rows and columns in all models, so a model's trees are
    those it would have alone.  No rows, or one label only, give trees of a
    single leaf.
    """
    s = {**SETTINGS, **settings}
    unknown = set(s) - set(SETTINGS)
    if unknown:
        raise ValueError(f"unknown boosting settings: {sorted(unknown)}")
    if not 0 < s["depth"] <= 16:
        raise ValueError("the depth of a tree is 1 to 16")
    models = list(models)
    first = binned.agg(F.count("label").alias("n"), F.max(F.abs("label")).alias("most"), *[
        F.avg(F.when(F.col("fold") != m, F.col("label"))).alias(f"m{i}") for i, m in enumerate(models)]).first()
    base = [first[f"m{i}"] or 0.0 for i in range(len(models))]
    # A power of two so small that sums of all gradients stay exact, and halves of 24 bits do in a task's doubles.
    most = 4 * max(1e-300, first["most"] or 0.0)
    unit = 2.0 ** (math.ceil(math.log2(most)) - min(44, 60 - math.ceil(math.log2(max(2, first["n"])))))
    rows = _written(binned.withColumn("margin", F.array(*[F.lit(b) for b in base])))
    rng, done, pending = np.random.default_rng(seed), [[] for _ in models], [[] for _ in models]
    gain = np.zeros((len(models), 2, features))
    take = max(1, int(s["columns"] * features)) if features else 0
    for t in range(s["trees"] if first["n"] else 0):
        columns = sorted(rng.choice(features, take, replace=False).tolist())
        trees: list[Tree] = [{0: (-2, 0, 0.0)} for _ in models]
        for level in range(s["depth"]):
            if not any(f == -2 for tree in trees for f, _, _ in tree.values()):
                break
            hist = _histogram(rows, models, pending, trees, columns, features, s, t, seed, unit)
            found = best_splits(split_gains(hist, ["model", "node"], s["l2"], s["l1"], s["least_hessian"]), ["model", "node"]).collect()
            for r in found:
                i = models.index(r.model)
                if r.gain is not None and r.gain > max(0.0, s["least_gain"]):
                    trees[i][r.node] = (r.feature, r.bin, 0.0)
                    last = level + 1 == s["depth"]
                    for child, g, h in ((2 * r.node + 1, r.gl, r.hl), (2 * r.node + 2, r.gr, r.hr)):
                        trees[i][child] = (-1 if last else -2, 0, leaf_weight(g, h, s["l2"], s["l1"]))
                    gain[i, 0, r.feature] += r.gain
                    gain[i, 1, r.feature] += 1
                else:
                    trees[i][r.node] = (-1, 0, leaf_weight(r.g_all, r.h_all, s["l2"], s["l1"]))
            for i, tree in enumerate(trees):  # a node that no sampled row reaches is a leaf
                met = {r.node for r in found if r.model == models[i]}
                for node, (f, b, w) in list(tree.items()):
                    if f == -2 and node not in met and (node + 1).bit_length() == level + 1:
                        tree[node] = (-1, 0, w)
        for i, tree in enumerate(trees):
            pending[i].append(tree)
            done[i].append(tree)
        if (t + 1) % refresh == 0 and t + 1 < s["trees"]:
            newer = _written(_with_trees(rows, pending, features, s["depth"], s["rate"]))
            _deleted(rows)
            rows, pending = newer, [[] for _ in models]
    _deleted(rows)
    return {m: (base[i], done[i], gain[i]) for i, m in enumerate(models)}


def fixed_cuts(df: DataFrame, cols: Sequence[str], n: int) -> list[list[float]]:
    """``n`` - 1 cuts of each column that split its range into equal widths; none for a column with one value at most."""
    ends = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("l", F.min), ("h", F.max))]).first()
    out = []
    for i in range(len(cols)):
        lo, hi = ends[f"l{i}"], ends[f"h{i}"]
        out.append([] if lo is None or lo == hi else [lo + (hi - lo) * j / n for j in range(1, n)])
    return out


def boosted_columns(df: DataFrame, cols: Sequence[str], label: str, cuts: list[list[float]], out_col: str = "prediction", seed: int = 42,
                    **settings) -> DataFrame:
    """``df`` with the predictions of a booster fitted on its own numeric columns and given cuts; rows without label are scored too."""
    s = {**SETTINGS, **settings}
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    rows = _written(binned_rows(df.where(F.col(f"`{label}`").isNotNull()), F.transform(x, lambda v: F.coalesce(v, F.lit(float("nan")))),
                                F.col(f"`{label}`"), cuts))
    base, trees, _ = boost(rows, len(cols), seed=seed, **s)[-2]
    _deleted(rows)
    run = predictor(cuts, base, trees, s["rate"], s["depth"])

    @F.pandas_udf("double")
    def guess(v: pd.Series) -> pd.Series:
        return pd.Series(run(np.stack(v.to_numpy()).astype(float)) if len(v) else [], dtype="float64")
    return df.withColumn(out_col, guess(x))


def predictor(cuts: list[list[float]], base: float, trees: list[Tree], rate: float, depth: int):
    """Function of an array (rows, features) of values, missing ones NaN: the predictions."""
    edges, tables = [np.asarray(c, float) for c in cuts], [_table(t) for t in trees]

    def run(x: np.ndarray) -> np.ndarray:
        bins = np.empty(x.shape, np.uint8)
        for i, e in enumerate(edges):
            bins[:, i] = np.where(np.isnan(x[:, i]), 0, 1 + np.searchsorted(e, x[:, i], side="left"))
        out = np.full(len(x), base)
        for t in tables:
            out += rate * t[2][_nodes(bins, t, depth)]
        return out
    return run


# ------------------------------------------------------------------ as Spark ML stages
class _BoosterParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "target", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "boosting settings as JSON", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the row and column samples", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", settings="{}", seed=42)

    def _settings(self) -> dict:
        return {**SETTINGS, **json.loads(self.getOrDefault("settings"))}


def feature_cuts(df: DataFrame, features_col: str, bins: int = BINS) -> list[list[float]]:
    """Cuts of each element of a vector column: at most ``bins`` - 2 quantiles a feature."""
    names = (df.schema[features_col].metadata or {}).get("ml_attr", {}).get("num_attrs")
    first = df.select(F.size(vector_to_array(features_col)).alias("n")).first() if names is None else None
    size = names if names is not None else first["n"] if first else 0
    x = vector_to_array(features_col)
    wide = df.select(*[x[i].alias(f"x{i}") for i in range(size)])
    return quantile_cuts(wide, [f"x{i}" for i in range(size)], bins - 2)


class HistogramBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Second-order boosted trees on a vector column; rows without a label are left out of the fit."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", settings="{}", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "HistogramBoosterModel":
        col, label = self.getOrDefault("featuresCol"), F.col(f"`{self.getOrDefault('labelCol')}`")
        known = df.where(label.isNotNull() & ~F.isnan(label.cast("double")))
        cuts = feature_cuts(known, col)
        rows = _written(binned_rows(known, vector_to_array(col), label, cuts))
        s = self._settings()
        base, trees, gain = boost(rows, len(cuts), seed=self.getOrDefault("seed"), **s)[-2]
        _deleted(rows)
        state = {"cuts": cuts, "base": base, "trees": [[[n, *t[n]] for n in sorted(t)] for t in trees],
                 "gain": gain.tolist(), "rate": s["rate"], "depth": s["depth"]}
        return HistogramBoosterModel(featuresCol=col, predictionCol=self.getOrDefault("predictionCol"), state=json.dumps(state))


class HistogramBoosterModel(Model, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "cuts and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", state="{}"):
        super().__init__()
        self._setDefault(state="{}")
        self._set(**self._input_kwargs)

    def _state(self) -> dict:
        s = json.loads(self.getOrDefault("state"))
        s["trees"] = [{n: (f, b, w) for n, f, b, w in t} for t in s["trees"]]
        return s

    @property
    def trees(self) -> list[Tree]:
        return self._state()["trees"]

    @property
    def featureImportances(self):
        """Mean gain of each feature's splits, as shares of one."""
        total, count = np.asarray(self._state()["gain"])
        mean = np.divide(total, count, out=np.zeros_like(total), where=count > 0)
        return Vectors.dense((mean / mean.sum() if mean.sum() else mean).tolist())

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self._state()
        run = predictor(s["cuts"], s["base"], s["trees"], s["rate"], s["depth"])

        @F.pandas_udf("double")
        def guess(x: pd.Series) -> pd.Series:
            return pd.Series(run(np.stack(x.to_numpy()).astype(float)) if len(x) else [], dtype="float64")
        return df.withColumn(self.getOrDefault("predictionCol"), guess(vector_to_array(F.col(self.getOrDefault("featuresCol")))))


def boosted_pipeline(df: DataFrame, feature_cols: Sequence[str], target_col: str, seed: int = 42, **settings) -> Pipeline:
    """Preprocessor + booster as one estimator, with the reference's settings unless others are given."""
    return Pipeline(stages=[build_preprocessor(df, feature_cols),
                            HistogramBooster(labelCol=target_col, settings=json.dumps(settings), seed=seed)])


def cross_validate_boosted(df: DataFrame, feature_cols: Sequence[str], target_col: str, fold_col: str, k: int = 5, seed: int = 42,
                           **settings) -> dict:
    """K-fold RMSE and the model of all rows, all k + 1 fitted over the same passes.

    Row for row, fold i's model is the one that a fit without fold i gives on
    these bins.  The preprocessor and the cuts see the features of all labelled
    rows, never a target.  Returns {"fold_rmse", "rmse_mean", "rmse_std",
    "model"}; the model is a fitted pipeline.
    """
    from pyspark.ml import PipelineModel
    known = df.where(F.col(f"`{target_col}`").isNotNull())
    pre = build_preprocessor(known, feature_cols).fit(known)
    ready = pre.transform(known)
    cuts = feature_cuts(ready, "features")
    rows = _written(binned_rows(ready, vector_to_array("features"), F.col(f"`{target_col}`"), cuts, F.col(fold_col)))
    s = {**SETTINGS, **settings}
    fitted = boost(rows, len(cuts), [-2, *range(k)], seed, **s)
    past = {i: (fitted[i][0], [_table(t) for t in fitted[i][1]]) for i in range(k)}

    def run(batches):
        for batch in batches:
            bins = _bins_of(batch.column(0), len(cuts)) if batch.num_rows else np.zeros((0, len(cuts)), np.uint8)
            label, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            wrong = np.zeros(len(bins))
            for i, (base, trees) in past.items():
                at = np.flatnonzero(fold == i)
                guess = np.full(len(at), base)
                for t in trees:
                    guess += s["rate"] * t[2][_nodes(bins[at], t, s["depth"])]
                wrong[at] = guess - label[at]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(wrong * wrong)], ["fold", "e"])
    errors = rows.select("bins", "label", "fold").mapInArrow(run, "fold int, e double")
    by_fold = {r.fold: r.rmse for r in errors.groupBy("fold").agg(F.sqrt(F.avg("e")).alias("rmse")).collect()}
    _deleted(rows)
    if set(range(k)) - set(by_fold):
        raise ValueError(f"fold {min(set(range(k)) - set(by_fold))} of {k} has no row with a known {target_col}; take fewer folds")
    scores = [by_fold[i] for i in range(k)]
    mean = sum(scores) / k
    base, trees, gain = fitted[-2]
    state = {"cuts": cuts, "base": base, "trees": [[[n, *t[n]] for n in sorted(t)] for t in trees], "gain": gain.tolist(),
             "rate": s["rate"], "depth": s["depth"]}
    booster = HistogramBoosterModel(featuresCol="features", predictionCol="prediction", state=json.dumps(state))
    return {"fold_rmse": scores, "rmse_mean": mean, "rmse_std": math.sqrt(sum((x - mean) ** 2 for x in scores) / k),
            "model": PipelineModel(stages=[pre, booster])}
