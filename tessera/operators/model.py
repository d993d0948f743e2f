"""Modelling: preprocessing statistics, a GBT pipeline, folds, metrics, export.

Fitted statistics (medians, means, modes, category lists) and metrics are
one small row each; everything else stays distributed.  The exact median
never buffers a whole column in one task: counted values are dealt by range
and ranked by running sums (see ``exact_medians``).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import to_number

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ------------------------------------------------------------------ statistics
def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column (mean of the two middle values), NULL and NaN ignored.

    (column number, value) pairs are counted with partial aggregation and dealt by
    range, so equal columns and neighbouring values stand together.  A sum per
    partition gives the number of values before it, a running sum inside each
    partition the rank of every value, and the rows that hold the two middle
    ranks -- at most two a column -- are all that reaches the driver.
    """
    out: dict[str, float | None] = dict.fromkeys(cols)
    if not cols:
        return out
    pair = [F.struct(F.lit(i).alias("k"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)]
    pairs = df.select(F.explode(F.array(*pair)).alias("e")).select("e.*").where("x is not null and not isnan(x)")
    counted = pairs.groupBy("k", "x").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("k", "x")
    counted = counted.withColumn("part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = counted.groupBy("k", "part").agg(F.sum("n").alias("m"))
        by_part = Window.partitionBy("k").orderBy("part")
        parts = parts.select("k", "part", (F.sum("m").over(by_part) - F.col("m")).alias("before"),
                             F.sum("m").over(Window.partitionBy("k")).alias("all"))
        inside = Window.partitionBy("part", "k").orderBy("x")
        ranked = counted.join(parts, ["k", "part"]).withColumn("end", F.col("before") + F.sum("n").over(inside))
        first = F.col("end") - F.col("n")
        low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
        holds = lambda r: (first <= r) & (r < F.col("end"))
        middle = ranked.groupBy("k").agg(F.max(F.when(holds(low), F.col("x"))).alias("a"),
                                         F.max(F.when(holds(high), F.col("x"))).alias("b"))
        out.update({cols[r["k"]]: (r["a"] + r["b"]) / 2.0 for r in middle.collect()})
    finally:
        counted.unpersist()
    return out


def mean_std(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population std per column in one job; zero std reported as 1."""
    if not cols:
        return {}
    known = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols}
    row = df.agg(*[e for c, x in known.items() for e in (F.avg(x).alias(f"m_{c}"),
                                                         F.stddev_pop(x).alias(f"s_{c}"))]).first()
    out = {}
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        if s is not None and (s == 0 or s < 10 * 2.220446049250313e-16 * max(abs(m or 0), 1.0)):
            s = 1.0
        out[c] = (m, s)
    return out


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-null value per column; ties go to the lowest value.

    One scan: (column, value) pairs are counted with partial aggregation and
    the winner per column is chosen on the executors, so only one row per
    column reaches the driver.
    """
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("string").alias("v")) for c in cols])).alias("p")) \
        .select("p.k", "p.v").where(F.col("v").isNotNull())
    counted = pairs.groupBy("k", "v").count()
    best = counted.groupBy("k").agg(F.min_by("v", F.struct((-F.col("count")).alias("n"), F.col("v"))).alias("v"))
    found = {r["k"]: r["v"] for r in best.collect()}
    out = {}
    for c in cols:
        v = found.get(c)
        dt = df.schema[c].dataType
        if v is not None and isinstance(dt, T.BooleanType):
            v = v == "true"
        out[c] = v
    return out


def categories(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values: one one-hot column each, so they have to fit the schema anyway."""
    rows = df.select(F.col(f"`{col}`").alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r["v"] for r in rows)


# ------------------------------------------------------------------ column operators
def impute_numeric(df: DataFrame, cols: Sequence[str], medians: dict | None = None,
                   report=print) -> DataFrame:
    """NULL -> the column's exact median; a column with no value at all is dropped."""
    medians = medians if medians is not None else exact_medians(df, cols)
    empty = [c for c in cols if medians.get(c) is None]
    if empty:
        report(f"Dropping numeric columns without any value: {empty}")
    fills = {c: F.coalesce(to_number(f"`{c}`"), F.lit(medians[c])) for c in cols if c not in empty}
    return df.withColumns(fills).drop(*empty)


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column is divided by 1."""
    stats = stats if stats is not None else mean_std(df, cols)
    return df.withColumns({c: (F.col(f"`{c}`") - F.lit(stats[c][0])) / F.lit(stats[c][1])
                           for c in cols if stats[c][0] is not None})


def impute_categorical(df: DataFrame, cols: Sequence[str], fill: dict | None = None) -> DataFrame:
    """NULL -> the column's most frequent value (lowest on ties)."""
    fill = fill if fill is not None else modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(fill[c]))
                           for c in cols if fill.get(c) is not None})


def one_hot_name(col: str, value) -> str:
    v = str(value).lower() if isinstance(value, bool) else str(value)
    return f"{col}_{v}"


def one_hot(df: DataFrame, col: str, cats: list | None = None, drop_input: bool = True) -> DataFrame:
    """One 0/1 DOUBLE column per sorted category; NULL or unknown -> all zeros."""
    cats = cats if cats is not None else categories(df, col)
    out = df.withColumns({one_hot_name(col, v): F.when(F.col(f"`{col}`") == F.lit(v), 1.0).otherwise(0.0)
                          for v in cats})
    return out.drop(col) if drop_input else out


def route_columns(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) by declared type.  Nullable booleans are categorical."""
    num, cat = [], []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, NUMERIC_TYPES):
            num.append(c)
        elif isinstance(dt, (T.StringType, T.BooleanType)):
            cat.append(c)
    return num, cat


# ------------------------------------------------------------------ the preprocessor as Spark ML stages
class _PreParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical inputs", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], outputCol="features")


class PanelPreprocessor(Estimator, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median-impute + standardize numeric columns, mode-impute + one-hot the rest."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PanelPreprocessorModel":
        num, cat = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        if not num and not cat:
            raise ValueError("the preprocessor needs a numeric, text or boolean column")
        med = exact_medians(df, num)
        num = [c for c in num if med[c] is not None]
        imputed = impute_numeric(df, num, med, report=lambda *_: None)
        ms = mean_std(imputed, num)
        fill = modes(df, cat)
        filled = impute_categorical(df, cat, fill)
        cats = {c: categories(filled, c) for c in cat}
        state = {"medians": med, "means": {c: ms[c][0] for c in num}, "stds": {c: ms[c][1] for c in num},
                 "modes": fill, "categories": cats}
        return PanelPreprocessorModel(numericCols=num, categoricalCols=cat,
                                      outputCol=self.getOrDefault("outputCol"), state=json.dumps(state))


class PanelPreprocessorModel(Model, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted statistics as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features", state="{}"):
        super().__init__()
        self._setDefault(state="{}")
        self._set(**self._input_kwargs)

    def feature_names(self) -> list[str]:
        st = json.loads(self.getOrDefault("state"))
        names = list(self.getOrDefault("numericCols"))
        for c in self.getOrDefault("categoricalCols"):
            names += [one_hot_name(c, v) for v in st["categories"][c]]
        return names

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault("state"))
        num, cat = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        parts = []
        for c in num:
            x = F.coalesce(to_number(f"`{c}`"), F.lit(st["medians"][c]))
            parts.append(((x - F.lit(st["means"][c])) / F.lit(st["stds"][c])).alias(f"__n_{c}"))
        for c in cat:
            v = F.coalesce(F.col(f"`{c}`"), F.lit(st["modes"][c]))
            parts += [F.when(v == F.lit(k), 1.0).otherwise(0.0).alias(f"__c_{one_hot_name(c, k)}")
                      for k in st["categories"][c]]
        tmp = df.select("*", *parts)
        inputs = tmp.columns[len(df.columns):]
        out = VectorAssembler(inputCols=inputs, outputCol=self.getOrDefault("outputCol")).transform(tmp)
        return out.drop(*inputs)


def build_preprocessor(df: DataFrame, feature_cols: Sequence[str], output_col: str = "features") -> PanelPreprocessor:
    """Route by declared type; no usable column raises."""
    num, cat = route_columns(df, feature_cols)
    if not num and not cat:
        raise ValueError("the preprocessor needs a numeric, text or boolean column")
    return PanelPreprocessor(numericCols=num, categoricalCols=cat, outputCol=output_col)


# The reference's boosting settings (500 trees, rate 0.05,
# depth 6, row and column sampling 0.8, squared error).
GBT_DEFAULTS = dict(maxIter=500, stepSize=0.05, maxDepth=6, subsamplingRate=0.8,
                    featureSubsetStrategy="0.8", lossType="squared")


def gbt_pipeline(df: DataFrame, feature_cols: Sequence[str], target_col: str, seed: int = 42,
                 **overrides) -> Pipeline:
    """Preprocessor + ``GBTRegressor`` as one estimator (refitted per fold)."""
    # GBT checkpoints its running predictions every ``checkpointInterval``
    # iterations when a checkpoint dir exists, which keeps a 500-tree lineage
    # short; cached node ids avoid re-walking deep trees on every level.
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    params = {**GBT_DEFAULTS, "checkpointInterval": 10, "cacheNodeIds": True, **overrides}
    gbt = GBTRegressor(featuresCol="features", labelCol=target_col, predictionCol="prediction",
                       seed=seed, **params)
    return Pipeline(stages=[build_preprocessor(df, feature_cols), gbt])


# ------------------------------------------------------------------ folds, metrics
def assign_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42,
                 method: str = "hash", out_col: str = "fold", equal: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """Deterministic fold in [0, k) from the row keys and the seed; no global sort.

    ``hash``: xxhash64 of keys and seed.  ``arith``: an integer mix of
    numeric keys that plain SQL engines reproduce; a NULL key counts as 0.
    With ``equal`` rows are ranked by that number (then keys and ``ties``) and dealt
    in turn, so that the folds' sizes differ by one at most; the ranks come from
    a prefix scan.
    """
    def folds(h):
        if not equal:
            return df.withColumn(out_col, F.pmod(h, F.lit(k)).cast("int"))
        from tessera.operators.scan import prefix_scan
        out = prefix_scan(df.withColumn("__h", h), [], ["__h", *keys, *ties], position="__rank")
        return out.withColumn(out_col, (F.col("__rank") % k).cast("int")).drop("__h", "__rank")

    if method == "hash":
        return folds(F.xxhash64(*[F.col(f"`{c}`") for c in keys], F.lit(seed)))
    p = 2147483647
    h = F.lit(seed).cast("long")
    for i, c in enumerate(keys):
        h = F.pmod(h * 48271 + F.pmod(F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0)), F.lit(p)) * (16807 + i), F.lit(p))
    return folds(h)


def regression_metrics(df: DataFrame, label_col: str, pred_col: str = "prediction") -> DataFrame:
    """One row: rmse, mae, r2, n_rows (rows with a NULL label or prediction are skipped).

    R2 uses ``var_pop(label) * n`` for the total sum of squares, so it needs
    one pass and no unpartitioned window.
    """
    y, p = F.col(f"`{label_col}`"), F.col(f"`{pred_col}`")
    d = df.where(y.isNotNull() & p.isNotNull()).select((y - p).alias("r"), y.alias("y"))
    return d.agg(
        F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rmse"),
        F.avg(F.abs("r")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(F.col("r") * F.col("r")), F.var_pop("y") * F.count("y"))).alias("r2"),
        F.count(F.lit(1)).alias("n_rows"))


def cross_validate(df: DataFrame, estimator_factory, target_col: str, keys: Sequence[str],
                   k: int = 5, seed: int = 42, fold_method: str = "hash", parallelism: int = 1) -> dict:
    """K-fold RMSE with the whole pipeline refitted per fold.

    Returns {"fold_rmse": [...], "rmse_mean": m, "rmse_std": population std}.
    The input is persisted once for the k fits (recomputed from lineage if
    an executor is lost).  ``parallelism`` folds are fitted at a time, which
    fills the gaps that the small jobs of a fit leave on a cluster.
    """
    data = assign_folds(df, keys, k, seed, fold_method, "__fold").persist()
    try:
        def fit_and_score(i: int) -> float:
            train, test = data.where(F.col("__fold") != i), data.where(F.col("__fold") == i)
            model = estimator_factory(train).fit(train)
            score = regression_metrics(model.transform(test), target_col).first()["rmse"]
            if score is None:
                raise ValueError(f"fold {i} of {k} has no row with a known {target_col}; take fewer folds")
            return score

        if parallelism > 1:
            data.count()  # stored before the folds start side by side
            with ThreadPoolExecutor(min(parallelism, k)) as pool:
                scores = list(pool.map(inheritable_thread_target(df.sparkSession)(fit_and_score), range(k)))
        else:
            scores = [fit_and_score(i) for i in range(k)]
    finally:
        data.unpersist()
    mean = sum(scores) / len(scores)
    std = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    return {"fold_rmse": scores, "rmse_mean": mean, "rmse_std": std}


def score_with_residual(model: Transformer, df: DataFrame, target_col: str | None,
                        pred_col: str = "prediction") -> DataFrame:
    """Model predictions plus ``residual = target - prediction`` when the target exists."""
    out = model.transform(df)
    extra = [c for c in out.columns if c not in df.columns and c != pred_col]
    out = out.drop(*extra)
    if target_col and target_col in df.columns:
        out = out.withColumn("residual", F.col(f"`{target_col}`") - F.col(pred_col))
    return out


def save_model_and_metrics(model, metrics: dict, model_path: str | None, metrics_path: str | None) -> None:
    """Spark ML model save (overwrite) and a one-row JSON metrics file; a path not given is not written."""
    if model_path:
        model.write().overwrite().save(model_path)
    if not metrics_path:
        return
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    row = {k: (list(map(float, v)) if isinstance(v, (list, tuple)) else float(v)) for k, v in metrics.items()}
    schema = T.StructType([T.StructField(k, T.ArrayType(T.DoubleType()) if isinstance(v, list) else T.DoubleType())
                           for k, v in row.items()])
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(metrics_path)


def feature_importance(model: PipelineModel, top: int = 25) -> DataFrame:
    """Top feature importances of the fitted GBT, named from the preprocessor."""
    pre, gbt = model.stages[0], model.stages[-1]
    imp = gbt.featureImportances.toArray().tolist()
    try:
        names = pre.feature_names()
    except Exception:  # noqa: BLE001
        names = [f"f{i}" for i in range(len(imp))]
    if len(names) != len(imp):
        raise ValueError(f"{len(imp)} importances for {len(names)} feature names")
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(names, map(float, imp))), "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(top)
