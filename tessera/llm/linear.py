"""Linear text classifiers on hashed n-gram indicators, scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved, sized, worker_cache

#: Hashed feature space; every model is a vector of this size, whatever the corpus.
DIM = 1 << 18
#: Rows that a model is fitted on: those of the smallest hashes.  Class counts cover all labelled rows.
MAX_FIT = 6000
#: Values of a block that holds rows of a fit: large enough for memory of its own, which many small arrays on the heap don't give back.
BLOCK = 1 << 18
#: A feature seen in fewer labelled rows has no weight.
MIN_ROWS = 3

#: Bytes to their kind: a lower-case letter or any byte beyond ASCII, an upper-case letter, a digit, or the byte itself.
SHAPES = bytes(97 if 97 <= b < 123 or b > 127 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b for b in range(256))
#: Bytes that aren't part of a word become spaces.
SPACES = bytes(b if b > 127 or 97 <= b < 123 or 65 <= b < 91 or 48 <= b < 58 else 32 for b in range(256))

Grams = Callable[[str], np.ndarray]


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, tokens), np.uint32, len(tokens)).astype(np.uint64)


def _ngrams(h: np.ndarray, orders: tuple[int, ...], salt: int) -> list[np.ndarray]:
    out = []
    for n in orders:
        g = np.full(max(0, len(h) - n + 1), 7919 * salt + n, np.uint64)
        for i in range(n):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i if n <= len(h) else i]
        out.append((g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 18))
    return out


def distinct(ids: np.ndarray) -> np.ndarray:
    """Distinct ids in one pass, without sorting."""
    mark = worker_cache().setdefault("mark", np.zeros(DIM, np.int64))
    at = np.arange(len(ids))
    mark[ids] = at
    return ids[mark[ids] == at]


def style_grams(text: str) -> np.ndarray:
    """Word 1-2-grams, and 1-3-grams of the words' shapes: kinds of their first and last characters, repeat of the word before."""
    raw = text.encode("utf-8", "replace")
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    shapes = [s[:2] + s[-2:] for s in raw.translate(SHAPES).split()]
    h, s = _hashes(words), _hashes(shapes)
    s[1:] += np.uint64(1 << 33) * (h[1:] == h[:-1])
    return distinct(np.concatenate(_ngrams(h, (1, 2), 1) + _ngrams(s, (1, 2, 3), 2)).astype(np.int64))


def word_grams(text: str) -> np.ndarray:
    """Words without punctuation and case, their 2-grams and the words' first five bytes."""
    words = text.encode("utf-8", "replace").lower().translate(SPACES).split()
    if not words:
        return np.zeros(0, np.int64)
    h, p = _hashes(words), _hashes([w[:5] for w in words])
    return distinct(np.concatenate(_ngrams(h, (1, 2), 3) + _ngrams(p, (1,), 4)).astype(np.int64))


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are never learnt from: CRC-32 of its id's text leaves 2, divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, targets: dict[str, Column], extra: list[str] = ()) -> DataFrame:
    """(id, text, one 0/1 column per target) of documents with a label that may be learnt from.

    The labels, a few bytes a row, go to the texts by broadcast while they
    take at most 64 MB, else both sides are shuffled by id.  Labels without an
    id or that are held out don't count; of a repeated id the largest label does.
    """
    own = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy(F.col("doc_id").alias("id")).agg(*[F.max(c).alias(t) for t, c in targets.items()])
    own = saved(own.dropna(subset=list(targets)), "labels")
    return docs.select(F.col("doc_id").alias("id"), "text", *extra).join(sized(own, 16 + 8 * len(targets)), "id")


@dataclass
class Counts:
    """Labelled rows, in all and of each target's class 1, and for each feature the rows that hold it."""
    rows: np.ndarray
    features: np.ndarray

    def ratio(self, target: int, less: Counts | None = None, alpha: float = 1.0) -> np.ndarray:
        """Log-count ratio of the classes for every feature; 0 where it was seen in fewer than MIN_ROWS rows."""
        total = (self.features - less.features if less else self.features).astype(float)
        pos, seen = total[:, target + 1], total[:, 0]
        neg = seen - pos
        r = np.log((pos + alpha) / (pos + alpha).sum()) - np.log((neg + alpha) / (neg + alpha).sum())
        return np.where(seen >= MIN_ROWS, r, 0.0)


def count_classes(train: DataFrame, targets: list[str], grams: Grams) -> Counts:
    """Class counts of every feature over all rows of ``train``: one dense table a task, summed by feature."""
    k = len(targets) + 1

    def run(batches):
        table = np.zeros((DIM + 1, k), np.int64)
        for pdf in batches:
            y = np.column_stack([np.ones(len(pdf), np.int64), pdf[targets].to_numpy(np.int64)])
            table[DIM] += y.sum(0)
            for text, row in zip(pdf["text"], y):
                table[grams(text or "")] += row
        at = np.flatnonzero(table[:, 0])
        if len(at):
            yield pd.DataFrame({"f": at} | {f"c{i}": table[at, i] for i in range(k)})

    part = train.select("text", *targets).mapInPandas(run, "f long, " + ", ".join(f"c{i} long" for i in range(k)))
    got = part.groupBy("f").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).toPandas()
    table = np.zeros((DIM + 1, k), np.int64)
    table[got["f"].to_numpy(np.int64)] = got.drop(columns="f").to_numpy(np.int64)
    return Counts(table[DIM], table[:DIM])


def sample(train: DataFrame, targets: list[str], grams: Grams, max_fit: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features, labels (a column a target) and hashes of the ``max_fit`` rows with the smallest hashes of their ids."""
    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: grams(t or "").astype(np.int32).tobytes())

    order = F.xxhash64(F.col("id"), F.lit("fit"))
    few = train.select("id").distinct().orderBy(order, "id").limit(max_fit)
    rows = train.join(F.broadcast(few), "id")
    rows = rows.select(order.alias("h"), *targets, features("text").alias("x")).toArrow()
    by = np.argsort(rows["h"].to_numpy(), kind="stable")
    y = np.column_stack([np.zeros(len(by)), *[rows[t].to_numpy() for t in targets]])[by, 1:]
    found = rows["x"]
    return flat((np.frombuffer(found[i].as_buffer(), np.int32) for i in by.tolist()), np.int32), y, rows["h"].to_numpy()[by]


def flat(rows: Iterable[np.ndarray], kind: type) -> list[np.ndarray]:
    """The rows as views of blocks of BLOCK values, so that their memory goes back to the system when they are used no more."""
    out: list[np.ndarray] = []
    part: list[np.ndarray] = []
    size = 0

    def close() -> None:
        out.extend(np.split(np.concatenate(part).astype(kind, copy=False), np.cumsum([len(x) for x in part])[:-1]))
        part.clear()
    for x in rows:
        part.append(x)
        size += len(x)
        if size >= BLOCK:
            close()
            size = 0
    if part:
        close()
    return out


def dual_descent(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, c: float = 1.0,
                 epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the L2-regularised hinge loss, by coordinate descent on its dual; x holds (indices, values) rows."""
    w, alpha, rng = np.zeros(size), np.zeros(len(x)), np.random.default_rng(seed)
    square = [float(v @ v) for _, v in x]
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            ids, v = x[i]
            if not square[i]:
                continue
            step = min(max(alpha[i] - (y[i] * (w[ids] @ v) - 1) / square[i], 0.0), c) - alpha[i]
            if step:
                alpha[i] += step
                w[ids] += step * y[i] * v
                moved = max(moved, abs(step))
        if moved < 1e-3 * c:
            break
    return w


def sigmoid_fit(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, with smoothed targets, by Newton steps."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        g = np.array([d @ s + 1e-3 * (a - 1), d.sum()])
        m = np.array([[h @ (s * s) + 1e-3, h @ s], [h @ s, h.sum() + 1e-9]])
        step = np.linalg.solve(m, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 0.0), float(b)


@dataclass
class Model:
    """Weights for DIM features, the given further inputs and a constant; slope and offset to a probability."""
    ratio: np.ndarray
    w: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, ids: np.ndarray, more: np.ndarray) -> float:
        at, v = scaled(self.ratio, ids, more)
        return float(self.w[at] @ v)

    def score(self, ids: np.ndarray, more: np.ndarray = np.zeros(0)) -> float:
        z = min(max(self.slope * self.margin(ids, more) + self.offset, -30.0), 30.0)
        return float(1 / (1 + np.exp(-z)))


def scaled(ratio: np.ndarray, ids: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row: its features' log-count ratios at unit length, then further inputs and a constant."""
    v = ratio[ids]
    ids, v = ids[v != 0], v[v != 0]
    v = v / (np.sqrt(v @ v) or 1.0)
    return np.concatenate([ids, np.arange(DIM, DIM + len(more) + 1)]), np.concatenate([v, more, [1.0]])


def scaled_rows(ratio: np.ndarray, x: list[np.ndarray], more: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """:func:`scaled` of every row, as views of a few blocks; the features' numbers take four bytes."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for a in range(0, len(x), 512):
        rows = [scaled(ratio, ids, m) for ids, m in zip(x[a:a + 512], more[a:a + 512])]
        out += zip(flat((ids for ids, _ in rows), np.int32), flat((v for _, v in rows), np.float64))
    return out


def fold_counts(x: list[np.ndarray], y: np.ndarray) -> Counts:
    table = np.zeros((DIM, y.shape[1] + 1), np.int64)
    for ids, row in zip(x, y.astype(np.int64)):
        table[ids] += np.concatenate([[1], row])
    return Counts(np.zeros(0), table)


def fit(x: list[np.ndarray], y: np.ndarray, target: int, counts: Counts, more: np.ndarray,
        folds: int = 3) -> tuple[Model, np.ndarray]:
    """The model of one target and its out-of-fold probabilities.

    A fold's own rows are taken out of the class counts that its scaling uses.
    The probabilities' slope and offset are fitted on the out-of-fold margins.
    Without rows of both classes every score is the share of class 1.
    """
    sign, size = np.where(y[:, target] > 0, 1.0, -1.0), DIM + more.shape[1] + 1
    if len(x) < 2 * folds or abs(sign.sum()) == len(sign):
        share = float((sign > 0).mean()) if len(x) else 0.5
        odds = np.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(np.zeros(DIM), np.zeros(size), 0.0, float(odds)), np.full(len(x), share)
    fold, margins = np.arange(len(x)) % folds, np.zeros(len(x))
    for f in range(folds):
        mine = np.flatnonzero(fold == f)
        rest = np.flatnonzero(fold != f)
        r = counts.ratio(target, fold_counts([x[i] for i in mine], y[mine]))
        w = dual_descent(scaled_rows(r, [x[i] for i in rest], more[rest]), sign[rest], size)
        part = Model(r, w)
        margins[mine] = [part.margin(x[i], more[i]) for i in mine]
    a, b = sigmoid_fit(margins, sign)
    r = counts.ratio(target)
    model = Model(r.astype(np.float32), dual_descent(scaled_rows(r, x, more), sign, size), a, b)
    return model, 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))


def broadcast_models(spark, models: list[Model]):
    """Models of fixed size (DIM weights and ratios each) for use in tasks, as plain arrays: see :func:`shared_models`."""
    return spark.sparkContext.broadcast([(m.ratio.astype(np.float32), m.w.astype(np.float32), m.slope, m.offset)
                                         for m in models])


def shared_models(broadcast) -> list[Model]:
    return [Model(*parts) for parts in broadcast.value]
