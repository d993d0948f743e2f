"""Periodic run detection: multi-scale minimizers for long periods, direct lag scans for short ones."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import read_table

#: Words of the shortest run.
MIN_WORDS = 12
#: Periods below are found by a scan of their lag; from here on each scale covers the periods up to twice its first.
FIRST_SCALE = 4 * MIN_WORDS
#: Words that are searched together: whole texts until so many words are reached.
BATCH_WORDS = 1 << 18

_MIX, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _MIX + b) * _FOLD
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` words from each place on, built from halves."""
    if k == 1:
        h = (words.astype(np.uint64) + np.uint64(1)) * _MIX
        return (h ^ (h >> np.uint64(29))) * _FOLD
    half = gram_hashes(words, k // 2)
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = _pair(half[:n], half[k // 2:k // 2 + n])
    return _pair(out, gram_hashes(words[k - 1:], 1)[:n]) if k % 2 else out


def minima(h: np.ndarray, window: int) -> np.ndarray:
    """Places that hold the first least value of some ``window`` neighbouring ones, built from halves; _NEVER is not chosen."""
    at, width = np.arange(max(0, len(h) - window + 1) and len(h)), 1
    while width < window and len(at):
        step = min(width, window - width)
        a, b = at[:len(at) - step], at[step:]
        at, width = np.where(h[a] <= h[b], a, b), width + step
    at = np.unique(at)
    return at[h[at] != _NEVER]


def lag_stretches(words: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the longest stretches of at least ``least`` places whose word comes again ``lag`` words on."""
    at = np.flatnonzero(words[:-lag] == words[lag:]) if lag < len(words) else np.zeros(0, np.int64)
    if not len(at):
        return at, at
    edge = np.flatnonzero(np.diff(at) > 1)
    first, last = at[np.concatenate([[0], edge + 1])], at[np.concatenate([edge, [len(at) - 1]])]
    size = last - first + 1
    return first[size >= least], size[size >= least]


def _reach(words: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on, forwards (step 1) or backwards (-1, i and j excluded), are alike."""
    n, size = 0, 64
    most = len(words) - j if step > 0 else i
    while n < most:
        size = min(size, most - n)
        a, b = (words[i + n:i + n + size], words[j + n:j + n + size]) if step > 0 else (
            words[i - n - size:i - n][::-1], words[j - n - size:j - n][::-1])
        unlike = a != b
        at = int(unlike.argmax())
        if unlike[at]:
            return n + at
        n, size = n + size, 2 * size
    return n


def _grown(words: np.ndarray, seeds: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, words, period) of the runs that the seeds (a place whose word comes again the lag further on) lie in."""
    out, order = [], np.lexsort((seeds, lags))
    end = lag_before = -1
    for at, lag in zip(seeds[order].tolist(), lags[order].tolist()):
        if lag == lag_before and at < end:
            continue
        left = _reach(words, at, at + lag, -1)
        right = _reach(words, at, at + lag, 1)
        end, lag_before = at + right, lag
        if left + right >= lag:
            out.append((at - left, left + right + lag, lag))
    return out


def _adjoining(words: np.ndarray, runs: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of runs that consist of the end of one run and the beginning of another of the same period that adjoins it.

    Where a text (ab)^i a (ab)^j turns, there are runs of many longer periods,
    whose first half holds nothing but the short period and so has no
    minimizers.  Their periods lie one short period apart.
    """
    seeds, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = np.lexsort((runs[:, 0], runs[:, 2]))
    r = runs[order]
    a, b = r[:-1], r[1:]
    ends = a[:, 0] + a[:, 1]
    near = (a[:, 2] == b[:, 2]) & (b[:, 0] <= ends) & (np.minimum(a[:, 1], b[:, 1]) >= low)
    for (x, n, d), (y, m, _) in zip(a[near].tolist(), b[near].tolist()):
        root, twice = words[x:x + d].tobytes(), words[y:y + 2 * d].tobytes()
        width, turn = words.itemsize, twice.find(root)
        while turn >= 0 and turn % width:
            turn = twice.find(root, turn + 1)
        if turn < 0:
            continue
        phase = y + turn // width - x
        first = low + (phase - low) % d
        q = np.arange(first, min(n, m, high - 1) + 1, d)
        seeds.append(np.maximum(x, y - q))
        lags.append(q)
    return np.concatenate(seeds), np.concatenate(lags)


def _scale(words: np.ndarray, runs: np.ndarray, low: int) -> list[tuple[int, int, int]]:
    """Runs of the periods ``low`` to 2 * low - 1, given those of all smaller ones.

    The two halves of such a run hold the same windows of low / 2 grams of
    low / 4 words, so the same minimizers, a period apart.  Grams that have a
    short period themselves (those that lie in a run found with a period of
    half their words at most) are never minimizers, so equal ones lie more than
    low / 8 words apart and each has a few partners only; a run whose half has
    no minimizers is made of two adjoining runs.
    """
    k = low // 4
    h = gram_hashes(words, k)
    short = runs[(runs[:, 2] * 2 <= k) & (runs[:, 1] >= k)]
    if len(short):
        edges = np.zeros(len(h) + 1, np.int64)
        np.add.at(edges, short[:, 0], 1)
        np.add.at(edges, short[:, 0] + short[:, 1] - k + 1, -1)
        h[np.cumsum(edges[:-1]) > 0] = _NEVER
    at = minima(h, low // 2)
    order = np.lexsort((at, h[at]))
    at, keys = at[order], h[at][order]
    seeds, lags = [], []
    for nth in range(1, len(at)):
        gap = at[nth:] - at[:-nth]
        same = keys[nth:] == keys[:-nth]
        near = same & (gap < 2 * low)
        if not near.any():
            break
        hit = near & (gap >= low)
        seeds.append(at[:-nth][hit])
        lags.append(gap[hit])
    more = _adjoining(words, short, low, 2 * low) if len(short) > 1 else (np.zeros(0, np.int64),) * 2
    return _grown(words, np.concatenate([*seeds, more[0]]), np.concatenate([*lags, more[1]]))


def find_runs(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """Of each text, as numbers of its words: rows (start, words, period) of all its runs, by start, then period.

    A run is a longest stretch of at least ``min_words`` words and twice its
    smallest period.  All of them are found: those of short periods by a scan
    of each lag, those of longer ones scale by scale.  The texts are searched
    as one sequence with a number of its own behind each; a scale only sees the
    texts that are long enough for it.
    """
    first_scale = max(FIRST_SCALE, 4 * min_words)
    sizes = np.array([len(t) for t in texts], np.int64)
    found, low = np.zeros((0, 4), np.int64), 1  # text, start, words, period
    while True:
        chosen = np.flatnonzero(sizes >= 2 * low)
        if not len(chosen):
            break
        offsets = np.concatenate([[0], np.cumsum(sizes[chosen] + 1)])
        words = np.empty(offsets[-1], np.int32)
        for i, (t, a) in enumerate(zip(chosen.tolist(), offsets.tolist())):
            words[a:a + sizes[t]] = texts[t]
            words[a + sizes[t]] = -1 - i
        if low == 1:
            new, high = [], first_scale
            for lag in range(1, first_scale):
                start, size = lag_stretches(words, lag, max(lag, min_words - lag))
                new.append(np.stack([start, size + lag, np.full(len(start), lag)], axis=1))
            new = np.concatenate(new)
        else:
            slot = np.searchsorted(chosen, found[:, 0])
            known = (slot < len(chosen)) & (chosen[np.minimum(slot, len(chosen) - 1)] == found[:, 0])
            before = np.column_stack([offsets[slot[known]] + found[known, 1], found[known, 2:]])
            new, high = np.array(_scale(words, before, low), np.int64).reshape(-1, 3), 2 * low
        slot = np.searchsorted(offsets, new[:, 0], side="right") - 1
        new = np.column_stack([chosen[slot], new[:, 0] - offsets[slot], new[:, 1:]])
        found = np.concatenate([found, new])
        order = np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))
        found = found[order]
        same = (found[1:, :3] == found[:-1, :3]).all(axis=1)  # of a stretch found with several periods the smallest counts
        found = found[np.concatenate([[True], ~same])] if len(found) else found
        low = high
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    edges = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    return [found[a:b, 1:] for a, b in zip(edges[:-1], edges[1:])]


def looped(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words, from some place on repeated with some period for one id in ten, as the id's CRC-32 says."""
    if doc_id is None or not words:
        return words
    h, n = crc32(doc_id.encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [w for w, gone in zip(words, (np.cumsum(edges[:-1]) > 0).tolist()) if not gone]


def text_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
              loops: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every row's periodic runs, and its text without their repeats.

    Words are what lies between ASCII white space.  ``runs`` is an array of
    structs (start, length, period) by start, then period; ``collapsed`` holds
    the words that are in no run after its first period, joined by one space.
    With ``loops`` every tenth text is first made to repeat itself
    (:func:`looped`), which plants runs of all periods.

    A text is one row and needs no other, so there is no shuffle, and rows with
    the same id each have a result.  NULL and empty texts have no words, no
    runs and an empty ``collapsed``; rows without id keep their text.  Time for
    a text of n words grows as n log n (squared), not with n * n; a very long
    text is searched alone.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(rows: list[tuple]):
        """rows: (doc_id, id as text, words)."""
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids = [np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for _, _, w in rows]
        found = find_runs(ids, min_words)
        kept = [b" ".join(collapsed(w, r)) for (_, _, w), r in zip(rows, found)]
        sizes = np.concatenate([[0], np.cumsum([len(r) for r in found])])
        flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run))
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _, _ in rows], pa.int64()), pa.array([len(w) for _, _, w in rows], pa.int64()),
             pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])

    def work(batches):
        for batch in batches:
            rows, size = [], 0
            for doc, text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                rows.append((doc, text_id, looped(words, text_id) if loops else words))
                size += len(words)
                if size >= BATCH_WORDS:
                    yield search(rows)
                    rows, size = [], 0
            if rows:
                yield search(rows)
    rows = docs.select(F.col(id_col).cast("long"), F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return rows.toDF("doc_id", "id", "text").mapInArrow(
        work, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """The result of :func:`text_runs` as counts and digests: the longest run, a hash of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def op13_runs(spark, sf_dir: str) -> DataFrame:
    return run_digests(text_runs(read_table(spark, sf_dir, "documents"), loops=True))
