"""Target-distribution importance resampling: bucket gains, Gumbel scores, a cutoff by bisection, ranks by range."""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, read_table, saved
from tessera.llm.linear import SPACES

#: Hashed features, words of the longest one, and the seed of the draw.
BUCKETS, MOST_WORDS, SEED = 10_000, 1, 2024
#: A document of fewer words is never drawn; of the others so many percent are.
MIN_WORDS, PERCENT = 20, 10
#: Cutoffs that one count job tries.
CUTS = 15


def features(text: bytes | None, buckets: int = BUCKETS, most: int = MOST_WORDS) -> tuple[int, np.ndarray]:
    """Number of words of a text, and the bucket of each run of 1 to ``most`` words, repeats included."""
    words = (text or b"").lower().translate(SPACES).split()
    runs = words
    for n in range(2, most + 1):
        runs = runs + [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return len(words), np.fromiter(map(crc32, runs), np.uint32, len(runs)).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MOST_WORDS, text_col: str = "text") -> np.ndarray:
    """Features in each bucket over all texts.  A task sends one row a bucket, however many texts it reads."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                total += np.bincount(features(text.as_py(), buckets, most)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])
    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many rows as buckets at most
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the log of how much likelier each bucket is in the target than in the corpus, one added to each count."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: str, seed: int = SEED) -> int:
    """Floor of 1000 times a Gumbel number that the seed and the id fix."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, most: int = MOST_WORDS, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, row) of every row; ``row`` numbers the rows.

    The weight is the sum of the gains over the text's features, the score
    the weight and the Gumbel number of the id; without an id there is no score.
    """
    def run(batches):
        for batch in batches:
            n, k, weight, score = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words, at = features(text.as_py(), len(gain), most)
                n.append(words)
                k.append(len(at))
                weight.append(int(gain[at].sum()))
                score.append(None if doc is None else weight[-1] + gumbel(doc, seed))
            cols = [batch.column(2), *(pa.array(x, pa.int64()) for x in (n, k, weight, score))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_features", "weight", "score"])
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.col(id_col).cast("long"))
    rows = rows.toDF("id", "text", "doc_id")
    out = rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")
    return out.withColumn("row", F.monotonically_increasing_id())


def cutoff(rows: DataFrame, key: Column, k: int) -> tuple[int, int]:
    """The largest value that at least k >= 1 rows reach, and how many rows lie above it.

    Each job counts exactly, over all rows, how many reach each of CUTS values
    between the bounds; the bounds close in until they meet.  Nothing but these
    counts reaches the driver.
    """
    rows = rows.select(key.alias("key"))
    lo, hi = rows.agg(F.min("key"), F.max("key")).first()
    while lo < hi:
        step = max(1, -(-(hi - lo) // (CUTS + 1)))
        cuts = [c for c in range(lo + step, hi + 1, step)] or [hi]
        at_least = rows.agg(*[F.count(F.when(F.col("key") >= c, 1)) for c in cuts]).first()
        enough = [c for c, n in zip(cuts, at_least) if n >= k]
        lo, hi = max([lo, *enough]), min([hi, *(c - 1 for c in cuts if c not in enough)])
    return lo, rows.where(F.col("key") > lo).count()


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank``, 1, 2, 3 ... by ``order``: dealt by range, numbered where they lie, shifted by the ranges before.

    The columns must be of types that Arrow carries.  One count a partition
    reaches the driver.
    """
    names = rows.columns

    def run(batches):
        nth, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(nth + 1, nth + n + 1), pa.int64())],
                [*names, "part", "nth"])
            nth += n
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{kind}, part int, nth long")
    placed = saved(placed, "ranges")
    before, shift = [], 0
    for r in placed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        before.append((r.part, shift))
        shift += r.n
    before = rows.sparkSession.createDataFrame(before, "part int, shift long")
    return placed.join(F.broadcast(before), "part").select(*names, (F.col("nth") + F.col("shift")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, most: int = MOST_WORDS, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``: a draw without return towards ``target``.

    Features are runs of 1 to ``most`` words (digits, letters A-Z lowered,
    anything beyond ASCII), hashed into ``buckets``; a bucket's gain is the log
    ratio of its share in ``target`` (a table with a column ``text``) and in
    ``docs``.  Of the n rows with ``min_words`` words, the percent * n // 100
    of the highest score are drawn, ties to the smaller id, and ranked.  The
    scores are written once.  The lowest score drawn, and among rows of that
    score the largest id drawn, are found by bisection with counts of all
    rows, so no sort covers more than the rows drawn.

    NULL and empty texts have no features and weight 0.  A row without id has
    no score and is neither drawn nor counted in n.  Rows that repeat an id
    each count; of rows with equal id and score those of fewer features come
    first, and equal rows share out the places left.  An empty target gives
    all its buckets one count; an empty ``docs`` gives an empty result.  A very
    long text costs time in proportion and is held once, by its task.
    """
    gain = gains(bucket_counts(docs, buckets, most, text_col), bucket_counts(target, buckets, most))
    rows = saved(scored(docs, gain, most, seed, id_col, text_col), "scores")
    out = ["doc_id", "n_features", "weight", "score"]
    able = rows.where(F.col("score").isNotNull() & (F.col("n_words") >= min_words))
    k = percent * able.count() // 100
    if not k:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    low, above = cutoff(able, F.col("score"), k)
    last, _ = cutoff(able.where(F.col("score") == low), F.bitwise_not("doc_id"), k - above)
    reach = F.coalesce((F.col("n_words") >= min_words) & (
        (F.col("score") > low) | (F.col("score") == low) & (F.bitwise_not("doc_id") >= last)), F.lit(False))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("row")]
    drawn = numbered(rows.where(reach).select(*out, "row"), order)
    rank = F.when(F.col("rank") <= k, F.col("rank"))
    return rows.where(~reach).select(*out, F.lit(None).cast("long").alias("rank")).union(drawn.select(*out, rank))


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL_RESAMPLING = r"""
with crc as (
  select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as tab),
words as (
  select 'd' as side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select 'b', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
said as (select w, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from words group by w),
hashed as (
  select w, s, t, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
           list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::bigint)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 10000 as bucket
  from said, crc),
counts as (
  select b.range as bucket, coalesce(sum(s), 0)::double as s, coalesce(sum(t), 0)::double as t
  from range(10000) b left join hashed h on h.bucket = b.range group by 1),
gains as (
  select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain
  from counts),
weights as (
  select doc_id, count(*) as n, sum(gain)::bigint as weight
  from words join hashed using (w) join gains using (bucket) where side = 'd' group by doc_id),
scores as (
  select d.doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || d.doc_id::varchar), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from documents d left join weights using (doc_id)),
ranks as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scores where n_features >= 20)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score,
       (case when r <= 10 * n // 100 then r end)::bigint as rank
from scores left join ranks using (doc_id)
"""
