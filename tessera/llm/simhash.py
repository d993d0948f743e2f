"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, packed, saved
from tessera.llm.components import connected_components

SEED = 42


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half the shingles' XXH64.

    Words are runs of anything but ASCII white space, A-Z lowered.  A text of
    fewer words than a shingle is one shingle; one without words gives zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n = len(words) - shingle + 1
    digest, join, counts, step = xxhash.xxh64_digest, b" ".join, np.zeros(64, np.int64), 1 << 16
    for a in range(0, n, step):
        part = words[a:min(a + step, n) + shingle - 1]
        hashes = b"".join([digest(join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)))])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text, shingle: int = 3):
    """Column of :func:`simhash64`."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash64(t, shingle) for t in texts], dtype="int64")
    return run(text)


def block_masks(blocks: int, open_blocks: int) -> list[int]:
    """Signed masks that keep all but ``open_blocks`` of the 64 bits' blocks, for every choice of those."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    kept = (sum(c) for c in combinations(part, blocks - open_blocks))
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                     for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.choice", "k.bits", "fp")


def bucket_links(fps: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links that connect the fingerprints of a bucket exactly as all close pairs would."""
    left, links = np.sort(fps.astype(np.int64)), []
    apart = lambda x: np.bitwise_count((left ^ x).view(np.uint64))  # noqa: E731  of signed numbers it counts the absolute value's
    while len(left):
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            close = apart(front.pop()) <= max_distance
            if close.any():
                found, left = left[close], left[~close]
                links.extend((int(f), int(root)) for f in found)
                front.extend(found)
    return links


def close_links(fps: DataFrame, max_distance: int = 2, bucket: int = 4096) -> DataFrame:
    """(u, v) links among distinct fingerprints ``fp``, whose components are those of all close pairs.

    With ``max_distance + 2`` blocks, two fingerprints that close agree in two
    blocks at least, so each pair of blocks is a key and close pairs meet in
    some key's bucket.  A bucket of at most ``bucket`` fingerprints is verified
    in one vectorised pass that yields a spanning set of links, never its
    pairs.  The fingerprints of larger buckets meet again under finer blocks of
    four bits, of which ``max_distance`` are open: a bucket there holds at most
    16 ** max_distance fingerprints, whatever the data.
    """
    @F.pandas_udf("array<struct<u:long,v:long>>")
    def link(buckets: pd.Series) -> pd.Series:
        return pd.Series([[{"u": u, "v": v} for u, v in bucket_links(np.asarray(b), max_distance)] for b in buckets])

    def linked(keyed: DataFrame) -> DataFrame:
        grouped = keyed.groupBy("choice", "bits").agg(F.collect_list("fp").alias("fps"))
        return grouped.where(F.size("fps") > 1).select(F.explode(link("fps")).alias("l")).select("l.u", "l.v")

    keyed = _keyed(fps, block_masks(max_distance + 2, max_distance))
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(keyed.join(sizes, ["choice", "bits"]), "blocks")
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    links = linked(shared.where(F.col("n") <= bucket)).union(
        linked(_keyed(crowded, block_masks(16, max_distance))))
    out = saved(links.distinct(), "links")
    discard(shared)
    return out


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_distance: int = 2, bucket: int = 4096) -> DataFrame:
    """(id, fp, component_id, root, text_hash): every row's fingerprint and the smallest id reachable over close fingerprints.

    ``root`` names the component itself: two components may have the same
    smallest id where an id names several texts.  Null and empty texts have fingerprint zero and link like any other.  A NULL
    id keeps its row, never names a component unless its whole component has
    none (then ``component_id`` is NULL).  Repeated rows stay repeated.  Equal
    fingerprints collapse to one node by a grouped minimum, so a group of
    copies costs one row from there on.
    """
    rows = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))
    rows = saved(rows, "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(close_links(nodes.select("fp"), max_distance, bucket))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = saved(nodes.select("fp", "low", F.coalesce("root", "fp").alias("root")), "nodes")
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(nodes.join(lows, "root").select("fp", "root", "component_id"), "fp").select(
        "id", "fp", "component_id", "root", "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_distance: int = 2) -> DataFrame:
    """``docs`` with one row left of each group: that of the smallest id, and of that id's texts that of the least hash.

    Decisions name rows, not ids: an id that stays with one text may go with
    another.  Of rows that repeat both, the least one stays, by its columns as
    JSON.  Rows with a NULL id always stay, since no decision can name them.
    """
    groups = simhash_groups(docs, id_col, text_col, shingle, max_distance).where("id is not null")
    keep = groups.groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("k")).select("k.id", "k.text_hash")
    rows = docs.select(packed(docs), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    rows = rows.join(keep, ["id", "text_hash"], "left_semi")
    one = rows.groupBy("id", "text_hash").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return one.union(docs.where(F.col(id_col).isNull()))


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")
