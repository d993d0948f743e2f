"""Benchmark decontamination: prefix-filtered set join on rare shingles, exact check of item-sized windows.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import NON_WORD, discard, packed, read_table, saved, sized, text_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 3


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NON_WORD), "")


def low_words(text: Column) -> Column:
    """Words with A-Z lowered and nothing else."""
    return raw_words(F.translate(text, UPPER, LOWER))


def shingle_hash(words: list[Column]) -> Column:
    """Hash of a shingle, for looking up only: words that agree with A-Z lowered agree lowered one by one."""
    return F.xxhash64(F.lit(len(words)), *[F.lower(w) for w in words])


def shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, n_words, pos, h) of every shingle of every text, for the given numbers of words."""
    most = max(sizes)
    rows = docs.select(text_key(F.col("text")).alias("key"), raw_words(F.col("text")).alias("w"))
    rows = rows.select("key", F.size("w").alias("n_words"), F.posexplode(F.arrays_zip(
        *[F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(most)])).alias("pos", "s"))
    word = [F.col(f"s.w{i}") for i in range(most)]
    if sizes == [most]:
        full = rows.where(word[-1].isNotNull())
        return full.select("key", "n_words", "pos", shingle_hash(word).alias("h"))
    each = F.array(*[F.when(word[k - 1].isNotNull(), shingle_hash(word[:k])) for k in sizes])
    return rows.select("key", "n_words", "pos", F.explode(each).alias("h")).where("h is not null")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, n, items): each distinct window of the items, its words joined by spaces, their number, the items' ids."""
    w = low_words(F.col("text"))
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), w.alias("w"))
    rows = rows.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    rows = rows.select("item", "w", F.explode(starts).alias("i"))
    gram = F.slice("w", F.col("i"), window)
    return rows.groupBy(F.array_join(gram, " ").alias("gram"), F.size(gram).alias("n")).agg(
        F.collect_set("item").alias("items"))


def prefixes(grams: DataFrame, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(h, offset, gram, n, items): each window's rarest shingle in the corpus, and where in the window it stands.

    All of a window has to be found, so one shingle is a sufficient prefix of
    its shingles ordered by rarity.  Windows of fewer words than a shingle are
    one shingle.
    """
    w = F.split("gram", " ")
    k = F.least(F.col("n"), F.lit(shingle))
    parts = grams.select("gram", "n", k.alias("k"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("n") - k + 1), lambda i: F.slice(w, i, k))).alias("offset", "s"))
    each = F.lit(None).cast("long")
    for size in range(1, shingle + 1):
        each = F.when(F.col("k") == size, shingle_hash([F.col("s")[i] for i in range(size)])).otherwise(each)
    parts = saved(parts.select("gram", "offset", "k", each.alias("h")), "parts")
    sizes = sorted(r["k"] for r in parts.select("k").distinct().collect())
    if not sizes:
        return parts.limit(0).join(grams, "gram").select("h", "offset", "gram", "n", "items", "k")
    vocabulary = saved(parts.select("h").distinct(), "vocabulary")
    seen = shingles(docs, sizes).join(sized(vocabulary, 16), "h").groupBy("h").agg(F.count("*").alias("rows"))
    rarest = parts.join(saved(seen, "rarity"), "h").groupBy("gram").agg(
        F.min(F.struct("rows", "h", "offset", "k")).alias("p"))
    return rarest.join(grams, "gram").select("p.h", "p.offset", "gram", "n", "items", "p.k")


def found_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(key, n_hit, items): for each text that holds a window, the words inside windows and the items, sorted.

    The corpus is read for the shingles' rarity, for places of the windows'
    rarest shingles, and for the exact check of those places whose window fits
    into the text.  Only texts with such a place are shuffled with their text.
    """
    grams = saved(windows(benchmark, window), "windows")
    rare = saved(prefixes(grams, docs, shingle), "prefixes")
    sizes = sorted(r["k"] for r in rare.select("k").distinct().collect()) or [shingle]
    wanted = saved(rare.select("h").distinct(), "wanted")
    at = shingles(docs, sizes).join(sized(wanted, 16), "h").distinct()
    start = F.col("pos") - F.col("offset")
    places = at.join(rare, "h").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    places = places.select("key", F.struct(start.alias("start"), "n", "gram", "items").alias("c"))
    places = saved(places.groupBy("key").agg(F.collect_set("c").alias("c")), "places")
    keys = saved(places.select("key"), "keys")
    texts = docs.select(text_key(F.col("text")).alias("key"), "text").join(sized(keys, 48), "key", "left_semi")
    rows = texts.join(places, "key").select("key", low_words(F.col("text")).alias("w"), "c")
    same = rows.select("key", F.filter("c", lambda c: F.array_join(
        F.slice("w", c["start"] + 1, c["n"]), " ") == c["gram"]).alias("c"))
    spots = F.flatten(F.transform("c", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("c", lambda c: c["items"]))))
    same = same.where(F.size("c") > 0).select("key", F.size(F.array_distinct(spots)).cast("long").alias("n_hit"),
                                              items.alias("items"))
    out = saved(same.groupBy("key").agg(F.first("n_hit").alias("n_hit"), F.first("items").alias("items")), "found")
    for used in (places, keys, wanted, rare, grams):
        discard(used)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of ``docs`` (doc_id, text).

    NULL text has no words.  Items without id or words are ignored, and items
    that share an id are one.  Rows and ids may repeat or be NULL; copies of a
    text are checked for their first copy's places and all get its result.
    """
    found = found_windows(docs, benchmark, window, shingle)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"),
                       F.size(raw_words(F.col("text"))).cast("long").alias("n_words"))
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item."""
    keys = saved(found_windows(docs, benchmark).select("key"), "contaminated")
    rows = docs.select(packed(docs), text_key(F.col("text")).alias("key"))
    return rows.join(sized(keys, 48), "key", "left_anti").select("row.*")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


#: DuckDB SQL of op1's contract.
SQL_DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT rid, i, n, item FROM g JOIN win USING (n, gram)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
