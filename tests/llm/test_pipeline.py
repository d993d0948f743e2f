"""The corpus pipeline against a plain composition of brute-force stages."""

import hashlib
import random

import sentencepiece
from test_llm import all_pairs_groups, prose, slow_hits, slow_simhash, words

import corpus_pipeline
from tessera.llm import pieces


def corpus(rng):
    texts = [prose(rng, rng.randrange(80, 140), 3000) for _ in range(160)]
    loud = {i for i in range(160) if i % 5 == 0}
    texts = [" ".join(w.upper() + "!!" for w in t.split()) if i in loud else t for i, t in enumerate(texts)]
    texts[21], texts[22] = texts[11], texts[11] + " more"  # copies
    shared = prose(rng, 70, 3000)
    texts[31], texts[32] = texts[31] + " " + shared, shared + " " + texts[32]
    item = prose(rng, 14, 3000)
    texts[41] = texts[41] + " " + item.upper()
    return texts, loud, shared, [(1, item), (2, prose(rng, 20, 3000))]


def test_stages_equal_brute_force(spark, tmp_path):
    texts, loud, shared, items = corpus(random.Random(31))
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in loud), 0) for i in range(150)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = {i: t for i, t in enumerate(texts) if i not in loud}
    groups = all_pairs_groups([(i, slow_simhash(t)) for i, t in left.items()])
    left = {i: t for i, t in left.items() if groups[i] == i}
    assert words(left[32])[:70] == words(shared)
    left[32] = " " + " ".join(left[32].split()[70:])
    left = {i: t for i, t in left.items() if not slow_hits(t, items)[1]}
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t in left.items():
        ids = lib.encode(t)
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want and 41 not in got and not loud & set(got) and 11 in got and 21 not in got


def test_stages_keep_the_columns_and_take_odd_rows(spark, tmp_path):
    texts, loud, _, items = corpus(random.Random(32))
    rows = [(i, t, "en", "s", len(t), "x") for i, t in enumerate(texts)] + [(None, None, None, None, None, "x"), (300, "", "en", None, 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    spark.createDataFrame([(i, int(i not in loud), 0) for i in range(150)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"], name
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() > 100
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
