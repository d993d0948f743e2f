"""The training-data operators against brute-force versions and edge cases on small tables."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import chat, decontaminate, language, licenses, linear, passages, pieces, quality, simhash, topk, toxicity
from tessera.llm.components import connected_components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = "key string, w string, h long, id long, fp long, row string, cuts string, new string, c string, pos long"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)


def with_clash(docs):
    for c in CLASH.split(", "):
        name, kind = c.split()
        docs = docs.withColumn(name, F.lit("9").cast(kind))
    return docs


# components and SimHash ----------------------------------------------------------------------------

def roots(links):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_components_paths_stars_loops_and_nothing(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    links += [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(25)]
    got = connected_components(spark.createDataFrame([*links, (None, 3)], "u long, v long"))
    want = roots([(a, b) for a, b in links if a != b])
    assert {r.node: r.root for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def slow_simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints_match_the_definition():
    rng = random.Random(1)
    for text in [None, "", " \t\n", "One", "one TWO", "é É x y  z", prose(rng, 200), prose(rng, 3)]:
        assert simhash.simhash64(text) % (1 << 64) == slow_simhash(text)


def test_block_masks_cover_every_close_pair():
    for d, blocks in ((2, 4), (2, 16), (3, 5)):
        masks = simhash.block_masks(blocks, d)
        for bits in combinations(range(0, 64, 5), d):
            flip = sum(1 << b for b in bits)
            assert any(not (m % (1 << 64)) & flip for m in masks)


def all_pairs_groups(rows):
    links = [(a, b) for (a, x), (b, y) in combinations(rows, 2) if bin(x ^ y).count("1") <= 2]
    return {a: a for a, _ in rows} | roots(links)


@pytest.mark.parametrize("bucket", [4096, 3])
def test_close_links_equal_all_pairs_also_in_crowded_buckets(spark, bucket):
    rng, fps = random.Random(2), {0, -1}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for b in rng.sample(range(64), rng.randrange(5)):
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >> 63 else x)
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = [(r.u, r.v) for r in simhash.close_links(frame, 2, bucket).collect()]
    assert all(bin((u ^ v) % (1 << 64)).count("1") for u, v in links)
    rows = [(x, x % (1 << 64)) for x in sorted(fps)]
    assert {x: x for x in fps} | roots(links) == all_pairs_groups(rows)
    assert len(links) < 3 * 6 * len(fps)  # a spanning set in each bucket, not its pairs


def test_simhash_groups_with_copies_nulls_and_clashing_columns(spark):
    rng = random.Random(3)
    base = prose(rng, 400).split()
    near = [" ".join(base[:i] + ["zzz"] + base[i + 1:]) for i in range(0, 400, 40)]
    texts = [" ".join(base), *near, " ".join(base), None, "", "  ", prose(rng, 100), "a b", "A B"]
    ids = [*range(50, 50 + len(texts) - 2), 7, None]
    docs = with_clash(docs_of(spark, texts, ids))
    got = {r.id: (r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs).collect()}
    rows = [(i, slow_simhash(t)) for i, t in zip(ids, texts) if i is not None]
    want = all_pairs_groups(rows)
    assert {i: c for i, (_, c) in got.items() if i is not None} == want
    assert {i: f for i, (f, _) in got.items()} == dict(zip(ids, map(slow_simhash, texts)))
    assert got[None][1] == 7  # a row without id belongs to its group, but names none
    kept = simhash.keep_one(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 2
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


# decontamination ----------------------------------------------------------------------------------

def slow_hits(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        for k in range(max(1, len(v) - window + 1) if v else 0):
            g = v[k:k + window]
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def contaminated_fixture(rng):
    long_item, short = prose(rng, 25), "Two words"
    items = [(1, long_item), (2, short), (3, "ΣΑΣ'Α Único"), (4, None), (5, "..."), (10, prose(rng, 10)), (11, long_item),
             (None, prose(rng, 12)), (2, "solo")]
    v = long_item.split()
    texts = [prose(rng, 60), prose(rng, 20) + " " + " ".join(v[3:13]).upper() + "! " + prose(rng, 5),
             " ".join(v[3:12]), long_item + " " + long_item, "say TWO, words; solo two-words", "σας α único", "ΣΑΣ Α Único",
             None, "", "?!", " ".join(v[5:15]) + " " + " ".join(v[6:16])]
    return items, texts


def test_decontamination_matches_brute_force(spark):
    items, texts = contaminated_fixture(random.Random(4))
    texts += texts[1:4]
    docs = with_clash(docs_of(spark, texts))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("gram", F.lit(1)).withColumn("n", F.lit(2))
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, bench).collect()}
    known = [(i, t) for i, t in items if i is not None]
    assert got == {i: slow_hits(t, known) for i, t in enumerate(texts)}
    left = decontaminate.remove_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i in got if not got[i][1]]


def test_decontamination_only_long_items_only_short_items_and_empty_tables(spark):
    rng = random.Random(6)
    items = [(1, prose(rng, 30))]
    texts = [prose(rng, 5) + " " + items[0][1], prose(rng, 40), None]
    for bench in (items, [(1, texts[1].split()[3])], [(9, None)], []):
        frame = spark.createDataFrame(bench, "item_id long, text string")
        got = [(r.n_words, r.n_hit, list(r["items"])) for r in
               decontaminate.contamination(docs_of(spark, texts), frame).orderBy("doc_id").collect()]
        assert got == [slow_hits(t, bench) for t in texts]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, texts).limit(0), frame).count() == 0


def test_rows_of_a_fit_lie_in_blocks_and_score_as_before(monkeypatch):
    """Before, each row was an array on the driver's heap, of 8 bytes a feature, and the heap kept its size after the fit."""
    monkeypatch.setattr(linear, "BLOCK", 1000)
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 5000, rng.integers(0, 90))) for _ in range(600)]
    got = linear.flat(iter(rows), np.int32)
    assert [x.tolist() for x in got] == [x.tolist() for x in rows] and all(x.dtype == np.int32 for x in got)
    assert len({id(x.base) for x in got}) <= sum(map(len, rows)) // 1000 + 1 and linear.flat([], np.int32) == []
    ratio, more = np.where(np.arange(linear.DIM) % 7 > 0, rng.normal(size=linear.DIM), 0.0), rng.normal(size=(600, 2))
    for x, m, (ids, v) in zip(rows, more, linear.scaled_rows(ratio, got, more)):
        want = linear.scaled(ratio, x, m)
        assert ids.tolist() == want[0].tolist() and v.tolist() == want[1].tolist()


# passages -----------------------------------------------------------------------------------------

def slow_chain_score(anchors):
    anchors, best = sorted(set(anchors)), {}
    for a, b in anchors:
        prior = [s - passages.GAP_COST * (a - x + b - y) for (x, y), s in best.items() if x < a and y < b]
        best[a, b] = passages.SEED_WORTH + max([0.0, *prior])
    return max(best.values(), default=0.0)


def test_chains_find_the_best_score_and_ascend():
    rng = random.Random(8)
    for _ in range(60):
        anchors = [(rng.randrange(150), rng.randrange(150)) for _ in range(rng.randrange(2, 40))]
        found = passages.chains(anchors)
        score = lambda c: sum(passages.SEED_WORTH for _ in c) - sum(
            passages.GAP_COST * (q[0] - p[0] + q[1] - p[1]) for p, q in zip(c, c[1:]))
        for c in found:
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(c, c[1:]))
        want = slow_chain_score(anchors)
        if want > passages.SEED_WORTH:
            assert max(map(score, found)) == pytest.approx(want)


def test_common_runs_share_a_seed():
    rng = random.Random(9)
    need = passages.SEED_WINDOW + passages.SEED_WORDS - 1
    for _ in range(40):
        run = prose(rng, need)
        a, b = (passages.word_hashes(prose(rng, rng.randrange(40)) + " " + run + " " + prose(rng, rng.randrange(40))) for _ in "ab")
        assert set(passages.seeds_of(a)[1]) & set(passages.seeds_of(b)[1])
    assert len(passages.seeds_of(passages.word_hashes("too short"))[0]) == 0


def repeats_fixture(rng):
    clean = [prose(rng, 150, 5000) for _ in range(6)]
    exact, fuzzy, short = prose(rng, 60, 5000), prose(rng, 120, 5000).split(), prose(rng, 20, 5000)
    edited = [w if i % 30 else "changed" for i, w in enumerate(fuzzy)]
    texts = [clean[0], clean[1] + " " + exact, exact.upper().replace(" ", ", ") + " " + clean[2], clean[3] + " " + " ".join(fuzzy),
             " ".join(edited) + " " + clean[4], short + " " + clean[5], prose(rng, 30, 5000) + " " + short, None, "", exact]
    return texts


def test_passages_exact_fuzzy_and_clean(spark):
    texts = repeats_fixture(random.Random(10))
    docs = with_clash(docs_of(spark, texts))
    rows = passages.repeated_passages(docs.union(docs.where("doc_id = 2"))).collect()
    linked = {frozenset((r.doc_id, r.other_id)) for r in rows}
    assert linked == {frozenset(x) for x in ((1, 2), (1, 9), (2, 9), (3, 4))} - ({frozenset((2, 9))} - linked)
    for r in rows:
        assert r.doc_id > r.other_id and r.identity >= 0.8
        assert min(r.end_word - r.start_word, r.other_end - r.other_start) >= 50
    one = next(r for r in rows if (r.doc_id, r.other_id) == (2, 1))
    assert (one.start_word, one.end_word, one.other_start, one.other_end) == (0, 60, 150, 210)
    left = {r.doc_id: r for r in passages.remove_repeats(docs).collect()}
    assert passages.remove_repeats(docs).columns == docs.columns
    assert set(left) == set(range(9))  # all of document 9 is a passage of document 1
    assert left[1].text == texts[1] and left[0].text == texts[0] and left[7].text is None
    assert words(left[2].text) == words(texts[2])[60:] and left[2].n_chars == len(left[2].text)
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_passages_of_many_documents_make_few_rows(spark):
    rng = random.Random(11)
    shared, n = prose(rng, 70, 5000), 40
    texts = [prose(rng, rng.randrange(5, 60), 5000) + " " + shared + " " + prose(rng, 10, 5000) for _ in range(n)]
    rows = passages.repeated_passages(docs_of(spark, texts)).collect()
    assert {r.doc_id for r in rows} | {r.other_id for r in rows} == set(range(n))
    assert len(rows) <= 4 * n
    assert len(set(roots([(r.doc_id, r.other_id) for r in rows]).values())) == 1


def test_shared_runs_are_covered_but_for_short_ends(spark):
    rng = random.Random(12)
    pool = [prose(rng, 200, 5000).split() for _ in range(3)]
    texts = []
    for _ in range(40):  # documents share overlapping parts of the same passages
        p = rng.choice(pool)
        a = rng.randrange(140)
        texts.append(prose(rng, 30, 5000) + " " + " ".join(p[a:a + rng.randrange(55, 90)]) + " " + prose(rng, 30, 5000))
    rows = passages.repeated_passages(docs_of(spark, texts)).collect()
    covered = {}
    for r in rows:
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
        covered.setdefault(r.other_id, set()).update(range(r.other_start, r.other_end))
    runs = {}
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - 49):
            runs.setdefault(tuple(w[i:i + 50]), set()).add((d, i))
    shared = [x for at in runs.values() if len({d for d, _ in at}) > 1 for x in at]
    assert shared and {d for d, _ in shared} <= set(covered)
    inside = {(d, x) for d, i in shared for x in range(i, i + 50)}
    missed = {(d, x) for d, x in inside if x not in covered[d]}
    assert len(missed) <= 0.02 * len(inside)
    assert not any(all((d, x + k) in missed for k in range(50)) for d, x in missed)


def edited_pairs(rng):
    """Two texts each, that share 50 to 70 words, of which the second has one more or one less."""
    for n in (50, 51, 52, 55, 60, 70):
        for k in range(1, n - 1):
            for less in (0, 1)[:1 + (n > 50)]:
                passage = prose(rng, n, 50000).split()
                other = passage[:k] + ["inserted"] * (1 - less) + passage[k + less:]
                a, b = ([*prose(rng, 30, 50000).split(), *p, *prose(rng, 30, 50000).split()] for p in (passage, other))
                yield " ".join(a), " ".join(b), n, len(other)


def test_one_word_more_or_less_at_every_place(spark):
    pairs = list(edited_pairs(random.Random(44)))
    docs = docs_of(spark, [t for p in pairs for t in p[:2]])
    found = {(r.other_id, r.doc_id): r for r in passages.repeated_passages(docs).collect()}
    assert set(found) == {(2 * i, 2 * i + 1) for i in range(len(pairs))}
    for (i, _), r in found.items():
        _, _, n, m = pairs[i // 2]
        assert 50 <= r.other_end - r.other_start <= n and 50 <= r.end_word - r.start_word <= m


def test_passages_of_boilerplate_and_a_shared_tail(spark):
    rng = random.Random(43)
    common, other = prose(rng, 45, 5000), prose(rng, 45, 5000)
    tails = [prose(rng, rng.randrange(5, 16), 5000) for _ in range(20)]
    ends = tails + tails + [other, other] + [prose(rng, 12, 5000) for _ in range(60)]
    texts = [f"{prose(rng, 30, 5000)} {common} {t} {prose(rng, 30, 5000)}" for t in ends]
    texts += [f"{prose(rng, 30, 5000)} {other} {prose(rng, 30, 5000)}" for _ in range(50)]
    order = rng.sample(range(len(texts)), len(texts))
    rows = passages.repeated_passages(docs_of(spark, [texts[i] for i in order])).collect()
    linked = {frozenset((order[r.doc_id], order[r.other_id])) for r in rows}
    assert linked == {frozenset((k, k + 20)) for k in range(20)} | {frozenset((40, 41))}
    assert all(r.identity == 1 and r.end_word - r.start_word >= 50 for r in rows)


def test_repeats_stay_in_the_smallest_id_only_beside_a_shorter_quote(spark):
    rng = random.Random(41)
    whole = prose(rng, 55, 5000).split()
    lone = [prose(rng, 40, 5000) for _ in range(10)]
    texts = [f"{lone[0]} {' '.join(whole[:45])} {lone[1]}"] + [f"{lone[k]} {' '.join(whole)} {prose(rng, 30, 5000)}" for k in range(2, 10)]
    left = {r.doc_id: words(r.text) for r in passages.remove_repeats(docs_of(spark, texts, range(1, 18, 2))).collect()}
    holds = {i for i, t in left.items() if any(t[k:k + 55] == whole for k in range(len(t)))}
    assert holds == {3} and left[1] == words(texts[0])
    assert all(left[i][:40] == words(texts[(i - 1) // 2])[:40] and len(left[i]) == 70 for i in range(5, 18, 2))


def test_unlike_places_of_a_class_take_few_rounds(spark, monkeypatch):
    """Before, each round aligned the places of a class with one only, so a class of n unlike places took n rounds of jobs."""
    rng = random.Random(17)
    kinds = [prose(rng, 60) for _ in range(9)]
    texts = [f"{prose(rng, 9)} {kinds[i % 9]} {prose(rng, 9)}" + (f" {kinds[(i + 4) % 9]}" if i % 5 == 0 else "") for i in range(30)]
    places = spark.createDataFrame([(i % 2, i, 5, len(t.split()) - 2) for i, t in enumerate(texts)], "class long, doc_id long, lo long, hi long")
    cuts, rounds, real = [], [], passages.saved
    monkeypatch.setattr(passages, "saved", lambda d, name: rounds.append(name) or real(d, name))
    for heads, block in ((1, 256), (4, 8), (32, 256)):
        monkeypatch.setattr(passages, "HEADS", heads)
        monkeypatch.setattr(passages, "BLOCK_PLACES", block)
        rounds.clear()
        cuts.append((sorted(map(tuple, passages.class_cuts(docs_of(spark, texts), places).collect())), rounds.count("open")))
    assert cuts[0][0] == cuts[1][0] == cuts[2][0] and {d for d, _, _ in cuts[0][0]} >= set(range(18, 30))
    assert cuts[2][1] <= 2 < cuts[1][1] < cuts[0][1]


def test_open_places_of_two_passages_in_one_class_are_each_compared(spark):
    rng = random.Random(42)
    one, two = prose(rng, 60, 5000), prose(rng, 60, 5000)
    texts = [prose(rng, 20, 5000) + " " + t for t in (one, two, one, two)]
    rows = [(7, k, 20, 80) for k in range(4)]
    places = spark.createDataFrame(rows, "class long, doc_id long, lo long, hi long")
    cuts = passages.class_cuts(docs_of(spark, texts), places).collect()
    assert sorted(map(tuple, cuts)) == [(2, 20, 80), (3, 20, 80)]


def test_cut():
    assert passages.cut("a, b c. d", [(1, 3)]) == "a, . d"
    assert passages.cut("a b", [(0, 1), (1, 2)]) is None
    assert passages.cut("...", []) is None or passages.cut("...", []) == "..."


# linear models: quality and toxicity ----------------------------------------------------------------

def test_distinct_and_grams():
    ids = np.array([5, 1, 5, 2, 1])
    assert sorted(linear.distinct(ids)) == [1, 2, 5]
    assert len(linear.style_grams("")) == len(linear.word_grams(" \n")) == 0
    assert len(linear.style_grams("one")) == 2
    assert max(linear.style_grams("a B c! 12 " * 50)) < linear.DIM


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [(np.arange(4), v) for v in x]
    w = linear.dual_descent(rows, y, 4, epochs=2000)
    loss = lambda w: 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()
    assert all(loss(w) <= loss(w + 1e-2 * rng.normal(size=4)) for _ in range(200))


def labelled_fixture(spark, n=600):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(n):
        bad, rude = i % 4 == 0, i % 5 == 0
        text = prose(rng, 40)
        if bad:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if rude:
            text += " you idiot" if i % 2 else " pathetic Trash"
        rows.append((i, text))
        labels.append((i, int(not bad), int(rude)))
    labels += [(None, 1, 1), (1, None, None), (10 ** 9, 0, 1)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def test_quality_on_held_out_rows_and_odd_rows(spark):
    rows, labels = labelled_fixture(spark)
    docs = with_clash(docs_of(spark, [t for _, t in rows] + [None, "", "x"], [*range(len(rows)), 5000, None, 3]))
    model = quality.fit_quality(docs, labels)
    got = docs.select("doc_id", quality.quality_score(model, docs).alias("s"), linear.held_out(F.col("doc_id")).alias("o")).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.s <= 1 for r in got)
    test = [r for r in got if r.o and r.doc_id is not None and r.doc_id < len(rows)]
    assert len(test) > 80 and all((r.s >= 0.7) == (r.doc_id % 4 != 0) for r in test)
    kept = quality.reject_low_quality(docs, labels)
    assert kept.columns == docs.columns
    none = quality.fit_quality(docs, labels.limit(0))
    assert {r[0] for r in docs.select(quality.quality_score(none, docs)).collect()} == {0.5}
    assert quality.reject_low_quality(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_never_learnt(spark):
    rows, labels = labelled_fixture(spark, 200)
    docs = docs_of(spark, [t for _, t in rows])
    wrong = labels.withColumn("quality", F.when(linear.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, wrong)
    assert np.array_equal(a.w, b.w) and a.slope == b.slope


def test_toxicity_chain(spark):
    rows, labels = labelled_fixture(spark)
    docs = docs_of(spark, [t for _, t in rows] + [None, ""])
    targets = [*toxicity.CATEGORIES, "toxic"]
    label = F.when(F.col("toxic").isNotNull(), (F.col("toxic") > 0).cast("long"))
    train = toxicity.category_labels(linear.labelled(docs, labels, {"toxic": label}))
    assert {c for c in toxicity.CATEGORIES if train.where(f"{c} = 1").count()} == {"insult", "contempt", "abuse"}
    models = toxicity.fit_chain(train, targets)
    assert [len(m.w) - linear.DIM - 1 for m in models] == [0, 1, 2, 3]  # earlier probabilities go into later models
    got = docs.select("doc_id", toxicity.chain_scores(models, targets, docs).alias("p"), linear.held_out(F.col("doc_id")).alias("o"))
    test = [r for r in got.collect() if r.o and r.doc_id < len(rows)]
    assert all((r.p.toxic >= 0.5) == (r.doc_id % 5 == 0) for r in test)
    empty = toxicity.fit_chain(train.limit(0), targets)
    assert docs.select(toxicity.chain_scores(empty, targets, docs).alias("p")).where("p.toxic = 0.5").count() == len(rows) + 2


# language -----------------------------------------------------------------------------------------

def slow_phrases(sample, text):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_cross_parsing_counts_longest_phrases():
    rng = random.Random(14)
    sample = "".join(rng.choice("abcd ") for _ in range(300))
    parser = language.CrossParser({"x": sample, "y": "zzz"})
    for _ in range(20):
        text = "".join(rng.choice("abcd e") for _ in range(rng.randrange(1, 250)))
        flat = re.sub(" +", " ", text)
        got = parser.bits([text])[0, 0] / parser.cost[0] * len(parser.encode(text))
        assert round(got) == slow_phrases(re.sub(" +", " ", sample), flat)


def test_languages_and_odd_texts(spark):
    rng = random.Random(15)
    make = lambda s, n: " ".join("".join(rng.choice(s) for _ in range(rng.randrange(2, 7))) for _ in range(n))
    rows = [(i, make("abcde" if i % 2 else "fghia", 40), "l1" if i % 2 else "l2") for i in range(120)]
    rows += [(200, None, "l1"), (201, "123 !", "l1"), (202, "", None), (None, make("abcde", 400), None), (203, "中文", None)]
    docs = with_clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    samples = language.training_sample(docs)
    assert set(samples) == {"l1", "l2"}
    got = {r.doc_id: r.p for r in docs.select("doc_id", language.detect(docs, samples).alias("p")).collect()}
    assert all(got[i].lang == ("l1" if i % 2 else "l2") and 0 < got[i].score <= 1 for i in range(120))
    assert [got[i].lang for i in (200, 201, 202, None)] == ["und", "und", "und", "l1"]
    assert got[203].lang in samples and got[200].score == 0
    assert {r.p.lang for r in docs.select(language.detect(docs, {}).alias("p")).collect()} == {"und"}
    assert language.training_sample(docs.limit(0)) == {}


# chat ---------------------------------------------------------------------------------------------

CONVS = "conv_id long, turn long, role string, text string"


def test_formatting_reads_back_and_masks_assistant_texts(spark):
    nasty = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty + "\\"), (2, 1, "assistant", "\\|<\\|\n"), (2, 0, "system", None),
            (3, None, "assistant", ""), (3, 5, None, "x"), (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"),
            (4, 0, "ro\nle<|", "é🙂"), (None, 0, "assistant", "lost")]
    got = {r.conv_id: r for r in chat.format_chats(with_clash(spark.createDataFrame(rows, CONVS))).collect()}
    order = sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, r in got.items():
        turns = [(role or "", text or "") for c, _, role, text in order if c == conv]
        assert chat.parse_marked(r.formatted) == turns and list(r.rewrites) == []
        assert [r.formatted[s.start:s.end] for s in r.spans] == [chat.marked_turns([t]) for t in turns]
        assert "".join(chat.unescape(r.formatted[s.start:s.end]) for s in r.loss) == "".join(t for x, t in turns if x == "assistant")
    assert chat.format_chats(spark.createDataFrame([], CONVS)).count() == 0


def test_templates_that_rewrite_history_are_found():
    def forgetful(turns):  # shows only the last assistant text in full
        last = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=-1)
        return "".join(f"[{r}]{t if r != 'assistant' or i == last else '...'}\n" for i, (r, t) in enumerate(turns))
    turns = [("user", "a"), ("assistant", "bbb"), ("user", "c"), ("assistant", "ddd")]
    got = chat.format_conversation(turns, forgetful, "assistant")
    assert got["rewrites"] == [3]
    last = got["loss"][-1]
    assert got["formatted"][last["start"]:last["end"]] == "ddd"
    assert chat.format_conversation([], forgetful, "assistant")["formatted"] == ""


# top-k --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("spread", [3, 200])
def test_topk_equals_brute_force(spark, spread):
    rng = np.random.default_rng(spread)
    vectors = {int(i): rng.integers(-spread, spread + 1, 8).tolist() for i in rng.permutation(300)}
    vectors[300], vectors[301], vectors[302] = [0] * 8, [], [1, 2]
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, v array<long>")
    queries = frame.where("vec_id % 20 = 0 or vec_id > 299")
    got = {}
    for r in topk.top_inner_products(frame, queries, 5, block_rows=64, block_queries=4).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (-r.score, r.vec_id)
    for q, best in got.items():
        dot = lambda a, b: sum(x * y for x, y in zip(a, b))
        want = sorted((-dot(vectors[q], v), i) for i, v in vectors.items() if i != q)[:5]
        assert [best[k] for k in sorted(best)] == want
    assert len(got) == queries.count()


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 23])
def test_topk_of_a_block_answers_many_queries_by_one_product_a_depth(scale, monkeypatch):
    """Before, each query read the lists by itself; sums are exact in single or double precision, else in 64-bit integers."""
    rng = np.random.default_rng(scale)
    vectors = rng.integers(-60, 61, (400, 16)) * scale
    vectors[50:60], vectors[60] = vectors[7], 0
    ids = rng.permutation(400).astype(np.int64)
    lists, asked, bounds = topk.SortedLists(ids, vectors), [], topk.SortedLists._bounds
    monkeypatch.setattr(topk.SortedLists, "_bounds", lambda *a: asked.append(a[3]) or bounds(*a))
    got = lists.top(vectors[:80], ids[:80], 5)
    for q, own, best in zip(vectors[:80], ids[:80], got):
        assert best == [(-s, i) for s, i in sorted((-int(v @ q), int(i)) for v, i in zip(vectors, ids) if i != own)[:5]]
    assert len(asked) <= len(topk.DEPTHS) and set(asked) == {1: {np.float32}, 1 << 12: {np.float64}}.get(scale, set())


def test_integer_vectors_leave_out_broken_rows(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("inf")]), (None, [1.0]),
            (6, [1.0, 2.0]), (6, [1.0, 2.0]), (6, [0.0, 2.0]), (7, [1e30])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = {r.vec_id: list(r.v) for r in topk.integer_vectors(frame).collect()}
    assert got == {1: [128, -1], 6: [0, 512]}
    two = topk.integer_vectors(frame)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_inner_products(two, two.where("vec_id = 6")).collect()] == [
        (6, 1, 1, -512)]
    assert topk.top_inner_products(two.limit(0), two.limit(0)).count() == 0


# pieces -------------------------------------------------------------------------------------------

def proto_bytes():
    return open(pieces.MODEL, "rb").read()


TEXTS = ["", " ", "Hello  world", "é🙂中\n\t x", "▁a ▁", "<s> </s>", "a" * 300, " lead and trail ", "́x", "tab\tend"]


def test_ids_spans_and_decoding(spark):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    docs = with_clash(docs_of(spark, [*TEXTS, None, TEXTS[2]], [*range(len(TEXTS)), None, 2]))
    got = pieces.encode_pieces(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r.id] if r.id is not None else ""
        assert list(r.ids) == lib.encode(text) and r.decoded == lib.decode(lib.encode(text))
        raw, ends = text.encode(), list(r.ends)
        assert ends == sorted(ends) and (ends[-1] if ends else 0) == len(raw)
        want = [p.end for p in lib.encode(text, return_type="proto").pieces]
        kinds = [lib.is_byte(i) for i in r.ids]
        assert [e for e, k in zip(ends, kinds) if not k] == [e for e, k in zip(want, kinds) if not k]
    assert pieces.encode_pieces(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_equals_the_library_for_compiled_maps(rule):
    import sentencepiece
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, escape_whitespaces=True, add_dummy_prefix=True,
                                                remove_extra_whitespaces=True)
    spec = pieces.model_pb2.ModelProto.FromString(proto_bytes())
    spec.normalizer_spec.ParseFromString(pieces.model_pb2.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec.SerializeToString())
    coder = pieces.PieceCodec(spec.SerializeToString())
    rng = random.Random(16)
    odd = ["ﬁne  ㌕ x", "  Ⅻ ①  ", "ＡＢＣ ｶﾞ", "é Å", "   ", "a 　b", "ÀÉ ß"]
    odd += ["".join(rng.choice("aé ﬁ㌕Ａ①́　中🙂") for _ in range(30)) for _ in range(30)]
    for text in odd:
        out, align = coder._rewrite(text.encode())
        assert out.decode() == lib.normalize(text), text
        want, offsets = lib.normalize(text, with_offsets=True)
        starts = [len(out.decode()[:i].encode()) for i in range(len(want))]
        assert [len(text.encode()[:align[s]].decode()) for s in starts] == list(offsets)[:len(want)]


# licences -----------------------------------------------------------------------------------------

def slow_licenses(text, rules):
    w = words(text)
    norm = " " + " ".join(w) + " "
    found = set()
    for i, r in enumerate(rules):
        for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", norm):
            start = norm[:m.start()].count(" ") - 1
            found.add((i, start, start + len(m[0].split())))
    kept = []
    for i, a, b in found:
        inside = any(c <= a and d >= b and rules[j].priority >= rules[i].priority and (
            (c, d) != (a, b) or (-rules[j].priority, j) < (-rules[i].priority, i)) for j, c, d in found if (j, c, d) != (i, a, b))
        if rules[i].base or not inside:
            kept.append((i, a, b))
    base = [a for i, a, _ in kept if rules[i].base]
    join = lambda x: ",".join(sorted(set(x)))
    return (len(w), len(base), min(base, default=None), max(base, default=None),
            join(rules[i].label for i, _, _ in kept if rules[i].base), join(rules[i].label for i, _, _ in kept),
            max([0.0, *(rules[i].weight for i, _, _ in kept)]))


def test_license_scan_matches_brute_force(spark):
    rng = random.Random(17)
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "CC BY-NC 4.0", "cc-by cc_by CC BY",
             "This work is licensed under the GNU General Public License, version 3.", "All Rights Reserved", "all rights\nreserved.",
             "SPDX-License-Identifier: BSD-3-Clause", "© Copyright 2019 2020 X", "the GNU Lesser General Public License v2.1",
             "dedicated to the public domain", "Permission is hereby granted, free of charge, to any person", "some rights reserved",
             "Creative Commons Attribution-ShareAlike 3.0", "licence", "gpl v3", "mit", "accbyte occ by"]
    texts = [*lines, None, "", "!!"]
    texts += [" ".join(rng.choice([prose(rng, 3), rng.choice(lines)]) for _ in range(rng.randrange(2, 12))) for _ in range(60)]
    rules = licenses.license_rules()
    assert len(rules) > 300
    docs = with_clash(docs_of(spark, texts + texts[:5]))
    got = {r.doc_id: tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
           for r in licenses.scan_licenses(docs).collect()}
    assert got == {i: slow_licenses(t, rules) for i, t in enumerate(texts + texts[:5])}
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_equal_spans_keep_the_higher_priority_and_native_plans_have_no_python(spark):
    rules = [licenses.Rule("low", " x ", "x y", 1, 0.1), licenses.Rule("high", " x ", "x y", 2, 0.2),
             licenses.Rule("long", " x ", "x y z", 1, 0.3), licenses.Rule("in", " x ", "y z", 1, 0.4)]
    got = licenses.scan_licenses(docs_of(spark, ["x y z", "x y"]), rules).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["high,long", "high"]
    plan = licenses.detections(docs_of(spark, ["x"]), rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_query_digests(spark):
    out = pieces.piece_digests(docs_of(spark, ["Hello"])).first()
    ids = ",".join(map(str, pieces.codec(proto_bytes()).encode("Hello")[0]))
    assert out.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert out.decoded_sha256 == hashlib.sha256(b"Hello").hexdigest()
