"""MinHash near-duplicates: chosen-path trees over minwise tokens, exact checks in small nodes, components."""

from __future__ import annotations

from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, read_table, saved, sized, text_key
from tessera.llm.components import connected_components

#: Words of a shingle, and the similarity of a link in percent.
SHINGLE, PERCENT = 3, 85
#: Minwise tokens of a set.
TOKENS = 64
#: Trees of each round.  A round begins with the components of the rounds before and skips nodes that lie in one.
TREES = (2, 8)
#: Members of a pivot's group, on average at most.
LOT = 64
#: Members of a node that are compared with each other; a larger node branches on.
LEAF = 512
#: A node of so many members is compared, too, if their sets have so many items together.
LARGE_LEAF, LEAF_ITEMS = 2048, 1 << 21
#: A node's branching factor, in percent of one: below the similarity, so that a similar pair's chance to stay together doesn't fade with depth.
BRANCH = 75
#: Levels that a large node's rows go down at once: as many as halve it to a leaf, so many at most.
STEPS = 6
#: Two sets are compared exactly if their tokens don't speak against it: four deviations below the similarity.
DEVIATIONS = 4.0

_MIX, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words, A-Z lowered; fewer words are one run, none give none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.full(max(1, len(h) - k + 1), min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        out = (out ^ h[i:i + len(out)]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out * _FOLD)


def _permutations(tokens: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 31, (tokens, 1), np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, (tokens, 1), np.uint32)


def minwise(items: np.ndarray, perms: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of the set under each permutation."""
    a, b = perms
    x = (items >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        h = a * x[i:i + 4096] + b
        out = np.minimum(out, (h ^ (h >> np.uint32(15))).min(axis=1))
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, tokens: int) -> DataFrame:
    """(doc_id, text_key, key, n, tokens) of every row: a digest of the set (NULL if empty), its size, its minwise tokens."""
    perms = _permutations(tokens)

    def run(batches):
        for batch in batches:
            n, keys, mins = [], [], []
            for text in batch.column(2).cast(pa.binary()):
                items = shingle_set(text.as_py(), shingle)
                n.append(len(items))
                keys.append(blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                mins.append(minwise(items, perms).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(mins, pa.binary())], ["doc_id", "text_key", "key", "n", "tokens"])
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long"), text_key(text), text).toDF("doc_id", "text_key", "text")
    return rows.mapInArrow(run, "doc_id long, text_key binary, key binary, n long, tokens binary")


def branches(nodes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of the children that each row chooses in its node.

    Below the root a node picks each token place with a chance of 100 / (BRANCH
    * places), so a similar pair is expected to stay together in more than one
    child; the child is named by the node, the place and the token there.
    """
    places = tokens.shape[1]
    draw = (nodes[:, None] + np.arange(1, places + 1, dtype=np.uint64) * _MIX) * _FOLD
    draw = (draw ^ (draw >> np.uint64(31))) * _MIX
    row, place = np.nonzero(draw >> np.uint64(32) < np.uint64(int((1 << 32) * 100 / (BRANCH * places))))
    child = (draw[row, place] ^ tokens[row, place].astype(np.uint64)) * _FOLD
    return row, (child ^ (child >> np.uint64(29))) * _MIX


def first_nodes(sets: DataFrame, trees: list[int]) -> DataFrame:
    """(node, key, label, n): every set in its child of each tree's root, which names the token at the tree's own place."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.stack([np.frombuffer(t, np.uint32) for t in batch.column(3).to_pylist()])
            for tree in trees:
                child = (tokens[:, 37 * tree % tokens.shape[1]] + (np.uint64(tree + 1) << np.uint64(32))) * _FOLD
                child = (child ^ (child >> np.uint64(29))) * _MIX
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *batch.columns[:3]], ["node", "key", "label", "n"])
    return sets.select("key", "label", "n", "tokens").mapInArrow(run, "node long, key binary, label long, n long")


def next_nodes(rows: DataFrame) -> DataFrame:
    """(node, key, label, n): the nodes that the rows of (node, steps, key, label, n, tokens) choose so many levels below theirs."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.stack([np.frombuffer(t, np.uint32) for t in batch.column(5).to_pylist()])
            nodes, steps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            nodes, at = nodes.view(np.uint64), np.arange(len(nodes))
            for step in range(1, STEPS + 1):
                row, nodes = branches(nodes, tokens[at])
                at = at[row]
                there = steps[at] == step
                take = pa.array(at[there])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[there].view(np.int64)), *(batch.column(i).take(take) for i in (2, 3, 4))],
                                                 ["node", "key", "label", "n"])
                nodes, at = nodes[~there], at[~there]
    return rows.select("node", "steps", "key", "label", "n", "tokens").mapInArrow(run, "node long, key binary, label long, n long")


def crowded(rows: DataFrame) -> DataFrame:
    """``rows`` of (node, key, label, n) with ``size``, the node's members, and ``leaf``, whether they are compared whole.

    Nodes whose members are known to be connected are left out.  The sizes are
    combined before the shuffle and written, so that the join back is a plain
    one, of which AQE splits a large node's part.
    """
    rows = saved(rows, "paths")
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("items"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    leaf = (F.col("size") <= LEAF) | (F.col("size") <= LARGE_LEAF) & (F.col("items") <= LEAF_ITEMS)
    sizes = saved(sizes.where("lo <> hi").select("node", "size", leaf.alias("leaf")), "sizes")
    out = saved(rows.join(sizes, "node"), "nodes")
    discard(rows)
    discard(sizes)
    return out


def with_tokens(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The saved ``nodes`` with each member's tokens; few rows go to the sets, not the sets to them."""
    return sets.select("key", "tokens").join(sized(nodes, 96), "key")


def with_marks(nodes: DataFrame, sets: DataFrame, tokens: int) -> DataFrame:
    """As :func:`with_tokens`, with the last byte of each token as ``marks``, a quarter of the size.

    Equal tokens have equal marks, so a comparison by marks finds whatever one
    by tokens does; what it finds beside that fails on the whole sets.  ``tried``
    is kept, if the sets have it.
    """
    marks = F.concat(*[F.substring("tokens", 4 * i + 1, 1) for i in range(tokens)])
    tried = [c for c in ("tried",) if c in sets.columns]
    return sets.select("key", marks.alias("marks"), *tried).join(sized(nodes, 96), "key")


def may_link(tokens: np.ndarray, sizes: np.ndarray, one: int, percent: int) -> np.ndarray:
    """Which sets have a size and minwise tokens (or marks) that don't speak against a link with set ``one``."""
    places, share = tokens.shape[1], percent / 100
    least = share * places - DEVIATIONS * (share * (1 - share) * places) ** 0.5
    fit = 100 * np.minimum(sizes, sizes[one]) >= percent * np.maximum(sizes, sizes[one])
    return fit & ((tokens == tokens[one]).sum(axis=1) >= least)


def spanning_links(items: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect the sets of distinct items exactly as all similar pairs would.

    Similar is 100 * intersection >= percent * union.  A set's intersections
    with all others are counted at once, over the members that hold its items;
    sets that are connected already make no further link.
    """
    sizes, root, out = np.array([len(x) for x in items]), np.arange(len(items)), []
    owner = np.repeat(np.arange(len(items)), sizes)
    _, item = np.unique(np.concatenate(items), return_inverse=True)
    order = np.argsort(item, kind="stable")
    holders, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(item))])
    ends = np.cumsum(sizes)
    for i in range(len(items) - 1):
        if (root == root[0]).all():
            break
        own = item[ends[i] - sizes[i]:ends[i]]
        lengths = first[own + 1] - first[own]
        at = np.arange(lengths.sum()) + np.repeat(first[own] - np.cumsum(lengths) + lengths, lengths)
        common = np.bincount(holders[at], minlength=len(items))
        close = (100 * common >= percent * (sizes + sizes[i] - common)) & (root != root[i])
        for j in np.flatnonzero(close).tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def leaf_groups(small: DataFrame, percent: int) -> DataFrame:
    """(group, key): of each leaf the members that may be similar to one of another label, by connected groups.

    All members of a node are compared with each other, by size and marks.  Two
    that share a group of ``tried``, those of earlier rounds, were compared whole
    there; if their labels still differ they aren't similar.  The same group
    found in several nodes comes once.
    """
    member = F.struct("key", "label", "n", "marks", *(c for c in ("tried",) if c in small.columns))
    nodes = small.groupBy("node").agg(F.collect_list(member).alias("members"))  # LARGE_LEAF at most

    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column(0).to_pylist():
                tokens = np.stack([np.frombuffer(m["marks"], np.uint8) for m in members])
                sizes, up = np.array([m["n"] for m in members]), list(range(len(members)))
                tried = [set(m.get("tried") or ()) for m in members]
                for i in range(len(members)):
                    for j in np.flatnonzero(may_link(tokens, sizes, i, percent)).tolist():
                        if j > i and members[i]["label"] != members[j]["label"] and tried[i].isdisjoint(tried[j]):
                            a, b = i, j
                            while up[a] != a:
                                a = up[a]
                            while up[b] != b:
                                b = up[b]
                            up[max(a, b)] = min(a, b)
                groups: dict[int, list[bytes]] = defaultdict(list)
                for i in range(len(members)):
                    a = i
                    while up[a] != a:
                        a = up[a]
                    groups[a].append(members[i]["key"])
                out += [sorted(g) for g in groups.values() if len(g) > 1]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.binary()))], ["keys"])
    found = nodes.select("members").mapInArrow(run, "keys array<binary>").distinct()
    return found.select(F.xxhash64("keys").alias("group"), F.explode("keys").alias("key"))


def set_rows(docs: DataFrame, sets: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(key, items) of the wanted keys: the whole sets, built again from one text each.

    Only if rows repeat an id with its text, which the counts tell, are the sets shuffled to drop the repeats.
    """
    one = saved(sets.join(wanted, "key").select("key", "one.doc_id", "one.text_key"), "chosen")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long"), text_key(text), text).toDF("id", "tk", "text")
    same = (F.col("tk") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id"))
    rows = texts.join(sized(one, 128), same).select("key", "text")  # no text moves where the keys are few

    def run(batches):
        for batch in batches:
            items = [shingle_set(t.as_py(), shingle).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], ["key", "items"])
    out = saved(rows.mapInArrow(run, "key binary, items binary"), "sets")
    if out.count() > one.count():
        repeated, out = out, saved(out.dropDuplicates(["key"]), "sets")
        discard(repeated)
    discard(one)
    return out


def confirmed(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) links among the members of each of the saved ``groups``: a spanning set of all pairs whose whole sets are similar."""
    rows = sets.join(sized(groups, 96), "key").groupBy("group").agg(F.collect_list(F.struct("key", "items")).alias("members"))

    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column(0).to_pylist():
                links = spanning_links([np.frombuffer(m["items"], np.uint64) for m in members], percent)
                out += [(members[i]["key"], members[j]["key"]) for i, j in links]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["u", "v"])
    return rows.select("members").mapInArrow(run, "u binary, v binary")


def pivot_groups(large: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """(group, key): each large node's pivot, with the members of another label that may be similar to it in lots."""
    rows = large.join(pivots, "node").where(F.col("label") != F.col("p_label")).select(
        "node", "size", "key", "n", "tokens", "p_key", "p_n", "p_tokens")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n, pn = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 6))
            own, other = (np.stack([np.frombuffer(t, np.uint32) for t in batch.column(i).to_pylist()]) for i in (4, 7))
            share, places = percent / 100, own.shape[1]
            least = share * places - DEVIATIONS * (share * (1 - share) * places) ** 0.5
            fit = (100 * np.minimum(n, pn) >= percent * np.maximum(n, pn)) & ((own == other).sum(axis=1) >= least)
            at = pa.array(np.flatnonzero(fit))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(at) for i in (0, 1, 5, 2)], ["node", "size", "p_key", "key"])
    near = rows.mapInArrow(run, "node long, size long, p_key binary, key binary")
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / LOT))  # the node's size bounds the number of its lots' members
    lots = near.groupBy("node", "p_key", part.alias("part")).agg(F.collect_list("key").alias("keys"))
    return lots.select(F.xxhash64("node", "part").alias("group"), F.explode(F.concat(F.array("p_key"), "keys")).alias("key"))


def round_links(docs: DataFrame, sets: DataFrame, trees: list[int], percent: int, id_col: str, text_col: str,
                shingle: int, tokens: int = TOKENS, tried: list[DataFrame] | None = None) -> list[DataFrame]:
    """Tables of (u, v) links that some trees find between sets of different labels.

    The (group, key) tables of what was compared whole are added to ``tried``, or deleted without it.
    """
    nodes, out, known, whole = crowded(first_nodes(sets.withColumn("label", F.xxhash64("label")), trees)), [], None, []
    while not nodes.isEmpty():
        groups, crowd = leaf_groups(with_marks(nodes.where("leaf"), sets, tokens), percent), nodes.where("not leaf")
        large = None if crowd.isEmpty() else with_tokens(crowd, sets)
        if large is not None:
            chosen = F.min_by(F.struct("key", "label", "n", "tokens"), F.xxhash64("node", "key"))
            pivots = large.groupBy("node").agg(chosen.alias("p"))
            pivots = saved(pivots.select("node", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("key", "label", "n", "tokens")]), "pivots")
            groups = groups.union(pivot_groups(large, pivots, percent))
        groups, links = saved(groups, "groups"), None
        if not groups.isEmpty():
            wanted = groups.select("key").distinct()  # sets that an earlier level has built are read again
            wanted = wanted if known is None else wanted.join(known.select("key"), "key", "left_anti")
            more = set_rows(docs, sets, wanted, id_col, text_col, shingle)
            whole.append(more)
            known = more if known is None else known.union(more)
            links = saved(confirmed(groups, known, percent), "links")
            out.append(links)
        if tried is None:
            discard(groups)
        else:
            tried.append(groups)
        if large is None:
            break
        rest = large.join(pivots.select("node", "p_key", "p_label"), "node").where(F.col("key") != F.col("p_key"))
        if links is not None:  # what is linked to its node's pivot takes the pivot's label
            linked = links.union(links.select("v", "u")).distinct().toDF("p_key", "key").withColumn("near", F.lit(True))
            rest = rest.join(linked, ["p_key", "key"], "left").withColumn(
                "label", F.when(F.col("near"), F.col("p_label")).otherwise(F.col("label")))
        steps = F.least(F.lit(STEPS), F.greatest(F.lit(1), F.ceil(F.log2(F.col("size") / LEAF)).cast("int")))
        below = crowded(next_nodes(rest.withColumn("steps", steps)))
        for used in (nodes, pivots):
            discard(used)
        nodes = below
    for used in (nodes, *whole):
        discard(used)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, trees: tuple[int, ...] = TREES, tokens: int = TOKENS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: components of texts whose shingle sets are similar.

    Equal sets become one node first.  In each tree a set joins the children
    that its node's chosen minwise tokens name.  Nodes of at most LEAF sets
    are compared whole, by size and tokens, and what may be similar is checked
    on the whole sets.  In a larger node one set, the pivot, is compared with
    all others and leaves it; the node branches on, and children whose sets are
    known to be connected end there.  So a large group of near copies costs one
    comparison a member, and no pairs of a group are listed.

    The trees are independent.  One keeps a pair of just the least similarity
    together with a chance of 0.85 below the root, 0.6 two, 0.4 four and 0.3
    eight levels down.  So ten trees miss a pair that meets in leaves below the
    roots, where nearly all do, with a chance below 1e-8, one that meets two
    levels down only with 1e-4, and with 0.03 one of which all common tokens are so
    frequent that it meets eight levels down only.  Every link is confirmed on the whole sets.

    NULL and empty texts have an empty set, size 0, and link with nothing.
    Words are what lies between ASCII white space, A-Z lowered; a text of fewer
    words than a shingle is one shingle.  Rows that repeat an id each count by
    their own text; a row without id links like others and never names a
    component unless none of its rows has an id.  An empty table gives an empty
    result.  A very long text's set is held whole by its task.
    """
    signed = saved(signatures(docs, id_col, text_col, shingle, tokens), "signatures")
    sets = signed.where("key is not null").groupBy("key").agg(F.min("n").alias("n"), F.min("tokens").alias("tokens"),
                                                              F.min(F.struct("doc_id", "text_key")).alias("one"))
    sets, found, tried, first = saved(sets.withColumn("label", F.col("key")), "distinct-sets"), [], [], 0
    roots = None
    for n in trees:
        found += round_links(docs, sets, list(range(first, first + n)), percent, id_col, text_col, shingle, tokens, tried)
        first += n
        if not found:
            continue
        links = found[0]
        for more in found[1:]:
            links = links.union(more)
        roots = saved(connected_components(links), "roots")
        if first < sum(trees):
            groups = tried[0]
            for more in tried[1:]:
                groups = groups.union(more)
            of_key = saved(groups.groupBy("key").agg(F.collect_set("group").alias("tried")), "tried")
            labelled = sets.drop("label", "tried").join(sized(roots, 128).withColumnRenamed("node", "key"), "key", "left")
            labelled = labelled.join(sized(of_key, 128), "key", "left")
            new = saved(labelled.select("key", "n", "tokens", "one", F.coalesce("root", "key").alias("label"), "tried"), "distinct-sets")
            discard(of_key)
            discard(sets)
            sets = new
    rows = signed.select("doc_id", "n", "key")
    low = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    if roots is not None:
        low = low.join(roots.withColumnRenamed("node", "key"), "key", "left")
    else:
        low = low.withColumn("root", F.lit(None).cast("binary"))
    low = saved(low.select("key", "low", F.coalesce("root", "key").alias("root")), "lows")
    least = low.groupBy("root").agg(F.min("low").alias("component_id"))
    named = saved(low.join(least, "root").select("key", "component_id"), "named")
    out = rows.join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
