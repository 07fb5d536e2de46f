"""MinHash near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets are one class. In each of TREES independent trees
a class walks down by its minwise shingle of that tree and level, so documents of
similarity s stay together with probability s at each level. A node of few classes
is compared exhaustively by sketches; a larger one is branched further. Every pair
that a sketch lets through is confirmed on the full sets of both texts.

Large groups of near copies are not expanded to all pairs. In a node, sketches give a
forest of candidates, a row for each class and not for each pair; the trees of all
nodes join to clusters, which hold every candidate pair. Each class is first tried
against its nearest candidate, which links most of a group in one row each. After
that only pairs in different components still count: in each cluster the classes
outside its main component are compared with all of the cluster, in blocks and on
the full sets. A node that is still large at the last level is a cluster whole. Pairs
within a component can add no link between components, so the components are those
of all links.

Defined cases: null and empty texts have an empty set and stand alone; a null id has
component null and is kept; a row that repeats an id must repeat its text and shares
its verdict; other columns are ignored by near_duplicates() and kept by keep_first();
an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

WORDS, SIMILARITY = 5, 80
#: Independent trees, and minwise tokens on a path of each.
TREES, LEVELS = 16, 6
#: Tokens that the nodes of each step have in common: a large node is branched by one or two more.
#: A pair of similarity 0.8 shares a node of 3 tokens in some tree but for one in 10**5 pairs, of 4
#: but for 2 in 10**4, of 5 but for 2 in 1000 and of 6 but for 8 in 1000.
DEPTHS = (1, 3, 4, 5, 6)
#: Share of pairs that may have no node in common at the last step; thresholds below that are refused.
MISSED = 0.01
#: Classes in a node that are compared exhaustively, classes in a side of a block, and columns
#: (shingles) of a block that are counted at once.
LIMIT, BLOCK, COLUMNS = 512, 256, 8192
#: Shingles in a side of a block, and shingles of a block that are sorted at once.
BLOCK_SHINGLES, RANGE_SHINGLES = 1 << 20, 1 << 19
#: Sketches (a byte of each minwise value) that agree in so many standard deviations less than the
#: threshold are no candidates.
SKETCH_DEVIATIONS = 5
#: Pairs that one copy of a pivot's text is sent for.
PIVOT_ROWS = 500
CACHE_WORDS = 250_000
FACTORS = np.random.default_rng(20240229).integers(1, 1 << 63, TREES * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = np.random.default_rng(20240301).integers(1, 1 << 63, TREES * LEVELS, dtype=np.uint64)
PRIME = np.uint64(0x9E3779B97F4A7C15)

_words: dict[bytes, int] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """The distinct k-word shingles of each text as sorted 64-bit hashes; A-Z count as lower case."""
    common.hold("chosen_path", _words.clear)
    split = [t.lower().split() for t in texts]
    missing = set(chain.from_iterable(split)) - _words.keys()
    if len(_words) + len(missing) > CACHE_WORDS:
        _words.clear()
        missing = set(chain.from_iterable(split))
    _words.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
    out = []
    for words in split:
        if len(words) < k:
            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))] if words else [], np.uint64))
            continue
        w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        h = w[: len(w) - k + 1].copy()
        for j in range(1, k):
            h *= PRIME
            h += w[j : len(w) - k + 1 + j]
        out.append(np.unique(mix(h)))
    return out


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the TREES * LEVELS functions over a set, as 32 bits."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        np.minimum(least, (part[None, :] * FACTORS[:, None] + SHIFTS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hi, lo, n_shingles, sig): the digest of each document's set, its size and minwise values."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_bytes(text).alias("data"))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle_sets([x.as_py() for x in batch.column("data")], k)
            digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
            sig = [minwise(s).tobytes() if len(s) else b"" for s in sets]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "hi", "lo", "n_shingles", "sig"])

        return fn

    return common.map_batches(rows, make, "doc_id long, hi long, lo long, n_shingles long, sig binary")


def sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.uint32).reshape(-1, TREES, LEVELS)


def nodes(classes: DataFrame, level: int) -> DataFrame:
    """(tree, node, doc_id): the node of each class at a step of its open trees; a class without that column is in every tree."""
    columns = [c for c in ("doc_id", "sig", "trees") if c in classes.columns]

    def run(batches):
        for batch in batches:
            sig = sig_matrix(batch.column("sig"))
            open_trees = batch.column("trees").to_pylist() if "trees" in columns else [range(TREES)] * len(sig)
            row = np.repeat(np.arange(len(sig)), [len(x) for x in open_trees])
            tree = np.fromiter(chain.from_iterable(open_trees), np.int32, len(row))
            sig = sig[row, tree]
            path = mix((tree + 1).astype(np.uint64))
            for depth in range(DEPTHS[level - 1]):
                path = mix(path * PRIME + sig[:, depth] + np.uint64(depth + 1))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(path.view(np.int64)), pa.array(ids)], ["tree", "node", "doc_id"])

    return classes.select(*columns).mapInArrow(run, "tree int, node long, doc_id long")


def members(classes: DataFrame) -> DataFrame:
    """(node, doc_id, n, pivot, level) of every node with two classes or more, down to the step where none is large.

    A class goes on to the next step in one row with those of its trees where its node is large,
    so a step makes a row for each class and tree at most; those of the later steps, which are
    few but for large groups, are made once and written.
    """
    out = []
    for level in range(1, len(DEPTHS) + 1):
        rows = nodes(classes, level) if level == 1 else common.saved(nodes(classes, level))
        counts = common.saved(rows.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("pivot")).filter("n > 1"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        found = common.saved(common.join_skewed(rows, counts, ["node"], total).select("tree", "node", "doc_id", "n", "pivot", F.lit(level).alias("level")))
        out.append(found.drop("tree"))
        if level == len(DEPTHS) or not common.some(counts.filter(F.col("n") > LIMIT)):
            break
        left = common.saved(found.filter(F.col("n") > LIMIT).groupBy("doc_id").agg(F.collect_set("tree").alias("trees")))
        classes = common.saved(common.join_small(classes.select("doc_id", "sig"), left, "doc_id", "inner"))
    found = out[0]
    for one in out[1:]:
        found = found.unionByName(one)
    return found


def sketches(classes: DataFrame) -> DataFrame:
    """(doc_id, sketch): a byte of each minwise value."""

    def run(batches):
        for batch in batches:
            low = sig_matrix(batch.column("sig")).astype(np.uint8).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in low], pa.binary())], ["doc_id", "sketch"])

    return classes.select("doc_id", "sig").mapInArrow(run, "doc_id long, sketch binary")


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def sketch_share(percent: int) -> float:
    """The least agreement of sketches of candidates."""
    s = percent / 100
    return s - SKETCH_DEVIATIONS * (s * (1 - s) / (TREES * LEVELS)) ** 0.5


def missed(percent: int) -> float:
    """The share of pairs at the threshold that have no node of the last step in common."""
    return (1 - (percent / 100) ** DEPTHS[-1]) ** TREES


def forest(sketch: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """Edges (child, parent, share) of breadth-first trees over rows whose sketches agree enough."""
    left = np.arange(len(sketch))
    out, queue = [], []
    while len(left):
        if queue:
            at = queue.pop()
        else:
            at, left = left[0], left[1:]
        share = agreement(sketch[left], sketch[at])
        near = share >= least
        out += [(int(x), int(at), float(y)) for x, y in zip(left[near], share[near], strict=True)]
        queue += left[near].tolist()
        left = left[~near]
    return out


def candidates(found: DataFrame, sketched: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """(a, b, share): candidate edges of all nodes, as a written table; share is null where no sketch was compared."""
    small = found.filter(F.col("n") <= LIMIT).select("node", "doc_id").join(sketched, "doc_id").repartition("node").sortWithinPartitions("node", "doc_id")

    least = sketch_share(percent)

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last, edges = None, []

        def grown() -> None:
            ids = np.concatenate([x for x, _ in held])
            edges.extend((ids[x], ids[y], share) for x, y, share in forest(np.concatenate([x for _, x in held]), least))
            held.clear()

        for batch in batches:
            node, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "doc_id"))
            sketch = np.frombuffer(b"".join(x.as_py() for x in batch.column("sketch")), np.uint8).reshape(len(ids), -1)
            cuts = np.flatnonzero(node[1:] != node[:-1]) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if start < stop:
                    if held and node[start] != last:
                        grown()
                    held.append((ids[start:stop], sketch[start:stop]))
                    last = node[start]
            if len(edges) > 10_000:
                yield edge_batch(edges)
                edges.clear()
        if held:
            grown()
        if edges:
            yield edge_batch(edges)

    compared = small.select("node", "doc_id", "sketch").mapInArrow(run, "a long, b long, share double")
    whole = found.filter((F.col("n") > LIMIT) & (F.col("level") == len(DEPTHS))).filter("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"), F.lit(None).cast("double").alias("share"))
    return common.saved(compared.unionByName(whole).groupBy("a", "b").agg(F.max("share").alias("share")))


def edge_batch(edges: list[tuple]) -> pa.RecordBatch:
    a, b, share = zip(*edges, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(share, pa.float64())], ["a", "b", "share"])


def contracted(edges: DataFrame) -> DataFrame:
    """(a, b): edges with the same components, one for each class and one for each two parents of a class.

    A class's parents are linked to the least of them instead of to the class; many
    classes have the same parents, so few links are left. A class has a parent in
    each of its nodes at most.
    """
    own = edges.groupBy("a").agg(F.min("b").alias("b"), F.collect_set("b").alias("parents"))
    parents = own.select(F.explode("parents").alias("a"), "b").filter("a <> b").distinct()
    return common.saved(own.select("a", "b").unionByName(parents))


def nearest(edges: DataFrame) -> DataFrame:
    """(a, b): the best candidate of each class."""
    return edges.groupBy("a").agg(F.max_by("b", F.struct("share", -F.col("b"))).alias("b"))


def linked(sets: list[np.ndarray], labels: np.ndarray, asked: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows, one of them asked, that join the labels which similar sets join, directly or by way of others.

    All pairs are compared; of those that are similar a forest over the labels is returned.
    Shingles are counted range by range of their hashes, so memory follows a range and not all sets.
    """
    sizes = np.array([len(x) for x in sets], np.float32)
    both = np.zeros((len(sets), len(sets)), np.float32)
    steps = int(sizes.sum()) // RANGE_SHINGLES + 1
    cuts = np.array([(i << 64) // steps for i in range(1, steps)], np.uint64)
    places = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in sets]
    for step in range(steps):
        some = [x[p[step] : p[step + 1]] for x, p in zip(sets, places, strict=True)]
        _, column, times = np.unique(np.concatenate(some), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in some])
        shared = times[column] > 1
        owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
        for low in range(0, int((times > 1).sum()), COLUMNS):
            here = (column >= low) & (column < low + COLUMNS)
            held = np.zeros((len(sets), COLUMNS), np.float32)
            held[owner[here], column[here] - low] = 1
            both += held @ held.T
    hit = (both > 0) & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (labels[:, None] != labels[None, :]) & (asked[:, None] | asked[None, :])
    i, j = np.nonzero(np.triu(hit))
    return [(int(i[k]), int(j[k])) for k in spanning(labels, i, j)]


def spanning(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Places in the pairs of rows i and j that span the components of their labels: fewer than there are labels."""
    kinds, kind = np.unique(labels, return_inverse=True)
    pair = np.full((len(kinds), len(kinds)), -1)
    pair[kind[i], kind[j]] = pair[kind[j], kind[i]] = np.arange(len(i))
    left = np.arange(len(kinds))
    out, queue = [], []
    while len(left):
        if queue:
            at = queue.pop()
        else:
            at, left = left[0], left[1:]
        near = pair[at, left] >= 0
        out += pair[at, left[near]].tolist()
        queue += left[near].tolist()
        left = left[~near]
    return out


def cluster_links(edges: DataFrame, labels: DataFrame, sized: DataFrame, docs: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(a, b): links between components within the clusters of candidate edges, on full sets; a written table.

    sized has the doc_id and n_shingles of each class. A side of a block is bounded by
    its classes and by their shingles.
    """
    clusters = components(contracted(edges)).withColumnRenamed("label", "cluster")
    rows = common.join_small(clusters, labels, "id", "left").select("id", "cluster", F.coalesce("label", "id").alias("label"))
    rows = common.saved(rows.join(sized.select(F.col("doc_id").alias("id"), "n_shingles"), "id"))
    sizes = common.saved(rows.groupBy("cluster", "label").agg(F.count("*").alias("k"), F.sum("n_shingles").alias("w")))
    mixed = sizes.groupBy("cluster").agg(F.max(F.struct("k", "label", "w")).alias("main"), F.sum("k").alias("n"), F.sum("w").alias("w"), F.count("*").alias("kinds")).filter("kinds > 1")
    side = lambda n, w: F.ceil(F.greatest(n / BLOCK, w / BLOCK_SHINGLES)).cast("int")
    mixed = mixed.select("cluster", F.col("main.label").alias("main"), "n", side(F.col("n"), F.col("w")).alias("across"), side(F.col("n") - F.col("main.k"), F.col("w") - F.col("main.w")).alias("down"))
    rows, mixed = rows.drop("n_shingles"), common.saved(mixed)
    rows = common.join_skewed(rows, mixed, ["cluster"], mixed.agg(F.sum("n")).first()[0] or 0).withColumn("asked", F.col("label") != F.col("main"))
    h = F.xxhash64("id")
    x, y = F.pmod(h, F.col("across")).cast("int"), F.pmod(h, F.col("down")).cast("int")
    # an asked class meets every block of its cluster, and so does each class every block of asked ones
    asked = rows.filter("asked").select("*", F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("x"), y.alias("y"))
    every = rows.withColumn("asked", F.lit(False)).select("*", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("y")).select("*", x.alias("x"))
    dealt = asked.unionByName(every).groupBy("cluster", "x", "y", "id").agg(F.first("label").alias("label"), F.max("asked").alias("asked"))
    ids = common.saved(rows.select("id"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), common.text_bytes(text).alias("data")).dropna(subset=["id"])
    texts = common.join_small(texts, ids, "id", "left_semi").dropDuplicates(["id"])
    blocks = dealt.join(texts, "id").repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y")

    def make():
        state: dict = {"key": None, "rows": []}

        def compared() -> list[tuple[int, int]]:
            own = state["rows"]
            state["rows"] = []
            if len(own) < 2:
                return []
            ids, labels, asked, sets = zip(*own, strict=True)
            return [(ids[i], ids[j]) for i, j in linked(list(sets), np.array(labels), np.array(asked, bool), percent)]

        def fn(batch: pa.RecordBatch | None) -> pa.RecordBatch | None:
            if batch is None:
                pairs = compared()
                return pair_batch(pairs) if pairs else None
            pairs = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("cluster", "x", "y")), strict=True)
            sets = shingle_sets([v.as_py() for v in batch.column("data")], k)
            for key, *row in zip(keys, batch.column("id").to_pylist(), batch.column("label").to_pylist(), batch.column("asked").to_pylist(), sets, strict=True):
                if key != state["key"]:
                    pairs += compared()
                    state["key"] = key
                state["rows"].append(row)
            return pair_batch(pairs) if pairs else None

        return fn

    return common.saved(common.map_batches(blocks.select("cluster", "x", "y", "id", "label", "asked", "data"), make, "a long, b long", ends=True))


def pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pairs (a written table of a, b) whose full sets are similar enough, as a written table.

    A pair brings the text of a; a copy of b's text comes with each PIVOT_ROWS pairs.
    """
    counts = common.saved(pairs.groupBy("b").agg(F.count("*").alias("n")))
    dealt = common.join_skewed(pairs, counts, ["b"], pairs.count()).withColumn("salt", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / PIVOT_ROWS)).cast("int"))
    ids = common.saved(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), common.text_bytes(text).alias("data")).dropna(subset=["id"])
    texts = common.join_small(texts, ids, "id", "left_semi")
    heads = dealt.select("b", "salt").distinct().join(texts, F.col("b") == F.col("id")).select("b", "salt", F.lit(None).cast("long").alias("a"), "data")
    tails = dealt.join(texts, F.col("a") == F.col("id")).select("b", "salt", "a", "data")
    rows = heads.unionByName(tails).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())

    def make():
        state: dict = {}

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            pairs = []
            for a, b, own in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), shingle_sets([x.as_py() for x in batch.column("data")], k), strict=True):
                if a is None:
                    state["head"] = own
                elif similar(own, state["head"], percent):
                    pairs.append((a, b))
            return pair_batch(pairs) if pairs else None

        return fn

    return common.saved(common.map_batches(rows, make, "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of each document; a threshold that the trees do not cover is an error."""
    if not 0 < percent <= 100 or missed(percent) > MISSED:
        raise ValueError(f"similarity of {percent} %: the trees are made for 80 and more")
    signed = common.saved(signatures(docs, k, doc_id, text))
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    same = named.groupBy("hi", "lo").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")).filter("n > 1")
    same = common.saved(same)
    copies = common.saved(common.join_skewed(named.select("doc_id", "hi", "lo"), same, ["hi", "lo"], named.count()).select("doc_id", "class_id").distinct())
    extra = copies.filter("doc_id <> class_id").select("doc_id")
    classes = common.join_small(named, extra, "doc_id", "left_anti").dropDuplicates(["doc_id"]) if common.some(extra) else named
    edges = candidates(members(classes), sketches(classes), percent)
    links = confirmed(common.saved(nearest(edges)), docs, k, percent, doc_id, text)
    labels = components(links)
    more = cluster_links(edges, labels, classes, docs, k, percent, doc_id, text)
    if common.some(more):
        labels = components(common.saved(links.unionByName(more)))
    moved = copies.select("doc_id", "class_id")
    out = common.join_small(signed.select("doc_id", "n_shingles"), moved, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    out = common.join_small(out, labels.withColumnRenamed("id", "class_id"), "class_id", "left")
    return out.select("doc_id", "n_shingles", "class_id", F.coalesce("label", "class_id").alias("component_id"))


def keep_first(docs: DataFrame, k: int = WORDS, percent: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that come first in their component."""
    judged = near_duplicates(docs, k, percent, doc_id, text)
    gone = common.saved(judged.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct())
    return common.join_small(docs, gone, F.col(doc_id).cast("long") == F.col("__gone"), "left_anti")
