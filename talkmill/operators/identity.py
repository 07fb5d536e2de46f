"""Face identity: frame samples, similarity to prototypes, clusters and their merge."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import dot, normalised

SIM, MERGE, CLUSTER, RECENT = 0.45, 0.5, 0.5, 5
SAMPLE, OPENING_S, OPENING_FRAMES = 400, 20.0, 60


def identified(faces: DataFrame, key: str, pos: str, cluster: float = CLUSTER, merge: float = MERGE) -> tuple[DataFrame, DataFrame]:
    """(ranked clusters, the main person's clusters) of each recording's sampled faces: agglomerated, ranked and merged."""
    labelled = faces.drop("label").join(clustered(faces, key, pos, cluster), [key, pos])
    rank = ranked(cluster_stats(labelled, [key]), [key])
    return rank, merged_identity(rank, [key], merge)


def located(faces: DataFrame, main: DataFrame, key: str, every: int, threshold: float = SIM) -> DataFrame:
    """The faces of sampled frames that are the main person's, with sim; main is identified()'s second table."""
    protos = main.select(key, F.col("centroid").alias("proto"))
    return best_similarity(faces.filter(F.pmod("frame", F.lit(every)) == 0), protos, key).filter(F.col("sim") >= threshold)


def spaced(first: Column, last: Column, n: Column) -> Column:
    """n evenly spaced whole numbers from first to last, truncated; first alone if n is 1."""
    step = F.when(n > 1, (last - first) / (n - 1)).otherwise(0.0)
    return F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)).cast("long") - 1), lambda i: F.when((i == n - 1) & (n > 1), last.cast("long")).otherwise((first + i * step).cast("long")))


def sample_frames(recordings: DataFrame, key: str, frames: int = SAMPLE, opening_s: float = OPENING_S, opening_frames: int = OPENING_FRAMES) -> DataFrame:
    """(key, frame, is_uniform): an even sample of each recording and a dense one of its opening, without repeats.

    recordings has start_frame, end_frame and fps. They are dealt to all tasks first,
    as a few rows give many frames. No list is carried with the frames: the even
    sample's steps are of a frame at least, so a frame that it has lies near the place
    that its distance from the first gives.
    """
    c, spark = F.col, recordings.sparkSession
    first, last = c("start_frame"), c("end_frame") - 1
    n = F.greatest(F.least(F.lit(frames), F.greatest(F.lit(1), c("end_frame") - c("start_frame"))), F.lit(1)).cast("long")
    opening = F.least(last, first + (opening_s * c("fps")).cast("long"))
    extra = F.when(opening > first, F.greatest(F.least(F.lit(opening_frames), opening - first), F.lit(1))).otherwise(0).cast("long")
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sized = recordings.filter(first.isNotNull()).select(key, first.alias("__first"), last.alias("__last"), n.alias("__n"), opening.alias("__end"), extra.alias("__extra"))
    step = lambda last, n: F.when(n > 1, (last - c("__first")) / F.greatest(n - 1, F.lit(1))).otherwise(0.0)
    dealt = sized.select("*", step(c("__last"), c("__n")).alias("__step"), step(c("__end"), c("__extra")).alias("__short")).repartition(tasks, key)
    place = lambda last, n, step, i: F.when((i == c(n) - 1) & (c(n) > 1), c(last).cast("long")).otherwise((c("__first") + i * c(step)).cast("long"))
    even = lambda i: place("__last", "__n", "__step", i)
    dense = lambda i: place("__end", "__extra", "__short", i)
    counted = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), c(n) - 1)).alias("__i")
    i = c("__i")
    uniform = dealt.select("*", counted("__n")).filter((i == 0) | (even(i) != even(i - 1))).select(key, even(i).alias("frame"), F.lit(True).alias("is_uniform"))
    # a generator, so that the frame is not worked out again in each of the tests below
    rest = dealt.filter("__extra > 0").select("*", counted("__extra")).filter((i == 0) | (dense(i) != dense(i - 1))).select("*", F.explode(F.array(dense(i))).alias("frame"))
    rest = rest.select("*", F.explode(F.array(F.floor((c("frame") - c("__first")) / F.greatest("__step", F.lit(1.0))))).alias("__near"))
    seen = [even(F.least(F.greatest(c("__near") + k, F.lit(0)), c("__n") - 1)) == c("frame") for k in (-1, 0, 1, 2)]
    rest = rest.filter(~(seen[0] | seen[1] | seen[2] | seen[3])).select(key, "frame", F.lit(False).alias("is_uniform"))
    return uniform.unionByName(rest)


def chunk_bounds(recordings: DataFrame, key: str, chunks: int) -> DataFrame:
    """(key, chunk, from_frame, to_frame): evenly cut ranges."""
    cuts = spaced(F.col("start_frame").cast("double"), F.col("end_frame").cast("double"), F.lit(chunks + 1))
    rows = recordings.select(key, cuts.alias("cuts"))
    return rows.select(key, "cuts", F.explode(F.sequence(F.lit(1), F.lit(chunks))).alias("chunk")).select(key, "chunk", F.element_at("cuts", F.col("chunk")).alias("from_frame"), F.element_at("cuts", F.col("chunk") + 1).alias("to_frame"))


def best_similarity(embedded: DataFrame, prototypes: DataFrame, key: str | None = None, vector: str = "embedding") -> DataFrame:
    """embedded with sim: the largest dot product with a prototype of its key, null without one.

    prototypes has key (if any) and proto; a key's prototypes become one array, so
    each embedding is scored in place and nothing is exploded.
    """
    if key:
        arrays = prototypes.groupBy(key).agg(F.collect_list("proto").alias("protos"))
        joined = embedded.join(arrays, key, "left")
    else:
        arrays = prototypes.agg(F.collect_list("proto").alias("protos"))  # one row
        joined = embedded.withColumn("__one", F.lit(1)).join(F.broadcast(arrays.withColumn("__one", F.lit(1))), "__one").drop("__one")
    sims = F.transform(F.coalesce("protos", F.array().cast("array<array<double>>")), lambda p: dot(F.col(vector), p))
    return joined.withColumn("sim", F.array_max(sims)).drop("protos")


def recent_median(samples: DataFrame, key: list[str], order: list[str], threshold: float = SIM, recent: int = RECENT) -> DataFrame:
    """samples with decided: the median of the last samples up to this one reaches the threshold."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(1 - recent, 0)
    return samples.withColumn("recent", F.percentile("sim", F.lit(0.5)).over(w)).withColumn("decided", F.coalesce(F.col("recent") >= threshold, F.lit(False)))


def mean_vectors(embedded: DataFrame, key: list[str], vector: str = "embedding") -> DataFrame:
    """(key, mean): element by element; partial sums are one small row per key and place."""
    places = embedded.select(*key, F.posexplode(vector).alias("place", "x"))
    means = places.groupBy(*key, "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda e: e["x"]).alias("mean"))


def cluster_stats(faces: DataFrame, key: list[str], label: str = "label") -> DataFrame:
    """(key, label, n, n_uniform, share, centroid, mean_box_area); faces has is_uniform, box_area and embedding."""
    by = [*key, label]
    counts = faces.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("is_uniform").alias("n_uniform"), F.avg("box_area").alias("mean_box_area"))
    all_uniform = F.greatest(F.lit(1), F.sum("n_uniform").over(Window.partitionBy(*key)))
    stats = counts.withColumn("share", F.col("n_uniform") / all_uniform)
    return stats.join(mean_vectors(faces, by).select(*by, normalised(F.col("mean")).alias("centroid")), by)


def ranked(stats: DataFrame, key: list[str], label: str = "label") -> DataFrame:
    """stats with rank: most uniform faces first, then most faces, then the least label."""
    return stats.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("n_uniform"), F.desc("n"), label)))


def merged_identity(rank: DataFrame, key: list[str], threshold: float = MERGE) -> DataFrame:
    """The first cluster of each key and those whose centroids are near it, with top_sim."""
    top = rank.filter("rank = 1").select(*key, F.col("centroid").alias("top_centroid"))
    return rank.join(top, key).withColumn("top_sim", dot(F.col("centroid"), F.col("top_centroid"))).filter((F.col("rank") == 1) | (F.col("top_sim") >= threshold)).drop("top_centroid")


def identity_summary(rank: DataFrame, merged: DataFrame, key: list[str], min_share: float = 0.0, label: str = "label") -> DataFrame:
    """(key, n_faces, n_clusters, shares, instructor_labels, instructor_share, weak)."""
    whole = rank.groupBy(*key).agg(F.sum("n").alias("n_faces"), F.count("*").alias("n_clusters"), F.transform(F.array_sort(F.collect_list(F.struct("rank", "share"))), lambda x: F.round(x["share"], 4)).alias("shares"), F.max(F.when(F.col("rank") == 1, F.col("share"))).alias("top"))
    own = merged.groupBy(*key).agg(F.sum("n").alias("own"), F.transform(F.array_sort(F.collect_list(F.struct("rank", label))), lambda x: x[label]).alias("instructor_labels"))
    return whole.join(own, key).select(*key, "n_faces", "n_clusters", "shares", "instructor_labels", F.round(F.col("own") / F.col("n_faces"), 4).alias("instructor_share"), (F.col("top") < min_share).alias("weak"))


def examples(faces: DataFrame, rank: DataFrame, key: list[str], pos: str, clusters: int = 8, per: int = 12, label: str = "label") -> DataFrame:
    """The first faces of the first clusters, for a contact sheet."""
    best = rank.filter(F.col("rank") <= clusters).select(*key, label, "rank")
    w = Window.partitionBy(*key, label).orderBy(pos)
    return faces.join(best, [*key, label]).withColumn("example", F.row_number().over(w)).filter(F.col("example") <= per)


def nearest(sums: np.ndarray, sizes: np.ndarray, of: np.ndarray, cells: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(mean cosine distance, place) of the nearest other cluster of each of some clusters; blocks of so many cells at a time."""
    gap, at = np.full(len(of), np.inf), np.zeros(len(of), int)
    for low in range(0, len(of), step := max(1, cells // max(1, len(sums)))):
        own = of[low : low + step]
        block = 1 - (sums[own] / sizes[own, None]) @ (sums / sizes[:, None]).T
        block[np.arange(len(own)), own] = np.inf
        np.nan_to_num(block, copy=False, nan=np.inf, posinf=np.inf)
        at[low : low + step] = block.argmin(1)
        gap[low : low + step] = block[np.arange(len(own)), at[low : low + step]]
    return gap, at


def average_linkage(vectors: np.ndarray, threshold: float = CLUSTER) -> np.ndarray:
    """Labels by agglomeration on mean cosine distance below a threshold; labels count by first member.

    The mean distance of two clusters is 1 less the product of their mean unit vectors,
    so sums and sizes stand for the matrix of distances. Clusters that are each other's
    nearest are merged in rounds: a merged cluster is no nearer to a third than the
    nearer of its parts, so this gives the tree of merging the nearest two each time
    (where distances differ), and only clusters whose nearest was merged look again.
    """
    n = len(vectors)
    if not n:
        return np.zeros(0, int)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.maximum(norms, 1e-12)
    owner = np.arange(n)  # each vector's cluster
    if threshold > 0:  # copies are merged before all others; vectors of no length are apart from one another
        owner = np.unique(np.hstack([unit, np.where(norms > 1e-12, -1.0, np.arange(n)[:, None])]), axis=0, return_inverse=True)[1].reshape(-1)
    sizes = np.bincount(owner).astype(float)
    sums = unit[np.unique(owner, return_index=True)[1]] * sizes[:, None]
    gap, at = nearest(sums, sizes, np.arange(len(sums)))
    while True:
        places = np.arange(len(sums))
        open_ = gap < threshold
        a = places[open_ & (at[at] == places) & (places < at)]
        if len(a) * 20 < open_.sum():  # a star or a ring: few pairs in a round
            return counted(chained(sums, sizes, threshold)[owner])
        if not len(a):
            return counted(owner)
        low, high = a, at[a]
        sums[low] += sums[high]
        sizes[low] += sizes[high]
        merged, kept, into = np.zeros(len(sums), bool), np.ones(len(sums), bool), places.copy()
        merged[a] = merged[high] = True
        kept[high], into[high] = False, low
        new = np.cumsum(kept) - 1
        owner = new[into[owner]]
        again = (merged | (merged[at] & open_))[kept]  # one that had none near never gets one
        sums, sizes, gap, at = sums[kept], sizes[kept], gap[kept], new[into[at[kept]]]
        gap[again], at[again] = nearest(sums, sizes, np.flatnonzero(again))


def chained(sums: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Each cluster's cluster in the end, by chains of nearest neighbours: a product with all means for each link, three for each cluster at most."""
    sums, sizes = sums.copy(), sizes.copy()
    means, alive, into, chain = sums / sizes[:, None], np.ones(len(sums), bool), np.arange(len(sums)), []
    for start in range(len(sums)):
        while chain or alive[start]:
            tip = chain[-1] if chain else start
            chain = chain or [start]
            gap = np.where(alive, 1 - means @ means[tip], np.inf)
            gap[tip] = np.inf
            np.nan_to_num(gap, copy=False, nan=np.inf, posinf=np.inf)
            best = int(gap.argmin())
            if len(chain) > 1 and gap[chain[-2]] <= gap[best]:
                best = chain[-2]
            if not gap[best] < threshold:
                alive[tip] = False
                chain.pop()
            elif len(chain) > 1 and best == chain[-2]:
                chain = chain[:-2]
                low, high = min(tip, best), max(tip, best)
                sums[low] += sums[high]
                sizes[low] += sizes[high]
                means[low], alive[high], into[high] = sums[low] / sizes[low], False, low
            else:
                chain.append(best)
    for i in range(len(into)):  # a cluster goes into an earlier one
        into[i] = into[into[i]]
    return into


def counted(owner: np.ndarray) -> np.ndarray:
    """Labels by first member."""
    first = {o: i for i, o in enumerate(dict.fromkeys(owner.tolist()))}
    return np.array([first[o] for o in owner.tolist()], int)


def clustered(faces: DataFrame, key: str, pos: str, threshold: float = CLUSTER, vector: str = "embedding") -> DataFrame:
    """(key, pos, label): clusters of each recording's faces.

    Takes a recording's sampled faces at once: sample_frames() bounds them.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(pos)
        labels = average_linkage(np.stack(group[vector].to_list()).astype(float), threshold) if len(group) else []
        return group[[key, pos]].assign(label=labels)

    kinds = {f.name: f.dataType.simpleString() for f in faces.schema}
    return faces.select(key, pos, vector).groupBy(key).applyInPandas(run, f"{key} {kinds[key]}, {pos} {kinds[pos]}, label long")
