"""Box tracks and coverage: folds that depend on order, one group (recording and chunk) at a time.

A group is a chunk, so state ends at a chunk's edge; chunk_bounds() fixes the edges.
What cannot be told apart from someone else is covered: a missing similarity never
makes a face the main one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BOX = ["x1", "y1", "x2", "y2"]
SAME, PAIR, LINGER = 0.3, 0.05, 2


def folded(rows: DataFrame, key: list[str], order: list[str], fold: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """A fold of each group's rows (tuples in column order, sorted) to rows of the schema.

    Groups stream through a task one after the other, so many small ones cost no
    Python call each from the JVM and only one is held at a time. They are dealt and
    ordered by a window, which takes rows that lie by key already as they are; its rank
    is the tuples' last value.
    """
    dealt = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    places = [rows.columns.index(k) for k in key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list[tuple] = []
        now, out = None, []
        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                own = tuple(row[p] for p in places)
                if own != now and group:
                    out += fold(group)
                    group = []
                now = own
                group.append(row)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if group:
            out += fold(group)
        if out:
            yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return dealt.mapInPandas(run, schema)


def share(a: tuple, b: tuple) -> float:
    """Intersection over union of two boxes."""
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    total = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / total if total > 0 else 0.0


class Identity:
    """Whether a track is the main person: the median of its last similarities reaches a limit."""

    def __init__(self, threshold: float, recent: int):
        self.threshold, self.recent = threshold, recent
        self.sims: list[float] = []
        self.main = False
        self.asked: int | None = None

    def due(self, frame: int, first: int, every: int, most: int) -> bool:
        n = len(self.sims)
        if n < first:
            return True
        return not self.main and n < most and (self.asked is None or frame - self.asked >= every)

    def take(self, sim: float | None) -> None:
        if sim is not None and sim == sim:
            self.sims.append(sim)
            last = sorted(self.sims[-self.recent :])
            half = len(last) // 2
            self.main = (last[half] if len(last) % 2 else (last[half - 1] + last[half]) / 2) >= self.threshold


def tracked(detections: DataFrame, key: list[str], every: int = 4, threshold: float = 0.45, first: int = 3, again: int = 25, most: int = 40, recent: int = 5) -> DataFrame:
    """detections (key, frame, det_pos, box, sim) with track, is_main and looked.

    A box goes to the first track, in order of birth, that was seen within four
    samples and overlaps it; several boxes may go to one. A track looks at its sim at
    birth, for its first samples, and while it is not the main one again from time to
    time; sim is null where no vector could be had.
    """

    k = len(key)

    def fold(group: list[tuple]) -> list[tuple]:
        tracks: list[list] = []  # box, last frame, identity
        out = []
        for row in group:
            frame, box, sim = row[k], row[k + 2 : k + 6], row[k + 6]
            sim = None if sim is None or sim != sim else float(sim)
            at = next((i for i, t in enumerate(tracks) if frame - t[1] <= 4 * every and share(box, t[0]) >= SAME), None)
            if at is None:
                at, ask = len(tracks), True
                tracks.append([box, frame, Identity(threshold, recent)])
            else:
                tracks[at][:2] = box, frame
                ask = tracks[at][2].due(frame, first, again, most)
                if ask and sim is not None:
                    tracks[at][2].asked = frame
            who = tracks[at][2]
            if ask:
                who.take(sim)
            out.append((*row[: k + 6], at, who.main, ask))
        return out

    kinds = {f.name: f.dataType.simpleString() for f in detections.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*key, "frame", "det_pos", *BOX)) + ", track long, is_main boolean, looked boolean"
    return folded(detections.select(*key, "frame", "det_pos", *BOX, "sim"), key, ["frame", "det_pos"], fold, schema)


def lingering(samples: list[list[tuple]], linger: int = LINGER) -> list[list[tuple]]:
    """Each sample's boxes and those of the samples just before that none of them overlaps."""
    out = []
    for i, own in enumerate(samples):
        held = list(own)
        for earlier in reversed(samples[max(0, i - linger) : i]):
            for box in earlier:
                if all(share(box, other) < SAME for other in held):
                    held.append(box)
        out.append(held)
    return out


def paired(now: list[tuple], then: list[tuple]) -> list[tuple]:
    """Boxes over a gap: unions of boxes matched greedily, the later of equal ones, and those without a match."""
    free, out = list(range(len(then))), []
    for box in now:
        best = max(((share(box, then[j]), j) for j in free), default=(0.0, -1))
        if best[0] >= PAIR:
            other = then[best[1]]
            free.remove(best[1])
            box = (min(box[0], other[0]), min(box[1], other[1]), max(box[2], other[2]), max(box[3], other[3]))
        out.append(box)
    return out + [then[j] for j in free]


def covered(sampled: DataFrame, key: list[str], every: int, linger: int = LINGER) -> DataFrame:
    """(key, from_frame, to_frame, box_pos, box): what is covered in [from_frame, to_frame).

    sampled has a row for each sampled frame with frame, n_frames and boxes (an array
    of boxes, maybe empty). Ranges stand for their frames; explode them with per_frame().
    """

    k = len(key)

    def fold(group: list[tuple]) -> list[tuple]:
        frames, n = [int(r[k]) for r in group], int(group[0][k + 1])
        held = lingering([[tuple(b[c] for c in BOX) for b in r[k + 2]] for r in group], linger)
        rows = []
        for i, start in enumerate(frames):
            final = i + 1 == len(frames)
            stop = n if final else min(frames[i + 1], n)
            if start < stop:
                rows += [(*group[0][:k], start, stop, j, *box) for j, box in enumerate(paired(held[i], [] if final else held[i + 1]))]
        return rows

    kinds = {f.name: f.dataType.simpleString() for f in sampled.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in key) + ", from_frame long, to_frame long, box_pos long, " + ", ".join(f"{c} double" for c in BOX)
    return folded(sampled.select(*key, "frame", "n_frames", "boxes"), key, ["frame"], fold, schema)


def per_frame(ranges: DataFrame) -> DataFrame:
    """covered() with a row for each frame."""
    return ranges.withColumn("frame", F.explode(F.sequence("from_frame", F.col("to_frame") - 1))).drop("from_frame", "to_frame")


def track_summary(tracks: DataFrame, key: list[str]) -> DataFrame:
    """(key, tracks, main_tracks, boxes, covered_boxes): a track is main if it is at its end."""
    ends = tracks.groupBy(*key, "track").agg(F.max_by("is_main", F.struct("frame", "det_pos")).alias("main"), F.count("*").alias("n"), F.count_if(~F.col("is_main")).alias("hidden"))
    return ends.groupBy(*key).agg(F.count("*").alias("tracks"), F.count_if("main").alias("main_tracks"), F.sum("n").alias("boxes"), F.sum("hidden").alias("covered_boxes"))
