"""Interval operators over recordings.

Every function takes the partition key explicitly and every order is a column.
Spans are half-open; a gap equal to the tolerance does not break a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded

BEFORE = (Window.unboundedPreceding, -1)


def islands(spoken: DataFrame, key: str, order: list[str], label: Column, tolerance: float = 1.5) -> DataFrame:
    """(key, start, end, flag): runs of words that are not the label's.

    spoken has speaker, start, end and flag; words without a speaker are left out and
    break nothing. A run ends at a word of the label, at a gap above the tolerance
    from the last word's end, and where the flag changes; its end is its last word's.
    """
    w = Window.partitionBy(key).orderBy(*order)
    said = spoken.filter("speaker is not null").withColumn("other", F.col("speaker") != label)
    before = {c: F.lag(c).over(w) for c in ("other", "end", "flag")}
    breaks = ~F.col("other") | before["other"].isNull() | ~before["other"] | (F.col("start") - before["end"] > tolerance) | (F.col("flag") != before["flag"])
    runs = said.withColumn("island", F.sum(breaks.cast("int")).over(w)).filter("other")
    at = F.struct(*order)
    return runs.groupBy(key, "island").agg(F.min_by("start", at).alias("start"), F.max_by("end", at).alias("end"), F.min_by("flag", at).alias("flag")).drop("island")


def leading_run(spans: DataFrame, key: str, tolerance: float) -> DataFrame:
    """(key, lead): the end of the run of spans that begins at 0, gaps up to the tolerance closed; 0 without one."""
    w = Window.partitionBy(key).orderBy("start", "end")
    reach = F.greatest(F.lit(0.0), F.coalesce(F.max("end").over(w.rowsBetween(*BEFORE)), F.lit(0.0)))
    broken = spans.withColumn("broken", (F.col("start") > reach + tolerance).cast("int")).withColumn("breaks", F.sum("broken").over(w))
    return broken.groupBy(key).agg(F.coalesce(F.max(F.when(F.col("breaks") == 0, F.greatest("end", F.lit(0.0)))), F.lit(0.0)).alias("lead"))


def on_frames(spans: DataFrame, duration: Column, fps: Column) -> DataFrame:
    """spans with whole frames a and b within the recording, and total; empty spans are dropped."""
    total = rounded(duration * fps)
    out = spans.withColumn("total", total).withColumn("a", F.greatest(F.lit(0).cast("long"), rounded(F.col("start") * fps)))
    return out.withColumn("b", F.least(F.col("total"), rounded(F.col("end") * fps))).filter("b > a")


def clipped(framed: DataFrame, key: str, pos: str) -> DataFrame:
    """Framed spans that don't overlap: a later one starts at the end of those before it and goes if nothing is left."""
    w = Window.partitionBy(key).orderBy("a", "b", pos).rowsBetween(*BEFORE)
    return framed.withColumn("a", F.greatest("a", F.coalesce(F.max("b").over(w), F.lit(0)))).filter("b > a")


def tiled(clips: DataFrame, key: str, pos: str, totals: DataFrame) -> DataFrame:
    """(key, kind, start_frame, n_frames, index): clips as cards and what lies between them as screen, over [0, total).

    totals has key and total of every recording, so one without clips is all screen.
    """
    w = Window.partitionBy(key).orderBy("a")
    cards = clips.select(key, F.lit("card").alias("kind"), F.col("a").alias("start_frame"), (F.col("b") - F.col("a")).alias("n_frames"), F.col(pos).cast("long").alias("index"))
    gap = clips.select(key, F.coalesce(F.lag("b").over(w), F.lit(0)).alias("start_frame"), "a")
    screens = gap.select(key, "start_frame", (F.col("a") - F.col("start_frame")).alias("n_frames"))
    tail = totals.join(clips.groupBy(key).agg(F.max("b").alias("last")), key, "left").select(key, F.coalesce("last", F.lit(0)).alias("start_frame"), (F.col("total") - F.coalesce("last", F.lit(0))).alias("n_frames"))
    screens = screens.unionByName(tail).filter("n_frames > 0")
    return cards.unionByName(screens.select(key, F.lit("screen").alias("kind"), "start_frame", "n_frames", F.lit(None).cast("long").alias("index")))


def united(spans: DataFrame, key: str, order: list[str], carry: str) -> DataFrame:
    """(key, start, end, carry): overlapping or touching spans as one, with the first one's carry."""
    w = Window.partitionBy(key).orderBy(*order)
    fresh = F.coalesce(F.col("start") > F.max("end").over(w.rowsBetween(*BEFORE)), F.lit(True))
    runs = spans.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(w))
    return runs.groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(carry, F.struct(*order)).alias(carry)).drop("run")


def union_tiled(runs: DataFrame, key: str, carry: str, durations: DataFrame) -> DataFrame:
    """(key, kind, start, dur, carry): united spans as cards and what lies between as layout, over [0, duration)."""
    w = Window.partitionBy(key).orderBy("start")
    cards = runs.select(key, F.lit("card").alias("kind"), "start", (F.col("end") - F.col("start")).alias("dur"), carry)
    gaps = runs.select(key, F.coalesce(F.lag("end").over(w), F.lit(0.0)).alias("from"), F.col("start").alias("to"))
    tail = durations.join(runs.groupBy(key).agg(F.max("end").alias("last")), key, "left").select(key, F.coalesce("last", F.lit(0.0)).alias("from"), F.col("duration").alias("to"))
    layout = gaps.unionByName(tail).filter("to > from")
    return cards.unionByName(layout.select(key, F.lit("layout").alias("kind"), F.col("from").alias("start"), (F.col("to") - F.col("from")).alias("dur"), F.lit(None).cast(runs.schema[carry].dataType).alias(carry)))


def overlap_join(left: DataFrame, right: DataFrame, key: str, width: float) -> DataFrame:
    """Pairs of one key with left.start < right.end and left.end > right.start.

    Both sides have start, end and other names besides the key. Spans are dealt to bins
    of a width, so the join is on (key, bin) and a long recording is split; a pair is
    kept in the bin of its later start only.
    """
    def binned(df: DataFrame, side: str) -> DataFrame:
        out = df.withColumnsRenamed({"start": f"{side}_start", "end": f"{side}_end"})
        return out.withColumn("bin", F.explode(F.sequence(*(F.expr(f"floor({e} / {width})") for e in (f"{side}_start", f"greatest({side}_end, {side}_start)")))))

    pairs = binned(left, "l").join(binned(right, "r"), [key, "bin"])
    later = F.floor(F.greatest("l_start", "r_start") / width)
    return pairs.filter((F.col("l_start") < F.col("r_end")) & (F.col("l_end") > F.col("r_start")) & (F.col("bin") == later)).drop("bin")


def ordered_text(text: str, order: list[str], sep: str = " ") -> Column:
    """Aggregate: texts joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t")))), lambda x: x["__t"]), sep)
