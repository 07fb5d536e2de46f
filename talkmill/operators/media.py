"""Media facts: probes, alignment of two recordings, quality rules, artifacts and sounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RULES = {"tol_s": 2.0, "min_bytes": 100_000, "expect_audio": False, "size_lo": 0.08, "size_hi": 8.0, "min_rate": 2_000}


def black_runs(lines: DataFrame, key: str, text: str = "value") -> DataFrame:
    """(key, start, end) of each black run that a detector's log lines name."""
    pattern = r"black_start:\s*([0-9.]+)\s+black_end:\s*([0-9.]+)"
    hits = lines.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"(black_start:\s*[0-9.]+\s+black_end:\s*[0-9.]+)"))).alias("hit"))
    return hits.select(key, *[F.regexp_extract("hit", pattern, i).cast("double").alias(n) for i, n in ((1, "start"), (2, "end"))])


def sync_plan(pairs: DataFrame, min_offset: float = 0.5, max_black: float = 600.0, drift_limit: float = 1.5, scan_s: float = 900.0) -> DataFrame:
    """How the two recordings of a pair are trimmed.

    pairs has camera_s, screen_s, lead (black at the screen's head) and, if trims were
    made, got_screen_s and got_camera_s. The longer one began earlier; black that
    alignment leaves is cut from both. Trims up to min_offset are not applied.
    """
    offset = F.col("screen_s") - F.col("camera_s")
    out = pairs.withColumns({"screen_align": F.greatest(F.lit(0.0), offset), "camera_align": F.greatest(F.lit(0.0), -offset)})
    out = out.withColumn("residual", F.greatest(F.lit(0.0), F.col("lead") - F.col("screen_align")))
    out = out.withColumns({"screen_trim": F.col("screen_align") + F.col("residual"), "camera_trim": F.col("camera_align") + F.col("residual")})
    flags = {"refused": F.col("residual") > max_black, "cut_screen": F.col("screen_trim") > min_offset, "cut_camera": F.col("camera_trim") > min_offset, "scan_ended": F.col("lead") >= scan_s - 1}
    out = out.withColumns(flags)
    if {"got_screen_s", "got_camera_s"} <= set(pairs.columns):
        out = out.withColumn("drift", F.abs(F.col("got_screen_s") - F.col("got_camera_s"))).withColumn("drifted", F.col("drift") > drift_limit)
    return out


def problems(media: DataFrame, **limits) -> Column:
    """The problems of a media row as an array of codes.

    media has path_exists, size, duration, has_video, has_audio, n_frames (size is null
    where a file can't be read) and, with a reference, wants_ref, ref_size and
    ref_duration. A limit may be overridden by a column of its name. A missing or
    unreadable file has that problem alone.
    """
    def limit(name: str) -> Column:
        default = F.lit(limits.get(name, RULES[name]))
        return F.coalesce(F.col(name), default) if name in media.columns else default

    c = F.col
    rate = c("size") / c("duration")
    ratio = c("size") / c("ref_size")
    rules = {
        "small": c("size") < limit("min_bytes"),
        "no_video": ~c("has_video"),
        "empty": (F.coalesce("n_frames", F.lit(0)) == 0) & (c("duration") <= 0),
        "no_audio": limit("expect_audio") & ~c("has_audio"),
        "thin": (c("duration") > 1) & (rate < limit("min_rate")),
    }
    if "wants_ref" in media.columns:
        has = c("wants_ref") & c("ref_size").isNotNull()
        rules |= {
            "bad_ref": c("wants_ref") & c("ref_size").isNull(),
            "duration": has & (c("ref_duration") > 0) & (F.abs(c("duration") - c("ref_duration")) > limit("tol_s")),
            "size_ratio": has & (c("ref_size") > 0) & ~ratio.between(limit("size_lo"), limit("size_hi")),
        }
    found = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return F.when(~c("path_exists"), F.array(F.lit("missing"))).when(c("size").isNull(), F.array(F.lit("unreadable"))).otherwise(found)


def transcript_problems(transcripts: DataFrame) -> Column:
    """Problems of a transcript: path_exists, readable, first_keys (of its first segment), n_segments, n_flagged."""
    c = F.col
    lacks = F.array_except(F.array(*map(F.lit, ("start", "end", "text"))), F.coalesce("first_keys", F.array().cast("array<string>")))
    return F.when(~c("path_exists"), F.array(F.lit("missing"))).when(~c("readable"), F.array(F.lit("unreadable"))).when(c("n_segments") == 0, F.array(F.lit("no_segments"))).when(F.size(lacks) > 0, F.transform(lacks, lambda k: F.concat(F.lit("lacks_"), k))).when(c("n_flagged") == 0, F.array(F.lit("not_classified"))).otherwise(F.array().cast("array<string>"))


def caption_problems(files: DataFrame, least: int = 32) -> Column:
    return F.when(~F.col("path_exists"), F.array(F.lit("missing"))).when(F.col("size") < least, F.array(F.lit("empty"))).otherwise(F.array().cast("array<string>"))


def best_artifact(wanted: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """wanted (key, want, candidate, priority, is_default) with the first candidate of each want that the catalog has.

    Without one the default candidate is named, with present false.
    """
    options = wanted.groupBy(key, "want").agg(F.collect_list(F.struct("candidate", "priority", "is_default")).alias("options"))
    have = catalog.groupBy(key).agg(F.collect_set("artifact").alias("existing"))
    rows = options.join(have, key, "left").withColumn("existing", F.coalesce("existing", F.array().cast("array<string>")))
    return rows.select(key, "want", first_option(F.col("options"), F.col("existing")).alias("b")).select(key, "want", "b.artifact", "b.present")


def first_option(options: Column, existing: Column) -> Column:
    """(artifact, present) of the first of a want's options (candidate, priority, is_default) whose name is in existing, else of the default."""
    present = lambda o: F.coalesce(F.array_contains(existing, o["candidate"]), F.lit(False))
    ordered = F.transform(options, lambda o: F.struct((~present(o)).alias("absent"), F.when(present(o), o["priority"]).alias("at"), (~o["is_default"]).alias("other"), o["priority"].alias("priority"), o["candidate"].alias("candidate")))
    best = F.array_min(ordered)
    return F.struct(best["candidate"].alias("artifact"), (~best["absent"]).alias("present"))


def publishable(best: DataFrame, key: str, allow: bool = False) -> DataFrame:
    """(key, refused): a recording whose camera is not the anonymized one is refused unless that is allowed."""
    camera = best.filter("want = 'assembly_camera'")
    return camera.select(key, (F.lit(not allow) & ((F.col("artifact") != "camera_anon") | ~F.col("present"))).alias("refused"))


def card_sounds(cards: DataFrame, key: str, order: str, most: int = 64) -> DataFrame:
    """cards with delay_ms and sounds: the first cards of a recording have a sound, the rest are marked as without."""
    w = Window.partitionBy(key).orderBy(order)
    return cards.withColumns({"delay_ms": (F.col("start") * 1000).cast("long"), "sounds": F.row_number().over(w) <= most})
