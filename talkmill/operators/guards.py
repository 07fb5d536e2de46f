"""What is checked before a run: the frames it takes, and what it may replace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_window(recordings: DataFrame, strict: bool = True) -> DataFrame:
    """recordings with start_frame, end_frame, total and empty: the frames that a run takes.

    recordings has n_frames, fps, and start_s, end_s and max_frames, which may be null
    (a max_frames of 0 is none too). Seconds are truncated to frames. An empty window is
    an error when the rows are used; without strict it is marked.
    """
    c = F.col
    start = (F.coalesce("start_s", F.lit(0.0)) * c("fps")).cast("long")
    end = F.coalesce((c("end_s") * c("fps")).cast("long"), c("n_frames"))
    end = F.least(end, F.when(F.coalesce("max_frames", F.lit(0)) > 0, start + c("max_frames")), c("n_frames"))  # least() skips nulls
    total = F.greatest(F.lit(0), end - start).cast("long")
    out = recordings.withColumns({"start_frame": start, "end_frame": end, "total": total, "empty": total == 0})
    if not strict:
        return out
    fail = F.raise_error(F.lit("empty frame range")).cast("long")
    return out.withColumn("total", F.when(c("empty"), fail).otherwise(c("total")))


def overwrite_guard(windows: DataFrame, allow: bool = False, times: int = 2) -> DataFrame:
    """windows with partial and refused: a run over a part may not replace an output of more than so many times its frames.

    windows has n_frames, total and existing_frames (null without an output).
    """
    partial = F.col("total") < F.col("n_frames")
    refused = F.lit(not allow) & partial & F.coalesce(F.col("existing_frames") > F.col("total") * times, F.lit(False))
    return windows.withColumns({"partial": partial, "refused": refused})


def reset_verdicts(segments: DataFrame) -> DataFrame:
    """segments as they were before any classification, so that a rerun inherits no verdict."""
    return segments.drop("is_student_question", "question_source")


def run_summary(stages: DataFrame, final: DataFrame, key: str) -> DataFrame:
    """(key, stages, minutes, final_mb): a row for each run; final_mb is null without a final file.

    stages has key and seconds, final has key and size in bytes.
    """
    total = stages.groupBy(key).agg(F.count("*").alias("stages"), (F.sum("seconds") / 60).alias("minutes"))
    return total.join(final.select(key, (F.col("size") / 1e6).alias("final_mb")), key, "left")
