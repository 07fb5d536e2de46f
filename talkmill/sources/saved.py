"""Readers of what outside services and tools have answered, saved as JSON text, and texts that are read back by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import readers

RESULT = "struct<DeliveryID: string, SessionID: string, SessionName: string>"
PROBE = "struct<streams: array<struct<codec_type: string, width: string, height: string, r_frame_rate: string, nb_frames: string>>, format: struct<duration: string, size: string>>"
POINTS = "struct<frames: array<bigint>, cx: array<double>, cy: array<double>>"
CROP = "struct<w: bigint, h: bigint, x: array<bigint>, y: array<bigint>>"
PATH = f"detections {POINTS}, n_frames bigint, fps double, width bigint, height bigint, crop {CROP}"
SEGMENT = "array<struct<start: double, end: double, text: string, speaker: string, is_student_question: boolean, question_source: string>>"


def first_folder(answers: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, folder_id): the first folder of each search's answer (an array of objects with Id); none is an error when it is used."""
    folders = F.from_json(body, "array<struct<Id: string>>")
    fail = F.raise_error(F.concat(F.lit("no folder found for "), F.col(key).cast("string"))).cast("string")
    return answers.select(key, F.coalesce(F.get(folders, F.lit(0))["Id"], fail).alias("folder_id"))


def sessions(pages: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, page, pos, session fields): the sessions of all pages of a folder's listing; a session that two pages have counts once, where it came first."""
    rows = pages.select(key, "page", F.posexplode(F.from_json(body, f"struct<d: struct<Results: array<{RESULT}>>>")["d"]["Results"]).alias("pos", "r")).select(key, "page", "pos", "r.*")
    first = rows.groupBy(key, "DeliveryID").agg(F.min(F.struct("page", "pos")).alias("at")).select(key, "DeliveryID", "at.*")
    return rows.join(first, [key, "DeliveryID", "page", "pos"], "left_semi")


def with_assets(listed: DataFrame, answers: DataFrame, body: str = "body") -> DataFrame:
    """listed sessions with the fields of their saved asset (answers: DeliveryID and JSON text), in the form that entries() takes; those without one are left out."""
    kinds = readers.ASSET.removeprefix("SessionId string, ")
    asset = F.from_json(body, kinds)
    return listed.join(answers.select("DeliveryID", asset.alias("asset")), "DeliveryID").select(F.col("SessionID").alias("SessionId"), "asset.*")


def probes(reports: DataFrame, key: list[str], body: str = "body") -> DataFrame:
    """(key, path_exists, size, duration, has_video, has_audio, fps, width, height, n_frames) of probe reports.

    reports has path_exists, file_size and the report's JSON text; a report that can't be
    read leaves size null, as the quality rules take it.
    """
    c = F.col
    report = F.from_json(body, PROBE)
    rows = reports.select(*key, "path_exists", "file_size", report.alias("p"), F.coalesce(F.try_parse_json(body).isNotNull(), F.lit(False)).alias("readable"))
    of = lambda kind: F.get(F.filter(F.coalesce("p.streams", F.array().cast(_kind("streams"))), lambda s: s["codec_type"] == kind), F.lit(0))
    rows = rows.filter("path_exists is not null").withColumns({"video": of("video"), "audio": of("audio")})
    good = c("path_exists") & c("readable")
    rate = F.split(F.coalesce("video.r_frame_rate", F.lit("0/1")), "/")
    den = F.coalesce(F.nullif(F.get(rate, F.lit(1)), F.lit("")), F.lit("1"))
    fps = F.coalesce(F.try_divide(rate[0].try_cast("double"), den.try_cast("double")), F.lit(0.0))
    whole = lambda name: F.coalesce(c(f"video.{name}").try_cast("long"), F.lit(0).cast("long"))
    seen = lambda x: F.when(good & c("video").isNotNull(), x)
    size = F.coalesce(F.nullif(c("p.format.size").try_cast("long"), F.lit(0).cast("long")), c("file_size"))
    return rows.select(
        *key, "path_exists", F.when(good, size).alias("size"), F.when(good, F.coalesce(c("p.format.duration").try_cast("double"), F.lit(0.0))).alias("duration"), F.when(good, c("video").isNotNull()).alias("has_video"),
        F.when(good, c("audio").isNotNull()).alias("has_audio"), seen(fps).alias("fps"), seen(whole("width")).alias("width"), seen(whole("height")).alias("height"), seen(whole("nb_frames")).alias("n_frames"),
    )


def _kind(name: str) -> str:
    return PROBE.split(f"{name}: ", 1)[1].split(", format", 1)[0]


def transcript_text(segments: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, body): each recording's segments in order as the text of one transcript file; a recording's segments bound it."""
    fields = [F.col(x).alias(x) for x in ("start", "end", "text", "speaker", "is_student_question", "question_source") if x in segments.columns]
    rows = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("__pos"), F.struct(*fields).alias("s"))))
    return segments.groupBy(key).agg(F.to_json(F.transform(rows, lambda r: r["s"])).alias("body"))


def transcript_rows(files: DataFrame, key: str, body: str = "body") -> DataFrame:
    """(key, seg_pos, segment fields) of transcript texts."""
    return files.select(key, F.posexplode(F.from_json(body, SEGMENT)).alias("seg_pos", "s")).select(key, "seg_pos", "s.*")


def write_texts(files: DataFrame, key: str, path: str, body: str = "body") -> None:
    """A text file for each row, in a folder by its key."""
    files.select(F.col(key).alias("recording"), F.col(body).alias("value")).write.mode("overwrite").partitionBy("recording").text(path)


def _ordered(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("frame", *[F.col(f) for f in fields if f != "frame"]))).alias("rows"))


def path_text(known: DataFrame, path: DataFrame, recordings: DataFrame, key: str) -> DataFrame:
    """(key, body): each recording's detections, facts and crop as one JSON text, so the crop can be made again without detection.

    known has frame, cx, cy; path frame, x, y, cw, ch; recordings n_frames, fps, width, height.
    """
    take = lambda c, f: F.transform(F.col(c), lambda r: r[f])
    seen = _ordered(known, key, ["frame", "cx", "cy"]).select(key, F.struct(take("rows", "frame").alias("frames"), take("rows", "cx").alias("cx"), take("rows", "cy").alias("cy")).alias("detections"))
    crop = _ordered(path, key, ["frame", "x", "y", "cw", "ch"]).select(key, F.struct(F.col("rows")[0]["cw"].alias("w"), F.col("rows")[0]["ch"].alias("h"), take("rows", "x").alias("x"), take("rows", "y").alias("y")).alias("crop"))
    whole = recordings.join(seen, key, "left").join(crop, key, "left")
    none = F.from_json(F.lit('{"frames": [], "cx": [], "cy": []}'), POINTS)
    return whole.select(key, F.to_json(F.struct(F.coalesce(F.col("detections").cast(POINTS), none).alias("detections"), "n_frames", "fps", "width", "height", "crop")).alias("body"))


def saved_paths(files: DataFrame, key: str, n_frames: Column | None = None, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(known, recordings) of path texts, as crop_path() takes them; n_frames of the recording at hand caps the saved one."""
    rows = files.select(key, F.from_json(body, f"struct<{', '.join(f'{n}: {t}' for n, t in (('detections', POINTS), ('n_frames', 'bigint'), ('fps', 'double'), ('width', 'bigint'), ('height', 'bigint'), ('crop', CROP)))}>").alias("p"), *([n_frames.alias("__cap")] if n_frames is not None else []))
    cap = F.least(F.col("p.n_frames"), F.col("__cap")) if n_frames is not None else F.col("p.n_frames")
    recordings = rows.select(key, cap.alias("n_frames"), "p.fps", "p.width", "p.height")
    points = F.arrays_zip(F.col("p.detections.frames").alias("frame"), F.col("p.detections.cx").alias("cx"), F.col("p.detections.cy").alias("cy"))
    known = rows.select(key, F.inline(points)).toDF(key, "frame", "cx", "cy")
    return known, recordings
