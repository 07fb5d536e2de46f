"""Readers and writers of the files of recordings: manifests, transcripts, captions, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STREAM = "struct<StreamUrl: string, StreamType: int, ViewerMediaFileTypeName: string>"
DELIVERY = f"struct<SessionName: string, Duration: double, OwnerDisplayName: string, SessionStartTime: string, Timestamps: array<string>, Streams: array<{STREAM}>>"
ASSET = f"SessionId string, Delivery {DELIVERY}, SessionName string, Duration double, OwnerDisplayName string, SessionStartTime string, Timestamps array<string>, Streams array<{STREAM}>"
METADATA = ("key", "id", "name", "durationSec", "course", "owner", "start")
SEGMENT = "start double, end double, text string, speaker string, is_student_question boolean, question_source string, words array<struct<start: double, end: double, speaker: string>>"


def safe_key(text: Column) -> Column:
    """A key that names one folder."""
    return F.regexp_replace(text, r"[/\\]+", "_")


def entries(assets: DataFrame, course: Column) -> DataFrame:
    """Manifest rows of saved session assets: nested values first, streams without a URL dropped.

    Streams of one type are told apart by a position.
    """
    pick = lambda name: F.coalesce(F.col(f"Delivery.{name}"), F.col(name))
    usable = F.filter(F.coalesce(pick("Streams"), F.array().cast(f"array<{STREAM}>")), lambda s: F.coalesce(s["StreamUrl"], F.lit("")) != "")
    kind = lambda s: F.when(s["StreamType"] == 1, "camera").otherwise("screen")
    plain = F.transform(usable, lambda s: F.struct(kind(s).alias("type"), (s["ViewerMediaFileTypeName"].eqNullSafe("hls")).alias("isHls"), s["StreamUrl"].alias("url")))
    return assets.select(safe_key(F.concat(course, F.lit("_"), F.col("SessionId"))).alias("key"), F.col("SessionId").alias("id"), pick("SessionName").alias("name"), pick("Duration").alias("durationSec"), course.alias("course"), pick("OwnerDisplayName").alias("owner"), pick("SessionStartTime").alias("start"), F.coalesce(pick("Timestamps"), F.array().cast("array<string>")).alias("chapters"), plain.alias("streams"))


def streams(manifest: DataFrame) -> DataFrame:
    """(key, pos, type, type_pos, isHls, url): a row for each stream; type_pos counts those of one type."""
    rows = manifest.select("key", F.posexplode("streams").alias("pos", "s")).select("key", "pos", "s.type", "s.isHls", "s.url")
    return rows.withColumn("type_pos", F.row_number().over(Window.partitionBy("key", "type").orderBy("pos")))


def metadata(manifest: DataFrame) -> DataFrame:
    """The seven fields of the sidecar."""
    return manifest.select(*METADATA)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a {"lectures": [...]} file."""
    entry = "struct<key: string, id: string, name: string, durationSec: double, course: string, owner: string, start: string, chapters: array<string>, streams: array<struct<type: string, isHls: boolean, url: string>>>"
    whole = spark.read.schema(f"lectures array<{entry}>").json(path, multiLine=True)
    return whole.select(F.inline("lectures"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(recording, seg_pos, segment fields) of transcript files, each an array of segments; recording is the file's folder."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("recording"), F.from_json("value", f"array<struct<{', '.join(f'{n}: {t}' for n, t in (x.split(' ', 1) for x in SEGMENT.split(', ') if ': ' not in x and '<' not in x))}, words: array<struct<start: double, end: double, speaker: string>>>>").alias("s"))
    return files.select("recording", F.posexplode("s").alias("seg_pos", "seg")).select("recording", "seg_pos", "seg.*")


def words_of(segments: DataFrame, key: str) -> DataFrame:
    """(key, seg_pos, word_pos, start, end, speaker, flag): a row for each word; a spoken word without a start is an error."""
    rows = segments.select(key, "seg_pos", F.coalesce("is_student_question", F.lit(False)).alias("flag"), F.posexplode("words").alias("word_pos", "w"))
    start = F.when(F.col("w.speaker").isNotNull() & F.col("w.start").isNull(), F.raise_error(F.lit("a spoken word has no start")).cast("double")).otherwise(F.col("w.start"))
    return rows.select(key, "seg_pos", "word_pos", start.alias("start"), F.col("w.end").alias("end"), F.col("w.speaker").alias("speaker"), "flag")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """A {"lectures": [...]} file for each course, in folders by the course, as read_manifest() reads them; a course's recordings bound a file."""
    rows = F.array_sort(F.collect_list(F.struct(*manifest.columns)), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    files = manifest.groupBy(safe_key(F.coalesce("course", F.lit(""))).alias("folder")).agg(rows.alias("lectures"))
    files.write.mode("overwrite").partitionBy("folder").json(path)


def write_sidecars(manifest: DataFrame, path: str) -> None:
    """Metadata and chapters of each recording, in folders by its key."""
    for name, rows in (("metadata", metadata(manifest)), ("chapters", manifest.select("key", "chapters"))):
        rows.withColumn("recording", F.col("key")).write.mode("overwrite").partitionBy("recording").json(f"{path}/{name}")


def caption_text(cues: DataFrame, key: str) -> DataFrame:
    """(key, srt): each recording's cues as one caption file's text."""
    block = F.concat_ws("\n", F.col("cue").cast("string"), F.concat("start", F.lit(" --> "), "end"), "text", F.lit(""))
    rows = F.array_sort(F.collect_list(F.struct("cue", block.alias("block"))))
    return cues.groupBy(key).agg(F.concat(F.array_join(F.transform(rows, lambda r: r["block"]), "\n"), F.lit("\n")).alias("srt"))


def write_captions(cues: DataFrame, key: str, path: str) -> None:
    """Caption files in folders by the key."""
    caption_text(cues, key).withColumn("recording", F.col(key)).select("recording", F.col("srt").alias("value")).write.mode("overwrite").partitionBy("recording").text(path)


def write_cards(cards: DataFrame, key: str, path: str) -> None:
    """Card spans (index, start, end, text) as JSON in folders by the key."""
    cards.select(F.col(key).alias("recording"), "index", "start", "end", "text").write.mode("overwrite").partitionBy("recording").json(path)


def ingest_status(downloads: DataFrame) -> DataFrame:
    """downloads (key, type, return_code, bytes) with size_mb and status: under a megabyte counts as failed."""
    mb = F.floor(F.coalesce("bytes", F.lit(0)) / (1024 * 1024)).cast("long")
    return downloads.withColumns({"size_mb": mb, "status": F.when((F.col("return_code") == 0) & (mb > 0), "ok").otherwise("FAILED")})
