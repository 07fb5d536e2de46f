"""Queries of guards, saved answers and files, reclassification and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import layout
from ..operators import guards, identity as idn
from ..operators import speech as sp
from ..sources import readers as rd
from ..sources import saved
from . import kept, seen, views
from .views import SEGMENTS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn_):
        QUERIES[fn_.__name__] = fn_
        if sql:
            SQL[fn_.__name__] = sql
        return fn_

    return add


WINDOWS = """asked AS (SELECT o_orderkey AS rec, CAST(trunc(o_totalprice / 100) AS BIGINT) AS n_frames, CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 50) * 0.75::DOUBLE END AS start_s,
  CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 70) * 0.9::DOUBLE END AS end_s, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 * 100 END AS max_frames, CASE WHEN o_orderkey % 6 <> 0 THEN CAST(trunc(o_totalprice / 300) AS BIGINT) END AS existing_frames FROM orders),
begun AS (SELECT *, CAST(trunc(coalesce(start_s, 0) * 25) AS BIGINT) AS start_frame FROM asked),
cut AS (SELECT *, least(coalesce(CAST(trunc(end_s * 25) AS BIGINT), n_frames), CASE WHEN max_frames > 0 THEN start_frame + max_frames ELSE n_frames END, n_frames) AS end_frame FROM begun),
windows AS (SELECT *, greatest(0, end_frame - start_frame) AS total FROM cut)"""


def windows(spark, d) -> DataFrame:
    key = F.col("o_orderkey")
    mod = lambda n: F.pmod(key, F.lit(n))
    asked = views.table(spark, d, "orders").select(
        key.alias("rec"), (F.col("o_totalprice") / 100).cast("long").alias("n_frames"), F.lit(25.0).alias("fps"), F.when(mod(3) != 0, mod(50) * 0.75).alias("start_s"), F.when(mod(4) != 0, mod(70) * 0.9).alias("end_s"),
        F.when(mod(5) != 0, mod(7) * 100).alias("max_frames"), F.when(mod(6) != 0, (F.col("o_totalprice") / 300).cast("long")).alias("existing_frames"),
    )
    return guards.frame_window(asked, strict=False)


@query(f"WITH {WINDOWS} SELECT rec, start_frame, end_frame, total, total = 0 AS empty FROM windows")
def frame_windows(spark, d) -> DataFrame:
    """The frames of a run; an empty window is marked here and an error by default."""
    return windows(spark, d).select("rec", "start_frame", "end_frame", "total", "empty")


@query(f"WITH {WINDOWS} SELECT rec, total < n_frames AS partial, total < n_frames AND coalesce(existing_frames > total * 2, FALSE) AS refused FROM windows")
def overwrite_guard(spark, d) -> DataFrame:
    """Q15."""
    return guards.overwrite_guard(windows(spark, d)).select("rec", "partial", "refused")


def classified(spark, d) -> DataFrame:
    rows = views.segments(spark, d)
    return rows.withColumnRenamed("flag", "is_student_question").withColumn("question_source", F.when(F.col("pos") % 2 == 0, "instructor_repeat_back"))


@query(f"WITH {SEGMENTS} SELECT rec, pos, coalesce(ends_with(rtrim(text), '?'), FALSE) AS is_question, text FROM segments")
def reclassified(spark, d) -> DataFrame:
    """P14 with X2 and J3: earlier verdicts are dropped, and the rule's are merged."""
    fresh = guards.reset_verdicts(classified(spark, d))
    verdicts = sp.classified(fresh, "text", sp.question_rule).select("rec", "pos", F.col("verdict.is_question").alias("is_question"), F.col("text").alias("question"))
    return sp.merged_verdicts(fresh.drop("is_question"), verdicts, "rec", "pos").select("rec", "pos", "is_question", "text")


def even_reply(items: list[dict]) -> str:
    """A classifier of a batch for the queries: an even position is a question; every third batch by its first position can't be read."""
    import json

    if items[0]["pos"] % 3 == 1:
        return "no JSON"
    return json.dumps([{"index": x["pos"], "is_repeat_back": x["pos"] % 2 == 0, "text": x["student"][:160]} for x in items])


def replied(spark, d) -> DataFrame:
    items = views.segments(spark, d).filter("flag or pos % 2 = 0").select("rec", "pos", F.coalesce("text", F.lit("")).alias("student"), F.lit("").alias("follows"))
    return sp.batch_replies(items, "rec", "pos", even_reply, 2)


REPLIED = f"""{SEGMENTS}, items AS (SELECT rec, pos, coalesce(text, '') AS student, (row_number() OVER (PARTITION BY rec ORDER BY pos) - 1) // 2 AS batch FROM segments WHERE flag OR pos % 2 = 0),
batches AS (SELECT rec, batch, min(pos) % 3 = 1 AS skipped, count(*) AS items FROM items GROUP BY ALL)"""


@query(f"WITH {REPLIED} SELECT rec, pos, pos % 2 = 0 AS is_repeat, substr(student, 1, 160) AS text FROM items JOIN batches USING (rec, batch) WHERE NOT skipped")
def repeat_back_replies(spark, d) -> DataFrame:
    """A classifier asked batch by batch; what it says of the batches that could be read."""
    return sp.read_replies(replied(spark, d), "rec", "pos")


@query(f"WITH {REPLIED} SELECT rec, count(*) AS batches, count(*) FILTER (skipped) AS skipped, CAST(coalesce(sum(items) FILTER (skipped), 0) AS BIGINT) AS items_skipped FROM batches GROUP BY rec")
def repeat_back_skips(spark, d) -> DataFrame:
    """The batches whose reply could not be read, counted."""
    return sp.skipped_batches(replied(spark, d), "rec")


@query(f"WITH {SEGMENTS} SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY pos) - 1 AS seg_pos, start, \"end\", text, speaker FROM segments")
def transcript_files(spark, d) -> DataFrame:
    """Each recording's segments as one file's text, read again."""
    files = saved.transcript_text(views.segments(spark, d), "rec", "pos")
    return saved.transcript_rows(files, "rec").select("rec", F.col("seg_pos").cast("long").alias("seg_pos"), "start", "end", "text", "speaker")


def path_files(spark, d) -> DataFrame:
    recordings = seen.lengths(spark, d).withColumn("fps", F.lit(25.0))
    return saved.path_text(seen.known(spark, d), seen.path(spark, d), recordings, "rec")


@query(f"WITH {seen.KNOWN} SELECT k.rec, k.frame, cx, cy, least(n_frames, 20) AS n_frames FROM known k JOIN lengths USING (rec)")
def path_reload(spark, d) -> DataFrame:
    """Paths saved with their detections and read again under a cap of frames."""
    known, recordings = saved.saved_paths(path_files(spark, d), "rec", F.lit(20).cast("long"))
    return known.join(recordings.select("rec", "n_frames"), "rec")


@query(f"""WITH {seen.BOXES}, {seen.LENGTHS}, lists AS (SELECT rec, {seen.spaced_sql("0::DOUBLE", "n_frames - 1", "6")} AS frames FROM lengths)
SELECT rec, unnest(range(1, 7)) AS place, unnest(frames) AS frame FROM lists""")
def overlay_frames(spark, d) -> DataFrame:
    """The six frames of a contact sheet."""
    frames = idn.spaced(F.lit(0.0), F.col("n_frames").cast("double") - 1, F.lit(6))
    return seen.lengths(spark, d).select("rec", F.posexplode(frames).alias("place", "frame")).select("rec", (F.col("place") + 1).cast("long").alias("place"), "frame")


def listing(spark, d) -> DataFrame:
    """Pages of three sessions for each customer, made of orders; the first session of a page repeats on the next."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = views.table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.row_number().over(w) - 1).alias("i"))
    at = F.floor(F.col("i") / 3)
    again = F.when((F.col("i") % 3 == 0), F.array(at, at + 1)).otherwise(F.array(at))
    one = F.struct(F.col("o_orderkey").cast("string").alias("DeliveryID"), F.concat(F.lit("s/"), F.col("o_orderkey").cast("string")).alias("SessionID"), F.concat(F.lit("name "), F.col("o_orderkey").cast("string")).alias("SessionName"))
    dealt = rows.select("o_custkey", "i", F.explode(again).alias("page"), one.alias("r"))
    results = F.transform(F.array_sort(F.collect_list(F.struct("i", "r"))), lambda x: x["r"])
    return dealt.groupBy(F.col("o_custkey").alias("folder"), "page").agg(F.to_json(F.struct(F.struct(results.alias("Results")).alias("d"))).alias("body"))


@query("""WITH numbered AS (SELECT o_custkey AS folder, o_orderkey AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT folder, i // 3 AS page, CASE WHEN i >= 3 THEN i % 3 + 1 ELSE i END AS pos, n::VARCHAR AS "DeliveryID", 's/' || n AS "SessionID", 'name ' || n AS "SessionName" FROM numbered""")
def session_list(spark, d) -> DataFrame:
    """S3: the sessions of all pages of a listing, each once."""
    out = saved.sessions(listing(spark, d), "folder")
    return out.withColumn("pos", F.col("pos").cast("long"))


@query("SELECT c_custkey AS search, 'f' || c_custkey AS folder_id FROM customer")
def first_folders(spark, d) -> DataFrame:
    """The first folder that a search found."""
    name = lambda extra: F.struct(F.concat(F.lit(f"f{extra}"), F.col("c_custkey").cast("string")).alias("Id"))
    answers = views.table(spark, d, "customer").select(F.col("c_custkey").alias("search"), F.to_json(F.array(name(""), name("x"))).alias("body"))
    return saved.first_folder(answers, "search")


@query("SELECT '15_210_s_' || o_orderkey AS key, 'name ' || o_orderkey AS name, round(o_totalprice / 10, 6) AS \"durationSec\", CASE WHEN (o_orderkey // 10) % 3 < 3 THEN 2 END AS n_streams FROM orders WHERE o_orderkey % 2 = 1")
def session_assets(spark, d) -> DataFrame:
    """Listed sessions joined with their saved asset; those without one are left out."""
    orders = views.table(spark, d, "orders")
    listed = orders.select(F.col("o_orderkey").cast("string").alias("DeliveryID"), F.concat(F.lit("s/"), F.col("o_orderkey").cast("string")).alias("SessionID"))
    made = kept.assets(spark, d).filter(F.substring("SessionId", -1, 1).isin(*"13579"))
    answers = made.select(F.substring("SessionId", 3, 20).alias("DeliveryID"), F.to_json(F.struct(*[c for c in made.columns if c != "SessionId"])).alias("body"))
    manifest = rd.entries(saved.with_assets(listed, answers), F.lit("15/210"))
    return manifest.select("key", "name", F.round("durationSec", 6).alias("durationSec"), F.size("streams").alias("n_streams"))


@query("""WITH files AS (SELECT o_orderkey AS rec, o_orderkey % 13 <> 0 AS path_exists, o_orderkey % 11 <> 0 AS readable, o_orderkey % 5 <> 0 AS video, o_orderkey % 3 <> 0 AS audio, CAST(trunc(o_totalprice) AS BIGINT) AS size, o_totalprice FROM orders)
SELECT rec, path_exists, CASE WHEN path_exists AND readable THEN size END AS size, CASE WHEN path_exists AND readable THEN rec % 100 / 4.0::DOUBLE END AS duration, CASE WHEN path_exists AND readable THEN video END AS has_video,
  CASE WHEN path_exists AND readable THEN audio END AS has_audio, CASE WHEN path_exists AND readable AND video THEN CASE WHEN rec % 7 = 0 THEN 0.0::DOUBLE ELSE 25.0::DOUBLE END END AS fps, CASE WHEN path_exists AND readable AND video THEN 1280 END AS width,
  CASE WHEN path_exists AND readable AND video THEN 720 END AS height, CASE WHEN path_exists AND readable AND video THEN CASE WHEN rec % 4 = 0 THEN 0 ELSE rec END END AS n_frames FROM files""")
def probe_reports(spark, d) -> DataFrame:
    """Probe reports read, those that fail as unreadable."""
    key = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    mod = lambda n: F.pmod(key, F.lit(n))
    video = F.when(mod(5) != 0, F.struct(F.lit("video").alias("codec_type"), F.lit("1280").alias("width"), F.lit("720").alias("height"), F.when(mod(7) == 0, "25/0").otherwise("50/2").alias("r_frame_rate"), F.when(mod(4) != 0, text(key)).alias("nb_frames")))
    audio = F.when(mod(3) != 0, F.struct(F.lit("audio").alias("codec_type"), *[F.lit(None).cast("string").alias(c) for c in ("width", "height", "r_frame_rate", "nb_frames")]))
    size = F.col("o_totalprice").cast("long")
    body = F.to_json(F.struct(F.array_compact(F.array(audio, video)).alias("streams"), F.struct(text(mod(100) / 4.0).alias("duration"), F.when(mod(2) == 0, text(size)).alias("size")).alias("format")))
    reports = views.table(spark, d, "orders").select(key.alias("rec"), (mod(13) != 0).alias("path_exists"), size.alias("file_size"), F.when(mod(11) != 0, body).otherwise(F.lit("{broken")).alias("body"))
    return saved.probes(reports, ["rec"])


@query("SELECT c.c_custkey AS run, count(*) AS stages, round(sum(o_totalprice) / 60, 4) AS minutes, round(CASE WHEN c.c_custkey % 4 <> 0 THEN abs(any_value(c_acctbal)) * 1000 / 1e6 END, 6) AS final_mb FROM orders JOIN customer c ON c.c_custkey = o_custkey GROUP BY c.c_custkey")
def run_totals(spark, d) -> DataFrame:
    """A run's stages, minutes and the size of its final file."""
    stages = views.table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.col("o_totalprice").alias("seconds"))
    final = views.table(spark, d, "customer").filter(F.pmod("c_custkey", F.lit(4)) != 0).select(F.col("c_custkey").alias("run"), (F.abs("c_acctbal") * 1000).alias("size"))
    return guards.run_summary(stages, final, "run").withColumns({"minutes": F.round("minutes", 4), "final_mb": F.round("final_mb", 6)})


@query("SELECT o_orderkey AS rec, round(least(0.40, o_totalprice / 100000 / 4), 6) AS fade, CAST(trunc(least(800, o_totalprice / 100000 * 1000 / 4)) AS BIGINT) AS sound_delay FROM orders")
def card_timing(spark, d) -> DataFrame:
    """F21."""
    length = F.col("o_totalprice") / 100000
    return views.table(spark, d, "orders").select(F.col("o_orderkey").alias("rec"), F.round(layout.card_fade(length), 6).alias("fade"), layout.card_sound_delay(length).alias("sound_delay"))
