"""Queries of the interval and speech operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import intervals as iv
from ..operators import speech as sp
from ..sources import readers as rd
from . import views
from .views import SAID, SEGMENTS

#: Scaled to the events' month: gaps of six hours close, frames are 100 s.
GAP_S, FPS = 21_600.0, 0.01
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn_):
        QUERIES[fn_.__name__] = fn_
        if sql:
            SQL[fn_.__name__] = sql
        return fn_

    return add


LABELS = """totals AS (
  SELECT rec, speaker, sum("end" - start) AS total, min(pos) AS first FROM {0} WHERE speaker IS NOT NULL GROUP BY ALL),
labels AS (
  SELECT rec, speaker AS label, total FROM totals QUALIFY row_number() OVER (PARTITION BY rec ORDER BY round(total, 6) DESC, first) = 1)"""
SEG_LABELS = f"{SEGMENTS}, {LABELS.format('segments')}"


@query(f"WITH {SEG_LABELS} SELECT rec, label, round(total, 6) AS total FROM labels")
def main_speaker(spark, d) -> DataFrame:
    """A1 on transcript segments."""
    return sp.main_speaker(views.segments(spark, d), "rec", ["pos"]).withColumn("total", F.round("total", 6))


@query(f"WITH {SAID}, {LABELS.format('said')} SELECT rec, label, round(total, 6) AS total FROM labels")
def main_speaker_words(spark, d) -> DataFrame:
    """A1 on words."""
    return sp.main_speaker(views.said(spark, d), "rec", ["pos"]).withColumn("total", F.round("total", 6))


@query(f"WITH {SEG_LABELS} SELECT s.rec, pos, speaker FROM segments s JOIN labels USING (rec) WHERE speaker IS DISTINCT FROM label")
def other_segments(spark, d) -> DataFrame:
    """A missing speaker is kept."""
    seg = views.segments(spark, d)
    return sp.others(seg.join(sp.main_speaker(seg, "rec", ["pos"]), "rec"), F.col("label")).select("rec", "pos", "speaker")


MUTE = f"""{SAID},
spoken AS (
  SELECT *, speaker <> 'view' AS other, lag(speaker <> 'view') OVER w AS o1, lag("end") OVER w AS e1, lag(flag) OVER w AS f1
  FROM said WHERE speaker IS NOT NULL WINDOW w AS (PARTITION BY rec ORDER BY start, pos)),
cut AS (
  SELECT *, sum(CASE WHEN NOT other OR o1 IS NULL OR NOT o1 OR start - e1 > {GAP_S} OR flag <> f1 THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY start, pos) AS island FROM spoken),
spans AS (
  SELECT rec, min(start) AS start, arg_max("end", (start, pos)) AS "end", arg_min(flag, (start, pos)) AS flag FROM cut WHERE other GROUP BY rec, island)"""


def mutes(spark, d) -> DataFrame:
    return iv.islands(views.said(spark, d), "rec", ["start", "pos"], F.lit("view"), GAP_S)


@query(f'WITH {MUTE} SELECT rec, round(start, 6) AS start, round("end", 6) AS "end", flag FROM spans')
def mute_spans(spark, d) -> DataFrame:
    """W1."""
    return mutes(spark, d).select("rec", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "flag")


@query(f'WITH {MUTE} SELECT rec, count(*) AS spans, round(sum("end" - start), 6) AS seconds, count(*) FILTER (flag) AS questions FROM spans GROUP BY rec')
def mute_totals(spark, d) -> DataFrame:
    """A2 and A3: spans, muted seconds and questions of each recording."""
    return mutes(spark, d).groupBy("rec").agg(F.count("*").alias("spans"), F.round(F.sum(F.col("end") - F.col("start")), 6).alias("seconds"), F.count_if("flag").alias("questions"))


@query(f'WITH {MUTE} SELECT rec, round(start, 6) AS start, round("end", 6) AS "end" FROM spans WHERE flag')
def question_spans(spark, d) -> DataFrame:
    """Question spans by words."""
    return mutes(spark, d).filter("flag").select("rec", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f'WITH {SEGMENTS} SELECT rec, pos, start, "end", trim(text) AS text FROM segments WHERE flag')
def question_segments(spark, d) -> DataFrame:
    """Question spans by segments."""
    return views.segments(spark, d).filter("flag").select("rec", "pos", "start", "end", fn.stripped(F.col("text")).alias("text"))


@query(f"""WITH {SAID}, moved AS (SELECT rec, start - min(start) OVER (PARTITION BY rec) + rec % 3 * {GAP_S} AS start, "end" - min(start) OVER (PARTITION BY rec) + rec % 3 * {GAP_S} AS "end" FROM said),
reach AS (SELECT *, greatest(0, coalesce(max("end") OVER (PARTITION BY rec ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS r FROM moved),
broken AS (SELECT *, sum(CASE WHEN start > r + {GAP_S} THEN 1 ELSE 0 END) OVER (PARTITION BY rec ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS breaks FROM reach)
SELECT rec, round(coalesce(max(greatest("end", 0)) FILTER (breaks = 0), 0), 6) AS lead FROM broken GROUP BY rec""")
def leading_run(spark, d) -> DataFrame:
    """The black at a recording's head."""
    first = F.min("start").over(views.Window.partitionBy("rec"))
    shift = F.pmod("rec", F.lit(3)) * GAP_S
    moved = views.said(spark, d).select("rec", (F.col("start") - first + shift).alias("start"), (F.col("end") - first + shift).alias("end"))
    return iv.leading_run(moved, "rec", GAP_S).withColumn("lead", F.round("lead", 6))


FRAMED = f"""{SAID},
asked AS (SELECT rec, pos, start, start + value * 6.0::DOUBLE AS "end" FROM said WHERE flag),
framed AS (
  SELECT *, {int(views.MONTH_S * FPS)} AS total, greatest(0, CAST(round_even(start * {FPS}, 0) AS BIGINT)) AS a, least({int(views.MONTH_S * FPS)}, CAST(round_even("end" * {FPS}, 0) AS BIGINT)) AS b FROM asked),
kept AS (SELECT rec, pos, total, a, b FROM framed WHERE b > a),
pushed AS (
  SELECT rec, pos, total, greatest(a, coalesce(max(b) OVER (PARTITION BY rec ORDER BY a, b, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS a, b FROM kept),
clips AS (SELECT * FROM pushed WHERE b > a)"""
PIECES = f"""{FRAMED},
gaps AS (SELECT rec, coalesce(lag(b) OVER (PARTITION BY rec ORDER BY a), 0) AS f, a AS t FROM clips),
tails AS (SELECT r.rec, coalesce(max(b), 0) AS f, {int(views.MONTH_S * FPS)} AS t FROM (SELECT DISTINCT rec FROM said) r LEFT JOIN clips USING (rec) GROUP BY r.rec),
pieces AS (
  SELECT rec, 'card' AS kind, a AS start_frame, b - a AS n_frames, pos AS index FROM clips
  UNION ALL SELECT rec, 'screen', f, t - f, NULL FROM (SELECT * FROM gaps UNION ALL SELECT * FROM tails) WHERE t > f)"""


def asked(spark, d) -> DataFrame:
    return views.said(spark, d).filter("flag").select("rec", "pos", "start", (F.col("start") + F.col("value") * 6.0).alias("end"))


def clips(spark, d) -> DataFrame:
    return iv.clipped(iv.on_frames(asked(spark, d), F.lit(views.MONTH_S), F.lit(FPS)), "rec", "pos")


def pieces(spark, d) -> DataFrame:
    totals = views.said(spark, d).select("rec").distinct().withColumn("total", fn.rounded(F.lit(views.MONTH_S * FPS)))
    return iv.tiled(clips(spark, d), "rec", "pos", totals)


@query(f"WITH {FRAMED} SELECT rec, pos, a, b FROM clips")
def clip_spans(spark, d) -> DataFrame:
    """W3 with P10 and O1."""
    return clips(spark, d).select("rec", "pos", "a", "b")


@query(f"WITH {PIECES} SELECT rec, kind, start_frame, n_frames, index FROM pieces")
def tile_pieces(spark, d) -> DataFrame:
    """W4."""
    return pieces(spark, d)


@query(f"WITH {PIECES} SELECT rec, sum(n_frames) FILTER (kind = 'card') AS card_frames, sum(n_frames) FILTER (kind = 'screen') AS screen_frames, count(*) AS pieces FROM pieces GROUP BY rec")
def piece_totals(spark, d) -> DataFrame:
    """A4."""
    by = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n_frames"))).alias(f"{k}_frames")
    return pieces(spark, d).groupBy("rec").agg(by("card"), by("screen"), F.count("*").alias("pieces"))


UNION = f"""{SAID},
padded AS (SELECT rec, pos, greatest(0, start - 60) AS start, least({views.MONTH_S}, start + value * 60 + 60) AS "end" FROM said WHERE flag),
fresh AS (SELECT *, CASE WHEN coalesce(start > max("end") OVER (PARTITION BY rec ORDER BY start, "end", pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) THEN 1 ELSE 0 END AS fresh FROM padded),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY rec ORDER BY start, "end", pos ROWS UNBOUNDED PRECEDING) AS run FROM fresh),
united AS (SELECT rec, min(start) AS start, max("end") AS "end", arg_min(pos, (start, "end", pos)) AS pos FROM runs GROUP BY rec, run)"""


def united(spark, d) -> DataFrame:
    padded = views.said(spark, d).filter("flag").select("rec", "pos", F.greatest(F.lit(0.0), F.col("start") - 60).alias("start"), F.least(F.lit(views.MONTH_S), F.col("start") + F.col("value") * 60 + 60).alias("end"))
    return iv.united(padded, "rec", ["start", "end", "pos"], "pos")


@query(f"""WITH {UNION},
gaps AS (SELECT rec, coalesce(lag("end") OVER (PARTITION BY rec ORDER BY start), 0) AS f, start AS t FROM united
  UNION ALL SELECT r.rec, coalesce(max("end"), 0), {views.MONTH_S} FROM (SELECT DISTINCT rec FROM said) r LEFT JOIN united USING (rec) GROUP BY r.rec)
SELECT rec, 'card' AS kind, round(start, 6) AS start, round("end" - start, 6) AS dur, pos FROM united
UNION ALL SELECT rec, 'layout', round(f, 6), round(t - f, 6), NULL FROM gaps WHERE t > f""")
def union_pieces(spark, d) -> DataFrame:
    """W5 with P11."""
    durations = views.said(spark, d).select("rec").distinct().withColumn("duration", F.lit(views.MONTH_S))
    return iv.union_tiled(united(spark, d), "rec", "pos", durations).withColumns({"start": F.round("start", 6), "dur": F.round("dur", 6)})


@query(f"""WITH {SEGMENTS}
SELECT q.rec, q.pos, q.start, q."end", string_agg(trim(s.text), ' ' ORDER BY s.pos) AS text
FROM segments q JOIN segments s ON s.rec = q.rec AND s.start < q."end" AND s."end" > q.start WHERE q.flag GROUP BY ALL""")
def span_text(spark, d) -> DataFrame:
    """The text shown over each question's span."""
    seg = views.segments(spark, d)
    spans = seg.filter("flag").select("rec", F.col("pos").alias("q_pos"), "start", "end")
    pairs = iv.overlap_join(spans, seg.select("rec", "pos", "start", "end", fn.stripped(F.col("text")).alias("said")), "rec", 30.0)
    return pairs.groupBy("rec", F.col("q_pos").alias("pos"), F.col("l_start").alias("start"), F.col("l_end").alias("end")).agg(iv.ordered_text("said", ["pos"]).alias("text"))


CANDIDATES = f"""{SEG_LABELS},
asked AS (
  SELECT s.rec, s.pos, s.text, s."end" FROM segments s JOIN labels USING (rec)
  WHERE speaker IS DISTINCT FROM label AND NOT flag AND len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) <= 60),
cands AS (
  SELECT a.rec, a.pos, trim(any_value(a.text)) AS student, substr(string_agg(trim(n.text), ' ' ORDER BY n.pos), 1, {sp.MAX_CHARS}) AS follows
  FROM asked a JOIN segments n ON n.rec = a.rec AND n.pos > a.pos AND n.start - a."end" <= {sp.WINDOW_S} JOIN labels l ON l.rec = n.rec AND n.speaker = l.label
  GROUP BY a.rec, a.pos)"""


def candidates(spark, d) -> DataFrame:
    seg = views.segments(spark, d)
    return sp.repeat_back_candidates(seg, sp.main_speaker(seg, "rec", ["pos"]), "rec", "pos", max_words=60)


@query(f"WITH {CANDIDATES} SELECT rec, pos, student, follows FROM cands")
def repeat_back(spark, d) -> DataFrame:
    """J2 and P5, with O7's first characters."""
    return candidates(spark, d)


@query(f"WITH {CANDIDATES} SELECT rec, pos, CAST((row_number() OVER (PARTITION BY rec ORDER BY pos) - 1) // 2 AS BIGINT) AS batch FROM cands")
def repeat_back_batches(spark, d) -> DataFrame:
    """W12."""
    return sp.batched(candidates(spark, d), "rec", "pos", 2).select("rec", "pos", "batch")


@query(f"""WITH {CANDIDATES}, replies AS (SELECT rec, pos, pos % 2 = 1 AS yes, 'Q: ' || substr(text, 1, 20) AS said_back FROM segments),
good AS (SELECT r.rec, r.pos, said_back FROM replies r SEMI JOIN cands c ON c.rec = r.rec AND c.pos = r.pos WHERE yes)
SELECT s.rec, s.pos, coalesce(said_back, text) AS text, flag OR said_back IS NOT NULL AS flag, CASE WHEN said_back IS NOT NULL THEN 'instructor_repeat_back' END AS question_source
FROM segments s LEFT JOIN good g ON g.rec = s.rec AND g.pos = s.pos""")
def repeat_back_merge(spark, d) -> DataFrame:
    """Positive replies to candidates become questions; others are ignored."""
    seg = views.segments(spark, d)
    replies = seg.select("rec", "pos", (F.pmod("pos", F.lit(2)) == 1).alias("is_repeat"), F.concat(F.lit("Q: "), F.substring("text", 1, 20)).alias("text"))
    return sp.merged_repeats(seg, replies, candidates(spark, d), "rec", "pos").select("rec", "pos", "text", "flag", "question_source")


def long_text(texts: pd.Series) -> pd.DataFrame:
    """The deterministic classifier of these queries: a long text is a question."""
    text = texts.fillna("").str.strip()
    return pd.DataFrame({"is_question": text.str.len() > 200, "question": text.str.slice(0, 160)})


@query(f"""WITH {SEGMENTS} SELECT rec, pos, length(trim(text)) > 200 AS is_question, CASE WHEN length(trim(text)) > 200 THEN substr(trim(text), 1, 160) ELSE text END AS text FROM segments""")
def classify_merge(spark, d) -> DataFrame:
    """Verdicts of all segments merged by position; their number must match."""
    seg = views.segments(spark, d)
    verdicts = sp.classified(seg.select("rec", "pos", "text"), "text", long_text).select("rec", "pos", "verdict.is_question", "verdict.question")
    return sp.merged_verdicts(seg, verdicts, "rec", "pos").select("rec", "pos", "is_question", "text")


SRT = "printf('%02d:%02d:%02d,%03d', {0} // 3600000, {0} // 60000 % 60, {0} // 1000 % 60, {0} % 1000)"
CUES = f"""{SEGMENTS}, shown AS (SELECT *, trim(text) AS t, CAST(round_even(start * 1000, 0) AS BIGINT) AS s0, CAST(round_even("end" * 1000, 0) AS BIGINT) AS s1 FROM segments WHERE trim(text) <> '' AND pos % 4 <> 3),
cues AS (SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY pos) AS cue, {SRT.format("s0")} AS start, {SRT.format("s1")} AS "end", t AS text FROM shown)"""


def cues(spark, d) -> DataFrame:
    seg = views.segments(spark, d).withColumn("text", F.when(F.pmod("pos", F.lit(4)) == 3, F.lit(" \n")).otherwise(F.col("text")))
    return sp.captions(seg, "rec", "pos")


@query(f"WITH {CUES} SELECT * FROM cues")
def captions(spark, d) -> DataFrame:
    """K6, P6, F2 and W13."""
    return cues(spark, d)


@query(f"""WITH {CUES} SELECT rec, string_agg(cue || chr(10) || start || ' --> ' || "end" || chr(10) || text || chr(10), chr(10) ORDER BY cue) || chr(10) AS srt FROM cues GROUP BY rec""")
def caption_files(spark, d) -> DataFrame:
    """K6: the text of each caption file."""
    return rd.caption_text(cues(spark, d), "rec")


@query(f"""WITH {SEGMENTS} SELECT rec, pos, FALSE AS is_question, text FROM segments WHERE pos < 0
UNION ALL SELECT rec, pos, TRUE, reverse(substr(text, 1, 10)) FROM segments""")
def caption_merge(spark, d) -> DataFrame:
    """Corrected texts merged by position (replies are reversed heads here)."""
    seg = views.segments(spark, d)
    fixed = seg.select("rec", "pos", F.lit(True).alias("is_question"), F.reverse(F.substring("text", 1, 10)).alias("question"))
    return sp.merged_verdicts(seg, fixed, "rec", "pos").select("rec", "pos", "is_question", "text")
