"""Queries of the identity, tracking and series operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import identity as idn
from ..operators import series as ser
from ..operators import tracking as trk
from . import views
from .views import BOXES, FACES, HEIGHT, WIDTH

QUERIES: dict = {}
SQL: dict[str, str] = {}
EVERY = 4


def query(sql: str | None = None):
    def add(fn_):
        QUERIES[fn_.__name__] = fn_
        if sql:
            SQL[fn_.__name__] = sql
        return fn_

    return add


DOT = "list_dot_product({0}, {1})"
MEANS = f"""{FACES},
places AS (SELECT rec, label, unnest(range(1, len(embedding) + 1)) AS place, unnest(embedding) AS x FROM faces),
elements AS (SELECT rec, label, place, avg(x) AS x FROM places GROUP BY ALL),
means AS (SELECT rec, label, list(x ORDER BY place) AS mean FROM elements GROUP BY ALL),
centroids AS (SELECT rec, label, list_transform(mean, lambda x: x / sqrt(list_dot_product(mean, mean))) AS centroid FROM means),
counts AS (SELECT rec, label, count(*) AS n, count(*) FILTER (is_uniform) AS n_uniform, avg(box_area) AS mean_box_area FROM faces GROUP BY ALL),
stats AS (
  SELECT c.rec, c.label, n, n_uniform, mean_box_area, n_uniform / greatest(1, sum(n_uniform) OVER (PARTITION BY c.rec)) AS share, centroid
  FROM counts c JOIN centroids m ON m.rec = c.rec AND m.label = c.label),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY n_uniform DESC, n DESC, label) AS rank FROM stats),
merged AS (
  SELECT r.*, {DOT.format("r.centroid", "t.centroid")} AS top_sim FROM ranked r JOIN ranked t ON t.rec = r.rec AND t.rank = 1
  WHERE r.rank = 1 OR {DOT.format("r.centroid", "t.centroid")} >= 0.0)"""


def stats(spark, d) -> DataFrame:
    return idn.cluster_stats(views.faces(spark, d), ["rec"])


def rank(spark, d) -> DataFrame:
    return idn.ranked(stats(spark, d), ["rec"])


def merged(spark, d) -> DataFrame:
    return idn.merged_identity(rank(spark, d), ["rec"], 0.0)


@query(f"WITH {MEANS} SELECT rec, label, n, n_uniform, round(share, 6) AS share, round(mean_box_area, 6) AS mean_box_area, round(centroid[1], 6) AS c0, round(list_dot_product(centroid, centroid), 6) AS norm FROM stats")
def cluster_stats(spark, d) -> DataFrame:
    """A5, F6."""
    return stats(spark, d).select("rec", "label", "n", "n_uniform", F.round("share", 6).alias("share"), F.round("mean_box_area", 6).alias("mean_box_area"), F.round(F.col("centroid")[0], 6).alias("c0"), F.round(fn.dot(F.col("centroid"), F.col("centroid")), 6).alias("norm"))


@query(f"WITH {MEANS} SELECT rec, label, rank, n, n_uniform FROM ranked")
def cluster_rank(spark, d) -> DataFrame:
    """O2."""
    return rank(spark, d).select("rec", "label", F.col("rank").cast("long").alias("rank"), "n", "n_uniform")


@query(f"WITH {MEANS} SELECT rec, label, n, round(top_sim, 6) AS top_sim FROM merged")
def identity_merge(spark, d) -> DataFrame:
    """J10."""
    return merged(spark, d).select("rec", "label", "n", F.round("top_sim", 6).alias("top_sim"))


@query(f"""WITH {MEANS},
own AS (SELECT rec, sum(n) AS own, string_agg(label, ',' ORDER BY rank) AS instructor_labels FROM merged GROUP BY rec)
SELECT r.rec, sum(n) AS n_faces, count(*) AS n_clusters, string_agg(printf('%.4f', round(share, 4)), ',' ORDER BY rank) AS shares, any_value(instructor_labels) AS instructor_labels,
       round(any_value(own) / sum(n), 4) AS instructor_share, max(share) FILTER (rank = 1) < 0.2 AS weak
FROM ranked r JOIN own USING (rec) GROUP BY r.rec""")
def identity_summary(spark, d) -> DataFrame:
    """A6, D17 and Q17."""
    out = idn.identity_summary(rank(spark, d), merged(spark, d), ["rec"], 0.2)
    text = lambda c: F.array_join(c, ",")
    return out.withColumns({"shares": text(F.transform("shares", lambda x: F.format_string("%.4f", x))), "instructor_labels": text(F.col("instructor_labels").cast("array<string>"))})


@query(f"""WITH {MEANS} SELECT rec, label, pos, example FROM (
  SELECT f.rec, f.label, f.pos, row_number() OVER (PARTITION BY f.rec, f.label ORDER BY f.pos) AS example FROM faces f JOIN ranked r ON r.rec = f.rec AND r.label = f.label WHERE rank <= 8) WHERE example <= 12""")
def cluster_examples(spark, d) -> DataFrame:
    """O5, K10's selection."""
    return idn.examples(views.faces(spark, d), rank(spark, d), ["rec"], "pos").select("rec", "label", "pos", F.col("example").cast("long").alias("example"))


SIMS = f"""{MEANS}, sims AS (
  SELECT f.rec, f.pos, max({DOT.format("f.embedding", "m.centroid")}) AS sim FROM faces f LEFT JOIN merged m ON m.rec = f.rec GROUP BY f.rec, f.pos)"""


@query(f"WITH {SIMS} SELECT rec, pos, round(sim, 6) AS sim, round(sim, 6) >= 0.25 AS kept FROM sims")
def top_match(spark, d) -> DataFrame:
    """Each face against its recording's prototypes."""
    protos = merged(spark, d).select("rec", F.col("centroid").alias("proto"))
    out = idn.best_similarity(views.faces(spark, d), protos, "rec")
    return out.select("rec", "pos", F.round("sim", 6).alias("sim"), (F.round("sim", 6) >= 0.25).alias("kept"))


@query("""SELECT user_id AS rec, event_id AS pos, round(recent, 6) AS recent, recent >= 100 AS decided FROM (
  SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent FROM events)""")
def recent_median(spark, d) -> DataFrame:
    """W6 and O7."""
    samples = views.said(spark, d).select("rec", "pos", "start", F.col("value").alias("sim"))
    return idn.recent_median(samples, ["rec"], ["start", "pos"], 100.0).select("rec", "pos", F.round("recent", 6).alias("recent"), "decided")


RECORDINGS = "recordings AS (SELECT o_orderkey AS rec, CAST(o_orderkey % 7 * 10 AS BIGINT) AS start_frame, CAST(o_orderkey % 7 * 10 + o_totalprice / 50 AS BIGINT) AS end_frame, CAST(25 AS DOUBLE) AS fps FROM orders)"


def recordings(spark, d) -> DataFrame:
    key = F.col("o_orderkey")
    start = F.pmod(key, F.lit(7)) * 10
    return views.table(spark, d, "orders").select(key.alias("rec"), start.alias("start_frame"), F.rint(start + F.col("o_totalprice") / 50).cast("long").alias("end_frame"), F.lit(25.0).alias("fps"))


def spaced_sql(first: str, last: str, n: str) -> str:
    return f"list_transform(range(greatest({n}, 1)), lambda i: CASE WHEN i = {n} - 1 AND {n} > 1 THEN CAST({last} AS BIGINT) ELSE CAST(trunc({first} + i * CASE WHEN {n} > 1 THEN ({last} - {first}) / ({n} - 1) ELSE 0 END) AS BIGINT) END)"


@query(f"""WITH {RECORDINGS.replace("CAST(o_orderkey % 7 * 10 + o_totalprice / 50 AS BIGINT)", "CAST(round_even(o_orderkey % 7 * 10 + o_totalprice / 50, 0) AS BIGINT)")},
sized AS (SELECT *, end_frame - 1 AS last, least(400, greatest(1, end_frame - start_frame)) AS n, least(end_frame - 1, start_frame + CAST(trunc(20 * fps) AS BIGINT)) AS opening FROM recordings),
counted AS (SELECT *, least(60, opening - start_frame) AS k FROM sized),
lists AS (SELECT rec, {spaced_sql("start_frame", "last", "n")} AS uniform, CASE WHEN opening > start_frame THEN {spaced_sql("start_frame", "opening", "k")} ELSE [] END AS opening FROM counted)
SELECT rec, frame, list_contains(uniform, frame) AS is_uniform FROM (SELECT rec, uniform, unnest(list_distinct(list_concat(uniform, opening))) AS frame FROM lists)""")
def sample_frames(spark, d) -> DataFrame:
    """The even and the opening sample of each recording."""
    return idn.sample_frames(recordings(spark, d), "rec")


@query(f"""WITH {RECORDINGS.replace("CAST(o_orderkey % 7 * 10 + o_totalprice / 50 AS BIGINT)", "CAST(round_even(o_orderkey % 7 * 10 + o_totalprice / 50, 0) AS BIGINT)")},
cuts AS (SELECT rec, {spaced_sql("start_frame", "end_frame", "9")} AS cuts FROM recordings)
SELECT rec, chunk, cuts[chunk] AS from_frame, cuts[chunk + 1] AS to_frame FROM (SELECT rec, cuts, unnest(range(1, 9)) AS chunk FROM cuts)""")
def chunk_bounds(spark, d) -> DataFrame:
    """Eight chunks of each recording."""
    return idn.chunk_bounds(recordings(spark, d), "rec", 8).withColumn("chunk", F.col("chunk").cast("long"))


IOU = """CASE WHEN least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1) THEN
  (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))
  / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))) ELSE 0 END"""


@query(f"""WITH {BOXES} SELECT a.rec, a.frame, a.det_pos AS a_pos, b.det_pos AS b_pos, round({IOU}, 6) AS iou
FROM boxes a JOIN boxes b ON b.rec = a.rec AND b.frame = a.frame + 4""")
def iou_pairs(spark, d) -> DataFrame:
    """F4 over boxes of consecutive samples (J7's candidates)."""
    seen = views.boxes(spark, d)
    one = seen.select("rec", "frame", F.col("det_pos").alias("a_pos"), *[F.col(c).alias(f"a_{c}") for c in trk.BOX])
    two = seen.select("rec", (F.col("frame") - EVERY).alias("frame"), F.col("det_pos").alias("b_pos"), *[F.col(c).alias(f"b_{c}") for c in trk.BOX])
    return one.join(two, ["rec", "frame"]).select("rec", "frame", "a_pos", "b_pos", F.round(fn.iou("a_", "b_"), 6).alias("iou"))


@query(f"WITH {BOXES} SELECT rec, frame, det_pos, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, round(sqrt((x2 - x1) * (y2 - y1)), 6) AS face FROM boxes QUALIFY row_number() OVER (PARTITION BY rec, frame ORDER BY (x2 - x1) * (y2 - y1) DESC, det_pos) = 1")
def largest_box(spark, d) -> DataFrame:
    """A7 and F7."""
    return ser.largest(views.boxes(spark, d), ["rec"]).select("rec", "frame", "det_pos", "cx", "cy", F.round("face", 6).alias("face"))


@query(f"""WITH {BOXES}, whole AS (SELECT rec, frame, det_pos, CAST(trunc(x1) AS BIGINT) AS a, CAST(trunc(y1) AS BIGINT) AS b, CAST(trunc(x2) AS BIGINT) AS c, CAST(trunc(y2) AS BIGINT) AS d FROM boxes),
padded AS (SELECT rec, frame, det_pos, greatest(0, CAST(trunc(a - 0.2::DOUBLE * (c - a)) AS BIGINT)) AS px1, greatest(0, CAST(trunc(b - 0.2::DOUBLE * (d - b)) AS BIGINT)) AS py1,
  least({WIDTH}, CAST(trunc(c + 0.2::DOUBLE * (c - a)) AS BIGINT)) AS px2, least({HEIGHT}, CAST(trunc(d + 0.2::DOUBLE * (d - b)) AS BIGINT)) AS py2 FROM whole)
SELECT *, greatest(2, least(12, (px2 - px1) // 8)) AS blocks_x, greatest(2, least(12, (py2 - py1) // 8)) AS blocks_y FROM padded""")
def padded_boxes(spark, d) -> DataFrame:
    """F8 and F9."""
    out = views.boxes(spark, d).withColumns(fn.padded_box("", WIDTH, HEIGHT))
    return out.select("rec", "frame", "det_pos", "px1", "py1", "px2", "py2", fn.blocks(F.col("px2") - F.col("px1")).alias("blocks_x"), fn.blocks(F.col("py2") - F.col("py1")).alias("blocks_y"))


def lengths(spark, d) -> DataFrame:
    """Recordings of the boxes: rec, n_frames, width, height."""
    return views.boxes(spark, d).groupBy("rec").agg((F.max("frame") + 6).alias("n_frames")).withColumns({"width": F.lit(WIDTH).cast("long"), "height": F.lit(HEIGHT).cast("long")})


LENGTHS = "lengths AS (SELECT rec, max(frame) + 6 AS n_frames FROM boxes GROUP BY rec)"


@query(f"""WITH {BOXES}, {LENGTHS}, hits AS (SELECT rec, count(DISTINCT frame) AS hits FROM boxes WHERE sim >= 0.45 GROUP BY rec)
SELECT rec, coalesce(hits, 0) AS hits, round(coalesce(hits, 0) / (n_frames / 4) * 100, 6) AS rate, coalesce(hits, 0) / (n_frames / 4) * 100 <= 40 AS low FROM lengths LEFT JOIN hits USING (rec)""")
def hit_rate(spark, d) -> DataFrame:
    """A8, Q18 and P9."""
    found = views.boxes(spark, d).filter("sim >= 0.45").filter(f"frame % {EVERY} = 0")
    return ser.hit_rate(found, lengths(spark, d), "rec", EVERY).withColumn("rate", F.round("rate", 6))


def tracks(spark, d) -> DataFrame:
    return trk.tracked(views.boxes(spark, d), ["rec"], EVERY)


@query()
def track_faces(spark, d) -> DataFrame:
    """J6, W11 and X10's first pass; P16 is its filter on is_main."""
    return tracks(spark, d)


@query()
def track_totals(spark, d) -> DataFrame:
    """A11."""
    return trk.track_summary(tracks(spark, d), ["rec"])


@query()
def face_cover(spark, d) -> DataFrame:
    """W10 with J7 and J8 over the boxes to hide."""
    hidden = tracks(spark, d).filter("not is_main").groupBy("rec", "frame").agg(F.transform(F.array_sort(F.collect_list(F.struct("det_pos", *trk.BOX))), lambda b: F.struct(*[b[c].alias(c) for c in trk.BOX])).alias("boxes"))
    grid = views.boxes(spark, d).select("rec", "frame").distinct().join(lengths(spark, d).select("rec", "n_frames"), "rec")
    empty = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    return trk.covered(grid.join(hidden, ["rec", "frame"], "left").withColumn("boxes", F.coalesce("boxes", empty)), ["rec"], EVERY)


def known(spark, d) -> DataFrame:
    """The main person's place where seen: rec, frame, cx, cy."""
    return ser.largest(views.boxes(spark, d).filter("sim >= 0.3"), ["rec"]).select("rec", "frame", (F.col("cx") * 10).alias("cx"), (F.col("cy") * 8).alias("cy"))


KNOWN = f"""{BOXES}, {LENGTHS},
known AS (SELECT rec, frame, (x1 + x2) / 2 * 10 AS cx, (y1 + y2) / 2 * 8 AS cy FROM boxes WHERE sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY rec, frame ORDER BY (x2 - x1) * (y2 - y1) DESC, det_pos) = 1),
grid AS (SELECT rec, unnest(range(n_frames)) AS frame FROM lengths),
around AS (
  SELECT g.rec, g.frame, last_value(k.frame IGNORE NULLS) OVER b AS f0, last_value(cx IGNORE NULLS) OVER b AS x0, last_value(cy IGNORE NULLS) OVER b AS y0,
         first_value(k.frame IGNORE NULLS) OVER f AS f1, first_value(cx IGNORE NULLS) OVER f AS x1, first_value(cy IGNORE NULLS) OVER f AS y1
  FROM grid g LEFT JOIN known k ON k.rec = g.rec AND k.frame = g.frame
  WINDOW b AS (PARTITION BY g.rec ORDER BY g.frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY g.rec ORDER BY g.frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
line AS (SELECT rec, frame,
  CASE WHEN f0 IS NULL THEN x1 WHEN f1 IS NULL OR f0 = f1 THEN x0 ELSE x0 + (x1 - x0) / (f1 - f0) * (frame - f0) END AS cx,
  CASE WHEN f0 IS NULL THEN y1 WHEN f1 IS NULL OR f0 = f1 THEN y0 ELSE y0 + (y1 - y0) / (f1 - f0) * (frame - f0) END AS cy FROM around)"""
WINDOW = 11
HANN = ", ".join(f"({k - WINDOW // 2}, {w!r}::DOUBLE)" for k, w in enumerate(ser.hann_weights(WINDOW)))
SMOOTH = f"""{KNOWN}, filled AS (SELECT rec, frame, coalesce(cx, {WIDTH / 2}) AS cx, coalesce(cy, {HEIGHT / 2}) AS cy FROM line),
weights(k, w) AS (VALUES {HANN}),
smooth AS (
  SELECT f.rec, f.frame, CASE WHEN any_value(n_frames) < 3 THEN any_value(f.cx) ELSE sum(o.cx * w) END AS cx, CASE WHEN any_value(n_frames) < 3 THEN any_value(f.cy) ELSE sum(o.cy * w) END AS cy
  FROM filled f JOIN lengths l USING (rec) CROSS JOIN weights JOIN filled o ON o.rec = f.rec AND o.frame = greatest(0, least(n_frames - 1, f.frame + k)) GROUP BY f.rec, f.frame)"""
CW, CH = WIDTH // 2, HEIGHT // 2


def line(spark, d) -> DataFrame:
    return ser.interpolated(known(spark, d), lengths(spark, d), "rec", ["cx", "cy"])


def filled(spark, d) -> DataFrame:
    return line(spark, d).withColumns({"cx": F.coalesce("cx", F.lit(WIDTH / 2)), "cy": F.coalesce("cy", F.lit(HEIGHT / 2))})


@query(f"WITH {KNOWN} SELECT rec, frame, round(cx, 6) AS cx, round(cy, 6) AS cy FROM line")
def interpolate(spark, d) -> DataFrame:
    """W7 and J13."""
    return line(spark, d).select("rec", "frame", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(f"WITH {SMOOTH} SELECT rec, frame, round(cx, 4) AS cx, round(cy, 4) AS cy FROM smooth")
def smooth(spark, d) -> DataFrame:
    """W8."""
    return ser.smoothed(filled(spark, d), "rec", ["cx", "cy"], WINDOW, in_order=True).select("rec", "frame", F.round("cx", 4).alias("cx"), F.round("cy", 4).alias("cy"))


BAND = """WITH RECURSIVE points AS (SELECT user_id AS rec, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, value AS v FROM events),
band AS (
  SELECT rec, frame, v AS out FROM points WHERE frame = 0
  UNION ALL SELECT p.rec, p.frame, CASE WHEN abs(p.v - b.out) > 50 THEN p.v - sign(p.v - b.out) * 50 ELSE b.out END FROM band b JOIN points p ON p.rec = b.rec AND p.frame = b.frame + 1)
SELECT rec, frame, round(out, 6) AS v FROM band"""


@query(BAND)
def dead_band(spark, d) -> DataFrame:
    """W9."""
    w = Window.partitionBy("rec").orderBy("start", "pos")
    points = views.said(spark, d).select("rec", (F.row_number().over(w) - 1).cast("long").alias("frame"), F.col("value").alias("v"))
    return ser.dead_band(points, "rec", ["v"], 50.0).withColumn("v", F.round("v", 6))


PATH = f"""{SMOOTH}, path AS (
  SELECT rec, frame, greatest(0, least({WIDTH - CW}, CAST(round_even(round(cx - {CW / 2}, 6), 0) AS BIGINT))) AS x, greatest(0, least({HEIGHT - CH}, CAST(round_even(round(cy + {CH * 0.1} - {CH / 2}, 6), 0) AS BIGINT))) AS y FROM smooth)"""


def path(spark, d) -> DataFrame:
    return ser.crop_path(known(spark, d), lengths(spark, d), "rec", zoom=0.5, smooth_s=WINDOW / 25)


@query(f"WITH {PATH} SELECT rec, frame, x, y, {CW} AS cw, {CH} AS ch FROM path")
def crop_path(spark, d) -> DataFrame:
    """W14, F17 and X9's output."""
    return path(spark, d)


@query(f"WITH {PATH}, steps AS (SELECT rec, abs(x - lag(x) OVER (PARTITION BY rec ORDER BY frame)) AS step FROM path) SELECT rec, round(avg(step), 6) AS mean_pan FROM steps GROUP BY rec")
def mean_pan(spark, d) -> DataFrame:
    """A9."""
    return ser.mean_pan(path(spark, d), "rec", in_order=True).withColumn("mean_pan", F.round("mean_pan", 6))


@query()
def cluster_faces(spark, d) -> DataFrame:
    """Agglomeration of each recording's faces."""
    return idn.clustered(views.faces(spark, d), "rec", "pos", 0.9)
