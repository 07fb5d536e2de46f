import random

import numpy as np

from talkmill.operators import identity as idn
from talkmill.operators import media as med
from talkmill.operators import series as ser
from talkmill.operators import tracking as trk
from tests import folds

BOX = "rec long, frame long, det_pos long, x1 double, y1 double, x2 double, y2 double, sim double"


def test_every_hidden_box_is_covered_in_its_gap(spark):
    rnd = random.Random(7)
    rows = []
    for rec in range(20):
        for i in range(12):
            boxes = [{"x1": (x := rnd.random() * 50), "y1": (y := rnd.random() * 50), "x2": x + 20, "y2": y + 20} for _ in range(rnd.randint(0, 3))]
            rows.append((rec, i * 4, 50, boxes))
    df = spark.createDataFrame(rows, "rec long, frame long, n_frames long, boxes array<struct<x1:double,y1:double,x2:double,y2:double>>")
    cover = {}
    for r in trk.per_frame(trk.covered(df, ["rec"], 4)).collect():
        cover.setdefault((r.rec, r.frame), []).append((r.x1, r.y1, r.x2, r.y2))
    for rec, frame, _, boxes in rows:
        for b in boxes:
            for f in range(frame, 50 if frame == 44 else frame + 4):
                assert any(c[0] <= b["x1"] and c[1] <= b["y1"] and c[2] >= b["x2"] and c[3] >= b["y2"] for c in cover[rec, f])
            for f in range(max(0, frame - 3), frame):  # what appears is covered before it is seen
                assert any(c[0] <= b["x1"] and c[1] <= b["y1"] and c[2] >= b["x2"] and c[3] >= b["y2"] for c in cover[rec, f])


def test_a_lost_box_lingers_for_two_samples():
    box = (0.0, 0.0, 10.0, 10.0)
    held = trk.lingering([[box], [], [], []])
    assert [len(x) for x in held] == [1, 1, 1, 0]


def test_tracks_decide_by_the_median_and_fail_closed(spark):
    rows = [(1, 4 * i, 0, 0.0, 0.0, 10.0, 10.0, s) for i, s in enumerate([0.1, 0.8, 0.9, 0.1, None])] + [(2, 0, 0, 0.0, 0.0, 5.0, 5.0, None)]
    got = trk.tracked(spark.createDataFrame(rows, BOX), ["rec"]).orderBy("rec", "frame").collect()
    assert [r.is_main for r in got] == [False, True, True, True, True, False]
    assert {(r.rec, r.track) for r in got} == {(1, 0), (2, 0)}


def test_a_track_ends_after_four_samples(spark):
    rows = [(1, f, 0, 0.0, 0.0, 10.0, 10.0, 0.9) for f in (0, 16, 33)]
    assert [r.track for r in trk.tracked(spark.createDataFrame(rows, BOX), ["rec"]).orderBy("frame").collect()] == [0, 0, 1]


def test_share_equals_the_definition():
    rnd = random.Random(8)
    for _ in range(500):
        a, b = ([(x := rnd.randint(0, 9)), (y := rnd.randint(0, 9)), x + rnd.randint(1, 9), y + rnd.randint(1, 9)] for _ in range(2))
        assert abs(trk.share(a, b) - folds.iou(a, b)) < 1e-12


def test_dead_band_equals_the_fold(spark):
    rnd = random.Random(9)
    points = [rnd.random() * 20 for _ in range(50)]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(points)] + [(2, 0, 5.0)], "rec long, frame long, v double")
    got = {r.frame: r.v for r in ser.dead_band(df, "rec", ["v"], 3.0).filter("rec = 1").collect()}
    assert np.allclose([got[i] for i in range(50)], folds.band(points, 3.0))
    assert ser.held([0, 3, 10, 4], 2) == [0, 1, 8, 6]


def test_interpolation_and_smoothing_equal_numpy(spark):
    known = {3: 1.0, 10: 8.0, 11: 2.0, 40: 5.0}
    df = spark.createDataFrame([(1, f, v) for f, v in known.items()], "rec long, frame long, v double")
    lengths = spark.createDataFrame([(1, 60), (2, 3)], "rec long, n_frames long")
    line = ser.interpolated(df, lengths, "rec", ["v"])
    got = {r.frame: r.v for r in line.filter("rec = 1").collect()}
    want = np.interp(np.arange(60), list(known), list(known.values()))
    assert np.allclose([got[i] for i in range(60)], want)
    assert [r.v for r in line.filter("rec = 2").collect()] == [None] * 3
    w = np.hanning(13)[1:-1]
    smooth = {r.frame: r.v for r in ser.smoothed(line.filter("rec = 1"), "rec", ["v"], 11).collect()}
    assert np.allclose([smooth[i] for i in range(60)], np.convolve(np.pad(want, 5, mode="edge"), w / w.sum(), mode="valid"))


def test_short_series_stay(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 9.0), (2, 0, 3.0)], "rec long, frame long, v double")
    assert sorted(r.v for r in ser.smoothed(df, "rec", ["v"], 11).collect()) == [1.0, 3.0, 9.0]


def test_crop_stays_in_the_frame(spark):
    known = spark.createDataFrame([(1, 0, -50.0, 2000.0), (1, 9, 3000.0, -5.0)], "rec long, frame long, cx double, cy double")
    recs = spark.createDataFrame([(1, 30, 1280, 720), (2, 4, 1280, 720)], "rec long, n_frames long, width long, height long")
    rows = ser.crop_path(known, recs, "rec", zone=2.0).collect()
    assert len(rows) == 34
    assert all(0 <= r.x <= 1280 - r.cw and 0 <= r.y <= 720 - r.ch for r in rows)
    assert {r.x for r in rows if r.rec == 2} == {320}


def test_clusters_by_hand():
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99], [-1, 0]])
    assert idn.average_linkage(v, 0.5).tolist() == [0, 0, 1, 1, 2]
    assert idn.average_linkage(v[:1]).tolist() == [0]
    assert len(idn.average_linkage(np.zeros((0, 2)))) == 0


def test_rule_bounds(spark):
    cols = "path_exists boolean, size long, duration double, has_video boolean, has_audio boolean, n_frames long, wants_ref boolean, ref_size long, ref_duration double"
    rows = [
        (False, None, None, None, None, None, False, None, None), (True, None, None, None, None, None, False, None, None),
        (True, 99_999, 10.0, True, True, 5, False, None, None), (True, 100_000, 10.0, True, True, 5, False, None, None),
        (True, 100_000, 12.0, True, True, 5, True, 1_250_000, 10.0), (True, 800_000, 12.01, True, True, 5, True, 100_000, 10.0),
        (True, 800_001, 10.0, False, True, 0, True, 100_000, 10.0), (True, 200_000, 0.0, True, False, 0, True, None, None),
    ]
    df = spark.createDataFrame(rows, cols)
    assert [r.p for r in df.select(med.problems(df, expect_audio=True).alias("p")).collect()] == [["missing"], ["unreadable"], ["small"], [], [], ["duration"], ["no_video", "size_ratio"], ["empty", "no_audio", "bad_ref"]]
