import json
import random
import time

import numpy as np
import pytest

from talkmill.operators import guards
from talkmill.operators import identity as idn
from talkmill.operators import series as ser
from talkmill.operators import speech as sp
from talkmill.sources import readers as rd
from talkmill.sources import saved


def test_an_empty_window_is_an_error(spark):
    schema = "rec long, n_frames long, fps double, start_s double, end_s double, max_frames long, existing_frames long"
    rows = [(1, 1000, 25.0, None, None, None, None), (2, 1000, 25.0, 10.0, 20.0, 0, 5000), (3, 1000, 25.0, 2.0, None, 100, 201), (4, 1000, 25.0, 39.0, 99.0, None, 50), (5, 1000, 25.0, 2.0, None, 100, 200)]
    df = spark.createDataFrame(rows, schema)
    got = {r.rec: (r.start_frame, r.end_frame, r.total, r.partial, r.refused) for r in guards.overwrite_guard(guards.frame_window(df)).collect()}
    assert got == {1: (0, 1000, 1000, False, False), 2: (250, 500, 250, True, True), 3: (50, 150, 100, True, True), 4: (975, 1000, 25, True, False), 5: (50, 150, 100, True, False)}
    assert not any(r.refused for r in guards.overwrite_guard(guards.frame_window(df), allow=True).collect())
    with pytest.raises(Exception, match="empty frame range"):
        guards.frame_window(spark.createDataFrame([(1, 100, 25.0, 9.0, 5.0, None, None)], schema)).collect()


def test_manifest_is_read_by_its_reader(spark, tmp_path):
    rows = [{"key": f"c_{i}", "id": str(i), "name": "n", "durationSec": 3.5, "course": c, "owner": None, "start": "x", "chapters": ["a"], "streams": [{"type": "camera", "isHls": True, "url": "u"}]} for i, c in enumerate(["15/210", "15/210", "b", None])]
    (tmp_path / "m.json").write_text(json.dumps({"lectures": rows}, indent=1))
    df = rd.read_manifest(spark, str(tmp_path / "m.json"))
    rd.write_manifest(df, str(tmp_path / "out"))
    back = rd.read_manifest(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_texts_on_disk(spark, tmp_path):
    seg = spark.createDataFrame([(1, 1, 1.0, 2.0, None, "a"), (1, 0, 0.0, 1.5, "hé \"x\"\n", None), (2, 0, 0.0, 1.0, "b", "c")], "rec long, pos long, start double, end double, text string, speaker string")
    saved.write_texts(saved.transcript_text(seg, "rec", "pos"), "rec", str(tmp_path / "t"))
    back = rd.read_transcripts(spark, str(tmp_path / "t/*/*.txt"))
    assert sorted((r.recording, r.seg_pos, r.start, r.text or "", r.speaker or "") for r in back.collect()) == [("recording=1", 0, 0.0, 'hé "x"\n', ""), ("recording=1", 1, 1.0, "", "a"), ("recording=2", 0, 0.0, "b", "c")]


def test_answers(spark):
    empty = spark.createDataFrame([("x", "[]")], "search string, body string")
    with pytest.raises(Exception, match="no folder found for x"):
        saved.first_folder(empty, "search").collect()
    reports = spark.createDataFrame([(1, True, 7, '{"streams": [], "format": {}}'), (2, True, 7, "nope"), (3, False, None, None)], "rec long, path_exists boolean, file_size long, body string")
    got = {r.rec: (r["size"], r.duration, r.has_video, r.fps) for r in saved.probes(reports, ["rec"]).collect()}
    assert got == {1: (7, 0.0, False, None), 2: (None, None, None, None), 3: (None, None, None, None)}


def test_null_texts_are_segments(spark):
    seg = spark.createDataFrame([(1, 0, None), (1, 1, "b")], "rec long, pos long, text string")
    verdicts = spark.createDataFrame([(1, 0, False, "x"), (1, 1, True, "q")], "rec long, pos long, is_question boolean, question string")
    got = sorted((r.pos, r.is_question, r.text) for r in sp.merged_verdicts(seg, verdicts, "rec", "pos").collect())
    assert got == [(0, False, None), (1, True, "q")]
    with pytest.raises(Exception, match="don't match"):
        sp.merged_verdicts(seg, verdicts.limit(1), "rec", "pos").collect()


def test_replies_of_other_rows_do_not_count(spark):
    items = spark.createDataFrame([(1, i, f"s{i}", "f") for i in range(5)], "rec long, pos long, student string, follows string")

    def ask(batch):
        return "no" if batch[0]["pos"] == 2 else json.dumps([{"index": x["pos"], "is_repeat_back": True, "text": "t"} for x in batch] + [{"index": 77, "is_repeat_back": True, "text": "spare"}])

    replies = sp.batch_replies(items, "rec", "pos", ask, 2)
    assert sorted(r.pos for r in sp.read_replies(replies, "rec", "pos").collect()) == [0, 1, 4]
    assert [(r.batches, r.skipped, r.items_skipped) for r in sp.skipped_batches(replies, "rec").collect()] == [(3, 1, 2)]


def test_series_equal_plain_loops(spark):
    rnd = random.Random(5)
    known, lengths = [], []
    for rec in range(40):
        n = rnd.choice([1, 2, 3, 30, 200])
        lengths.append((rec, n))
        known += [(rec, f, rnd.random() * 100) for f in sorted(rnd.sample(range(n), rnd.randint(1, max(1, n // 4))))]
    line = ser.interpolated(spark.createDataFrame(known, "rec long, frame long, v double"), spark.createDataFrame(lengths, "rec long, n_frames long"), "rec", ["v"])
    got = {(r.rec, r.frame): r.v for r in line.collect()}
    smooth = {(r.rec, r.frame): r.v for r in ser.smoothed(line, "rec", ["v"], 11).collect()}
    weights = ser.hann_weights(11)
    for rec, n in lengths:
        x, y = zip(*[(f, v) for k, f, v in known if k == rec], strict=True)
        want = np.interp(np.arange(n), x, y)
        assert np.allclose([got[rec, f] for f in range(n)], want)
        padded = np.pad(want, 5, mode="edge")
        soft = np.convolve(padded, weights, mode="valid") if n >= 3 else want
        assert np.allclose([smooth[rec, f] for f in range(n)], soft)


def test_a_long_recording_takes_seconds(spark):
    n = 120_000
    known = spark.range(0, n, 8).selectExpr("1L AS rec", "id AS frame", "rand(3) * 100 AS cx", "rand(4) * 100 AS cy")
    recordings = spark.createDataFrame([(1, n, 1280, 720)], "rec long, n_frames long, width long, height long")
    began = time.perf_counter()
    assert ser.crop_path(known, recordings, "rec", smooth_s=2.0).count() == n
    assert ser.smoothed(ser.interpolated(known, recordings, "rec", ["cx"]), "rec", ["cx"], 51).agg({"cx": "sum"}).first()[0] > 0
    assert time.perf_counter() - began < 90


def test_the_main_person_is_found(spark):
    rnd = np.random.default_rng(7)
    one, two = np.eye(8)[0], np.eye(8)[3]
    faces = []
    for rec in (1, 2):
        for i in range(12):
            v = (one if i % 4 else two) + rnd.normal(0, 0.05, 8)
            faces.append((rec, i, i * 4, (v / np.linalg.norm(v)).tolist(), True, 10.0, 0))
    df = spark.createDataFrame(faces, "rec long, pos long, frame long, embedding array<double>, is_uniform boolean, box_area double, label long")
    rank, main = idn.identified(df, "rec", "pos")
    assert sorted((r.rec, r["rank"], r.n) for r in rank.collect()) == [(1, 1, 9), (1, 2, 3), (2, 1, 9), (2, 2, 3)]
    found = idn.located(df, main, "rec", 8)
    assert sorted((r.rec, r.frame) for r in found.collect()) == [(rec, f) for rec in (1, 2) for f in range(0, 48, 8) if (f // 4) % 4]
