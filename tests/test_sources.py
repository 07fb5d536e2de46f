import json

from talkmill.operators import speech as sp
from talkmill.plans import stages
from talkmill.sources import readers as rd
from talkmill.streaming.live import live_islands


def test_manifest_round_trip(spark, tmp_path):
    rows = [{"key": "c_1", "id": "1", "name": "n", "durationSec": 3.5, "course": "c", "owner": None, "start": "x", "chapters": [], "streams": [{"type": "camera", "isHls": True, "url": "u"}]}]
    (tmp_path / "m.json").write_text(json.dumps({"lectures": rows}, indent=1))
    df = rd.read_manifest(spark, str(tmp_path / "m.json"))
    assert [r.key for r in rd.metadata(df).collect()] == ["c_1"]
    assert [(r.type, r.isHls, r.type_pos) for r in rd.streams(df).collect()] == [("camera", True, 1)]
    rd.write_manifest(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    rd.write_sidecars(df, str(tmp_path / "side"))
    assert (tmp_path / "side/metadata/recording=c_1").exists()


def test_transcripts_and_words(spark, tmp_path):
    (tmp_path / "talk").mkdir()
    segs = [{"start": 0.0, "end": 2.0, "text": "a b", "speaker": "x", "words": [{"start": 0.0, "end": 1.0, "speaker": "x"}, {"start": 1.0, "end": 2.0}]}, {"start": 2.0, "end": 3.0, "text": "c", "is_student_question": True}]
    (tmp_path / "talk/t.json").write_text(json.dumps(segs))
    df = rd.read_transcripts(spark, str(tmp_path / "talk/t.json"))
    assert [(r.recording, r.seg_pos, r.text) for r in df.orderBy("seg_pos").collect()] == [("talk", 0, "a b"), ("talk", 1, "c")]
    assert [(r.word_pos, r.speaker, r.flag) for r in rd.words_of(df, "recording").orderBy("word_pos").collect()] == [(0, "x", False), (1, None, False)]


def test_caption_files(spark, tmp_path):
    seg = spark.createDataFrame([(1, 0, 0.0, 1.0, "a"), (1, 1, 1.0, 2.0, " \n"), (1, 2, 2.0, 3.5, " b ")], "rec long, pos long, start double, end double, text string")
    cues = sp.captions(seg, "rec", "pos")
    text = rd.caption_text(cues, "rec").first().srt
    assert text == "1\n00:00:00,000 --> 00:00:01,000\na\n\n2\n00:00:02,000 --> 00:00:03,500\nb\n\n"
    rd.write_captions(cues, "rec", str(tmp_path / "srt"))
    assert (tmp_path / "srt/recording=1").exists()
    rd.write_cards(cues.withColumn("index", cues.cue), "rec", str(tmp_path / "cards"))


def test_stage_selection():
    names = lambda x: [s.name for s in x]
    assert names(stages.selected("audio", "cards", skip=("face_anon",))) == ["audio", "track_instructor", "cards"]
    assert names(stages.selected(only="sync")) == ["sync"]
    for bad in (lambda: stages.selected("cards", "audio"), lambda: stages.selected("nothing"), lambda: stages.placed(stages.selected(), True)):
        try:
            bad()
        except ValueError:
            continue
        raise AssertionError
    assert len(stages.placed(stages.selected(), True, force=True)) == len(stages.STAGES)


def test_live_spans(spark, tmp_path):
    src = tmp_path / "in"
    schema = "rec long, start double, end double, speaker string, flag boolean"
    rows = [(1, 0.0, 1.0, "b", False), (1, 1.2, 2.0, "c", False), (1, 5.0, 6.0, "b", False), (1, 6.5, 7.0, "a", False), (1, 8.0, 9.0, None, False)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src))
    out = live_islands(spark.readStream.schema(schema).parquet(str(src)), "a", timeout_ms=None)
    q = out.writeStream.format("memory").queryName("live").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted(tuple(r) for r in spark.table("live").collect()) == [(1, 0.0, 2.0, False), (1, 5.0, 6.0, False)]
