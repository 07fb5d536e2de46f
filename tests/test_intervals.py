import random

from pyspark.sql import functions as F

from talkmill.operators import intervals as iv
from talkmill.operators import speech as sp
from tests import folds

WORDS = "rec long, pos long, speaker string, start double, end double, flag boolean"


def random_words(seed, groups=60):
    rnd = random.Random(seed)
    out = {}
    for rec in range(groups):
        at, rows = 0.0, []
        for pos in range(rnd.randint(0, 25)):
            at += rnd.choice([0.0, 0.5, 1.49, 1.5, 1.51, 4.0])
            rows.append((rec, pos, rnd.choice(["a", "b", "c", None]), at, at + rnd.choice([0.0, 0.5, 2.0]), rnd.random() < 0.4))
        out[rec] = rows
    return out


def by_rec(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(tuple(r[1:]))
    return {k: sorted(v) for k, v in out.items()}


def test_islands_equal_the_fold(spark):
    groups = random_words(1)
    df = spark.createDataFrame([r for rows in groups.values() for r in rows], WORDS)
    got = by_rec(iv.islands(df, "rec", ["pos"], F.lit("a"), 1.5).collect())
    want = {k: sorted(folds.islands([r[2:] for r in rows], "a", 1.5)) for k, rows in groups.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_leading_run_equals_the_fold(spark):
    rnd = random.Random(2)
    spans = {rec: [(rnd.choice([0.0, 2.9, 3.0, 3.1, 7.0, 9.0]), rnd.choice([1.0, 4.0, 12.0])) for _ in range(rnd.randint(1, 6))] for rec in range(60)}
    spans = {k: [(a, max(a, b)) for a, b in v] for k, v in spans.items()} | {100: [(0.0, 131.2), (132.32, 628.96)], 101: [(3.1, 9.0)]}
    df = spark.createDataFrame([(k, a, b) for k, v in spans.items() for a, b in v], "rec long, start double, end double")
    got = {r.rec: r["lead"] for r in iv.leading_run(df, "rec", 3.0).collect()}
    assert got == {k: folds.lead(v, 3.0) for k, v in spans.items()}
    assert got[100] == 628.96 and got[101] == 0.0


def frames(seed):
    rnd = random.Random(seed)
    rows = []
    for rec in range(80):
        for pos in range(rnd.randint(0, 8)):
            a = rnd.randint(0, 20) / 2
            rows.append((rec, pos, a, a + rnd.choice([0, 0.5, 1, 3, 8])))
    return rows


def test_clip_and_tile(spark):
    rows = frames(3)
    df = spark.createDataFrame(rows, "rec long, pos long, start double, end double")
    framed = iv.on_frames(df, F.lit(12.0), F.lit(1.0))
    clipped = iv.clipped(framed, "rec", "pos")
    got = by_rec(clipped.select("rec", "a", "b", "pos").collect())
    want = {}
    for rec, pos, start, end in rows:
        a, b = max(0, round(start)), min(12, round(end))
        if b > a:
            want.setdefault(rec, []).append((a, b, pos))
    assert got == {k: folds.clips(v) for k, v in want.items()}
    totals = spark.createDataFrame([(k, 12) for k in range(80)], "rec long, total long")
    pieces = by_rec(iv.tiled(clipped, "rec", "pos", totals).select("rec", "start_frame", "n_frames").collect())
    assert len(pieces) == 80
    for rec in pieces.values():
        at = 0
        for start, n in rec:
            assert start == at and n > 0
            at += n
        assert at == 12


def test_union_merges_touching_and_keeps_the_first(spark):
    rows = frames(4)
    df = spark.createDataFrame(rows, "rec long, pos long, start double, end double")
    got = by_rec(iv.united(df, "rec", ["start", "end", "pos"], "pos").select("rec", "start", "end", "pos").collect())
    want = {}
    for rec, pos, a, b in rows:
        want.setdefault(rec, []).append((a, b, pos))
    assert got == {k: folds.united(v) for k, v in want.items()}


def test_overlap_join_has_each_pair_once(spark):
    rnd = random.Random(5)
    spans = lambda n: [(rnd.randint(0, 2), i, (a := rnd.random() * 100), a + rnd.choice([0.0, 0.3, 5.0, 40.0])) for i in range(n)]
    left, right = spans(120), spans(120)
    a = spark.createDataFrame(left, "rec long, i long, start double, end double")
    b = spark.createDataFrame(right, "rec long, j long, start double, end double")
    got = sorted(tuple(r) for r in iv.overlap_join(a, b, "rec", 7.0).select("rec", "i", "j").collect())
    assert got == sorted((r, i, j) for r, i, s, e in left for q, j, t, f in right if r == q and s < f and e > t)


def test_main_speaker_ties_go_to_the_first(spark):
    rows = [(1, 0, "b", 0.0, 2.0), (1, 1, "a", 2.0, 4.0), (1, 2, None, 4.0, 99.0), (2, 0, None, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "rec long, pos long, speaker string, start double, end double")
    assert [tuple(r) for r in sp.main_speaker(df, "rec", ["pos"]).collect()] == [(1, "b", 2.0)]


def test_others_keep_missing_speakers(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "speaker string")
    assert sp.others(df, F.lit("a")).count() == 2


def test_repeat_back_window_and_cut(spark):
    rows = [(1, 0, "s", 0.0, 1.0, "Yeah?", False), (1, 1, "t", 10.9, 11.0, "x" * 400, False), (1, 2, "t", 11.0, 12.0, "y" * 400, False), (1, 3, "t", 11.1, 12.0, "late", False), (1, 4, "t", 500.0, 600.0, "z", False)]
    df = spark.createDataFrame(rows, "rec long, pos long, speaker string, start double, end double, text string, flag boolean")
    got = sp.repeat_back_candidates(df, sp.main_speaker(df, "rec", ["pos"]), "rec", "pos").collect()
    assert [(r.pos, r.student, r.follows) for r in got] == [(0, "Yeah?", ("x" * 400 + " " + "y" * 400)[:600])]


def test_missing_verdict_is_an_error(spark):
    import pytest

    seg = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "rec long, pos long, text string")
    verdict = spark.createDataFrame([(1, 0, True, "q")], "rec long, pos long, is_question boolean, question string")
    with pytest.raises(Exception, match="match"):
        sp.merged_verdicts(seg, verdict, "rec", "pos").collect()


def test_empty_tables(spark):
    df = spark.createDataFrame([], WORDS)
    assert iv.islands(df, "rec", ["pos"], F.lit("a")).count() == 0
    assert iv.leading_run(df, "rec", 1.0).count() == 0
    assert sp.main_speaker(df, "rec", ["pos"]).count() == 0
