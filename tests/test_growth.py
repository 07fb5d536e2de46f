"""What the findings of round 3 named: results by plain loops, and plans or states that must not grow."""

import random
import tracemalloc

import numpy as np

from pyspark.sql import functions as F

from talkmill.operators import identity as idn
from talkmill.operators import media as med
from talkmill.operators import series as ser
from talkmill.plans import stages

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def evenly(first, last, n):
    step = (last - first) / (n - 1) if n > 1 else 0.0
    return [int(last) if i == n - 1 and n > 1 else int(first + i * step) for i in range(max(n, 1))]


def test_samples_carry_no_list(spark):
    rnd = random.Random(3)
    rows = [(i, s, s + rnd.choice([-3, 0, 1, 2, 5, 59, 60, 61, 399, 400, 401, 402, 900, 5000]), rnd.choice([0.0, 2.5, 25.0])) for i, s in enumerate(rnd.choice([-250, -1, 0, 7, 60]) for _ in range(300))]
    df = idn.sample_frames(spark.createDataFrame(rows, "rec long, start_frame long, end_frame long, fps double"), "rec")
    want = []
    for rec, a, b, fps in rows:
        uniform, stop = evenly(a, b - 1, min(400, max(1, b - a))), min(b - 1, a + int(20 * fps))
        dense = evenly(a, stop, min(60, stop - a)) if stop > a else []
        want += [(rec, f, f in uniform) for f in dict.fromkeys(uniform + dense)]
    assert sorted((r.rec, r.frame, r.is_uniform) for r in df.collect()) == sorted(want)
    assert "array_contains" not in plan(df)


def test_a_sweep_joins_recordings_with_the_checks_only(spark):
    cols = "rec long, artifact string, path_exists boolean, size long, duration double, has_video boolean, has_audio boolean, n_frames long"
    rnd = random.Random(4)
    names = [a for s in stages.STAGES for a, _ in s.outputs] + ["camera"]
    rows = [(rec, a, rnd.random() < 0.6, rnd.choice([None, 50_000, 900_000, 9_000_000]), float(rnd.choice([0, 100, 104])), True, rnd.random() < 0.5, None) for rec in (1, 2, 3, 4, 4, None) for a in names if rnd.random() < 0.9]
    df = stages.sweep(spark.createDataFrame(rows, cols), "rec", stages.checks(spark))
    want = []
    for rec, a, exists, *_ in rows:
        for s in stages.STAGES:
            ref = dict(s.outputs).get(a, "none")
            if rec is None or ref == "none" or not (exists or a not in stages.OPTIONAL) or not any(r[0] == rec and r[1] in dict(s.outputs) and r[2] for r in rows):
                continue
            want += [(rec, s.name, a)] * max(1, sum(r[0] == rec and r[1] == ref for r in rows))
    assert sorted((r.rec, r.stage, r.artifact) for r in df.collect()) == sorted(want)
    from talkmill.plans import registry

    for name in ("stage_sweep", "stage_verdicts"):
        assert plan(registry.queries()[name](spark, DIR)).count("orders.parquet") + plan(registry.queries()[name](spark, DIR)).count("Relation [") == 1


def test_the_best_artifact_is_chosen_within_its_recording(spark):
    from talkmill.plans import registry

    assert "Join" not in plan(registry.queries()["best_artifact"](spark, DIR))
    wanted = spark.createDataFrame([(r, "w", c, i, c == "b") for r in (1, 2, 3) for i, c in enumerate("abc")] + [(None, "w", "b", 1, True)], "rec long, want string, candidate string, priority int, is_default boolean")
    have = spark.createDataFrame([(1, "c"), (1, "a"), (1, "a"), (2, "c")], "rec long, artifact string")
    assert sorted(map(str, med.best_artifact(wanted, have, "rec").collect())) == sorted(["Row(rec=1, want='w', artifact='a', present=True)", "Row(rec=2, want='w', artifact='c', present=True)", "Row(rec=3, want='w', artifact='b', present=False)", "Row(rec=None, want='w', artifact='b', present=False)"])


def naive(vectors, threshold):
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    groups = [[i] for i in range(len(unit))]
    while len(groups) > 1:
        gap, i, j = min((1 - np.mean(unit[a] @ unit[b].T), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if gap >= threshold:
            break
        groups[i] += groups.pop(j)
    label = {v: k for k, g in enumerate(sorted(groups, key=min)) for v in g}
    return [label[i] for i in range(len(unit))]


def test_clusters_need_no_matrix_of_distances():
    rnd = np.random.default_rng(5)
    for n, width, threshold in ((40, 3, 0.4), (30, 8, 0.9), (1, 2, 0.5)):
        v = rnd.normal(size=(n, width))
        v[::5], v[n // 2] = v[0], 0
        assert idn.average_linkage(v, threshold).tolist() == naive(v, threshold)
    star = np.vstack([[[10.0, 0, 0]], rnd.normal(size=(25, 3)) * 0.1 + [10, 0, 0]])
    assert idn.average_linkage(star, 1e-5).tolist() == naive(star, 1e-5)
    tracemalloc.start()
    assert len(set(idn.average_linkage(rnd.normal(size=(6000, 8)), 0.2).tolist())) > 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000  # a matrix has 288 MB


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frames_are_not_dealt_or_ordered(spark):
    from talkmill.plans import registry

    for name in ("interpolate", "smooth", "crop_path", "mean_pan"):
        above = physical(registry.queries()[name](spark, DIR)).split("Generate")[0]
        assert not any(x in above for x in ("Exchange", "Sort", "Join", "Window")), name


def test_series_across_batches(spark):
    known = spark.createDataFrame([(1, 5, 2.0), (1, 5000, 9.0), (1, 9999, 1.0), (3, -1, 7.0), (3, 2, 4.0)], "rec long, frame long, cx double")
    lengths = spark.createDataFrame([(1, 9000), (2, 2), (3, 4), (4, 0)], "rec long, n_frames long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        line = ser.interpolated(known, lengths, "rec", ["cx"])
        got = {(r.rec, r.frame): r.cx for r in line.collect()}
        want = np.interp(np.arange(9000), [5, 5000], [2.0, 9.0])
        assert np.allclose([got.pop((1, i)) for i in range(9000)], want)
        assert got == {(2, 0): None, (2, 1): None, (3, 0): 4.0, (3, 1): 4.0, (3, 2): 4.0, (3, 3): 4.0}
        path = line.select("rec", "frame", (F.coalesce("cx", F.lit(0.0)) * 100).cast("long").alias("x"))
        pan = {r.rec: r.mean_pan for r in ser.mean_pan(path, "rec", in_order=True).collect()}
        x = np.array([int(v * 100) for v in want])
        assert abs(pan[1] - np.abs(np.diff(x)).mean()) < 0.01 and pan[2] == pan[3] == 0.0
        assert ser.mean_pan(path.filter("frame = 0"), "rec").first().mean_pan is None
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_boxes_are_dealt_once(spark):
    from talkmill.plans import registry

    for name in ("track_faces", "track_totals"):
        assert physical(registry.queries()[name](spark, DIR)).count("Exchange hashpartitioning(l_orderkey") == 1
    assert physical(registry.queries()["track_faces"](spark, DIR)).count("Exchange") == 1
