import os

import pyarrow as pa
import pytest

import corpus_pipeline
from talkmill.llm import chosen_path, common, private_spans
from tests.llm import brute
from tests.llm.test_hosts_and_urls import host_kept

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, held = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name != "pack":
            assert docs.columns == columns
            held[name] = {r.doc_id: r.text for r in docs.collect()}
    start = {r.doc_id: (r.source, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    good, _ = host_kept(start)
    assert held["quality"] == {d: t for d, (_, t) in start.items() if good[d]}
    assert held["line_dedup"] == brute.line_dedup(held["quality"])
    want = brute.near_components(held["line_dedup"], 5, 80)
    assert held["near_dedup"] == {d: t for d, t in held["line_dedup"].items() if want[d][1] == d}
    assert held["private"] == {d: private_spans.masked(t) for d, t in held["near_dedup"].items()}
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(held["private"])
    assert all(sum(r.length for r in rows if r.doc_id == d) == next(r.doc_tokens for r in rows if r.doc_id == d) for d in held["private"])


def test_stages_take_odd_rows(spark):
    """Null and empty texts, repeated rows, null ids and sources, clashing columns and an empty table."""
    line = " ".join(f"word{i}" for i in range(60))
    rows = [(1, line, "en", "s", 1, "x"), (1, line, "en", "s", 1, "x"), (2, None, "en", None, None, "x"), (3, "", None, "s", 0, "x"), (None, line + " more", "en", "s", 1, "x"), (4, line + "\nmail a@b.co", "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, data string")
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = spark.createDataFrame(stage(spark, now, DIR).collect(), now.schema) if name != "pack" else stage(spark, now, DIR)
            if name != "pack":
                assert now.columns == docs.columns
        assert (now.count() > 0) == (start is docs)


@pytest.mark.parametrize("stage", [private_spans.find, private_spans.redact])
def test_private_empties_the_stores_of_stages_before_it(spark, monkeypatch, stage):
    made = []
    monkeypatch.setattr(common, "map_batches", lambda df, make, schema, *rest: made.append(make) or spark.createDataFrame([], schema))
    stage(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    chosen_path.shingle_sets([b"one two three four five six"])
    assert chosen_path._words
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "row": {"doc_id": 1}, "none": False, "data": b"mail a@b.co"}])
    assert made[0]()(batch).num_rows == 1
    assert not chosen_path._words
