"""Card layout over whole texts, against plain loops."""

import os
import random

import duckdb
import pytest

from talkmill.plans import registry
from tests.test_queries import DIR, TABLES

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def card(text):
    """Size, lines and over-budget flag of a text, by plain loops."""
    for size in range(64, 31, -4):
        width, lines = int(1680 / (size * 0.5)), []
        for word in text.split():
            if lines and len(lines[-1]) + 1 + len(word) <= width:
                lines[-1] += " " + word
            else:
                lines.append(word)
        if len(lines) * size + (len(lines) - 1) * 18 <= 389:
            break
    return size, lines, len(text) > 160


def test_cards_hold_the_whole_text(spark, tmp_path):
    rnd = random.Random(8)
    texts = [" ".join("x" * rnd.randint(1, 12) for _ in range(n)) for n in (0, 1, 20, 60, 90, 120, 160, 250, 400)] + ["y" * 900, "z" * 399 + " end"]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.pos: (r["size"], r.lines, r.over_budget) for r in registry.queries()["card_layout"](spark, str(tmp_path)).collect()}
    assert got == {i: card(t) for i, t in enumerate(texts)}
    assert sum(len(t) > 400 for t in texts) > 4 and {s for s, _, _ in got.values()} >= {32, 64}


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
def test_cards_of_the_turns(spark, duck):
    got = {(r.rec, r.pos): (r["size"], r.lines, r.over_budget) for r in registry.queries()["card_layout"](spark, DIR).collect()}
    turns = duck.execute("SELECT conv_id, turn, text FROM conversations").fetchall()
    assert got == {(rec, pos): card(text) for rec, pos, text in turns}
    assert any(len(text) > 400 for _, _, text in turns)
