"""Operators on diarized transcripts: who leads, who asks, what is shown."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import srt_time, stripped, words
from .intervals import ordered_text

WINDOW_S, MAX_WORDS, BATCH, MAX_CHARS = 10.0, 12, 40, 600


def main_speaker(spoken: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, label, total): the speaker with most time; of equal ones the first to speak. Null speakers don't count.

    Totals are rounded to a millionth, so the order of their sums can't break a tie.
    """
    totals = spoken.filter("speaker is not null").groupBy(key, "speaker").agg(F.round(F.sum(F.col("end") - F.col("start")), 6).alias("total"), F.min(F.struct(*order)).alias("first"))
    w = Window.partitionBy(key).orderBy(F.desc("total"), "first")
    return totals.withColumn("rank", F.row_number().over(w)).filter("rank = 1").select(key, F.col("speaker").alias("label"), "total")


def batch_replies(items: DataFrame, key: str, pos: str, ask: Callable[[list[dict]], str], size: int = BATCH) -> DataFrame:
    """(key, batch, items, reply): an outside classifier asked once for each batch of a recording's candidates, in order.

    ask gets the batch's items (dicts of pos, student and follows) and returns the text of
    its reply; a batch is bounded, so a row holds it.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), "student", "follows")))
    dealt = batched(items, key, pos, size).groupBy(key, "batch").agg(rows.alias("items"))

    @F.pandas_udf("string")
    def reply(batches: pd.Series) -> pd.Series:
        return pd.Series([ask([dict(x) for x in batch]) for batch in batches], dtype=object)

    return dealt.withColumn("reply", reply("items"))


REPLY = "array<struct<index: bigint, is_repeat_back: boolean, text: string>>"


def read_replies(replies: DataFrame, key: str, pos: str) -> DataFrame:
    """(key, pos, is_repeat, text): the verdicts of the replies that can be read; an index that was not asked doesn't count."""
    rows = replies.select(key, "items", F.explode(F.from_json("reply", REPLY)).alias("r"))
    asked = rows.filter(F.array_contains(F.transform("items", lambda x: x["pos"]), F.col("r.index")))
    return asked.select(key, F.col("r.index").alias(pos), F.coalesce("r.is_repeat_back", F.lit(False)).alias("is_repeat"), F.col("r.text").alias("text"))


def skipped_batches(replies: DataFrame, key: str) -> DataFrame:
    """(key, batches, skipped, items_skipped): replies that can't be read, counted for each recording."""
    bad = F.try_parse_json("reply").isNull()
    return replies.groupBy(key).agg(F.count("*").alias("batches"), F.count_if(bad).alias("skipped"), F.sum(F.when(bad, F.size("items")).otherwise(0)).cast("long").alias("items_skipped"))


def others(segments: DataFrame, label: Column) -> DataFrame:
    """Segments that are not the label's; a missing speaker is someone else."""
    return segments.filter(~F.col("speaker").eqNullSafe(label))


def repeat_back_candidates(segments: DataFrame, labels: DataFrame, key: str, pos: str, window: float = WINDOW_S, max_words: int = MAX_WORDS) -> DataFrame:
    """(key, pos, student, follows): short segments of others, and what the main speaker says within a window after them.

    Starts must not decrease with pos. Segments are dealt by (recording, bin of the
    window's width): a short one meets the main speaker's in the bins that its window
    touches, so a long recording is split.
    """
    own = F.col("speaker").eqNullSafe(F.col("label"))
    seen = segments.join(labels.select(key, "label"), key, "left").withColumn("own", F.coalesce(own, F.lit(False)))
    asked = seen.filter(~F.col("own") & ~F.coalesce("flag", F.lit(False)) & (F.size(words(F.col("text"))) <= max_words))
    said = seen.filter("own").select(key, F.col(pos).alias("next_pos"), F.col("start").alias("next_start"), stripped(F.col("text")).alias("said"))
    # windows of one width: an asked segment meets the bin of its end and the next one
    at = lambda c: F.floor(F.col(c) / window)
    dealt = asked.select(key, pos, "text", "end", F.explode(F.sequence(F.floor(F.least("start", "end") / window), at("end") + 1)).alias("bin"))
    pairs = dealt.join(said.withColumn("bin", at("next_start")), [key, "bin"]).filter((F.col("next_pos") > F.col(pos)) & (F.col("next_start") - F.col("end") <= window))
    return pairs.groupBy(key, pos).agg(stripped(F.first("text")).alias("student"), F.substring(ordered_text("said", ["next_pos"]), 1, MAX_CHARS).alias("follows"))


def batched(rows: DataFrame, key: str, pos: str, size: int = BATCH) -> DataFrame:
    """rows with their batch of a size, in order within the key."""
    w = Window.partitionBy(key).orderBy(pos)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def classified(rows: DataFrame, text: str, rule: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """rows with verdict (is_question, question), by an outside classifier of a batch of texts.

    rule takes the texts and returns a frame of as many rows with both columns.
    """

    @F.pandas_udf("is_question boolean, question string")
    def verdict(texts: pd.Series) -> pd.DataFrame:
        out = rule(texts)
        if len(out) != len(texts):
            raise ValueError(f"{len(texts)} texts, {len(out)} verdicts")
        return out

    return rows.withColumn("verdict", verdict(F.col(text)))


def question_rule(texts: pd.Series) -> pd.DataFrame:
    """The classifier used where no outside one is given: a text is a question if it ends in '?'."""
    text = texts.fillna("").str.strip()
    return pd.DataFrame({"is_question": text.str.endswith("?"), "question": text.str.slice(0, 160)})


def merged_verdicts(segments: DataFrame, verdicts: DataFrame, key: str, pos: str) -> DataFrame:
    """segments with is_question and text from verdicts of all of them; a missing or spare verdict is an error.

    The count is checked per recording when the rows are used, in the same join.
    """
    joined = segments.withColumn("known", F.lit(True)).join(verdicts.select(key, pos, "is_question", "question", F.lit(True).alias("had")), [key, pos], "full")
    fail = F.raise_error(F.lit("verdicts and segments don't match")).cast("boolean")
    good = joined.withColumn("is_question", F.when(F.col("had") & F.col("known"), F.col("is_question")).otherwise(fail))
    return good.withColumn("text", F.when(F.col("is_question"), F.col("question")).otherwise(F.col("text"))).drop("question", "had", "known")


def merged_repeats(segments: DataFrame, replies: DataFrame, candidates: DataFrame, key: str, pos: str) -> DataFrame:
    """segments where positive replies to candidates make a question; replies to other rows don't count."""
    good = replies.filter("is_repeat").join(candidates.select(key, pos).distinct(), [key, pos], "left_semi").select(key, pos, F.col("text").alias("said_back"))
    joined = segments.join(good, [key, pos], "left")
    hit = F.col("said_back").isNotNull()
    return joined.withColumns({"text": F.coalesce("said_back", "text"), "flag": F.coalesce("flag", F.lit(False)) | hit, "question_source": F.when(hit, "instructor_repeat_back")}).drop("said_back")


def captions(segments: DataFrame, key: str, pos: str, hide_others: Column | None = None) -> DataFrame:
    """(key, cue, start, end, text): segments with text, counted from 1 in order; hide_others drops those it is true for."""
    shown = segments.withColumn("text", stripped(F.col("text"))).filter(F.col("text") != "")
    if hide_others is not None:
        shown = shown.filter(~hide_others)
    cue = F.row_number().over(Window.partitionBy(key).orderBy(pos)).cast("long")
    return shown.select(key, cue.alias("cue"), srt_time(F.col("start")).alias("start"), srt_time(F.col("end")).alias("end"), "text")
