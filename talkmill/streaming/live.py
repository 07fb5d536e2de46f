"""Streams of words: speaker spans while a recording is still going on.

A span is given out once a later word closes it, or when no word has come for a
timeout. Words of a recording must arrive in order; what arrives before the last
word taken is left out, as it can no longer be placed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

SPAN = "rec long, start double, end double, flag boolean"
STATE = "at double, start double, end double, flag boolean"


def live_islands(words: DataFrame, label: str, tolerance: float = 1.5, timeout_ms: int | None = 60_000) -> DataFrame:
    """(rec, start, end, flag) of closed spans of words that are not the label's, appended as they close.

    words is a stream with rec, start, end, speaker and flag. The rules are those of
    operators.intervals.islands: a span ends at a word of the label, at a gap above
    the tolerance and where the flag changes. Without a timeout an open span waits for
    the word that closes it.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        nothing = (None, None, None)
        at, *span = state.get if state.exists else (float("-inf"), *nothing)
        span, closed = tuple(span), []
        if state.hasTimedOut:
            state.remove()
            if span[0] is not None:
                yield pd.DataFrame([(key[0], *span)], columns=["rec", "start", "end", "flag"])
            return
        rows = pd.concat(list(batches)).dropna(subset=["speaker"]).sort_values("start")
        for start, end, speaker, flag in rows[["start", "end", "speaker", "flag"]].itertuples(index=False):
            if start < at:
                continue
            at = start
            if span[0] is not None and (speaker == label or start - span[1] > tolerance or bool(flag) != span[2]):
                closed.append((key[0], *span))
                span = nothing
            if speaker != label:
                span = (span[0] if span[0] is not None else start, end, bool(flag))
        state.update((at, *span))
        if timeout_ms is not None:
            state.setTimeoutDuration(timeout_ms)
        if closed:
            yield pd.DataFrame(closed, columns=["rec", "start", "end", "flag"])

    return words.groupBy("rec").applyInPandasWithState(run, SPAN, STATE, "append", "NoTimeout" if timeout_ms is None else "ProcessingTimeTimeout")
