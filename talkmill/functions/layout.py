"""Scalar expressions of layout, timing and progress. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Corners of the frame: whether the picture is at the right and at the bottom.
CORNERS = {"bottom-right": (1, 1), "top-right": (1, 0), "bottom-left": (0, 1), "top-left": (0, 0)}
#: Frames a second that the detector takes, as measured on a CPU.
DETECTOR_FPS = 17.63


def pip_height(width: Column) -> Column:
    """The height of a 16:9 picture of a width, truncated."""
    return F.floor(width * 9 / 16).cast("long")


def pip_place(size: Column, whole: int, far: Column, margin: int = 30) -> Column:
    """Where a picture begins along a side: at its far end or its near one, a margin inside."""
    return F.when(far == 1, whole - size - margin).otherwise(margin)


def card_fade(length: Column) -> Column:
    """Seconds of a card's fade."""
    return F.least(F.lit(0.40), length / 4)


def card_sound_delay(length: Column) -> Column:
    """Milliseconds before a card's sound, truncated."""
    return F.least(F.lit(800.0), length * 1000 / 4).cast("long")


def inference_minutes(frames: Column, every: Column, chunks: Column, fps: float = DETECTOR_FPS) -> Column:
    """Minutes of detection in every so many frames, dealt to chunks that run at once."""
    return frames / every / fps / chunks / 60


def progress(done: Column, whole: Column, elapsed: Column) -> dict[str, Column]:
    """The rate so far, and the minutes that the rest takes at it."""
    rate = done / elapsed
    return {"rate": rate, "eta_min": (whole - done) / rate / 60}
