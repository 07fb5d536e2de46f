"""Scalar expressions: rounding, time text, words, boxes and vectors. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column) -> Column:
    """Half-to-even rounding to a whole number."""
    return F.rint(x).cast("long")


def stripped(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """The words of a text; none for a blank one."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zoneless timestamp, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def parse_time(text: Column) -> Column:
    """Seconds of SS, MM:SS or HH:MM:SS; null stays null."""
    parts = F.transform(F.split(text, ":"), lambda p: p.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total * 60 + p)


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm; milliseconds are rounded before the split, so they carry."""
    ms = rounded(seconds * 1000)
    part = lambda unit, mod, width: F.lpad(F.pmod(F.floor(ms / unit), F.lit(mod)).cast("string"), width, "0")
    hours = F.floor(ms / 3_600_000).cast("string")
    return F.concat(F.lpad(hours, F.greatest(F.length(hours), F.lit(2)), F.lit("0")), F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit(","), part(1, 1000, 3))


def frame_rate(text: Column) -> Column:
    """num/den as a number: an empty denominator counts as 1, what fails is 0."""
    parts = F.split(text, "/")
    top, bottom = F.try_to_number(parts[0], F.lit("999999999")), F.coalesce(F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.lit("1"))
    return F.coalesce(F.try_divide(top.cast("double"), F.try_to_number(bottom, F.lit("999999999")).cast("double")), F.lit(0.0))


def area(b: str | Column) -> Column:
    g = _fields(b)
    return (g("x2") - g("x1")) * (g("y2") - g("y1"))


def _fields(b: str | Column):
    return (lambda k: F.col(f"{b}{k}")) if isinstance(b, str) else (lambda k: b[k])


def iou(a: str | Column, b: str | Column) -> Column:
    """Intersection over union of two boxes (column prefixes or structs); 0 if they are apart."""
    p, q = _fields(a), _fields(b)
    w = F.least(p("x2"), q("x2")) - F.greatest(p("x1"), q("x1"))
    h = F.least(p("y2"), q("y2")) - F.greatest(p("y1"), q("y1"))
    both = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    total = area(a) + area(b) - both
    return F.when((both > 0) & (total > 0), both / total).otherwise(0.0)


def padded_box(b: str, width: int, height: int, pad: float = 0.2) -> dict[str, Column]:
    """A box widened by a share of its size, in whole pixels within the frame."""
    x1, y1, x2, y2 = (F.col(f"{b}{k}").cast("long") for k in ("x1", "y1", "x2", "y2"))
    w, h = x2 - x1, y2 - y1
    cut = lambda c: c.cast("long")
    return {"px1": F.greatest(F.lit(0).cast("long"), cut(x1 - pad * w)), "py1": F.greatest(F.lit(0).cast("long"), cut(y1 - pad * h)), "px2": F.least(F.lit(width).cast("long"), cut(x2 + pad * w)), "py2": F.least(F.lit(height).cast("long"), cut(y2 + pad * h))}


def blocks(pixels: Column) -> Column:
    """Blocks along a side of a pixelated region: one for 8 pixels, from 2 to 12."""
    return F.greatest(F.lit(2), F.least(F.lit(12), F.floor(pixels / 8))).cast("long")


def crop_size(width: Column, height: Column, zoom: float | Column) -> tuple[Column, Column]:
    """Whole-pixel crop of a share (0.15 to 1) of the width that keeps the aspect."""
    share = F.least(F.greatest(F.lit(zoom).cast("double"), F.lit(0.15)), F.lit(1.0))
    cw = F.least(rounded(share * width), width)
    return cw, F.least(rounded(cw * height / width), height)


def dot(a: Column, b: Column) -> Column:
    """Dot product in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x)


def normalised(v: Column) -> Column:
    """v over its length; a zero vector stays."""
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def mute_gain(sample: Column, start: Column, end: Column, fade: int = 480) -> Column:
    """Gain of a sample under one muted span [start, end): ramps lie inside the span, a short span has none."""
    at, n = sample - start, end - start
    ramp = F.when(at < fade, 1 - at / (fade - 1)).when(at >= n - fade, (at - (n - fade)) / (fade - 1)).otherwise(0.0)
    return F.when((at < 0) | (at >= n), 1.0).when(n <= 2 * fade, 0.0).otherwise(ramp)


def wrapped(text: Column, width: Column) -> Column:
    """Lines of at most width characters, filled greedily; a longer word has a line of its own."""
    state = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("line"))

    def add(s: Column, w: Column) -> Column:
        trial = F.when(s["line"] == "", w).otherwise(F.concat(s["line"], F.lit(" "), w))
        fits = (F.length(trial) <= width) | (s["line"] == "")
        return F.struct(F.when(fits, s["lines"]).otherwise(F.concat(s["lines"], F.array(s["line"]))).alias("lines"), F.when(fits, trial).otherwise(w).alias("line"))

    return F.aggregate(words(text), state, add, lambda s: F.when(s["line"] == "", s["lines"]).otherwise(F.concat(s["lines"], F.array(s["line"]))))


def fitted_size(text: Column, box_width: int, box_height: int, sizes: tuple[int, ...] = tuple(range(64, 31, -4)), char_share: float = 0.5, spacing: int = 18) -> Column:
    """The largest type size whose wrapped lines fit the box, or the least size.

    A character is char_share of the size wide and a line as high as the size.
    """
    out = F.lit(sizes[-1])
    for size in reversed(sizes):
        n = F.size(wrapped(text, F.lit(int(box_width / (size * char_share)))))
        out = F.when(n * size + (n - 1) * spacing <= box_height, F.lit(size)).otherwise(out)
    return out
