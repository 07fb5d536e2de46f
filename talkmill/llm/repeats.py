"""Removal of long repeated strings by threshold-bounded interval expansion.

A text is a sequence of symbols: its bytes, or the hashes of its words. Every window
of a length has an anchor: its leftmost least gram hash. Equal windows have equal
anchors at equal places, so windows only need to be compared with windows of the same
anchor. A document's consecutive windows of one anchor make a context. Contexts are
counted by digest: a context that occurs twice is repeated whole, and an anchor with
one context that occurs once is not repeated at all. Only anchors with several
different contexts are left, and one copy of each such context is fetched. Its windows
are dealt once more, by some places of the anchor in them: windows of one step share a
core of nearly their length, so parts of contexts are counted as contexts were, by
core and digest.

What is left are cores with several different parts. They meet in one batch, and
there a Burrows-Wheeler transform is extended backwards breadth-first. Intervals fix
common-prefix lengths in increasing order and the search stops at the length:
neighbours without a value share it, which marks repeated windows. A core whose parts
exceed BATCH_BYTES is not given to one task: its parts are dealt down to single
windows, which are counted by a 128-bit hash. All of this is exact up to collisions of
hashes (64 bits of an anchor or core with 64 of all bytes; 128 of a window).

Defined cases: null and empty texts and texts under the length lose nothing; a row
that repeats an id with the same text is a text that repeats the first, and with
another text it is another document; null ids are told apart by their texts; other
columns are ignored by digests() and passages() and kept by without_repeats(); an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Scale:
    """Symbols in a window, in a hashed gram (a power of two) and in a step of anchor places; bytes of a symbol."""

    length: int
    gram: int
    step: int
    width: int = 1


LENGTH, GRAM = 400, 32
BYTES = Scale(LENGTH, GRAM, 40)
#: Passages: strings of this many words, a word being its 32-bit hash.
PASSAGE_WORDS = 50
PASSAGES = Scale(PASSAGE_WORDS, 8, 6, 4)
#: Bytes of contexts in one transform, and symbols in a segment of a very long text.
BATCH_BYTES, SEGMENT = 256 << 10, 8 << 20
#: Bytes of a text whose words are hashed at once.
WORD_BYTES = 1 << 20
#: Bytes of contexts that a task transforms, at least and (where the cluster has more tasks) at most.
TASK_BYTES = (1 << 20, 64 << 20)
#: Anchors (a number and a count) that are broadcast at most.
ANCHOR_ROWS = 1_000_000
BASE = 0x9E3779B97F4A7C15
PLACE = np.uint64((1 << 24) - 1)
#: A context or part by two 64-bit hashes: of its anchor or core, and of all its bytes.
KEY = ["anchor", "digest"]
#: A document by its id and the hash of its text.
DOC = ["doc", "txt"]
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the gram symbols at each place; gram is a power of two."""
    h, size, factor = data.astype(np.uint64) + np.uint64(1), 1, BASE
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least value in each run of width values."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """A 32-bit hash of each word `[^\\x20\\x09-\\x0D]+` of a text."""
    out, begin = [np.zeros(0, np.uint32)], 0
    whole = np.frombuffer(text, np.uint8)
    while begin < len(whole):
        stop = begin + WORD_BYTES
        while stop < len(whole) and not SPACES[whole[stop]]:  # a word is not cut
            stop += 1
        data = whole[begin:stop]
        begin = stop
        inside = ~SPACES[data]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        first, last = edges[::2], edges[1::2]
        up, down = powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
        h = (sums[last] - sums[first]) * down[first]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append((h >> np.uint64(32)).astype(np.uint32))
    return np.concatenate(out)


def sequence(text: bytes, scale: Scale = BYTES) -> np.ndarray:
    """The symbols of a text."""
    return np.frombuffer(text, np.uint8) if scale.width == 1 else word_hashes(text)


def contexts(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int, int]]:
    """(anchor hash, anchor's place, first window, last window) of each run of windows with one anchor."""
    out: list[tuple[int, int, int, int]] = []
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + length - 1]
        h = gram_hashes(part, gram)
        marked = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        at = (window_least(marked, length - gram + 1) & PLACE).astype(np.int64)
        edges = np.flatnonzero(at[1:] != at[:-1]) + 1
        first = np.concatenate([[0], edges])
        last = np.concatenate([edges - 1, [len(at) - 1]])
        out += zip(h[at[first]].view(np.int64).tolist(), (at[first] + begin).tolist(), (first + begin).tolist(), (last + begin).tolist(), strict=True)
    return out


def own_key(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc"), F.xxhash64(common.text_bytes(text)).alias("txt")]


def signed(data) -> int:
    """A 64-bit hash of bytes as a signed number."""
    h = xxhash.xxh3_64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


def occurrences(docs: DataFrame, scale: Scale = BYTES) -> DataFrame:
    """(KEY, DOC, size, at, places): each document's distinct contexts, their symbols, the anchor's place in them, and where they start."""
    length, width = scale.length, scale.width

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows: dict[tuple, list[int]] = {}
            for doc, txt, x in zip(batch.column("doc").to_pylist(), batch.column("txt").to_pylist(), batch.column("data"), strict=True):
                data = sequence(x.as_py(), scale)
                if len(data) < length:
                    continue
                view = memoryview(data).cast("B")
                for anchor, at, first, last in contexts(data, length, scale.gram):
                    rows.setdefault((anchor, signed(view[first * width : (last + length) * width]), doc, txt, last + length - first, at - first), []).append(first)
            if not rows:
                return None
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (*[pa.int64()] * 4, pa.int32(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(rows.values()), pa.list_(pa.int64()))], [*KEY, *DOC, "size", "at", "places"])

        return fn

    return common.map_batches(docs, make, "anchor long, digest long, doc long, txt long, size int, at int, places array<long>")


def suffix_order(text: np.ndarray, kinds: int, length: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """(order, bounds, size): suffixes sorted by length symbols or more, and where the first size symbols of neighbours differ.

    text has numbers below kinds; None if all suffixes turn out to differ within fewer symbols than length.
    """
    n, bits = len(text), max(1, int(kinds).bit_length())
    size = max(1, min(62 // bits, length))
    key = text.copy()
    for j in range(1, size):
        key <<= bits
        key[:-j] |= text[j:]
    order = np.argsort(key)
    ranked = key[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    bounds, depth = fresh, size
    while depth < length:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if fresh.all():
            return None
        key = rank * (n + 1)
        key[:-depth] += rank[depth:]
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        depth *= 2
    return order, bounds, size


def repeated(texts: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """Starts, in each text, of the strings of length symbols that start elsewhere in the texts as well.

    An interval of the transform stands for a string and holds the suffixes that begin
    with it; extending it to the left by each symbol before them gives intervals of
    strings that are longer by one. The first interval that ends at a place fixes the
    common prefix there, and one that ends at a known place is not extended.
    """
    sizes = np.array([len(p) for p in texts])
    ends = np.cumsum(sizes + 1)
    n, k = int(ends[-1]), len(texts)
    symbols, small = np.unique(np.concatenate(texts), return_inverse=True)
    text = np.empty(n, np.int64)
    inside = np.ones(n, bool)
    inside[ends - 1] = False
    text[~inside] = np.arange(k)  # ends differ, so no common prefix goes past one
    text[inside] = small.ravel() + k
    sort = suffix_order(text, k + len(symbols), length)
    if sort is None:
        return [np.zeros(0, np.int64) for _ in texts]
    order, bounds, size = sort
    before = text[order - 1]
    ahead = np.empty(n, np.int64)  # where the suffix that is longer by the symbol before stands
    ahead[np.argsort(before.astype(np.uint16) if k + len(symbols) <= 1 << 16 else before, kind="stable")] = np.arange(n)
    ahead[before < k] = -1  # ends are never extended
    known = np.append(bounds, True)  # whether the common prefix of a suffix and the one before it is known to be short
    edges = np.flatnonzero(known)
    left, right = edges[:-1], edges[1:]  # intervals of strings of size symbols
    for _ in range(size, length):
        counts = right - left
        owner = np.repeat(np.arange(len(left)), counts)
        to = ahead[np.arange(len(owner)) + np.repeat(left - np.cumsum(counts) + counts, counts)]
        owner, to = owner[to >= 0], to[to >= 0]
        rank = np.argsort(to)
        owner, to = owner[rank], to[rank]
        # suffixes of one interval that get the same symbol stand side by side
        first = np.ones(len(to), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (np.diff(text[order[to]]) != 0)
        starts = np.flatnonzero(first)
        new_left, new_right = to[starts], to[np.append(starts[1:], len(to)) - 1] + 1 if len(to) else to
        fresh = ~known[new_right]
        known[new_right] = True
        left, right = new_left[fresh], new_right[fresh]
        if not len(left):
            break
    same = ~known  # place i: suffixes i - 1 and i share length symbols or more
    starts = np.sort(order[same[:-1] | same[1:]])
    cuts = np.searchsorted(starts, ends)
    return [starts[a:b] - (e - s - 1) for a, b, e, s in zip([0, *cuts], cuts, ends, sizes)]


def ranges(starts: np.ndarray) -> list[int]:
    """Consecutive starts as flat (first, last) pairs."""
    if not len(starts):
        return []
    edges = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.concatenate([[0], edges + 1])], starts[np.concatenate([edges, [len(starts) - 1]])]], axis=1).ravel().tolist()


def fetched(wanted: DataFrame, sources: DataFrame, on: list[str], scale: Scale, texts: bool) -> DataFrame:
    """(KEY, at, context): the symbols, as bytes, at a place of a source row (on, data) that each wanted row (on, KEY, at, place, size) names.

    texts: data are texts, else symbols as bytes.
    """
    lists = common.saved(wanted.groupBy(*on).agg(F.collect_list(F.struct(*KEY, "at", "place", "size")).alias("wanted")))
    rows = common.join_small(sources, common.saved(lists.select(*on)), on, "left_semi").join(lists, on).select("data", "wanted")
    width = scale.width

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for x, own in zip(batch.column("data"), batch.column("wanted").to_pylist(), strict=True):
                data = sequence(x.as_py(), scale).tobytes() if texts else x.as_py()
                out += [(w["anchor"], w["digest"], w["at"], data[w["place"] * width : (w["place"] + w["size"]) * width]) for w in own]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, [*KEY, "at", "context"])

        return fn

    return common.map_batches(rows, make, "anchor long, digest long, at int, context binary")


def parts(found: DataFrame, scale: Scale = BYTES) -> DataFrame:
    """(p_anchor, p_digest, KEY, place, size): the parts of each context; anchor is now the hash of the core."""
    length, step, width = scale.length, scale.step, scale.width

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, at, x in zip(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True), batch.column("at").to_pylist(), batch.column("context"), strict=True):
                view = memoryview(x.as_py())
                last = len(view) // width - length
                for level in range(max(0, at - last) // step, at // step + 1):
                    # windows that have their anchor at a place from level * step on share these symbols
                    low, high = at - (level + 1) * step + 1, at - level * step
                    core = signed(b"%d %d " % (key[0], level) + bytes(view[high * width : (low + length) * width]))
                    first, stop = max(0, low), min(last, high) + length
                    out.append((*key, core, signed(view[first * width : stop * width]), first, stop - first))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (*[pa.int64()] * 4, pa.int32(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["p_anchor", "p_digest", *KEY, "place", "size"])

        return fn

    return common.map_batches(found, make, "p_anchor long, p_digest long, anchor long, digest long, place int, size int", "context")


def expanded(found: DataFrame, scale: Scale, total: int) -> DataFrame:
    """(KEY, spans): repeated windows of the contexts of each anchor, as flat (first, last) pairs; total is their bytes.

    Tasks are dealt by bytes, since a byte costs much here.
    """
    tasks = max(1, min(total // TASK_BYTES[0], max(4 * found.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES[1])))
    dealt = found.repartition(int(tasks), "anchor").sortWithinPartitions("anchor")
    kind = np.uint8 if scale.width == 1 else np.uint32

    def run(batches):
        keys: list[tuple[int, int]] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch | None:
            hits = [(k, s) for k, starts in zip(keys, repeated(held, scale.length), strict=True) if (s := ranges(starts))]
            keys.clear()
            held.clear()
            if not hits:
                return None
            columns = list(zip(*(k for k, _ in hits), strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([s for _, s in hits], pa.list_(pa.int64()))], [*KEY, "spans"])

        for batch in batches:
            for key, context in zip(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True), batch.column("context"), strict=True):
                if keys and key[0] != keys[-1][0] and size >= BATCH_BYTES:
                    if (out := flush()) is not None:
                        yield out
                    size = 0
                keys.append(key)
                held.append(np.frombuffer(context.as_py(), kind))
                size += held[-1].nbytes
        if keys and (out := flush()) is not None:
            yield out

    return dealt.mapInArrow(run, "anchor long, digest long, spans array<long>")


def counted(found: DataFrame, scale: Scale) -> DataFrame:
    """As expanded(), for cores with many parts: the parts are dealt down to single windows, which are counted by hash."""
    length, width = scale.length, scale.width

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, places, digests = [], [], []
            for key, x in zip(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True), batch.column("context"), strict=True):
                view = memoryview(x.as_py())
                n = len(view) // width - length + 1
                keys += [key] * n
                places += range(n)
                digests += [xxhash.xxh3_128_digest(view[p * width : (p + length) * width]) for p in range(n)]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            columns = list(zip(*keys, strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(places, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], [*KEY, "place", "w1", "w2"])

        return fn

    windows = common.saved(common.map_batches(found, make, "anchor long, digest long, place long, w1 long, w2 long", "context"))
    twice = common.saved(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1"))
    hits = common.join_skewed(windows, twice, ["w1", "w2"], windows.count()).groupBy(*KEY).agg(F.sort_array(F.collect_list("place")).alias("at"))
    return hits.select(*KEY, F.flatten(F.transform("at", lambda x: F.array(x, x))).alias("spans"))


def counted_kinds(seen: DataFrame, times, one: list) -> tuple[DataFrame, DataFrame]:
    """(kinds, anchors) of rows with KEY: each KEY's rows n, occurrences times and one of its places; anchors with several kinds, as k and symbols."""
    kinds = common.saved(seen.groupBy(*KEY).agg(F.sum(times).alias("times"), F.count("*").alias("n"), F.min(F.struct(*one)).alias("one")))
    anchors = common.saved(kinds.groupBy("anchor").agg(F.count("*").alias("k"), F.sum("one.size").alias("symbols")).filter("k > 1"))
    return kinds, anchors


def several(kinds: DataFrame, anchors: DataFrame) -> DataFrame:
    return common.join_skewed(kinds.select(*KEY, "one.*"), anchors, ["anchor"], anchors.agg(F.sum("k")).first()[0] or 0, "k")


def whole(kinds: DataFrame, length: int) -> DataFrame:
    """(KEY, n, spans) of what occurs more than once."""
    return kinds.filter("times > 1").select(*KEY, "n", F.array(F.lit(0).cast("long"), (F.col("one.size") - length).cast("long")).alias("spans"))


def part_spans(found: DataFrame, scale: Scale = BYTES) -> DataFrame:
    """(KEY, spans): repeated windows of different contexts, in their parts."""
    seen = common.saved(parts(found, scale))
    kinds, anchors = counted_kinds(seen, F.lit(1), ["p_anchor", "p_digest", "place", "size"])
    names = ["p_anchor", "p_digest"]
    sources = found.select(F.col("anchor").alias("p_anchor"), F.col("digest").alias("p_digest"), F.col("context").alias("data"))
    wanted = several(kinds, anchors).withColumn("at", F.lit(0))
    got = common.saved(fetched(wanted, sources, names, scale, texts=False).drop("at"))
    large = common.saved(anchors.filter(F.col("symbols") * scale.width > BATCH_BYTES).select("anchor"))
    n, total = large.count(), (anchors.agg(F.sum("symbols")).first()[0] or 0) * scale.width
    spans = expanded(common.join_small(got, large, "anchor", "left_anti", n), scale, total)
    if n:
        spans = spans.unionByName(counted(common.join_small(got, large, "anchor", "left_semi", n), scale))
    hits = whole(kinds, scale.length)
    hits = common.saved(hits.unionByName(kinds.filter("times = 1").select(*KEY, "n").join(spans, KEY)))
    rows = common.join_skewed(seen, hits, KEY, hits.agg(F.sum("n")).first()[0] or 0)
    return rows.select(F.col("p_anchor").alias("anchor"), F.col("p_digest").alias("digest"), F.transform("spans", lambda x: x + F.col("place")).alias("spans"))


def marks(docs: DataFrame, scale: Scale = BYTES) -> DataFrame:
    """(DOC, found array<struct<places, spans>>): where each document's contexts start and their repeated windows."""
    seen = common.saved(occurrences(docs, scale))
    # most anchors stand alone; only the rows of the others go on
    shared = common.saved(seen.groupBy("anchor").agg(F.sum(F.size("places")).alias("n")).filter("n > 1"))
    seen = common.saved(common.join_skewed(seen, shared, ["anchor"], shared.agg(F.sum("n")).first()[0] or 0, rows=ANCHOR_ROWS).drop("n"))
    kinds, anchors = counted_kinds(seen, F.size("places"), [*DOC, F.col("places")[0].alias("place"), "size", "at"])
    found = common.saved(fetched(several(kinds, anchors), docs, DOC, scale, texts=True).dropDuplicates(KEY))
    once = kinds.filter("times = 1").select(*KEY, "n").join(part_spans(found, scale).groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans")), KEY)
    hits = common.saved(whole(kinds, scale.length).unionByName(once))
    rows = common.join_skewed(seen.select(*KEY, *DOC, "places"), hits, KEY, hits.agg(F.sum("n")).first()[0] or 0)
    return rows.groupBy(*DOC).agg(F.collect_list(F.struct("places", "spans")).alias("found"))


def covered(found: list[dict], length: int) -> np.ndarray:
    """Sorted disjoint (first, stop) of the symbols that the windows of a document's found contexts cover."""
    pairs = np.concatenate([(np.array(x["spans"], np.int64).reshape(1, -1, 2) + np.array(x["places"], np.int64)[:, None, None]).reshape(-1, 2) for x in found])
    pairs = pairs[np.argsort(pairs[:, 0])]
    stops = np.maximum.accumulate(pairs[:, 1] + length)
    first = np.concatenate([[True], pairs[1:, 0] > stops[:-1]])
    last = np.append(np.flatnonzero(first)[1:], len(pairs)) - 1
    return np.stack([pairs[first, 0], stops[last]], axis=1)


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: Scale = PASSAGES) -> DataFrame:
    """(DOC, n_passages, n_passage_words), written: maximal runs of words in strings of scale.length words that start elsewhere as well, of documents with any."""
    found = marks(docs.select(*own_key(doc_id, text), common.text_bytes(text).alias("data")), scale)

    def run(batches):
        for batch in batches:
            runs = [covered(x, scale.length) for x in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, DOC), pa.array([len(r) for r in runs], pa.int64()), pa.array([int((r[:, 1] - r[:, 0]).sum()) for r in runs], pa.int64())], [*DOC, "n_passages", "n_passage_words"])

    return common.saved(found.mapInArrow(run, "doc long, txt long, n_passages long, n_passage_words long"))


def marked(docs: DataFrame, scale: Scale = BYTES) -> DataFrame:
    """docs (a row for each text: DOC, data, ...) with found; texts without any are not shuffled where the others are few."""
    found = common.saved(marks(docs.select(*DOC, "data"), scale))
    ids = common.saved(found.select(*DOC))
    if not common.fits(ids):
        return docs.join(found, DOC, "left")
    touched = docs.join(F.broadcast(ids), DOC, "left_semi").join(found.hint("merge"), DOC)
    rest = docs.join(F.broadcast(ids), DOC, "left_anti").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    return touched.unionByName(rest)


def kept_parts(data: bytes, found: pa.Scalar, length: int) -> tuple[list[bytes], np.ndarray]:
    """What stays of a text, and the (first, stop) of what goes."""
    if not found.is_valid:
        return [data], np.zeros((0, 2), np.int64)
    gone = covered(found.as_py(), length)
    return [data[a:b] for a, b in zip([0, *gone[:, 1].tolist()], [*gone[:, 0].tolist(), len(data)], strict=True)], gone


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: Scale = BYTES) -> DataFrame:
    """(doc_id, DOC, n_bytes, n_removed, n_spans, kept_sha256) of each document."""
    rows = marked(docs.select(*own_key(doc_id, text), F.col(doc_id).cast("long").alias("doc_id"), common.text_bytes(text).alias("data")), scale)

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for x, found in zip(batch.column("data"), batch.column("found"), strict=True):
                data = x.as_py()
                kept, gone = kept_parts(data, found, scale.length)
                out.append((len(data), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(b"".join(kept)).hexdigest()))
            columns = list(zip(*out, strict=True))
            names = ["doc_id", *DOC]
            return pa.RecordBatch.from_arrays([*map(batch.column, names), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])], [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return fn

    return common.map_batches(rows, make, "doc_id long, doc long, txt long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """digests() with n_passages and n_passage_words: repeats by bytes and, for passages shorter in bytes, by words."""
    docs = docs.select(doc_id, text)
    own = common.join_small(digests(docs, doc_id, text), passages(docs, doc_id, text), DOC, "left")
    return own.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_passages", "n_passage_words")}).drop(*DOC)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: Scale = BYTES) -> DataFrame:
    """docs with repeated strings taken out of text; bytes that no longer form a character become U+FFFD; a null text stays null."""
    rows = docs.select(*own_key(doc_id, text), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), F.col(text).isNull().alias("none"), common.text_bytes(text).alias("data"))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for x, found, none in zip(batch.column("data"), batch.column("found"), batch.column("none").to_pylist(), strict=True):
                out.append(None if none else b"".join(kept_parts(x.as_py(), found, scale.length)[0]).decode("utf-8", "replace"))
            return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

        return fn

    out = common.map_batches(marked(rows, scale), make, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
