"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are cut at every full sequence, and longer tails at half of one; what is
left of each has one of a fixed number of length classes. A linear program over patterns of classes covers the
class histogram (at most CLASSES rows, whatever the corpus), knapsack dynamic
programming prices new patterns, solutions are rounded down and what remains is
placed best-fit. Pieces are ranked within their class and read off their sequence.

Defined cases: null and empty texts hold the end id alone; repeated rows are packed
again; extra columns are ignored; an empty table packs to nothing.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY = 2048
#: Length classes: the linear program has a row for each, and a class is CAPACITY / CLASSES tokens wide.
CLASSES = 512
END_ID = 1
#: Pieces in a salt of a class, and the most salts that a class is split into for ranking.
SALT_ROWS, MAX_SALTS = 5_000, 4_096
#: Chunks that a Python worker keeps tokenised.
CACHE_CHUNKS = 600_000
#: Pre-tokens in a line that the library encodes at once.
LINE = 200
#: Column generation ends within this share of the bound, or after so many columns.
GAP, MAX_COLUMNS = 2e-4, 6_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: The tokenizer's own split of lower-case text, spelled out for characters up to U+00FF
#: (letters, numbers and white space of Unicode in that range).
LETTERS, NUMBERS, BLANK = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANK}{LETTERS}{NUMBERS}]+")


class Tokens:
    """Ids of texts by a tokenizers file; each distinct pre-token is encoded once.

    The file must lower-case, split as LATIN does and never cross white space. Texts
    with characters beyond U+00FF, or with what may be a special token, are cut at
    white space alone and the library splits the chunks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text, without special tokens."""
        common.hold("packing", self.clear)
        out: list[bytes] = [b""] * len(texts)
        latin, other = [], []
        for i, text in enumerate(texts):
            (latin if text.isascii() or is_latin(text) else other).append(i) if "<|" not in text else other.append(i)
        split = [LATIN.findall(texts[i].lower()) for i in latin]
        for i, ids in zip(latin, self._joined(split, self.words, self._encode_words), strict=True):
            out[i] = ids
        split = [texts[i].replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for i in other]
        for i, ids in zip(other, self._joined(split, self.chunks, self._encode_chunks), strict=True):
            out[i] = ids
        return out

    def clear(self) -> None:
        self.words.clear()
        self.chunks.clear()

    def _joined(self, split: list[list[str]], cache: dict[str, bytes], encode) -> list[bytes]:
        missing = list(set(chain.from_iterable(split)) - cache.keys())
        if len(cache) + len(missing) > CACHE_CHUNKS:
            cache.clear()
            missing = list(set(chain.from_iterable(split)))
        for i in range(0, len(missing), 20_000):
            some = missing[i : i + 20_000]
            cache.update(zip(some, encode(some), strict=True))
        return [b"".join(map(cache.__getitem__, parts)) for parts in split]

    def _encode_chunks(self, some: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _encode_words(self, some: list[str]) -> list[bytes]:
        """Pre-tokens go in lines of many; the library tells which of them each id belongs to."""
        out = []
        for i, e in enumerate(self.tokenizer.encode_batch([" ".join(some[i : i + LINE]) for i in range(0, len(some), LINE)], add_special_tokens=False)):
            own = np.fromiter(e.word_ids, np.int64, len(e))
            n = min(LINE, len(some) - i * LINE)
            ids = array("I", e.ids).tobytes()
            edges = (4 * np.searchsorted(own, np.arange(n + 1))).tolist()
            out += [ids[a:b] for a, b in zip(edges, edges[1:])]
        return out


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def load(path: str) -> Tokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokens(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Where n ids are cut: at each full sequence, and a tail of more than half of one at its half.

    No piece but a full one then exceeds half a sequence, so patterns leave next to no room.
    """
    edges = [*range(0, n, capacity), n]
    if n - edges[-2] > capacity // 2 and n - edges[-2] < capacity:
        edges.insert(-1, edges[-2] + capacity // 2)
    return list(zip(edges, edges[1:]))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most capacity ids of each document and its end id; ids array<int> too if asked for."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_bytes(text).alias("data"))
    end = np.array([end_id], "<u4").tobytes()

    def make():
        tokens = load(tokenizer)

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode([x.as_py().decode("utf-8", "replace") for x in batch.column("data")]), strict=True):
                ids += end
                n = len(ids) // 4
                for start, stop in cuts(n, capacity):
                    part = ids[4 * start : 4 * stop]
                    out.append((key, start, len(part) // 4, zlib.crc32(part), n, *([np.frombuffer(part, "<i4")] if with_ids else [])))
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + ([pa.array(columns[5], pa.list_(pa.int32()))] if with_ids else [])
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])])

        return fn

    return common.map_batches(rows, make, PIECES + (", ids array<int>" if with_ids else ""))


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best multiset of sizes 1..len(values) within capacity: (value, counts)."""
    n = len(values)
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        most = min(c, n)
        options = best[c - most : c][::-1] + values[:most]
        at = int(options.argmax())
        if options[at] > best[c - 1] + 1e-12:
            best[c], choice[c] = options[at], at + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(n, np.int64), capacity
    while c > 0:
        if choice[c]:
            counts[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def fractional(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Column generation: (patterns, one in a row; how often each is used, fractional). Size i + 1 is demanded demand[i] times."""
    sizes = np.flatnonzero(demand)
    m, need = len(sizes), demand[sizes].astype(float)
    columns = np.diag(capacity // (sizes + 1)).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ need
    for _ in range(MAX_COLUMNS):
        duals = inverse.sum(axis=0)
        values = np.zeros(len(demand))
        values[sizes] = np.maximum(duals, 0)
        value, counts = knapsack(values, capacity)
        if value <= 1 + GAP:  # used.sum() / value is a lower bound of the optimum
            break
        column = counts[sizes].astype(float)
        step = inverse @ column
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        theta = ratios[out]
        used = np.maximum(used - theta * step, 0)
        used[out] = theta
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = column
    patterns = np.zeros((m, len(demand)), np.int64)
    patterns[:, sizes] = np.rint(columns.T).astype(np.int64)
    return patterns, used


def best_fit(items: list[tuple[int, int]], capacity: int) -> list[dict[int, int]]:
    """Bins of sizes placed by decreasing size into the fullest bin that has room."""
    open_by_room: dict[int, list[dict[int, int]]] = {}
    bins: list[dict[int, int]] = []
    for size, n in sorted(items, reverse=True):
        for _ in range(n):
            room = next((r for r in range(size, capacity + 1) if open_by_room.get(r)), None)
            if room is None:
                chosen, room = {}, capacity
                bins.append(chosen)
            else:
                chosen = open_by_room[room].pop()
            chosen[size] = chosen.get(size, 0) + 1
            open_by_room.setdefault(room - size, []).append(chosen)
    return bins


def plan(histogram: dict[int, int], capacity: int = CLASSES) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: count}) patterns that hold exactly the histogram's sizes, each within capacity."""
    out = [(histogram[capacity], {capacity: 1})] if histogram.get(capacity) else []
    demand = np.zeros(capacity - 1, np.int64)
    for size, n in histogram.items():
        if size < capacity:
            demand[size - 1] = n
    left = demand.copy()
    if demand.any():
        patterns, used = fractional(demand, capacity)
        for pattern, times in zip(patterns, np.floor(used + 1e-6).astype(np.int64), strict=True):
            held = pattern > 0
            times = min(int(times), *(left[held] // pattern[held]).tolist()) if held.any() else 0
            if times > 0:
                left -= times * pattern
                out.append((times, {int(i) + 1: int(pattern[i]) for i in np.flatnonzero(pattern)}))
        alike: dict[tuple, int] = {}
        for one in best_fit([(int(i) + 1, int(left[i])) for i in np.flatnonzero(left)], capacity):
            key = tuple(sorted(one.items()))
            alike[key] = alike.get(key, 0) + 1
        out += [(n, dict(key)) for key, n in alike.items()]
    return out


def slots(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end rank, of it in a sequence, first sequence) of each pattern's sizes."""
    ranks: dict[int, int] = {}
    base, out = 0, []
    for times, held in patterns:
        for size, n in sorted(held.items(), reverse=True):
            first = ranks.get(size, 0)
            ranks[size] = first + times * n
            out.append((size, first, ranks[size], n, base))
        base += times
    return out


def place(cut: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES) -> DataFrame:
    """cut (a written table with doc_id, start, length, ...) with sequence_id and offset."""
    spark, width = cut.sparkSession, capacity // classes
    sized = cut.withColumn("size", F.ceil(F.col("length") / width).cast("int"))
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most classes rows
    n_salts = min(MAX_SALTS, max(1, sum(histogram.values()) // SALT_ROWS))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(n_salts)).cast("int"))
    counts = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = counts.select("size", "salt", (F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("size", "salt").orderBy(F.desc("length"), "doc_id", "start"))
    ranked = salted.withColumn("own", own).join(before, ["size", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    layout = spark.createDataFrame(slots(plan(histogram, classes)), "slot_size int, first long, end long, per int, base long")  # bounded by classes, not by rows
    on = (F.col("size") == F.col("slot_size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    placed = ranked.join(F.broadcast(layout), on).withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("per")).cast("long"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).select(*cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, classes: int = CLASSES, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """PIECES, sequence_id and offset of each piece (and ids); texts are tokenised once."""
    return place(common.saved(pieces(docs, tokenizer, capacity, doc_id=doc_id, text=text, with_ids=with_ids)), capacity, classes)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids) of pack(..., with_ids=True): pieces in order, padded to capacity unless the length is a power of two."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    whole = n.bitwiseAND(n - 1) == 0
    return ids.select("sequence_id", F.when(whole, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - n))).alias("ids"))
