"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the 128-bit hash of its stripped, A-Z lower-cased bytes. The exact
table is a log of (key, document, +1 or -1) rows, one generation for each insertion
or deletion; a key's reference count is the number of its live documents and its
owner the smallest of them. Each shard of keys has a cuckoo filter over its live
keys. An insertion asks it slice by slice: a key that it does not hold is put in, and
one that it may hold is noted, as is one that a slice has from several documents. Only
noted keys can be in two documents, and only they are counted in the log. A deletion
takes out the fingerprints of keys whose count falls to 0, so deleting a batch restores
what was before it.

A key in many documents is counted map-side. Where keys meet their documents again,
the keys that hold a large share of all rows (a bounded number) are broadcast and
the others shuffled.

Defined cases: a null text is one empty line; null ids count as one document that
comes after all others; a row that repeats an id is the same document; other columns
are ignored by digests() and kept by dedup(); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_CHARS = 10
#: White space that is stripped (fixed by the contract).
SPACE = b" \t\n\x0b\x0c\r"
#: Keys that a shard is sized for, and slots in a bucket of its filter.
SHARD_KEYS, SLOTS = 50_000, 4
#: Rows of the log that a task counts at once, and rows that ask a filter at once.
TASK_ROWS, ASK_ROWS = 500_000, 8192
NULL_ID = (1 << 63) - 1
KEY = ["hi", "lo"]


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte key of a line, None if its text has fewer code points."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """16-bit fingerprints in buckets of SLOTS; a bulk insertion places whole arrays in rounds."""

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (0.8 * SLOTS)))))
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table = table

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first bucket) of keys by their low halves."""
        h = lo.astype(np.uint64)
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        return print_, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ (print_.astype(np.int64) * 0x5BD1 & len(self.table) - 1)

    def contains(self, lo: np.ndarray) -> np.ndarray:
        print_, at = self.places(lo)
        hit = (self.table[at] == print_[:, None]).any(axis=1)
        return hit | (self.table[self.other(at, print_)] == print_[:, None]).any(axis=1)

    def insert(self, lo: np.ndarray, rounds: int = 500) -> bool:
        """Adds every key; False if some found no place (the filter is too small then)."""
        print_, at = self.places(lo)
        print_, at = self._fill(print_, at)
        at = self.other(at, print_)
        for turn in range(rounds):
            print_, at = self._fill(print_, at)
            if not len(at):
                return True
            order = np.argsort(at, kind="stable")
            print_, at = print_[order], at[order]
            first = np.ones(len(at), bool)
            first[1:] = at[1:] != at[:-1]
            slot = (turn + at[first]) % SLOTS
            moved = self.table[at[first], slot].copy()
            self.table[at[first], slot] = print_[first]
            print_ = np.concatenate([moved, print_[~first]])
            at = np.concatenate([self.other(at[first], moved), at[~first]])
        return not len(at)

    def _fill(self, print_: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places what has a free slot; returns the rest."""
        for slot in range(SLOTS):
            if not len(at):
                break
            free = self.table[at, slot] == 0
            _, one = np.unique(at, return_index=True)
            chosen = np.zeros(len(at), bool)
            chosen[one] = True
            chosen &= free
            self.table[at[chosen], slot] = print_[chosen]
            print_, at = print_[~chosen], at[~chosen]
        return print_, at

    def remove(self, lo: np.ndarray) -> None:
        """Takes out one fingerprint of each key, which must be held."""
        for p, a in zip(*self.places(lo), strict=True):
            for b in (a, self.other(np.array([a]), np.array([p]))[0]):
                slot = np.flatnonzero(self.table[b] == p)
                if len(slot):
                    self.table[b, slot[0]] = 0
                    break


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, doc_id): each document's distinct keys."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), common.text_bytes(text).alias("data"))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, owners = [], []
            for key, data in zip(batch.column("doc_id").to_pylist(), batch.column("data"), strict=True):
                own = {k for line in data.as_py().split(b"\n") if (k := line_key(line, min_chars))}
                found += own
                owners += [key] * len(own)
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(owners, pa.int64())], ["hi", "lo", "doc_id"])

        return fn

    return common.map_batches(rows, make, "hi long, lo long, doc_id long")


def grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, sum of weights) of each distinct row of keys."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ranked = keys[order]
    first = np.ones(len(order), bool)
    first[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    starts = np.flatnonzero(first)
    return order[starts], np.add.reduceat(weights[order], starts) if len(order) else weights


def collapsed(rows: DataFrame) -> DataFrame:
    """(hi, lo, n): a row for each key and slice of a task, with the slice's rows of the key."""

    def run(batches):
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            keys = np.concatenate(held)
            held.clear()
            at, n = grouped(keys, np.ones(len(keys), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(keys[at, 0]), pa.array(keys[at, 1]), pa.array(n)], [*KEY, "n"])

        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY], axis=1))
            if sum(map(len, held)) > TASK_ROWS:
                yield counted()
        if held:
            yield counted()

    return rows.select(*KEY).mapInArrow(run, "hi long, lo long, n long")


class LineIndex:
    """The log of references and the filters, under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int | None = None, min_chars: int = MIN_CHARS):
        self.spark, self.path, self.shards, self.min_chars = spark, path or common.scratch(spark), shards, min_chars
        self.generations: list[str] = []
        self.filters: DataFrame | None = None
        self.noted: DataFrame | None = None
        self.deleted = False

    def log(self) -> DataFrame:
        return self.spark.read.schema("hi long, lo long, doc_id long, sign int").parquet(*self.generations)

    def live(self) -> DataFrame:
        """(hi, lo, doc_id) of the references that stand."""
        if not self.deleted:
            return self.log().drop("sign")
        return self.log().groupBy("hi", "lo", "doc_id").agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")

    def counts(self) -> DataFrame:
        """(hi, lo, n, owner, last): live references, smallest and largest document of each key."""
        return self.live().groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))

    def _append(self, pairs: DataFrame, sign: int) -> DataFrame:
        path = f"{self.path}/log-{len(self.generations)}"
        out = common.saved(pairs.select("hi", "lo", "doc_id", F.lit(sign).alias("sign")), path)
        self.generations.append(path)
        return out.drop("sign")

    def _shard(self) -> Column:
        return F.pmod(F.col("hi"), F.lit(self.shards)).cast("int").alias("shard")

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Adds the documents' lines."""
        before = self.live().select(*KEY).distinct() if self.generations else None
        rows = self._append(line_keys(docs, doc_id, text, self.min_chars), 1)
        if self.shards is None:
            self.shards = max(1, rows.count() // SHARD_KEYS + 1)
        asked = self._ask(collapsed(rows))
        own = asked.select(F.inline(F.arrays_zip(*KEY, "n")))
        self.noted = own if self.noted is None else self.noted.unionByName(own)
        unknown = asked.filter("not full").select(F.inline(F.arrays_zip(F.col("new_hi").alias("hi"), F.col("new_lo").alias("lo"))))
        self.filters = self._rebuilt(asked.select("shard", "blob", "full"))
        if before is not None:  # the exact answer for what the filters may hold: keys that do not stand are put in
            self._change(unknown.join(before.hint("merge"), KEY, "left_anti"), "insert")

    def delete(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Takes the documents' references back; they must have been inserted with the same texts."""
        gone = self._append(line_keys(docs, doc_id, text, self.min_chars), -1).select(*KEY).distinct()
        self.deleted = True
        self._change(gone.join(self.live().select(*KEY).distinct(), KEY, "left_anti"), "remove")

    def _ask(self, keys: DataFrame) -> DataFrame:
        """(shard, blob, full, hi, lo, n, new_hi, new_lo), written: new filters, noted keys, and those of them whose place in the filter is in doubt."""

        def run(key, some: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            rows, n, full = some[KEY].to_numpy(np.int64), some.n.to_numpy(np.int64), False
            own = CuckooFilter.load(held.blob[0]) if len(held) else CuckooFilter(2 * min(len(rows), SHARD_KEYS))
            added, noted, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start in range(0, len(rows), ASK_ROWS):
                at, count = grouped(rows[start : start + ASK_ROWS], n[start : start + ASK_ROWS])
                at = at + start
                seen = own.contains(rows[at, 1]) | full  # a full filter has lost keys: whatever comes after is noted
                full = not own.insert(rows[at[~seen], 1]) or full
                added.append(at[~seen])
                noted.append(at[seen | (count > 1)])
                times.append(count[seen | (count > 1)])
            put, asked = np.concatenate(added), np.concatenate(noted)
            at, count = grouped(rows[asked], np.concatenate(times))
            kept = rows[asked[at]]
            both = np.concatenate([put, asked])
            at, known = grouped(rows[both], (np.arange(len(both)) < len(put)).astype(np.int64))
            doubt = rows[both[at[known == 0]]]
            if not len(held):  # nothing stood before: all of it is new
                full, doubt = not own.insert(doubt[:, 1]) or full, doubt[:0]
            return pd.DataFrame({"shard": [key[0]], "blob": [own.dump()], "full": [full], "hi": [kept[:, 0]], "lo": [kept[:, 1]], "n": [count], "new_hi": [doubt[:, 0]], "new_lo": [doubt[:, 1]]})

        out = keys.withColumn("shard", self._shard()).groupBy("shard").cogroup(self._held().groupBy("shard"))
        return common.saved(out.applyInPandas(run, "shard int, blob binary, full boolean, hi array<long>, lo array<long>, n array<long>, new_hi array<long>, new_lo array<long>"))

    def _held(self) -> DataFrame:
        return self.filters if self.filters is not None else self.spark.createDataFrame([], "shard int, blob binary")

    def _change(self, keys: DataFrame, what: str) -> None:
        """New filters after keys were inserted or removed; a shard that is full is built again with room."""

        def run(key, some: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            lo, full = some.lo.to_numpy(), False
            own = CuckooFilter.load(held.blob[0]) if len(held) else CuckooFilter(2 * len(lo))
            if what == "insert":
                full = not own.insert(lo)
            else:
                own.remove(lo)
            return pd.DataFrame({"shard": [key[0]], "blob": [own.dump()], "full": [full]})

        out = keys.withColumn("shard", self._shard()).groupBy("shard").cogroup(self._held().groupBy("shard"))
        self.filters = self._rebuilt(common.saved(out.applyInPandas(run, "shard int, blob binary, full boolean")))

    def _rebuilt(self, out: DataFrame) -> DataFrame:
        """The filters of a written table, those that are full built again."""
        full = out.filter("full").select("shard")
        if full.head(1):
            grown = self.live().select(*KEY).distinct().withColumn("shard", self._shard()).join(full, "shard")

            def build(key, some: pd.DataFrame) -> pd.DataFrame:
                room = 2 * len(some)
                while not (own := CuckooFilter(room)).insert(some.lo.to_numpy()):
                    room *= 2
                return pd.DataFrame({"shard": [key[0]], "blob": [own.dump()], "full": [False]})

            out = common.saved(out.filter("not full").unionByName(grown.groupBy("shard").applyInPandas(build, out.schema)))
        return out.drop("full")

    def drops(self) -> DataFrame:
        """(doc_id, keys array<struct<hi, lo>>): what each document loses because a smaller one holds it."""
        total = self.log().count()
        noted = common.saved(self.noted.groupBy(*KEY).agg(F.sum("n").alias("n")))
        live = common.saved(common.join_skewed(self.live(), noted, KEY, total).drop("n"))
        shared = live.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last")
        lost = common.join_skewed(live, common.saved(shared.drop("last")), KEY, total).filter("doc_id <> owner")
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("keys"))

    def _kept(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        """(row: all columns but text, data, none, keys) of each document."""
        rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("__key"), F.struct(F.col(doc_id).alias("__id"), *[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), common.text_bytes(text).alias("data"), F.col(text).isNull().alias("none"))
        return rows.join(self.drops().select(F.col("doc_id").alias("__key"), "keys"), "__key", "left").drop("__key")

    def digests(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept_sha256) of documents that were inserted."""
        rows = self._kept(docs.select(doc_id, text), doc_id, text).select(F.col("row.__id").cast("long").alias("doc_id"), "data", "keys")
        min_chars = self.min_chars

        def make():
            def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
                out = [(n, n - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()) for n, kept in (stripped(*x, min_chars) for x in zip(batch.column("data"), batch.column("keys"), strict=True))]
                columns = list(zip(*out, strict=True))
                return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2])], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

            return fn

        return common.map_batches(rows, make, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")

    def dedup(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """docs with the lines that they lose taken out of text; a null text stays null."""
        rows, min_chars = self._kept(docs, doc_id, text), self.min_chars

        def make():
            def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
                texts = [None if none else b"\n".join(stripped(data, keys, min_chars)[1]).decode("utf-8", "replace") for data, keys, none in zip(batch.column("data"), batch.column("keys"), batch.column("none").to_pylist(), strict=True)]
                return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

            return fn

        out = common.map_batches(rows, make, f"row {rows.schema['row'].dataType.simpleString()}, text string")
        return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def stripped(data: pa.Scalar, keys: pa.Scalar, min_chars: int) -> tuple[int, list[bytes]]:
    """(number of lines, lines that stay) of a text and the keys it loses."""
    lines = data.as_py().split(b"\n")
    if not keys.is_valid:
        return len(lines), lines
    values = keys.values
    lost = np.stack([values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1).astype("<i8")
    gone = {x.tobytes() for x in lost}
    return len(lines), [line for line in lines if line_key(line, min_chars) not in gone]


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the lines that a smaller document holds, by a new index of them alone."""
    index = LineIndex(docs.sparkSession)
    index.insert(docs, doc_id, text)
    return index.dedup(docs, doc_id, text)


SQL = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM cut),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
shared AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= {min_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def oracle() -> str:
    return SQL.replace("{min_chars}", str(MIN_CHARS))
