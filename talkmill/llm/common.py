"""What the corpus operators share: table reading, Arrow batches, scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch; texts can be long, so a batch stays small.
BATCH_ROWS = 512
#: Bytes of text that one step of a batch function holds at a time.
SLICE_BYTES = 4 << 20
#: Rows and stored bytes up to which a written table is broadcast; beyond either the join is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 16 << 20
#: A key with this share of all rows is heavy: there are at most 1 / HEAVY of them.
HEAVY = 1 / 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators need, and this package on the executors.

    The package is shipped only if executors would not find it by themselves.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * SLICE_BYTES))
    root = Path(__file__).resolve().parents[2]
    found = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")] if p]
    if root in found or (Path(os.getcwd()) / "talkmill").resolve() == root / "talkmill":
        return
    context = spark.sparkContext
    if getattr(context, "_talkmill_shipped", False):
        return
    path = os.path.realpath(os.path.join(tempfile.gettempdir(), f"talkmill-{uuid.uuid4().hex}.zip"))
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "talkmill").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(path)
    context._talkmill_shipped = True


def scratch(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder that all executors share.

    The session's own setting is used; where none is set, a session in one process (as in
    tests) gets a local folder and a cluster is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="talkmill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/talkmill-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """df written as a table in the shared folder and read again: its lineage ends there. options are the writer's."""
    spark = df.sparkSession
    path = path or scratch(spark)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def some(df: DataFrame) -> bool:
    """Whether a written table has rows, by one job."""
    return df.agg(F.count("*")).first()[0] > 0


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most limit bytes in a binary column, a row at least."""
    start = total = 0
    for row, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if total and total + n > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


#: How to empty what a Python worker holds between batches, by operator.
_held: dict[str, Callable[[], None]] = {}


def hold(name: str, clear: Callable[[], None]) -> None:
    """Says that an operator now fills its store in this worker; the stores of other operators are emptied.

    Workers are used again, so without this a pipeline's stores would add up.
    """
    for other in [k for k in _held if k != name]:
        _held.pop(other)()
    _held[name] = clear


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "data", ends: bool = False) -> DataFrame:
    """mapInArrow by a function of bounded slices; make() builds it once in each task.

    ends: the function is called once more, with None, after the last slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, column):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
        if ends and (out := fn(None)) is not None and out.num_rows:
            yield out

    return df.mapInArrow(run, schema)


def fits(small: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to be broadcast, by its rows and by the bytes of its files."""
    if (small.count() if rows is None else rows) > most:
        return False
    return int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= BROADCAST_BYTES


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str, rows: int | None = None) -> DataFrame:
    """big joined with a written table: broadcast if it is small, else shuffled (skewed keys are split by AQE)."""
    return big.join(F.broadcast(small) if fits(small, rows) else small.hint("merge"), on, how)


def join_skewed(big: DataFrame, groups: DataFrame, on: list[str], total: int, n: str = "n", rows: int = BROADCAST_ROWS) -> DataFrame:
    """big joined with a written table of one row for each key, where n is the key's rows in big and total all rows.

    Few keys are broadcast. Of many keys the heavy ones, of which there are at most
    1 / HEAVY, are broadcast and the rest shuffled, so no task gets a heavy key whole.
    """
    if fits(groups, most=rows):
        return big.join(F.broadcast(groups), on)
    limit = int(HEAVY * total) + 1
    heavy, light = groups.filter(F.col(n) > limit), groups.filter(F.col(n) <= limit)
    rest = big.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return big.join(F.broadcast(heavy), on).unionByName(rest.join(light.hint("merge"), on))
