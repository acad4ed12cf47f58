"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the package calls a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see, inside spark.checkpoint.dir.

    Where that setting is absent a local folder is set once for the session, in one process only; on a cluster it must be there.
    The folders hold intermediate tables and archives; their owner may expire them after the result is written.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            root = jvm_dir.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        else:
            root = "file://" + tempfile.mkdtemp(prefix="spanlink-")
            spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/spanlink-{uuid.uuid4().hex}"


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, lost executors lose nothing."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting the (materialized) rows; a larger table is left to shuffle joins."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what a Python worker has freed to the system: workers outlive their tasks, and what they keep adds to later stages' memory."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def beside(df: DataFrame, carried: list[str], used: list[str], made: str, start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """Columns `carried` as they are, and those that a function makes of each batch of columns `used`; `start` gives a task that function.

    What is carried stays in Arrow: in pandas a column of long numbers with a null in it becomes floating-point, and large ids change.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = start()
        for batch in batches:
            columns = [batch.column(c) for c in carried] + each(batch)
            yield pa.RecordBatch.from_arrays(columns, [*carried, *names])
            del columns, batch
            give_back()

    rows = df.select(*dict.fromkeys([*carried, *used]))
    names = [field.split()[0] for field in made.split(", ")]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in carried] + [made]))
