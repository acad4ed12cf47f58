"""Binary files in the shared folder, written and read inside tasks.

A file is written under a name of its task attempt and then moved to its final name, which depends only on the
partition; a repeated or speculative attempt replaces it with the same bytes.
"""

from __future__ import annotations

import contextlib
import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, shared_dir


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


@contextlib.contextmanager
def replacing(uri: str) -> Iterator:
    """An output stream whose bytes appear under `uri` only when the block ends well."""
    fs, path = resolve(uri)
    parent = path.rpartition("/")[0]
    fs.create_dir(parent, recursive=True)
    own = f"{parent}/.{uuid.uuid4().hex}.tmp"
    out = fs.open_output_stream(own)
    try:
        yield out
    except BaseException:
        out.close()
        with contextlib.suppress(OSError):
            fs.delete_file(own)
        raise
    out.close()
    fs.move(own, path)


def reading(uri: str):
    fs, path = resolve(uri)
    return fs.open_input_stream(path)


def text_files(docs: DataFrame, file_bytes: int) -> DataFrame:
    """(file, path, bytes): rows (doc_id, text as binary) in files of about `file_bytes` in the shared folder, a longer text in one of its own."""
    folder = shared_dir(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), itertools.count()
        held: list[pa.RecordBatch] = []
        size = 0

        def write() -> pa.RecordBatch:
            k = next(number)
            path = f"{folder}/{part:06d}-{k:06d}.parquet"
            with replacing(path) as out:
                pq.write_table(pa.Table.from_batches(held), out, compression="zstd", row_group_size=4096)
            return pa.RecordBatch.from_pydict({"file": [(part << 32) + k], "path": [path], "bytes": [size]})

        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64)
                held.append(some)
                size += sum(len(t) for t in some.column("text").to_pylist() if t)
                if size >= file_bytes:
                    yield write()
                    held, size = [], 0
        if held:
            yield write()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, "file long, path string, bytes long"))
