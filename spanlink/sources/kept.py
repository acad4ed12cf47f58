"""Tables that several steps read, written once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """The table written as Parquet to the folder in spark.checkpoint.dir and read from there: lost executors lose none of it, and each reader reads its columns only.

    Where that setting is absent a local folder is set for the session, in one process only; on a cluster it must be there.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spanlink-"))
    path = f"{context._jsc.sc().getCheckpointDir().get()}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
