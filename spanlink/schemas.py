"""Shapes of the tables that the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

#: One row per line of a snapshot; a book is (source, title).
LINES = T.StructType([T.StructField("source", T.StringType(), False), T.StructField("title", T.StringType(), False), T.StructField("line_index", T.IntegerType(), False), T.StructField("content", T.StringType()), T.StructField("context", T.StringType(), False)])
#: A link from a span of a line (UTF-16 code units, end exclusive) to a target reference.
LINKS = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("line_index", T.IntegerType(), False),
        T.StructField("line_index_base", T.IntegerType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("target_ref", T.StringType(), False),
        T.StructField("source_path", T.StringType()),
        T.StructField("source_hash", T.StringType()),
        T.StructField("context_ref", T.StringType()),
        T.StructField("relative_direction", T.StringType()),
    ]
)
#: One row per recognized entity of a line; parts are relative to the entity.
MENTIONS = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("line_index", T.IntegerType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("parts", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    ]
)
BOOK = ["source", "title"]
LINE = [*BOOK, "line_index"]
