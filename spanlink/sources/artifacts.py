"""Link records as JSON lines, one file per book, and the checks on reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.functions.text import artifact_path
from spanlink.operators.checks import file_violations, record_violations, require
from spanlink.schemas import BOOK, LINE, LINKS

_REQUIRED = ["book_key", "line_index", "line_index_base", "start", "end", "target_ref"]
_OPTIONAL = ["source_path", "source_hash", "context_ref", "relative_direction"]
_NESTED = "book_key struct<source_name:string,canonical_he_title:string>, line_index int, line_index_base int, start int, end int, target_ref string, source_path string, source_hash string, context_ref string, relative_direction string"


def canonical(links: DataFrame) -> Column:
    """A record as JSON: keys in order, no spaces, nothing for null."""
    key = F.struct(F.col("title").alias("canonical_he_title"), F.col("source").alias("source_name")).alias("book_key")
    fields = {"book_key": key} | {c: F.col(c) for c in [*_REQUIRED[1:], *_OPTIONAL]}
    return F.to_json(F.struct(*[fields[c].alias(c) for c in sorted(fields)]))


def write_store(links: DataFrame, path: str) -> None:
    """A version of the store: checked records, partitioned by source, books together and in order.

    A store is never changed in place: the next version goes to another folder, and a book without links has no rows.
    """
    require(record_violations(links), "records")
    links.select(*LINKS.names).repartition("source", "title").sortWithinPartitions(*LINE, "start", "end", "target_ref").write.mode("errorifexists").partitionBy("source").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINKS).parquet(path).select(*LINKS.names)


def as_files(links: DataFrame) -> DataFrame:
    """(path, line): the lines of each book's artifact file, for an exporter that writes text by path."""
    return links.select(artifact_path(F.col("source"), F.col("title")).alias("path"), *LINE, "start", "end", "target_ref", canonical(links).alias("line"))


def link_counts(links: DataFrame) -> DataFrame:
    """(source, title, n_links), and a row of nulls with the number of all links of a store."""
    return links.rollup(*BOOK).agg(F.count("*").alias("n_links")).where("title is not null or source is null")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSONL artifacts, blank lines apart: unknown keys, missing keys and broken rules are errors that name the file."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    keys = F.json_object_keys("value")
    known = F.array(*[F.lit(c) for c in [*_REQUIRED, *_OPTIONAL]])
    needed = F.array(*[F.lit(c) for c in _REQUIRED])
    odd = F.coalesce((F.size(F.array_except(keys, known)) > 0) | (F.size(F.array_except(needed, keys)) > 0) | (F.size(keys) != F.size(F.array_distinct(keys))), F.lit(True))
    require(raw.where(odd).select("file", "value"), "keys")
    rows = raw.select("file", F.from_json("value", _NESTED, {"mode": "PERMISSIVE"}).alias("r"))
    links = rows.select("file", F.col("r.book_key.source_name").alias("source"), F.col("r.book_key.canonical_he_title").alias("title"), *[F.col(f"r.{c}").alias(c) for c in [*_REQUIRED[1:], *_OPTIONAL]])
    require(record_violations(links), "records")
    require(file_violations(links.select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("path"), *BOOK)), "files of other books")
    return links.select(*LINKS.names)
