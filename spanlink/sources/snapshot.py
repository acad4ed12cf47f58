"""Snapshots: tables of lines with a small table that says what they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.operators.checks import ContractError, require
from spanlink.schemas import BOOK, LINE, LINES

META = {"schema_version": "2", "context_policy": "explicit-relative-v1"}


def write_snapshot(lines: DataFrame, path: str) -> None:
    """Books lie together and in order, so that readers of one book skip most row groups."""
    spark = lines.sparkSession
    lines.select(*LINES.names).repartitionByRange(*BOOK).sortWithinPartitions(*LINE).write.mode("errorifexists").parquet(f"{path}/lines")
    spark.createDataFrame(list(META.items()), "key string, value string").coalesce(1).write.mode("errorifexists").parquet(f"{path}/meta")


def read_snapshot(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The lines of a snapshot; another version or other columns are an error, and with check so are bad rows."""
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/meta").limit(100).collect()}
    if any(meta.get(k) != v for k, v in META.items()):
        raise ContractError(f"{path}: not a snapshot of this version: {meta}")
    lines = spark.read.parquet(f"{path}/lines")
    if set(lines.columns) != set(LINES.names):
        raise ContractError(f"{path}: columns {lines.columns}")
    if check:
        require(line_violations(lines), f"{path}: bad lines")
    return lines.select(*LINES.names)


def line_violations(lines: DataFrame) -> DataFrame:
    """Lines without a book, a number of 0 or more, or a context; and numbers that a book has twice."""
    bad = lines.where("source is null or title is null or trim(source) = '' or trim(title) = '' or line_index is null or line_index < 0 or trim(coalesce(context, '')) = ''")
    twice = lines.groupBy(*LINE).agg(F.count("*").alias("n")).where("n > 1")
    return bad.select(*LINE, F.lit("value").alias("problem")).unionByName(twice.select(*LINE, F.lit("twice").alias("problem")))


def book(lines: DataFrame, source: str, title: str) -> DataFrame:
    """One book's lines in order; the filter reaches the scan."""
    return lines.where((F.col("source") == source) & (F.col("title") == title)).orderBy("line_index")


def book_keys(lines: DataFrame) -> DataFrame:
    return lines.select(*BOOK).distinct().orderBy(*BOOK)


def requested(lines: DataFrame, books: DataFrame) -> DataFrame:
    """Lines of the requested books, all of which must be there, once each."""
    require(books.groupBy(*BOOK).agg(F.count("*").alias("n")).where("n > 1"), "requested twice")
    require(books.join(lines.select(*BOOK).distinct(), BOOK, "left_anti"), "requested but absent")
    return lines.join(books.select(*BOOK), BOOK, "left_semi")
