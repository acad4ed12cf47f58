"""Packing of lines into requests, and sizes that guide the order of work."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions.text import words
from spanlink.schemas import BOOK, LINE


def transport_batches(lines: DataFrame, max_lines: int = 100, max_chars: int = 120_000) -> DataFrame:
    """(source, title, line_index, batch_start): greedy batches of at most so many lines and characters; a longer line is alone.

    batch_start is the position, in its whole book, of the batch's first line. Every batch depends on where the one before it ended, so a
    book's lines are streamed in order past one row of state. Only sizes are shuffled. selected (optional): lines to send.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, n, chars, start, place = None, 0, 0, 0, -1
        for pdf in batches:
            starts = []
            for source, title, size, selected in zip(pdf["source"], pdf["title"], pdf["size"], pdf["selected"], strict=True):
                if (source, title) != now:
                    now, n, chars, place = (source, title), 0, 0, -1
                place += 1
                if not selected:
                    starts.append(-1)
                    continue
                if n == 0 or n >= max_lines or chars + size > max_chars:
                    n, chars, start = 0, 0, place
                n, chars = n + 1, chars + size
                starts.append(start)
            yield pdf[LINE].assign(batch_start=starts)

    selected = F.coalesce("selected", F.lit(True)) if "selected" in lines.columns else F.lit(True)
    sizes = lines.select(*LINE, F.length(F.coalesce("content", F.lit(""))).alias("size"), selected.alias("selected"))
    ordered = sizes.repartition(*BOOK).sortWithinPartitions(*LINE)
    return ordered.mapInPandas(run, "source string, title string, line_index int, batch_start int").where("batch_start >= 0")


def seams(batches: DataFrame) -> DataFrame:
    """First line of every batch but a book's first."""
    firsts = batches.groupBy(*BOOK, "batch_start").agg(F.min("line_index").alias("line_index"))
    nth = F.row_number().over(Window.partitionBy(*BOOK).orderBy("batch_start"))
    return firsts.withColumn("nth", nth).where("nth > 1").select(*LINE)


def largest_first(lines: DataFrame) -> DataFrame:
    """(source, title, n_lines), by size, then key."""
    return lines.groupBy(*BOOK).agg(F.count("*").alias("n_lines")).orderBy(F.desc("n_lines"), *BOOK)


def batch_sizes(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """(source, title, batch_start, lines, words, chars)."""
    met = batches.join(lines, LINE)
    return met.groupBy(*BOOK, "batch_start").agg(F.count("*").alias("lines"), F.sum(words(F.col("content"))).alias("words"), F.sum(F.length(F.coalesce("content", F.lit("")))).alias("chars"))
