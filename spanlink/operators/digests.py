"""Digests of lines and books, and what changed between two snapshots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spanlink.schemas import BOOK, LINE


def content_hash(content: Column) -> Column:
    """16 hex digits of a line's SHA-1; null content counts as empty."""
    return F.substring(F.sha1(F.coalesce(content, F.lit(""))), 1, 16)


def line_identity(content: Column, context: Column) -> Column:
    """128 bits of content and context, for matching inside the library."""
    return F.md5(F.concat(F.coalesce(content, F.lit("")), F.lit("\0"), context))


@F.pandas_udf(StringType())
def line_fingerprint(content: pd.Series, context: pd.Series) -> pd.Series:
    """BLAKE2b-128 of content and context, for exchange with stored baselines; there is no built-in for it."""
    return pd.Series([hashlib.blake2b(f"{a or ''}\0{b}".encode(), digest_size=16).hexdigest() for a, b in zip(content, context, strict=True)])


def book_digests(lines: DataFrame) -> DataFrame:
    """(source, title, hash, n_lines): SHA-1 over index, content and context of all lines in order, for exchange.

    The format makes a book sequential. Sorted lines are streamed through one running hash, so a task holds a batch of lines and no book.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha, n, done = None, None, 0, []
        for pdf in batches:
            for source, title, index, content, context in zip(*(pdf[c] for c in [*LINE, "content", "context"]), strict=True):
                if (source, title) != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()[:16], n))
                    now, sha, n = (source, title), hashlib.sha1(), 0
                sha.update(f"{index}\0{content}\0{context}\0".encode())
                n += 1
            yield pd.DataFrame(done, columns=[*BOOK, "hash", "n_lines"])
            done = []
        if now is not None:
            yield pd.DataFrame([(*now, sha.hexdigest()[:16], n)], columns=[*BOOK, "hash", "n_lines"])

    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("content", "context")]
    ordered = lines.select(*LINE, *text).repartition(*BOOK).sortWithinPartitions(*LINE)
    return ordered.mapInPandas(run, "source string, title string, hash string, n_lines long")


def book_identities(lines: DataFrame) -> DataFrame:
    """(source, title, hash, n_lines): a digest for comparison inside the library, that tasks combine before the shuffle.

    128 bits of each line's number and identity, added up by exclusive or; a book has each number once.
    """
    fp = line_identity(F.col("content"), F.col("context"))
    both = [F.bit_xor(F.xxhash64(F.lit(seed), "line_index", fp)) for seed in (1, 2)]
    return lines.groupBy(*BOOK).agg(F.concat(*[F.hex(x) for x in both], F.lit(":"), F.count("*").cast("string")).alias("hash"), F.count("*").alias("n_lines"))


def changed_books(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Books whose hash differs from the baseline's, new ones included: (source, title, hash, prior_hash)."""
    prior = baseline.select(*BOOK, F.col("hash").alias("prior_hash"))
    return current.join(prior, BOOK, "left").where(~F.col("hash").eqNullSafe(F.col("prior_hash"))).select(*BOOK, "hash", "prior_hash")


def removed_books(current: DataFrame, baseline: DataFrame) -> DataFrame:
    return baseline.join(current, BOOK, "left_anti").select(*BOOK)


def plan_summary(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: books that are new, edited, unchanged, removed."""
    prior = baseline.select(*BOOK, F.col("hash").alias("prior_hash"))
    kinds = current.select(*BOOK, "hash").join(prior, BOOK, "full_outer")
    return kinds.agg(
        F.count_if(F.col("prior_hash").isNull()).alias("n_new"),
        F.count_if(F.col("hash").isNotNull() & F.col("prior_hash").isNotNull() & (F.col("hash") != F.col("prior_hash"))).alias("n_edited"),
        F.count_if(F.col("hash") == F.col("prior_hash")).alias("n_same"),
        F.count_if(F.col("hash").isNull()).alias("n_removed"),
    )
