"""Comparing the records of two rule versions, and accounts of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.schemas import LINE

KINDS = ("unchanged", "added", "removed", "changed")


def replay_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, title, line_index, start, end, before, after, kind) by a full outer join on the span."""
    keys = [*LINE, "start", "end"]
    met = before.select(*keys, F.col("target_ref").alias("before")).join(after.select(*keys, F.col("target_ref").alias("after")), keys, "full_outer")
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") == F.col("after"), "unchanged").otherwise("changed")
    return met.withColumn("kind", kind)


def replay_counts(diff: DataFrame) -> DataFrame:
    """(kind, n), a row for every kind, 0 included."""
    kinds = diff.sparkSession.createDataFrame([(k,) for k in KINDS], "kind string")
    return kinds.join(diff.groupBy("kind").agg(F.count("*").alias("n")), "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


def provenance(books: DataFrame) -> DataFrame:
    """One row of counters from (status, lines_reused, lines_computed, lives): adopted + computed + failed must be the total."""
    return books.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "adopted").alias("adopted"),
        F.count_if(F.col("status") == "computed").alias("computed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("lines_reused"), F.lit(0)).alias("lines_reused"),
        F.coalesce(F.sum("lines_computed"), F.lit(0)).alias("lines_computed"),
        F.coalesce(F.sum(F.greatest(F.col("lives") - 1, F.lit(0))), F.lit(0)).alias("replaced"),
    )


def fingerprint_parts(fingerprints: DataFrame) -> DataFrame:
    """(fingerprint, part, value) of `k=v;k=v` strings."""
    return fingerprints.select("fingerprint", F.explode(F.str_to_map("fingerprint", F.lit(";"), F.lit("="))).alias("part", "value"))


def migrations_for(pairs: DataFrame, registry: DataFrame) -> DataFrame:
    """(from, to, review): exactly registered migrations; a pair that is registered more than once is dropped as undecided."""
    met = pairs.join(registry, ["from", "to"])
    return met.groupBy("from", "to").agg(F.count("*").alias("n"), F.min("review").alias("review")).where("n = 1").drop("n")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.exceptAll(right)
