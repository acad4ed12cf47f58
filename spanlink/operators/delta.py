"""Which lines of changed books can keep their results, and which must be computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions.text import SAME_PLACE
from spanlink.operators.digests import line_identity
from spanlink.schemas import BOOK, LINE


#: Lines of a bucket in joins of lines with ranges.
WIDTH = 256


def identified(lines: DataFrame) -> DataFrame:
    return lines.select(*LINE, line_identity(F.col("content"), F.col("context")).alias("fp"))


def same_index(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Lines that stand where they stood: (source, title, old_index, new_index) from identified lines."""
    met = current.join(prior, [*LINE, "fp"])
    return met.select(*BOOK, F.col("line_index").alias("old_index"), F.col("line_index").alias("new_index"))


def moved(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Of the remaining lines, equal ones in pairs, the k-th old with the k-th new."""
    left = current.join(prior, [*LINE, "fp"], "left_anti")
    gone = prior.join(current, [*LINE, "fp"], "left_anti")
    nth = F.row_number().over(Window.partitionBy(*BOOK, "fp").orderBy("line_index"))
    a = left.select(*BOOK, "fp", nth.alias("k"), F.col("line_index").alias("new_index"))
    b = gone.select(*BOOK, "fp", nth.alias("k"), F.col("line_index").alias("old_index"))
    return a.join(b, [*BOOK, "fp", "k"]).select(*BOOK, "old_index", "new_index")


def reuse(current: DataFrame, prior: DataFrame) -> DataFrame:
    return same_index(current, prior).unionByName(moved(current, prior))


def recompute(current: DataFrame, pairs: DataFrame) -> DataFrame:
    """Lines of the current snapshot that no pair covers."""
    return current.join(pairs.select(*BOOK, F.col("new_index").alias("line_index")), LINE, "left_anti").select(*LINE)


def partition_violations(current: DataFrame, pairs: DataFrame, again: DataFrame) -> DataFrame:
    """Lines that aren't covered exactly once by reuse or recomputation; none when the plan is sound."""
    covered = pairs.select(*BOOK, F.col("new_index").alias("line_index")).unionAll(again.select(*LINE))
    times = covered.groupBy(*LINE).agg(F.count("*").alias("times"))
    known = current.select(*LINE, F.lit(True).alias("known"))
    return known.join(times, LINE, "full_outer").where("known is null or times is null or times <> 1").select(*LINE, F.coalesce("times", F.lit(0)).alias("times"))


def ranges(lines: DataFrame) -> DataFrame:
    """Line numbers as half-open ranges (source, title, start, end), by gaps and islands."""
    once = lines.select(*LINE).distinct()
    island = F.col("line_index") - F.row_number().over(Window.partitionBy(*BOOK).orderBy("line_index"))
    return once.withColumn("island", island).groupBy(*BOOK, "island").agg(F.min("line_index").alias("start"), (F.max("line_index") + 1).alias("end")).drop("island")


def in_ranges(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines inside a range of their book: an equi-join on buckets of WIDTH lines that a range touches."""
    bucket = F.explode(F.sequence(F.floor(F.col("start") / WIDTH), F.floor((F.col("end") - 1) / WIDTH)))
    posted = ranges.where("end > start").select(*BOOK, F.col("start").alias("r_start"), F.col("end").alias("r_end"), bucket.alias("bucket"))
    inside = (F.col("line_index") >= F.col("r_start")) & (F.col("line_index") < F.col("r_end"))
    found = lines.withColumn("bucket", F.floor(F.col("line_index") / WIDTH)).alias("l")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in [*BOOK, "bucket"]]
    return found.join(posted.alias("r"), (on[0]) & on[1] & on[2] & inside, "left_semi").select(*lines.columns)


def range_violations(ranges: DataFrame) -> DataFrame:
    """Ranges that are empty, negative or overlap the one before."""
    before = F.lag("end").over(Window.partitionBy(*BOOK).orderBy("start", "end"))
    return ranges.withColumn("before", before).where("start < 0 or end <= start or before > start").select(*BOOK, "start", "end")


def needs_context(lines: DataFrame, pattern: str = SAME_PLACE) -> DataFrame:
    """(source, title, book_context): whether some line leans on the lines above it."""
    return lines.groupBy(*BOOK).agg(F.bool_or(F.coalesce(F.col("content").rlike(pattern), F.lit(False))).alias("book_context"))


def order_kept(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(source, title, kept): whether the reused lines with entities keep their order; entities: (source, title, line_index) of old lines."""
    old = pairs.join(entities.withColumnRenamed("line_index", "old_index"), [*BOOK, "old_index"])
    before = F.lag("old_index").over(Window.partitionBy(*BOOK).orderBy("new_index"))
    return old.withColumn("before", before).groupBy(*BOOK).agg(F.bool_and(F.coalesce(F.col("old_index") > F.col("before"), F.lit(True))).alias("kept"))


def seam_counts(lines: DataFrame, seams: DataFrame) -> DataFrame:
    """(source, title, counts): entity lines before each seam, distinct and sorted, without 0; null if any flag is unknown.

    lines: (source, title, line_index, entity boolean); seams: (source, title, line_index).
    """
    before = Window.partitionBy(*BOOK).orderBy("line_index").rowsBetween(Window.unboundedPreceding, -1)
    run = lines.withColumn("n", F.coalesce(F.sum(F.col("entity").cast("int")).over(before), F.lit(0)))
    at = run.join(seams.select(*LINE, F.lit(True).alias("seam")), LINE, "left")
    counts = F.array_sort(F.collect_set(F.when(F.col("seam") & (F.col("n") > 0), F.col("n"))))
    return at.groupBy(*BOOK).agg(F.when(F.count_if(F.col("entity").isNull()) == 0, counts).alias("counts"))


def context_probe(prior_context: Column, unknown_flags: Column, reused: Column, dropped_entities: Column, kept: Column, seams_equal: Column) -> Column:
    """Whether a book that leans on context may be probed instead of computed whole."""
    return prior_context & ~unknown_flags & (reused > 0) & (dropped_entities == 0) & kept & seams_equal
