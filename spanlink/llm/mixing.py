"""Mixing sources to target weights by hash thresholds.

Every document gets a 24-bit cell from the MD5 of its id and text. Sizes are summed by source and coarse bucket (the cell's top
12 bits); each source's budget is nested in that histogram, so a running sum finds the one bucket where it ends, and
only that bucket is summed again by single cells. The result is a threshold per source, and choosing documents is a
filter on the cell: nothing is sorted, and a larger budget always keeps what a smaller one kept.

Defined cases: null text has size 0; a null source is a source of its own, last in order; rows with null or repeated ids have cells by
their texts; rows of equal id and text each count and share one decision; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.common import broadcast_if_small, materialize, table, word_count

#: Bits of a cell's number that a coarse bucket drops.
FINE_BITS = 12
#: More sources than this are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def cell(doc_id: Column, text: Column) -> Column:
    """24 bits of the MD5 of the id's decimal text and the text's MD5."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    The k-th source in code-point order, null last, has weight weights[k mod len(weights)]. Targets share the total size by weight,
    none above max_repeat times its source: the level of a water-filling over sources in order of cap per weight.
    The windows span one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), k + 1).cast("long")
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat)
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(every)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), cell(F.col("doc_id"), F.col("text")).alias("cell"))


def mix_rule(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, target, whole, threshold), one row per source of a table that sizes() made.

    The mix takes each document `whole` times, and once more where its cell is at most `threshold`.
    """
    coarse = sized.groupBy("source", F.shiftright("cell", FINE_BITS).alias("bucket")).agg(F.sum("size").alias("words"))
    coarse = materialize(coarse)
    totals = source_targets(coarse.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    # whole passes over the source, and the words that one more, partial pass may add
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = materialize(totals.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    small_plan = broadcast_if_small(plan, BROADCAST_SOURCES)

    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    run = coarse.withColumn("upto", F.sum("words").over(upto)).alias("h").join(small_plan.alias("p"), F.col("h.source").eqNullSafe(F.col("p.source")))
    boundary = run.where((F.col("budget") > 0) & (F.col("upto") > F.col("budget"))).groupBy("h.source").agg(F.min(F.struct("bucket", F.col("upto"), "words", "budget")).alias("b"))
    boundary = boundary.select("source", "b.bucket", (F.col("b.upto") - F.col("b.words")).alias("below"), "b.budget")
    boundary = broadcast_if_small(materialize(boundary), BROADCAST_SOURCES)

    # the boundary bucket alone, by single cells; a cell is in when at least half of it fits
    fine = sized.alias("d").join(boundary.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.shiftright("d.cell", FINE_BITS) == F.col("b.bucket")))
    fine = fine.groupBy("d.source", "d.cell", "b.below", "b.budget").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("words").over(before), F.lit(0))
    fits = fine.withColumn("start", start).where(F.col("start") * 2 + F.col("words") <= F.col("budget") * 2)
    last = fits.groupBy("source").agg(F.max("cell").alias("last"))
    edge = boundary.alias("b").join(last.alias("l"), F.col("b.source").eqNullSafe(F.col("l.source")), "left")
    edge = edge.select("b.source", F.coalesce("last", F.shiftleft("bucket", FINE_BITS) - 1).alias("threshold"))

    # no boundary: the partial pass has room for the whole source, which whole passes leave only to sources of size 0
    rule = plan.alias("p").join(edge.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left").select("p.*", F.coalesce("threshold", F.lit(-1)).alias("threshold"))
    return broadcast_if_small(materialize(rule), BROADCAST_SOURCES)


def with_copies(rows: DataFrame, rule: DataFrame, cell: Column) -> DataFrame:
    """`rows` (struct column d, source among its fields) with the rule's columns and `copies`, at most max_repeat of each."""
    met = rows.join(rule, F.col("d.source").eqNullSafe(rule["source"]))
    return met.withColumn("copies", F.col("whole") + (cell <= F.col("threshold")).cast("int"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of `docs` (doc_id, source, text); taken = size * copies."""
    sized = materialize(sizes(docs))
    out = with_copies(sized.select(F.struct("*").alias("d")), mix_rule(sized, weights, max_repeat), F.col("d.cell"))
    return out.select("d.doc_id", "d.source", "d.size", "source_size", "target", "copies", (F.col("d.size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken."""
    rule = mix_rule(materialize(sizes(docs)), weights, max_repeat)
    out = with_copies(docs.select(F.struct("*").alias("d")), rule, cell(F.col("d.doc_id"), F.col("d.text")))
    return out.where("copies > 0").select("d", F.explode(F.sequence(F.lit(1), "copies"))).select("d.*")


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 6))::INTEGER AS cell
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / weight AS ratio FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio)) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (
  SELECT source, cell, sum(size) AS words, coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d GROUP BY source, cell),
k AS (
  SELECT c.source, c.cell FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
  WHERE c.start * 2 + c.words <= (p.target - p.whole * p.source_size) * 2 AND p.target > p.whole * p.source_size)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.whole + CASE WHEN k.cell IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.cell = k.cell
"""
