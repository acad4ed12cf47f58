"""Constraints as queries: each returns the rows that break a rule, and require() turns any into a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.functions.text import artifact_path, utf16_length
from spanlink.operators.digests import content_hash
from spanlink.schemas import BOOK, LINE

#: Rules of a link record, by name: what breaks them.
RECORD_RULES: dict[str, str] = {
    "book": "coalesce(source, '') = '' or coalesce(title, '') = ''",
    "line_index": "line_index is null or line_index < 0",
    "line_index_base": "line_index_base is null or line_index_base <> 0",
    "start": "start is null or start < 0",
    "end": "end is null or end <= start",
    "target_ref": "coalesce(trim(target_ref), '') = ''",
    "source_hash": "source_hash is not null and not source_hash rlike '^[0-9a-f]{16}$'",
    "context_pair": "(context_ref is null) <> (relative_direction is null)",
    "relative_direction": "relative_direction is not null and relative_direction not in ('above', 'below')",
}


class ContractError(ValueError):
    """Data that breaks a contract; nothing is written after it."""


def require(violations: DataFrame, what: str) -> None:
    """Raise with a few examples if there are any rows."""
    some = violations.limit(5).collect()
    if some:
        raise ContractError(f"{what}: {[r.asDict() for r in some]}")


def record_violations(links: DataFrame) -> DataFrame:
    """(source, title, line_index, start, end, rule): a row for each broken rule of each record."""
    broken = F.filter(F.array(*[F.when(F.expr(f"coalesce({rule}, true)"), F.lit(name)) for name, rule in RECORD_RULES.items()]), lambda x: x.isNotNull())
    return links.select(*LINE, "start", "end", F.explode(broken).alias("rule"))


def place_violations(links: DataFrame, lines: DataFrame) -> DataFrame:
    """(.., problem): records whose line is missing, whose hash or context isn't the line's, or that end after it in UTF-16 units."""
    known = lines.select(*LINE, "content", "context", F.lit(True).alias("known"))
    met = links.join(known, LINE, "left")
    problem = (
        F.when(F.col("known").isNull(), "line")
        .when(F.col("source_hash") != content_hash(F.col("content")), "hash")
        .when(F.col("context_ref") != F.col("context"), "context")
        .when(F.col("end") > utf16_length(F.coalesce("content", F.lit(""))), "end")
    )
    return met.withColumn("problem", problem).where("problem is not null").select(*LINE, "start", "end", "problem")


def duplicate_places(links: DataFrame) -> DataFrame:
    """Spans with more than one record."""
    return links.groupBy(*LINE, "start", "end").agg(F.count("*").alias("n")).where("n > 1")


def file_violations(records: DataFrame) -> DataFrame:
    """(path, problem): files (path, source, title) that hold several books, or a book whose own path is another; paths may be absolute."""
    own = F.endswith("path", artifact_path(F.col("source"), F.col("title")))
    files = records.groupBy("path").agg(F.count_distinct(*BOOK).alias("books"), F.bool_and(own).alias("own"))
    problem = F.when(F.col("books") != 1, "books").when(~F.col("own"), "path")
    return files.withColumn("problem", problem).where("problem is not null").select("path", "problem")


def missing(planned: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return planned.join(done, keys, "left_anti").select(*keys)


def not_superset(larger: DataFrame, smaller: DataFrame) -> DataFrame:
    """(source, title): books whose larger set of lines lacks a line of the smaller, or has none more."""
    a, b = larger.select(*LINE).distinct().withColumn("a", F.lit(1)), smaller.select(*LINE).distinct().withColumn("b", F.lit(1))
    both = a.join(b, LINE, "full_outer").groupBy(*BOOK).agg(F.count_if(F.col("a").isNull()).alias("lacks"), F.count_if(F.col("b").isNull()).alias("more"), F.count("b").alias("smaller"))
    return both.where("lacks > 0 or (more = 0 and smaller > 0)").select(*BOOK)


def entity_violations(mentions: DataFrame) -> DataFrame:
    """Mentions with a bad label or range, or parts outside of them."""
    part = F.exists(F.coalesce("parts", F.array().cast("array<struct<label:string,start:int,end:int>>")), lambda p: (p["start"] < 0) | (p["end"] <= p["start"]) | (p["end"] > F.col("end") - F.col("start")))
    bad = (F.length("label") > 200) | (F.length("label") == 0) | (F.col("start") < 0) | (F.col("end") <= F.col("start")) | part
    return mentions.where(F.coalesce(bad, F.lit(True)))



def target_violations(links: DataFrame, segments: DataFrame) -> DataFrame:
    """Records whose target isn't a known reference in its canonical spelling."""
    return links.join(segments.select(F.col("ref").alias("target_ref")).distinct(), "target_ref", "left_anti").select(*LINE, "start", "end", "target_ref")
