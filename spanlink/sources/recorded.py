"""Recorded recognizer output for audits, and its replay through two versions of the rules.

A recording is a gzipped JSON array per file, which can't be split: a file is read by one task and its rows are dealt to many before anything
else. Rows: source, title, index, content, context, normalized, ner (entities with ranges in code points of the normalized text).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.functions import text
from spanlink.operators import audit, checks
from spanlink.operators.checks import require
from spanlink.schemas import LINE

ENTITY = "struct<label:string,range:array<int>,parts:array<struct<label:string,range:array<int>>>>"
RECORDED = f"source string, title string, index int, content string, context string, normalized string, ner struct<entities:array<{ENTITY}>>, broken string"
Engine = Callable[[DataFrame, DataFrame], DataFrame]


def read_recorded(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Rows of recordings (path: files or folders), dealt to `tasks` (the session's shuffle partitions) by line."""
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = spark.read.schema(RECORDED).option("multiLine", True).option("columnNameOfCorruptRecord", "broken").json(path)
    return raw.withColumnRenamed("index", "line_index").repartition(n, *LINE)


def violations(recorded: DataFrame) -> DataFrame:
    """(LINE, problem): broken rows, lines recorded twice, texts whose normal form has drifted, and ranges outside of it."""
    n = F.length("normalized")
    outside = F.exists("ner.entities", lambda e: ~F.coalesce((F.size(e["range"]) == 2) & (e["range"][0] >= 0) & (e["range"][0] < e["range"][1]) & (e["range"][1] <= n), F.lit(False)))
    rows = recorded.withColumn("form", text.normalized(F.col("content"))["text"])
    problem = F.when(F.col("broken").isNotNull() | F.col("line_index").isNull() | F.col("ner.entities").isNull(), "row").when(~F.col("form").eqNullSafe(F.col("normalized")), "normalized").when(outside, "range")
    each = rows.withColumn("problem", problem).where("problem is not null").select(*LINE, "problem")
    twice = recorded.groupBy(*LINE).count().where("count > 1").select(*LINE, F.lit("twice").alias("problem"))
    return each.unionByName(twice)


def mentions(recorded: DataFrame, labels: tuple[str, ...] = ("citation",)) -> DataFrame:
    """(LINE, label, start, end, parts) of the entities of these labels, in code points of the line itself; parts are relative to the entity."""
    placed = recorded.select(*LINE, text.normalized(F.col("content"))["places"].alias("places"), F.explode("ner.entities").alias("e")).where(F.col("e.label").isin(*labels))
    at = lambda k: F.get("places", k)
    start, end = at(F.col("e.range")[0]), at(F.col("e.range")[1] - 1) + 1
    part = lambda p: F.struct(p["label"].alias("label"), (at(F.col("e.range")[0] + p["range"][0]) - F.col("start")).alias("start"), (at(F.col("e.range")[0] + p["range"][1] - 1) + 1 - F.col("start")).alias("end"))
    spans = placed.select(*LINE, F.col("e.label").alias("label"), start.alias("start"), end.alias("end"), "places", "e")
    return spans.withColumn("parts", F.transform(F.coalesce("e.parts", F.array().cast("array<struct<label:string,range:array<int>>>")), part)).drop("places", "e")


@dataclass
class Replay:
    """Both versions' links, their difference by span, and its counts with a row for every kind."""

    before: DataFrame
    after: DataFrame
    diff: DataFrame
    counts: DataFrame


def replay(recorded: DataFrame, before: Engine, after: Engine, segments: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Replay:
    """Run two versions of the rules, as functions of lines and mentions to LINKS, over one recording and compare them.

    The recording must be sound, and either version's records must keep the contract: fields, places in their lines, one per span, and
    (with segments) targets that exist in their usual spelling.
    """
    require(violations(recorded), "recording")
    rows = keep(recorded)
    lines, found = rows.select(*LINE, "content", "context"), keep(mentions(rows))
    out = []
    for name, engine in (("before", before), ("after", after)):
        links = keep(engine(lines, found))
        require(checks.record_violations(links), f"{name}: records")
        require(checks.place_violations(links, lines), f"{name}: places")
        require(checks.duplicate_places(links), f"{name}: spans")
        if segments is not None:
            require(checks.target_violations(links, segments), f"{name}: targets")
        out.append(links)
    diff = keep(audit.replay_diff(*out))
    return Replay(*out, diff, audit.replay_counts(diff))
