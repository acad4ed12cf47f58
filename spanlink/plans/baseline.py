"""What a run leaves for the next one: digests of books and lines, where entities were, and who wrote it.

A baseline is a folder per version with three tables: `identity` (one row), `books` and `lines`. Versions are never changed; the one in
use is the newest row of the table of versions, so a failed run leaves the older one in use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.operators import delta, digests, handoff
from spanlink.schemas import BOOK, LINE

_BOOK_ENTRY = "struct<source_name:string,canonical_he_title:string,hash:string>"


def read_book_baseline(spark: SparkSession, path: str) -> DataFrame:
    """(source, title, hash, engine) of a JSON file: a bare list of books, or an object of a list and the engine's fingerprint."""
    text = spark.read.option("wholetext", True).text(path).select("value")
    bare = F.from_json("value", f"array<{_BOOK_ENTRY}>")
    wrapped = F.from_json("value", f"struct<engine_fingerprint:string,books:array<{_BOOK_ENTRY}>>")
    listed = F.trim("value").startswith("[")
    both = text.select(F.when(listed, bare).otherwise(wrapped["books"]).alias("books"), F.when(~listed, wrapped["engine_fingerprint"]).alias("engine"))
    return both.select(F.explode("books").alias("b"), "engine").select(F.col("b.source_name").alias("source"), F.col("b.canonical_he_title").alias("title"), "b.hash", "engine")


def book_entries(hashes: DataFrame) -> DataFrame:
    """(line): the books' entries of that file as JSON, keys in order, by book."""
    entry = F.struct(F.col("title").alias("canonical_he_title"), "hash", F.col("source").alias("source_name"))
    return hashes.orderBy(*BOOK).select(F.to_json(entry).alias("line"))


def line_baseline(lines: DataFrame, flags: DataFrame) -> DataFrame:
    """(LINE, fp, entity): each line's fingerprint for exchange, and whether it held an entity (null: not known)."""
    prints = lines.select(*LINE, digests.line_fingerprint(F.coalesce("content", F.lit("")), F.col("context")).alias("fp"))
    return prints.join(flags.select(*LINE, "entity"), LINE, "left")


def book_baseline(lines: DataFrame, flags: DataFrame, seams: DataFrame, artifacts: DataFrame, pattern: str) -> DataFrame:
    """(BOOK, hash, artifact_sha256, book_context, ibid_seams); artifacts: BOOK, sha256; seams: LINE of batches' first lines."""
    books = digests.book_digests(lines).select(*BOOK, "hash")
    known = lines.select(*LINE).join(flags.select(*LINE, "entity"), LINE, "left")
    counts = delta.seam_counts(known, seams).withColumnRenamed("counts", "ibid_seams")
    return books.join(artifacts.select(*BOOK, F.col("sha256").alias("artifact_sha256")), BOOK, "left").join(delta.needs_context(lines, pattern), BOOK).join(counts, BOOK)


def write_baseline(folder: str, version: str, identity: DataFrame, books: DataFrame, lines: DataFrame, versions: str) -> None:
    """Write all tables of a version, then, as the last thing, its row in the table of versions."""
    spark = lines.sparkSession
    for name, df, keys in (("books", books, BOOK), ("lines", lines, LINE)):
        df.repartition(*BOOK).sortWithinPartitions(*keys).write.mode("errorifexists").parquet(f"{folder}/{version}/{name}")
    identity.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/{version}/identity")
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at")).write.mode("append").parquet(versions)


def in_use(spark: SparkSession, versions: str) -> str | None:
    """The newest version."""
    row = spark.read.parquet(versions).agg(F.max(F.struct("at", "version")).alias("m")).first()
    return row["m"]["version"] if row and row["m"] else None


def read_baseline(spark: SparkSession, folder: str, versions: str, snapshot_sha256: str, engine: str | None) -> tuple[DataFrame, DataFrame] | None:
    """(books, lines) of the version in use, or None if it isn't that of the last snapshot and engine: reuse is an option, not a must."""
    version = in_use(spark, versions)
    if version is None:
        return None
    books, lines, identity = (spark.read.parquet(f"{folder}/{version}/{t}") for t in ("books", "lines", "identity"))
    bad = handoff.identity_violations(identity, snapshot_sha256, engine, books.count())
    return None if bad.limit(1).count() else (books, lines)


def identity(spark: SparkSession, snapshot_sha256: str, engine: str | None, book_count: int) -> DataFrame:
    return spark.createDataFrame([(3, snapshot_sha256, engine, book_count, "blake2b-128")], "schema_version int, snapshot_sha256 string, engine string, book_count long, line_fingerprint string")


def run_meta(spark: SparkSession, snapshot_sha256: str, book_count: int, engine: str | None, export_tag: str | None, generated_at: str | None) -> DataFrame:
    """(json): one object with keys in order that says what the last run read and with what."""
    row = spark.createDataFrame([(snapshot_sha256, book_count, engine, export_tag, generated_at)], "sha string, n long, engine string, tag string, at string")
    s = F.struct(F.struct(F.lit("drop").alias("ambiguity_policy"), F.lit(False).alias("bavli_convention"), F.col("engine").alias("fingerprint")).alias("engine"), F.col("at").alias("generated_at"), F.lit(3).alias("schema_version"), F.struct(F.col("n").alias("book_count"), F.col("sha").alias("sha256")).alias("snapshot"), F.struct(F.col("tag").alias("export_tag")).alias("source_export"))
    return row.select(F.to_json(s, {"ignoreNullFields": "false"}).alias("json"))


def planned_books(changed: DataFrame, compute: DataFrame, probes: DataFrame, lines: DataFrame) -> DataFrame:
    """(BOOK, pos, hash, ranges, context_ranges) in order: the plan that goes to the recognizer; probes: BOOK of those only probed."""
    gathered = lambda rows, name: delta.ranges(rows).groupBy(*BOOK).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(name))
    whole = gathered(lines.join(probes.select(*BOOK), BOOK, "left_semi"), "context_ranges")
    none = F.array().cast("array<struct<start:int,end:int>>")
    books = changed.select(*BOOK, "hash").join(gathered(compute, "ranges"), BOOK, "left").join(whole, BOOK, "left")
    return books.select(*BOOK, (F.row_number().over(Window.orderBy(*BOOK)) - 1).alias("pos"), "hash", F.coalesce("ranges", none).alias("ranges"), "context_ranges")


def plan_lines(books: DataFrame) -> DataFrame:
    """(pos, line): the plan's books as canonical JSON."""
    pairs = lambda c: F.transform(c, lambda r: F.array(r["start"], r["end"]))
    entry = F.struct(F.col("title").alias("canonical_he_title"), pairs("context_ranges").alias("context_ranges"), pairs("ranges").alias("ner_ranges"), F.col("source").alias("source_name"))
    return books.select("pos", F.to_json(entry).alias("line"))


def probes(ids: DataFrame, old: DataFrame, pairs: DataFrame, books: DataFrame, flags: DataFrame, seams: DataFrame) -> DataFrame:
    """(BOOK): books that lean on context but whose unchanged lines keep their history, so that only new lines need a look.

    ids, old: current and prior lines (LINE, fp); pairs: what could be reused; books: prior (BOOK, book_context, ibid_seams); flags: prior
    (LINE, entity); seams: LINE of the current batches' first lines. Only lines with an entity move the history: no such line may
    be dropped, they must keep their order, and the batches' seams must fall between the same ones. Any unknown flag rules a book out.
    """
    prior = old.select(*LINE).join(flags.select(*LINE, "entity"), LINE, "left")
    used = prior.join(pairs.withColumnRenamed("old_index", "line_index"), LINE, "left")
    facts = used.groupBy(*BOOK).agg(F.bool_or(F.col("entity").isNull()).alias("unknown"), F.count("new_index").alias("reused"), F.count_if(F.col("entity") & F.col("new_index").isNull()).alias("dropped"))
    kept = delta.order_kept(pairs, prior.where("entity").select(*LINE))
    carried = used.where("new_index is not null").select(*BOOK, F.col("new_index").alias("line_index"), "entity")
    now = ids.select(*LINE).join(carried, LINE, "left").select(*LINE, F.coalesce("entity", F.lit(False)).alias("entity"))
    counts = delta.seam_counts(now, seams)
    met = books.join(facts, BOOK).join(kept, BOOK, "left").join(counts, BOOK)
    fits = delta.context_probe(F.coalesce("book_context", F.lit(False)), F.col("unknown"), F.col("reused"), F.col("dropped"), F.coalesce("kept", F.lit(True)), F.col("counts").eqNullSafe(F.col("ibid_seams")))
    return met.where(fits & F.col("ibid_seams").isNotNull()).select(*BOOK)
