"""The contract between planning, recognition and resolving, as tables and the rows that break it.

Plan books: source, title, pos, hash, ranges array<struct<start,end>> (lines to recognize), context_ranges (null, or all lines of a
book that is only probed). Batches: source, title, batch_start, pos, line_index, normalized_sha256, entities array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions.text import is_safe_path
from spanlink.schemas import BOOK, LINE

HEX64, HEX16 = "^[0-9a-f]{64}$", "^[0-9a-f]{16}$"
COUNTERS = ("total", "adopted", "computed", "failed", "lines_reused", "lines_computed", "requeued", "requeued_distinct", "duplicates", "restarts")


def range_total(ranges: Column) -> Column:
    """Lines in half-open ranges."""
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]))


def claim_id(source: Column, title: Column) -> Column:
    """A book's name for files and markers: the SHA-1 of both parts of its key."""
    return F.sha1(F.concat(source, F.lit("\0"), title))


def _problems(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]))
    return rows.select(*keys, F.explode(broken).alias("problem"))


def plan_violations(plan: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(problem) of the plan's one row (request_id, snapshot_sha256, changelog_sha256, engine) against the current run."""
    rules = {name: ~F.col(name).eqNullSafe(value) for name, value in expected.items()}
    rules |= {f"{c} form": ~F.col(c).rlike(HEX64) for c in ("request_id", "snapshot_sha256")}
    rules["changelog_sha256 form"] = F.col("changelog_sha256").isNotNull() & ~F.col("changelog_sha256").rlike(HEX64)
    return _problems(plan, [], rules)


def planned_book_violations(books: DataFrame) -> DataFrame:
    """(source, title, problem) of the plan's books: names, hashes, ranges in order and apart, repeated books, context ranges that aren't more."""
    in_order = F.forall(F.sequence(F.lit(1), F.greatest(F.size("ranges"), F.lit(1))), lambda k: F.coalesce(F.get("ranges", k)["start"] >= F.get("ranges", k - 1)["end"], F.lit(True)))
    sound = F.forall("ranges", lambda r: (r["start"] >= 0) & (r["end"] > r["start"]))
    covered = F.forall("ranges", lambda r: F.exists("context_ranges", lambda c: (c["start"] <= r["start"]) & (r["end"] <= c["end"])))
    rules = {
        "book": (F.trim("source") == "") | (F.trim("title") == ""),
        "hash": ~F.col("hash").rlike(HEX16),
        "ranges": ~(sound & in_order),
        "context_ranges": F.col("context_ranges").isNotNull() & ~(covered & (range_total(F.col("context_ranges")) > range_total(F.col("ranges")))),
        "twice": F.count("*").over(Window.partitionBy(*BOOK)) > 1,
    }
    named = books.select("*", *[rule.alias(f"_{k}") for k, rule in enumerate(rules.values())])
    return _problems(named, BOOK, {name: F.col(f"_{k}") for k, name in enumerate(rules)})


def completed_violations(completed: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, title, problem) of completed books (source, title, hash, claim_id, artifact) against the plan: unknown, other hash or id, twice."""
    met = completed.join(plan.select(*BOOK, F.col("hash").alias("planned")), BOOK, "left").withColumn("n", F.count("*").over(Window.partitionBy(*BOOK)))
    own = claim_id(F.col("source"), F.col("title"))
    rules = {"plan": F.col("planned").isNull(), "hash": F.col("planned").isNotNull() & (F.col("hash") != F.col("planned")), "claim": F.col("claim_id") != own, "twice": F.col("n") > 1}
    rules["artifact"] = F.col("artifact").isNotNull() & (F.col("artifact") != F.concat(own, F.lit(".jsonl")))
    return _problems(met, BOOK, rules)


def order_violations(bundle: DataFrame, plan: DataFrame) -> DataFrame:
    """(pos, ..): places where two ordered lists of books (source, title, pos) differ."""
    a, b = bundle.select("pos", F.struct(*BOOK).alias("bundled")), plan.select("pos", F.struct(*BOOK).alias("planned"))
    return a.join(b, "pos", "full_outer").where(~F.col("bundled").eqNullSafe(F.col("planned"))).select("pos", "bundled", "planned")


def batch_violations(batches: DataFrame, expected: DataFrame) -> DataFrame:
    """(source, title, batch_start, pos, problem): batch lines against the snapshot's (.., line_index, text), aligned by position."""
    keys = [*BOOK, "batch_start", "pos"]
    a = batches.select(*keys, "line_index", "normalized_sha256", F.lit(True).alias("sent"))
    b = expected.select(*keys, F.col("line_index").alias("want"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    met = a.join(b, keys, "full_outer")
    problem = F.when(F.col("sent").isNull(), "missing").when(F.col("want").isNull(), "unplanned").when(F.col("line_index") != F.col("want"), "line").when(~F.col("normalized_sha256").eqNullSafe(F.col("digest")), "digest")
    return met.withColumn("problem", problem).where("problem is not null").select(*keys, "problem")


def bundle_violations(listed: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem): files of a manifest (path, size, sha256) against those that are there (path, content binary)."""
    there = files.select("path", F.length("content").cast("long").alias("length"), F.sha2("content", 256).alias("digest"))
    met = listed.join(there, "path", "full_outer").withColumn("n", F.count("*").over(Window.partitionBy("path")))
    problem = (
        F.when(F.col("sha256").isNull(), "unlisted")
        .when(~is_safe_path(F.col("path")), "path")
        .when(F.col("digest").isNull(), "missing")
        .when(F.col("size") != F.col("length"), "size")
        .when(F.col("sha256") != F.col("digest"), "digest")
        .when(F.col("n") > 1, "twice")
    )
    return met.withColumn("problem", problem).where("problem is not null").select("path", "problem").distinct()


def read_bundle(spark, path: str) -> DataFrame:
    """(path, content) of the files below a folder, with paths relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    root = path.rstrip("/") + "/"
    return files.select(F.element_at(F.split("path", root, 2), -1).alias("path"), "content")


def entity_flags(batches: DataFrame, planned: DataFrame) -> DataFrame:
    """(LINE, entity): whether recognition found anything on each planned line; null where an eligible line wasn't sent.

    planned: LINE, eligible. Lines that aren't eligible are never sent and hold nothing.
    """
    found = batches.groupBy(*LINE).agg(F.bool_or(F.size("entities") > 0).alias("found"))
    return planned.join(found, LINE, "left").select(*LINE, F.coalesce("found", F.when(~F.col("eligible"), F.lit(False))).alias("entity"))


def unplanned(partial: DataFrame, planned: DataFrame) -> DataFrame:
    """Books with partial data that no plan asks for."""
    return partial.select(*BOOK).distinct().join(planned.select(*BOOK), BOOK, "left_anti")


def stateful_violations(plan: DataFrame, sizes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(source, title, problem): books that lean on their context (book_context) but aren't computed whole, or reuse lines.

    plan: source, title, book_context, ranges, context_ranges; sizes: source, title, n_lines; pairs: reused lines. A probe is
    exempt, as its book is covered whole if the probe finds anything.
    """
    reused = pairs.groupBy(*BOOK).agg(F.count("*").alias("reused"))
    met = plan.where("book_context and context_ranges is null").join(sizes, BOOK).join(reused, BOOK, "left")
    rules = {"whole": range_total(F.col("ranges")) != F.col("n_lines"), "reuse": F.coalesce("reused", F.lit(0)) > 0}
    return _problems(met, BOOK, rules)


def escalated(plan: DataFrame, flags: DataFrame) -> DataFrame:
    """Books that were probed and where a probed line holds an entity, or isn't known: they are covered whole."""
    probed = plan.where("context_ranges is not null").select(*BOOK)
    return flags.join(probed, BOOK, "left_semi").where(F.coalesce("entity", F.lit(True))).select(*BOOK).distinct()


def inert_violations(plan: DataFrame, covered: DataFrame, links: DataFrame) -> DataFrame:
    """(LINE): lines of probes that weren't escalated (covered: those that were) for which there are new records all the same."""
    quiet = plan.where("context_ranges is not null").select(*BOOK).join(covered.select(*BOOK), BOOK, "left_anti")
    return links.join(quiet, BOOK, "left_semi").select(*LINE).distinct()


def prior_artifact_violations(baseline: DataFrame, artifacts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(source, title, problem): books with reused lines whose stored artifact isn't the baseline's (artifact_sha256, null for none)."""
    books = pairs.select(*BOOK).distinct()
    met = books.join(baseline.select(*BOOK, "artifact_sha256", F.lit(True).alias("known")), BOOK, "left").join(artifacts.select(*BOOK, F.col("sha256").alias("stored")), BOOK, "left")
    problem = F.when(F.col("known").isNull(), "baseline").when(F.col("artifact_sha256").isNull() & F.col("stored").isNotNull(), "unexpected").when(~F.col("artifact_sha256").eqNullSafe(F.col("stored")), "digest")
    return met.withColumn("problem", problem).where("problem is not null").select(*BOOK, "problem")


def reuse_violations(links: DataFrame, pairs: DataFrame, current: DataFrame) -> DataFrame:
    """(LINE, problem): records of reused lines whose hash or context isn't that of the line at its new number."""
    moved = links.join(pairs.withColumnRenamed("old_index", "line_index"), LINE)
    lines = current.select(*BOOK, F.col("line_index").alias("new_index"), F.substring(F.sha1(F.coalesce("content", F.lit(""))), 1, 16).alias("hash"), "context")
    met = moved.join(lines, [*BOOK, "new_index"], "left")
    problem = F.when(F.col("hash").isNull(), "line").when(F.col("source_hash") != F.col("hash"), "hash").when(F.col("context_ref") != F.col("context"), "context")
    return met.withColumn("problem", problem).where("problem is not null").select(*BOOK, F.col("new_index").alias("line_index"), "problem")


def empty_artifacts(files: DataFrame, records: DataFrame) -> DataFrame:
    """Artifact files (path) without a record (path); a book without links has no file."""
    return files.select("path").join(records.select("path"), "path", "left_anti")


def work_violations(work: DataFrame) -> DataFrame:
    """(run_id, problem) of accounts of runs: COUNTERS, checkpoint_source, _run_id, _attempt, generated_at, run_id, attempt."""
    half = lambda a, b: F.col(a).isNull() != F.col(b).isNull()
    rules = {c: F.col(c).isNull() | (F.col(c) < 0) for c in COUNTERS}
    rules["sum"] = F.col("adopted") + F.col("computed") + F.col("failed") != F.col("total")
    rules["checkpoint_source"] = F.col("checkpoint_source").isNotNull() & ~F.col("checkpoint_source").rlike("^[\\x20-\\x7E]{1,200}$")
    rules["checkpoint coordinates"] = half("checkpoint_run_id", "checkpoint_attempt") | (F.coalesce(F.least("checkpoint_run_id", "checkpoint_attempt"), F.lit(1)) < 1)
    rules["coordinates without source"] = F.col("checkpoint_run_id").isNotNull() & F.col("checkpoint_source").isNull()
    rules["generated_at"] = F.col("generated_at").isNotNull() & ~F.col("generated_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    rules["run coordinates"] = half("run_id", "attempt") | (F.coalesce(F.least("run_id", "attempt"), F.lit(1)) < 1)
    return _problems(work, ["run_id"], rules)


def is_canonical_fingerprint(fingerprint: Column) -> Column:
    """Whether `k=v;..;policy=drop;bavli=0` has well-formed parts with different keys, in order."""
    parts = F.split(fingerprint, ";")
    own = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 2, F.lit(0)))
    keys = F.transform(own, lambda p: F.substring_index(p, "=", 1))
    tail = F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)) == F.array(F.lit("policy=drop"), F.lit("bavli=0"))
    sound = F.forall(own, lambda p: p.rlike("^[^=\\r\\n][^\\r\\n]*$") & F.contains(p, F.lit("="))) & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.coalesce((F.size(parts) >= 3) & tail & sound & (F.array_sort(own) == own), F.lit(False))


def identity_violations(manifest: DataFrame, snapshot_sha256: str, engine: str | None, book_count: int) -> DataFrame:
    """(problem) of a baseline's one row of identity against the run that wants to use it; no row at all is one, too."""
    rules = {
        "schema_version": F.col("schema_version") != 3,
        "snapshot_sha256": F.col("snapshot_sha256") != snapshot_sha256,
        "engine": ~F.col("engine").eqNullSafe(F.lit(engine)),
        "book_count": F.col("book_count") != book_count,
        "line_fingerprint": F.col("line_fingerprint") != "blake2b-128",
    }
    none = manifest.agg(F.count("*").alias("n")).where("n <> 1").select(F.lit("rows").alias("problem"))
    return _problems(manifest, [], rules).unionByName(none)
