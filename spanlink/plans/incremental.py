"""The incremental run as one plan of tables: diff, line plan, reuse, recognition, validation, audit.

Nothing is changed in place. A run reads a snapshot, the baseline's lines and the store's links, and gives the next version of the
links with the plan that led there; the caller publishes it as a new version when all checks have passed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.functions.text import SAME_PLACE, retitled
from spanlink.operators import checks, delta, digests
from spanlink.operators.handoff import escalated
from spanlink.plans.baseline import probes
from spanlink.schemas import BOOK, LINE, LINKS

Keep = Callable[[DataFrame], DataFrame]


@dataclass
class Plan:
    """Tables of a run: books that changed or went, lines that keep their links, lines to compute, books that are only probed."""

    changed: DataFrame
    removed: DataFrame
    pairs: DataFrame
    compute: DataFrame
    probed: DataFrame


@dataclass
class Known:
    """What the baseline knows of the prior run: books (BOOK, book_context, ibid_seams), flags (LINE, entity), and this run's batch seams (LINE)."""

    books: DataFrame
    flags: DataFrame
    seams: DataFrame


def plan(current: DataFrame, prior: DataFrame, same_engine: bool = True, context_pattern: str = SAME_PLACE, keep: Keep = lambda df: df, known: Known | None = None) -> Plan:
    """With another engine every current book is computed whole; removed books are those of the baseline in any case.

    Books with lines that lean on those above are computed whole too, unless `known` proves that a look at their new lines will do:
    those are `probed`, and if the look finds anything the caller computes them whole (handoff.escalated). keep: what to do with narrow tables
    that several steps read (ids and hashes, no texts), such as writing them; by default they are computed again.
    """
    now, then = keep(digests.book_identities(current)), keep(digests.book_identities(prior))
    changed = digests.changed_books(now, then) if same_engine else now.select(*BOOK, "hash", F.lit(None).cast("string").alias("prior_hash"))
    lines = current.join(changed.select(*BOOK), BOOK, "left_semi")
    ids, old = keep(delta.identified(lines)), delta.identified(prior)
    if same_engine:
        context = keep(delta.needs_context(lines, context_pattern))
        mine = keep(old.join(changed.select(*BOOK), BOOK, "left_semi"))
        pairs = keep(delta.reuse(ids, mine))
        leaning = context.where("book_context").select(*BOOK)
        probed = leaning.limit(0)
        if known is not None:
            probed = keep(probes(ids.join(leaning, BOOK, "left_semi"), mine.join(leaning, BOOK, "left_semi"), pairs.join(leaning, BOOK, "left_semi"), known.books, known.flags, known.seams))
        pairs = pairs.join(leaning.join(probed, BOOK, "left_anti"), BOOK, "left_anti")
    else:
        pairs, probed = delta.reuse(ids, old).limit(0), changed.select(*BOOK).limit(0)
    return Plan(changed, digests.removed_books(now, then), pairs, delta.recompute(ids, pairs), probed)


def covered_whole(p: Plan, current: DataFrame, books: DataFrame) -> Plan:
    """The plan with these probed books computed whole instead, as their probes found something."""
    lines = current.join(books, BOOK, "left_semi").select(*LINE)
    compute = p.compute.join(books, BOOK, "left_anti").unionByName(lines)
    return Plan(p.changed, p.removed, p.pairs.join(books, BOOK, "left_anti"), compute, p.probed.join(books, BOOK, "left_anti"))


def escalate(p: Plan, current: DataFrame, recognize: Callable[[DataFrame], DataFrame]) -> tuple[Plan, DataFrame]:
    """The second phase of a plan with probes, and the books (BOOK) that it covers whole after all.

    Only the probes' lines are recognized, as lines to mentions (LINE, ..); a book where one of them holds a mention is computed whole, the
    others are done with what was planned.
    """
    lines = current.join(p.compute.join(p.probed, BOOK, "left_semi"), LINE, "left_semi")
    seen = recognize(lines).select(*LINE, F.lit(True).alias("entity")).distinct()
    flags = lines.select(*LINE).join(seen, LINE, "left").select(*LINE, F.coalesce("entity", F.lit(False)).alias("entity"))
    books = escalated(p.probed.withColumn("context_ranges", F.lit(True)), flags)
    return covered_whole(p, current, books), books


def reused_links(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """The old records of reused lines, at their new line numbers."""
    moved = links.join(pairs, (links["source"] == pairs["source"]) & (links["title"] == pairs["title"]) & (links["line_index"] == pairs["old_index"]))
    return moved.select(links["source"], links["title"], F.col("new_index").alias("line_index"), *[links[c] for c in LINKS.names[3:]])


def renamed(links: DataFrame, renames: list[tuple[str, str]]) -> DataFrame:
    """Target references under their books' new names; renames apply one after the other, so they chain."""
    for old, new in renames:
        links = links.withColumn("target_ref", retitled(F.col("target_ref"), F.lit(old), F.lit(new)))
    return links


def run(current: DataFrame, prior: DataFrame, links: DataFrame, resolve: Callable[[DataFrame], DataFrame], same_engine: bool = True, renames: list[tuple[str, str]] = (), keep: Keep = lambda df: df, known: Known | None = None, recognize: Callable[[DataFrame], DataFrame] | None = None, context_pattern: str = SAME_PLACE) -> tuple[Plan, DataFrame]:
    """The plan and the next version of the links. resolve: lines (source, title, line_index, content, context) to LINKS.

    With `known` and `recognize`, books that lean on context are probed first where that will do, and only those whose probes find something are computed whole.
    """
    if (known is None) != (recognize is None):
        raise ValueError("known and recognize come together: a probe needs both")
    p = plan(current, prior, same_engine, context_pattern, keep=keep, known=known)
    if recognize is not None:
        p, _ = escalate(p, current, recognize)
        p = Plan(p.changed, p.removed, keep(p.pairs), keep(p.compute), keep(p.probed))
    links = renamed(links, list(renames))
    kept = links.join(p.changed.select(*BOOK), BOOK, "left_anti").join(p.removed, BOOK, "left_anti")
    todo = current.join(p.compute, LINE, "left_semi")
    out = kept.select(*LINKS.names).unionByName(reused_links(links, p.pairs)).unionByName(resolve(todo).select(*LINKS.names))
    return p, out


def check(current: DataFrame, p: Plan, out: DataFrame) -> None:
    """All that must hold before a version is published."""
    changed = current.join(p.changed.select(*BOOK), BOOK, "left_semi").select(*LINE)
    checks.require(delta.partition_violations(changed, p.pairs, p.compute), "lines not covered once")
    quiet = p.compute.join(p.probed, BOOK, "left_semi")
    checks.require(out.join(quiet, LINE, "left_semi").select(*LINE), "records in probes that found nothing")
    checks.require(checks.record_violations(out), "records")
    checks.require(checks.place_violations(out, current), "records off their lines")
    checks.require(checks.duplicate_places(out), "spans with several records")
