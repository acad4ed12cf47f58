"""Operators along the lines of a book: headings above, citations before, and references carried forward."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanlink.schemas import BOOK


def heading_positions(lines: DataFrame, address: str = "address") -> DataFrame:
    """Lines with `position`: the last non-null address at or above each, which is an as-of join of lines to headings."""
    above = Window.partitionBy(*BOOK).orderBy("line_index").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("position", F.last(address, ignorenulls=True).over(above))


def heading_stack(lines: DataFrame, levels: int = 6) -> DataFrame:
    """Lines (heading level or null in `level`, text in `heading`) with `stack`: the open headings above, outermost first.

    A heading closes those of its own and deeper levels.
    """
    above = Window.partitionBy(*BOOK).orderBy("line_index").rowsBetween(Window.unboundedPreceding, 0)
    out = lines
    for k in range(1, levels + 1):
        out = out.withColumn(f"_h{k}", F.last(F.when(F.col("level") == k, F.struct("line_index", "heading")), ignorenulls=True).over(above))
        out = out.withColumn(f"_s{k}", F.max(F.when(F.col("level") < k, F.col("line_index"))).over(above))
    open_ = [F.when(F.col(f"_h{k}").isNotNull() & F.coalesce(F.col(f"_h{k}.line_index") > F.col(f"_s{k}"), F.lit(True)), F.col(f"_h{k}.heading")) for k in range(1, levels + 1)]
    return out.withColumn("stack", F.filter(F.array(*open_), lambda h: h.isNotNull())).drop(*[f"_{x}{k}" for k in range(1, levels + 1) for x in "hs"])


def previous_mentions(mentions: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Mentions with `previous`: the value of the one before in their group."""
    return mentions.withColumn("previous", F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))


def reference_history(mentions: DataFrame, keys: list[str], order: list[str], value: str, length: int = 3) -> DataFrame:
    """Mentions with `history`: the last `length` non-null values before each, newest first."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # only non-null values are gathered; a window over those rows alone keeps each list at `length`
    known = F.when(F.col(value).isNotNull(), F.count(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    ranked = mentions.withColumn("_k", known).withColumn("_upto", F.coalesce(F.max("_k").over(before), F.lit(0)))
    some = ranked.where(F.col(value).isNotNull()).select(*keys, F.col("_k").alias("_at"), F.col(value).alias("_v"))
    spans = some.withColumn("_upto", F.explode(F.sequence("_at", F.col("_at") + length - 1)))
    lists = spans.groupBy(*keys, "_upto").agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_v")), asc=False), lambda x: x["_v"]).alias("history"))
    empty = F.array().cast(f"array<{dict(mentions.dtypes)[value]}>")
    return ranked.join(lists, [*keys, "_upto"], "left").withColumn("history", F.coalesce("history", empty)).drop("_k", "_upto")


def resolve_in_order(mentions: DataFrame) -> DataFrame:
    """A per-book fold: (source, title, line_index, pos, ref) for mentions (.., candidates array, same_as_above boolean).

    A mention with one candidate is that one. A mention that points above takes the book's last reference, if its
    candidates are none or hold that one. Anything else stays null, and a mention that fails forgets the last reference, as its own
    outcome is part of later ones' input; so books are folded in order, each by itself, after a sort by key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Books lie together and in order in a partition; a fold is carried over batches, so no book is held whole."""
        now, last = None, None
        for pdf in batches:
            refs = []
            for source, title, candidates, above in zip(pdf["source"], pdf["title"], pdf["candidates"], pdf["same_as_above"], strict=True):
                if (source, title) != now:
                    now, last = (source, title), None
                candidates = [] if candidates is None else list(candidates)
                if above:
                    last = last if last is not None and (not candidates or last in candidates) else None
                else:
                    last = candidates[0] if len(candidates) == 1 else None
                refs.append(last)
            yield pdf[[*BOOK, "line_index", "pos"]].assign(ref=refs)

    ordered = mentions.repartition(*BOOK).sortWithinPartitions(*BOOK, "line_index", "pos")
    return ordered.select(*BOOK, "line_index", "pos", "candidates", "same_as_above").mapInPandas(run, "source string, title string, line_index int, pos int, ref string")
