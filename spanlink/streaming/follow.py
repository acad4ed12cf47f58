"""Following a stream of mentions or snapshots with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanlink.operators import resolve
from spanlink.schemas import BOOK

HISTORY = 3


def resolve_stream(mentions: DataFrame) -> DataFrame:
    """(source, title, line_index, pos, ref, history) of a stream of mentions, as sequence.resolve_in_order() gives for a table.

    State per book is its last reference and the last HISTORY ones. Within a micro-batch a book's mentions are put in order; batches
    must come in order, as lines of a growing book do.
    """

    def step(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, history = state.get if state.exists else (None, [])
        history = list(history)
        pdf = pd.concat(list(rows)).sort_values(["line_index", "pos"])
        refs, seen = [], []
        for candidates, above in zip(pdf["candidates"], pdf["same_as_above"], strict=True):
            candidates = [] if candidates is None else list(candidates)
            if above:
                last = last if last is not None and (not candidates or last in candidates) else None
            else:
                last = candidates[0] if len(candidates) == 1 else None
            seen.append(list(history))
            refs.append(last)
            if last is not None:
                history = [last, *history][:HISTORY]
        state.update((last, history))
        yield pdf[[*BOOK, "line_index", "pos"]].assign(ref=refs, history=seen)

    return mentions.groupBy(*BOOK).applyInPandasWithState(step, "source string, title string, line_index int, pos int, ref string, history array<string>", "last string, history array<string>", "append", GroupStateTimeout.NoTimeout)


def fold_stream(rows: DataFrame) -> DataFrame:
    """`resolve.folded` for a stream of prepared rows: the same step, with a book's history as its state.

    Within a micro-batch a book's rows are put in order; batches must come in order, as lines of a growing book do.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        history = resolve.History(*(state.get if state.exists else ()))
        out = []
        for row in pd.concat(list(parts)).sort_values(resolve.ROW[2:]).to_dict("records"):
            lists = {k: [] if row[k] is None else list(row[k]) for k in ("labels", "candidates", "outcomes", "homes", "verse", "evidence")}
            history, taken = resolve.step(history, row | lists)
            if taken is not None:
                out.append({k: row[k] for k in resolve.ROW} | {k: taken[k] for k in resolve.TAKEN})
        state.update(tuple(history))
        yield pd.DataFrame(out, columns=[*resolve.ROW, *resolve.TAKEN])

    return rows.groupBy(*BOOK).applyInPandasWithState(run, resolve.FOLDED, "last string, trusted string", "append", GroupStateTimeout.NoTimeout)


def follow_snapshots(spark: SparkSession, lines: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run publish(lines, version) once for each batch of a stream of lines that is there now, then stop."""
    return lines.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
