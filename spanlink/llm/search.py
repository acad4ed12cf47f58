"""Ranked lexical search: documents ranked for each item of a query set by windowed bucket scoring.

1. Texts become vectors: the document's number of terms, and its counts of those terms that some item holds. What the scores need of
   the whole corpus (documents, terms, documents by term) is summed over these vectors.
2. A task takes its vectors in doc_id order, WINDOW documents at a time, and turns a window into postings by term. Items are scored one
   after the other: the postings of an item's terms are added into an array with a place for each document of the window, small
   enough for a core's cache, and a bit is set for each bucket of 64 places that got something. Only marked buckets are read, harvested
   into the item's heap of the K best, and cleared. A posting's weight is worked out once for all items.
3. Heaps of tasks are merged in two steps, so no item brings a task more than SALT * K rows.

Nothing is pruned by a guess: every posting of every item is added. Items are taken in blocks, so that the terms which go to the tasks and the
driver stay under MAX_TERMS rows and MAX_BYTES bytes; each block reads the texts again. Vectors aren't shuffled, so a hot source or a long text
stays where it was read.

Defined cases: null and empty texts have no terms and never rank; terms of rows with one item_id, null too, are one set; an item without
terms ranks nothing; rows of documents with one doc_id rank each for itself, a null doc_id after others of its score; an
empty table gives an empty result. Numbers are 64-bit: 50 * n * N must stay below 2^63.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, table

K = 50
#: Documents of a window: the scores of one item, 8 bytes a document, fill 256 KiB. Bits of occupancy stand for BUCKET documents.
WINDOW, BUCKET = 1 << 15, 64
#: Postings beyond which a window is closed early.
WINDOW_POSTINGS = 1 << 22
#: Rows (item, term), and bytes of terms, of a block of items.
MAX_TERMS, MAX_BYTES = 1_000_000, 32 << 20
SALT = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same of lower-cased UTF-8: bytes from 0x80 on are those of characters beyond ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes | None) -> list[bytes]:
    return _TERM.findall(text.lower()) if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), distinct."""
    lowered: Column = F.translate("text", UPPER, LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def vectors(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): number of all terms, and counts of the known ones by their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            n, which, counts, ends = [], [], [], [0]
            for text in batch.column("text").cast(pa.large_binary()):
                found = terms(text.as_py())
                own = Counter(number[t] for t in found if t in number)
                n.append(len(found))
                which.extend(own)
                counts.extend(own.values())
                ends.append(len(which))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(which, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class _Window:
    """Postings of some documents by term, with their parts of a score, and the scoring of items."""

    def __init__(self, batches: list[pa.RecordBatch], weight: np.ndarray, n_docs: int, n_terms: int):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.ids = rows.column("doc_id").to_pylist()
        lists = rows.column("terms").combine_chunks()
        n = rows.column("n").to_numpy()
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = rows.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        place = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        length = 100 - 50 + (50 * n * n_docs) // n_terms
        part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * length[place]))
        order = np.argsort(term, kind="stable")
        self.place, self.part = place[order], part[order]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(weight)))])
        self.sums = np.zeros(-(-len(n) // BUCKET) * BUCKET, np.int64)
        self.marks = np.zeros(len(self.sums) // BUCKET, bool)

    def harvest(self, item: np.ndarray, above: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores, ascending by place, of the documents that the item scores above some score."""
        starts, ends = self.ends[item], self.ends[item + 1]
        for k in np.flatnonzero(ends > starts):
            at = self.place[starts[k] : ends[k]]
            self.sums[at] += self.part[starts[k] : ends[k]]
            self.marks[at // BUCKET] = True
        marked = np.flatnonzero(self.marks)
        by_bucket = self.sums.reshape(-1, BUCKET)
        scores = by_bucket[marked]
        by_bucket[marked] = 0
        self.marks[marked] = False
        row, column = np.nonzero(scores > above)
        return marked[row] * BUCKET + column, scores[row, column]


def _best(windows: Iterator[_Window], items: list[np.ndarray], k: int) -> list[list[tuple[int, int, int | None]]]:
    """For each item a heap of (score, minus the document's number in this order, doc_id)."""
    heaps: list[list[tuple[int, int, int | None]]] = [[] for _ in items]
    before = 0
    for window in windows:
        for heap, item in zip(heaps, items, strict=True):
            place, score = window.harvest(item, heap[0][0] if len(heap) == k else 0)
            if len(place) > k:
                first = np.lexsort((place, -score))[:k]
                place, score = place[first], score[first]
            for p, s in zip(place.tolist(), score.tolist(), strict=True):
                entry = (s, -(before + p), window.ids[p])
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
        before += len(window.ids)
    return heaps


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches of WINDOW rows together, or of about WINDOW_POSTINGS postings."""
    held: list[pa.RecordBatch] = []
    rows = postings = 0
    for batch in batches:
        sizes = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))
        at = 0
        while at < len(batch):
            done = sizes[at - 1] if at else 0
            fit = int(np.searchsorted(sizes, done + WINDOW_POSTINGS - postings, side="right"))
            end = min(len(batch), at + WINDOW - rows, max(fit, at + (not held)))
            if end > at:
                held.append(batch.slice(at, end - at))
                rows += end - at
                postings += int(sizes[end - 1] - done)
                at = end
            if at < len(batch):
                yield held
                held, rows, postings = [], 0, 0
    if held:
        yield held


def ranked(found: DataFrame, items: list[tuple], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): every task's k best for each of the items, (item_id, numbers of its terms)."""
    sent = found.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        windows = (_Window(held, weight, n_docs, n_terms) for held in _cut(batches))
        for (item_id, _), heap in zip(items, _best(windows, [x for _, x in items], k), strict=True):
            if heap:
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(heap), pa.int64()) if x is not None else pa.nulls(len(heap), pa.int64()) for x in (item_id,)] + [pa.array([e[2] for e in heap], pa.int64()), pa.array([e[0] for e in heap], pa.int64())], ["item_id", "doc_id", "score"])

    ordered = found.where(F.size("terms") > 0).sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    return ordered.mapInArrow(run, "item_id long, doc_id long, score long")


def top(scored: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of each item, equal scores by doc_id, nulls last."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALT)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    final = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return final.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, max_terms: int = MAX_TERMS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents of highest score above 0."""
    pairs = materialize(item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")))
    rows, size = pairs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    n_blocks = max(1, -(-rows // max_terms), -(-size // max_bytes))
    parts = []
    for block in range(n_blocks):
        own = pairs if n_blocks == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block)
        asked: dict[int | None, list[int]] = {}
        known: dict[bytes, int] = {}
        for item_id, term in own.collect():
            asked.setdefault(item_id, []).append(known.setdefault(term.encode(), len(known)))
        if not known:
            continue
        found = materialize(vectors(docs, known))
        n_docs, n_terms = found.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        weight = np.zeros(len(known), np.int64)
        for term, df in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        parts.append(ranked(found, [(i, np.array(sorted(x))) for i, x in asked.items()], weight, n_docs, n_terms, k))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return top(scored, k)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS ts FROM documents),
q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
m AS (SELECT doc_id, row, 100 - 50 + (50 * len(ts)::BIGINT * n_docs) // n_terms AS m FROM d, s WHERE len(ts) > 0),
p AS (SELECT doc_id, row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part FROM tf JOIN w USING (term) JOIN m USING (row)),
x AS (SELECT item_id, doc_id, row, sum(part)::BIGINT AS score FROM p JOIN q USING (term) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {K}
"""
