"""Benchmark decontamination in built-in column functions and joins alone.

A document is contaminated by an item when some window of it, as long as the item, has a weighted similarity of 0.8 or more to
the item: multisets of five-word shingles of lower-cased text, sum of least counts over sum of greatest.

1. Documents that share no shingle with any item can't reach that and are left out by a join on shingle hashes.
2. A window of n shingles and an item of m have a similarity of 0.8 only with at least 0.8 / 1.8 * (n + m) shingles in common.
   Windows that hold fewer shingles of items of their size can't reach it; each of the others gets a 64-bit SimHash of its shingles.
3. Distinct fingerprints are cut into RADIUS + 1 blocks; two within RADIUS bits agree on a whole block, so an equi-join on
   (size, block, value) finds all of them. A pair that agrees on several blocks is kept at the first only.
4. Windows and items of fingerprints within RADIUS are verified by the exact weighted similarity. Pairs of just 0.8 differ in 7 to 10
   of 64 bits in the mean; in 24,000 random ones of 5 to 600 shingles none differed in more than 21.

Texts are read twice, windows are cut in pieces of CHUNK starts, and blocks are joined on fingerprints without the windows. A
side is broadcast only when its rows, a few numbers wide each, have been counted; a larger one is joined by shuffles.

Defined cases: a text of 1 to 4 words is one shingle of all its words; null or empty texts and items match nothing; a document
shorter than the item is one window; repeated rows and repeated items report once per pair of ids; a null id is
an id; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import broadcast_if_small, materialize, table
from spanlink.llm.simhash import keyed

WIDTH, SIMILARITY, RADIUS = 5, 0.8, 22
#: Starts of windows that are cut out of a document together.
CHUNK = 256
#: Rows of ids, hashes or fingerprints beyond which a side is shuffled instead of broadcast.
BROADCAST_ROWS = 1_000_000
_BLOCKS = [(b, 64 * b // (RADIUS + 1), 64 * (b + 1) // (RADIUS + 1)) for b in range(RADIUS + 1)]


def shingles(text: Column) -> Column:
    """Hashes of a text's shingles, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def hashed(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))
        return F.when(F.size(words) >= WIDTH, each).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))

    # the words are named once, by a lambda, or each use would split the text again
    return F.get(F.transform(F.array(words), hashed), 0)


def simhash(column: str) -> Column:
    """Bits set in over half of the hashes of an array column; bits k and k + 32 of all hashes are counted in one sum."""
    halves = f"transform(sequence(0, 31), k -> aggregate({column}, 0L, (n, h) -> n + (shiftrightunsigned(h, k) & {1 + (1 << 32)}L)))"
    ones = f"(shiftright(halves[bit % 32], 32 * (bit div 32)) & {(1 << 32) - 1}L)"
    bits = f"aggregate(sequence(0, 63), 0L, (fp, bit) -> fp | shiftleft(if({ones} * 2 > size({column}), 1L, 0L), bit))"
    return F.expr(f"transform(array({halves}), halves -> {bits})[0]")


def _mask(first: int, last: int) -> int:
    m = (1 << last) - (1 << first)
    return m - (1 << 64) if m >= 1 << 63 else m


def blocks(fp: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.col(fp).bitwiseAND(F.lit(_mask(x, y))).alias("value")) for b, x, y in _BLOCKS])).alias("part")


def first_block(a: str, b: str) -> Column:
    differing = F.col(a).bitwiseXOR(F.col(b))
    return F.coalesce(*[F.when(differing.bitwiseAND(F.lit(_mask(x, y))) == 0, F.lit(k)) for k, x, y in _BLOCKS])


def similarity(a: str, b: str) -> Column:
    """Sum of least counts over sum of greatest, of two arrays taken as multisets."""

    def repeats(x: str) -> str:
        return f"transform(array(array_sort({x})), s -> array_distinct(filter(s, (h, i) -> i > 0 AND h = s[i - 1])))[0]"

    count = "size(filter({}, x -> x = h))"
    more = f"aggregate(array_intersect({repeats(a)}, {repeats(b)}), 0L, (n, h) -> n + least({count.format(a)}, {count.format(b)}) - 1)"
    both = f"size(array_intersect({a}, {b})) + {more}"
    return F.expr(f"transform(array({both}), c -> c / (size({a}) + size({b}) - c))[0]")


def matching(docs: DataFrame, known: DataFrame, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(row, `by`, shingles) of the documents that share a shingle with an item; `row` tells rows of one id apart."""
    posted = broadcast_if_small(known.select("h").distinct(), BROADCAST_ROWS)
    hashed = docs.select(*by, shingles(F.col("text")).alias("shingles"))
    ids = materialize(hashed.select(*by, F.explode("shingles").alias("h")).join(posted, "h", "left_semi").select(*by).distinct())
    ids = broadcast_if_small(ids, BROADCAST_ROWS).alias("i")
    same = functools.reduce(Column.__and__, [F.col(f"d.{c}").eqNullSafe(F.col(f"i.{c}")) for c in by])
    some = docs.select(*by, "text").alias("d").join(ids, same, "left_semi")
    return materialize(some.select(F.monotonically_increasing_id().alias("row"), *by, shingles(F.col("text")).alias("shingles")))


def starts(some: DataFrame, known: DataFrame, at_least: float) -> DataFrame:
    """(row, size, start) of the windows that hold enough shingles of items of their size.

    With positions p of such shingles in order, any `need` of them that follow each other lie in the windows that start from
    p[i + need - 1] - size + 1 to p[i].
    """
    hits = some.select("row", F.size("shingles").alias("n"), F.posexplode("shingles").alias("pos", "h")).join(broadcast_if_small(known, BROADCAST_ROWS), "h")
    # least number in common: ceil(at_least / (1 + at_least) * (size of the window + size of the item)), 1 at least
    fewer = F.ceil(F.lit(at_least / (1 + at_least)) * (F.least("n", "size") + F.col("size")) - 1e-9).cast("int")
    placed = hits.groupBy("row", "size", "n").agg(F.array_sort(F.collect_list("pos")).alias("p")).withColumn("need", F.greatest(fewer, F.lit(1)))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("need")),
        lambda i: F.struct(F.greatest(F.lit(0), F.get("p", i + F.col("need") - 1) - F.col("size") + 1).alias("a"), F.least(F.get("p", i), F.greatest(F.lit(0), F.col("n") - F.col("size"))).alias("b")),
    )
    fit = F.filter(runs, lambda r: r["a"] <= r["b"])
    spans = placed.where(F.size("p") >= F.col("need")).select("row", "size", F.explode(fit).alias("r"))
    return spans.select("row", "size", F.explode(F.sequence("r.a", "r.b")).alias("start")).distinct()


def candidates(docs: DataFrame, items: DataFrame, at_least: float = SIMILARITY, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(`by`, start, size, window): the item-sized windows that may be similar enough to an item of that size."""
    known = materialize(items.select("size", F.explode("shingles").alias("h")).distinct())
    some = matching(docs, known, by)
    piece = F.floor(F.col("start") / CHUNK).cast("int")
    pieces = starts(some, known, at_least).groupBy("row", "size", piece.alias("piece")).agg(F.collect_list(F.col("start") - piece * CHUNK).alias("starts"))
    by_row = pieces.groupBy("row").agg(F.collect_list(F.struct("size", "piece", "starts")).alias("pieces"))
    # a document's row gives pieces of CHUNK starts, a piece gives its windows
    cut = F.transform("pieces", lambda p: F.struct(p["size"].alias("size"), (p["piece"] * CHUNK).alias("base"), p["starts"].alias("starts"), F.slice(F.col("shingles"), p["piece"] * CHUNK + 1, p["size"] + CHUNK - 1).alias("part")))
    pieces = some.join(by_row, "row").select(*by, F.explode(cut).alias("p")).select(*by, "p.*")
    windows = F.transform("starts", lambda s: F.struct((F.col("base") + s).alias("start"), F.slice(F.col("part"), s + 1, F.col("size")).alias("window")))
    return pieces.select(*by, "size", F.explode(windows).alias("w")).select(*by, "size", "w.*")


def near(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(size, fp, item_fp): distinct fingerprints of windows and items within RADIUS bits, by blocks."""
    posted = items.select("size", "item_fp").distinct().select("*", blocks("item_fp")).select("size", "item_fp", "part.*")
    asked = windows.select("size", "fp").distinct().select("*", blocks("fp")).select("size", "fp", "part.*")
    met = asked.join(broadcast_if_small(materialize(posted), BROADCAST_ROWS), ["size", "block", "value"])
    within = (F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS) & (F.col("block") == first_block("fp", "item_fp"))
    return met.where(within).select("size", "fp", "item_fp")


def contaminated(docs: DataFrame, benchmark: DataFrame, at_least: float = SIMILARITY, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(doc_id, item_id, similarity, start): each pair once, with its best window's first word. Other columns `by` may tell documents apart."""
    items = benchmark.select("item_id", shingles(F.col("text")).alias("shingles")).withColumn("size", F.size("shingles")).where("size > 0")
    items = materialize(items.withColumn("item_fp", simhash("shingles")))
    windows = materialize(candidates(docs, items, at_least, by).withColumn("fp", simhash("window")))
    pairs = broadcast_if_small(materialize(near(windows, items)), BROADCAST_ROWS)
    met = windows.join(pairs, ["size", "fp"]).join(items, ["size", "item_fp"])
    verified = met.withColumn("similarity", similarity("window", "shingles")).where(F.col("similarity") >= at_least)
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("back"))).alias("best")
    found = verified.groupBy(*by, "item_id").agg(best)
    return found.select(*by, "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that no item contaminates. Rows are told apart by their contents, so null and repeated ids lose no clean text."""
    rows, key = keyed(docs), ["k1", "k2"]
    hit = materialize(contaminated(rows.select(*key, "text"), benchmark, by=key).select(*key).distinct())
    return rows.join(broadcast_if_small(hit, BROADCAST_ROWS), key, "left_anti").select("row.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH w AS (SELECT doc_id, row_number() OVER () AS row, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, row, CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
v AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
t AS (SELECT item_id, CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM v),
known AS (SELECT DISTINCT len(sh) AS size, unnest(sh) AS h FROM t),
placed AS (SELECT row, len(sh) AS n, unnest(sh) AS h, generate_subscripts(sh, 1) - 1 AS pos FROM s WHERE len(sh) > 0),
hits AS (SELECT row, n, size, pos FROM placed JOIN known USING (h)),
starts AS (SELECT DISTINCT row, size, unnest(range(greatest(0, least(pos - size + 1, n - size)), greatest(0, least(pos, n - size)) + 1)) AS start FROM hits),
win AS (SELECT row, size, start, len(sh[start + 1:start + size]) AS n, unnest(sh[start + 1:start + size]) AS h FROM starts JOIN s USING (row)),
wc AS (SELECT row, size, start, n, h, count(*) AS c FROM win GROUP BY ALL),
ic AS (SELECT item_id, size, h, count(*) AS c FROM (SELECT item_id, len(sh) AS size, unnest(sh) AS h FROM t) GROUP BY ALL),
b AS (SELECT row, item_id, start, n + size AS total, sum(least(wc.c, ic.c)) AS common FROM wc JOIN ic USING (size, h) GROUP BY ALL),
m AS (SELECT doc_id, item_id, start, common::DOUBLE / (total - common)::DOUBLE AS similarity FROM b JOIN s USING (row)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS k FROM m WHERE similarity >= 0.8)
SELECT doc_id, item_id, similarity, start FROM r WHERE k = 1
"""
