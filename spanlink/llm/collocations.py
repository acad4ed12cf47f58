"""Collocations: phrases whose words come together more often than apart, per language.

1. Lower-cased texts are split into pieces. Identical pieces become one row with a multiplicity, combined before the shuffle, so a line that
   is everywhere is cut into phrases once.
2. Tasks cut CHUNK_WORDS words of pieces at a time into weighted n-grams and add up equal ones, so a common word leaves a chunk once.
   N-grams are dealt into hash buckets by (lang, words); those of a chunk and bucket are shuffled as one compressed block of codes, and
   duckdb counts each bucket from the stream of its blocks, within MEMORY_LIMIT; what doesn't fit goes to a folder of the task in
   spark.checkpoint.dir, where that is a path of files. The number of buckets follows the number of words, about BUCKET_ROWS n-grams each. Only counts of `least` or more go on: no phrase counts more than its parts.
3. Candidates ask for the counts of their parts by requests, which are shuffled to the parts, answered, and shuffled back. Parts
   with more than a HOT_SHARE of all requests, so at most 1 / HOT_SHARE of them, are answered in SALT places.
4. Scores are whole numbers in decimals of 38 digits, exact for counts below 10^15. Each language's best are found in two steps.

Defined cases: a null lang is `und`; null and empty texts have no words; a text without any mark is one piece, however long; copies
and repeated rows count each; ties are broken by the count and then by the phrase's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import contextlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, shared_dir, table
from spanlink.llm.files import resolve

LONGEST, LEAST, BEST, CONTAINED = 3, 10, 2000, 50
CHUNK_WORDS, BUCKET_ROWS, MEMORY_LIMIT = 1 << 21, 4_000_000, "512MB"
HOT_SHARE, HOT_LEAST, SALT = 1 / 10_000, 1_000, 64
MARKS = r"[.,;:!?\x0A-\x0D]"
_ODD = np.uint64(0x9E3779B97F4A7C15)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, piece, times): distinct pieces, their words joined by one space."""
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER + "\t", LOWER + " ")
    piece = F.trim(F.regexp_replace("piece", r"\x20{2,}", " "))
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(lowered, MARKS)).alias("piece"))
    return rows.select("lang", piece.alias("piece")).where("piece <> ''").groupBy("lang", "piece").agg(F.count("*").alias("times"))


def _totals(names: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one place of each distinct name, sum of its weights, each place's number of its name)."""
    order = np.argsort(names)
    sorted_names = names[order]
    new = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    number = np.empty(len(names), np.int64)
    number[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return order[starts], np.add.reduceat(weights[order], starts), number


def weighted_grams(chunk: pa.Table, longest: int) -> tuple[pa.Array, pa.Array, list[tuple[np.ndarray, list[np.ndarray], np.ndarray]]]:
    """Languages and words of some (lang, piece, times); for each length the distinct grams as codes into them: (language, words by place, weights)."""
    lists = pc.split_pattern(chunk.column("piece").combine_chunks(), " ")
    sizes = np.diff(lists.offsets.to_numpy())
    words = pc.dictionary_encode(lists.flatten())
    langs = pc.dictionary_encode(chunk.column("lang").combine_chunks())
    row = np.repeat(np.arange(len(sizes)), sizes)
    times = chunk.column("times").to_numpy()[row]
    code = words.indices.to_numpy().astype(np.int64)
    lang = langs.indices.to_numpy().astype(np.int64)[row]
    name, found = lang, []
    for k in range(1, longest + 1):
        at = np.flatnonzero(row[k - 1 :] == row[: max(0, len(row) - k + 1)])
        if not len(at):
            break
        # a gram's name follows from that of its first k - 1 words, or the language, and its last word
        one, n, number = _totals(name[at] * len(words.dictionary) + code[at + k - 1], times[at])
        start = at[one]
        found.append((lang[start].astype(np.int32), [code[start + j].astype(np.int32) for j in range(k)], n))
        name = np.full(len(row), -1, np.int64)
        name[at] = number
    return langs.dictionary, words.dictionary, found


def _hashes(values: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(v) for v in values.to_pylist()), np.uint64, len(values))


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def blocks(chunk: pa.Table, longest: int, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, names, grams): a chunk's grams that fall into one bucket, as codes of names (words and languages; an empty name stands for no word)."""
    langs, words, grams = weighted_grams(chunk, longest)
    lang_hash, word_hash = _hashes(langs), _hashes(words)
    names = pa.concat_arrays([pa.array([""]), words.cast(pa.string()), langs.cast(pa.string())])
    columns, hashes = [], []
    for lang, codes, n in grams:
        h = lang_hash[lang]
        for code in codes:
            h = (h ^ (h >> np.uint64(29))) * _ODD + word_hash[code]
        hashes.append(h)
        none = [np.zeros(len(n), np.int32)] * (longest - len(codes))
        columns.append([lang + len(words) + 1, *[code + 1 for code in codes], *none, n])
    if not columns:
        return
    h, columns = np.concatenate(hashes), [np.concatenate(x) for x in zip(*columns, strict=True)]
    bucket = (((h ^ (h >> np.uint64(32))) * _ODD) >> np.uint64(16)) % np.uint64(buckets)
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)  # short numbers are sorted by their digits
    order = np.argsort(bucket, kind="stable").astype(np.int32)
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        codes = [x[own] for x in columns[:-1]]
        used = np.zeros(len(names), bool)
        for code in codes:
            used[code] = True
        local = np.cumsum(used) - 1
        kind = np.uint16 if local[-1] < 1 << 16 else np.uint32
        batch = pa.RecordBatch.from_arrays([pa.array(local[code].astype(kind)) for code in codes] + [pa.array(columns[-1][own])], _columns(longest))
        yield int(bucket[own[0]]), _packed(pa.RecordBatch.from_arrays([names.filter(pa.array(used))], ["name"])), _packed(batch)


def _columns(longest: int) -> list[str]:
    return ["lang", *[f"w{j}" for j in range(longest)], "n"]


def opened(rows: list[tuple[bytes, bytes]]) -> tuple[pa.Array, Iterator[pa.RecordBatch]]:
    """Names of blocks (names, grams), the empty one first, and the grams with one number for each name."""
    lists = [pa.array([""]), *[pa.ipc.open_stream(names).read_next_batch().column(0) for names, _ in rows]]
    coded = pa.concat_arrays(lists).dictionary_encode()
    number, ends = coded.indices.to_numpy(), np.cumsum([len(x) for x in lists])

    def grams() -> Iterator[pa.RecordBatch]:
        for (_, block), a, b in zip(rows, ends[:-1], ends[1:], strict=True):
            batch = pa.ipc.open_stream(block).read_next_batch()
            yield pa.RecordBatch.from_arrays([pa.array(number[a:b][c.to_numpy()]) for c in batch.columns[:-1]] + [batch.column("n")], batch.schema.names)

    return coded.dictionary, grams()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.add(pc.count_substring(batch.column("piece"), " "), 1).to_numpy().astype(np.int64))
        at = 0
        while at < len(batch):
            done = int(ends[at - 1]) if at else 0
            end = max(int(np.searchsorted(ends, done + CHUNK_WORDS - size, side="right")), at + (not held))
            if end > at:
                held.append(batch.slice(at, end - at))
                size += int(ends[end - 1]) - done
                at = end
            if at < len(batch):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


@contextlib.contextmanager
def _spill(uri: str) -> Iterator[dict[str, str]]:
    """Settings for duckdb: a folder of this task attempt if the shared folder is a path of files."""
    if not uri.startswith(("file:", "/")):
        yield {}
        return
    fs, path = resolve(f"{uri}/{uuid.uuid4().hex}")
    fs.create_dir(path, recursive=True)
    try:
        yield {"temp_directory": path}
    finally:
        fs.delete_dir(path)


def gram_counts(found: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, gram, k, a) of (lang, piece, times): phrases of 1 to `longest` words that occur `least` times or more."""
    spill = shared_dir(found.sparkSession)

    words = found.agg(F.sum(word_count())).first()[0] or 0
    buckets = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-longest * words // BUCKET_ROWS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for bucket, names, grams in blocks(chunk, longest, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([names], pa.binary()), pa.array([grams], pa.binary())], ["bucket", "names", "grams"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        by_bucket: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for bucket, *block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                by_bucket.setdefault(bucket, []).append(tuple(block))
        names = _columns(longest)
        for rows in by_bucket.values():
            text, grams = opened(rows)
            first = next(grams)
            reader = pa.RecordBatchReader.from_batches(first.schema, itertools.chain([first], grams))
            with _spill(spill) as folder, duckdb.connect(config={"threads": "1", "memory_limit": MEMORY_LIMIT, "preserve_insertion_order": "false", **folder}) as db:
                db.register("bucket", reader)
                keys = ", ".join(names[:-1])
                frequent = db.sql(f"SELECT {keys}, CAST(sum(n) AS BIGINT) AS a FROM bucket GROUP BY {keys} HAVING sum(n) >= {int(least)}").to_arrow_table()
            of = lambda c: text.take(frequent.column(c).combine_chunks())  # noqa: B023, E731
            length = sum((frequent.column(c).to_numpy() > 0).astype(np.int32) for c in names[1:-1])
            gram = of("w0")
            for c in names[2:-1]:
                none = pa.array(frequent.column(c).to_numpy() == 0)
                gram = pc.if_else(none, gram, pc.binary_join_element_wise(gram, of(c), " "))
            yield pa.RecordBatch.from_arrays([of("lang"), gram, pa.array(length), frequent.column("a").combine_chunks()], ["lang", "gram", "k", "a"])

    grams = found.select("lang", "piece", "times").mapInArrow(cut, "bucket int, names binary, grams binary")
    return grams.repartition(buckets, "bucket").mapInArrow(count, "lang string, gram string, k int, a long")


def word_count() -> Column:
    return F.expr("CAST(octet_length(piece) - octet_length(replace(piece, ' ', '')) + 1 AS BIGINT)")


def _words(a: Column | int, n: Column | int) -> Column:
    """n words of the gram from its word number a, counted from 1."""
    return F.array_join(F.slice("words", a, n), " ")


def parts_of(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, gram, cuts: list of (cut, l, r)) for phrases (lang, gram, k), by requests to the counts (lang, gram, a)."""
    split = phrases.select("lang", "gram", "k", F.split("gram", " ").alias("words"))
    cuts = F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(c.alias("cut"), _words(F.lit(1), c).alias("first"), _words(c + 1, F.col("k") - c).alias("rest")))
    each = split.select("lang", "gram", F.explode(cuts).alias("c")).select("lang", "gram", "c.*")
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), F.col("first").alias("part")), F.struct(F.lit("r").alias("side"), F.col("rest").alias("part"))))
    requests = materialize(each.select("lang", "gram", "cut", sides.alias("s")).select("lang", "gram", "cut", "s.*"))
    total = requests.count()
    hot = requests.groupBy("lang", "part").agg(F.count("*").alias("n")).where(F.col("n") > max(HOT_LEAST, total * HOT_SHARE)).select("lang", "part", F.lit(True).alias("hot"))
    hot = F.broadcast(materialize(hot))  # 1 / HOT_SHARE rows at most
    asked = requests.join(hot, ["lang", "part"], "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("gram"), F.lit(SALT))).otherwise(0))
    places = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    held = counts.select("lang", F.col("gram").alias("part"), "a").join(hot, ["lang", "part"], "left").select("lang", "part", "a", F.explode(places).alias("salt"))
    answers = asked.join(held, ["lang", "part", "salt"]).select("lang", "gram", "cut", "side", "a")
    by_cut = answers.groupBy("lang", "gram", "cut").agg(F.max(F.when(F.col("side") == "l", F.col("a"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("a"))).alias("r"))
    return by_cut.groupBy("lang", "gram").agg(F.collect_list(F.struct("cut", "l", "r")).alias("cuts"))


def _inside(phrases: DataFrame) -> DataFrame:
    """(lang, gram, longer): the count of the commonest longer phrase around a phrase."""
    split = phrases.where("k > 2").select("lang", "a", "k", F.split("gram", " ").alias("words"))
    sizes = F.sequence(F.lit(2), F.col("k") - 1)
    subs = F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: _words(i, n))))
    return split.select("lang", "a", F.explode(F.array_distinct(subs)).alias("gram")).groupBy("lang", "gram").agg(F.max("a").alias("longer"))


def score(a: str, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exact."""
    exact = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", exact(F.col(a)) * exact(F.col(a)) * F.lit(1_000_000).cast("decimal(7,0)"), exact(l) * exact(r))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, best: int = BEST, contained: int = CONTAINED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `best` phrases of 2 to `longest` words.

    A phrase is left out if a longer one around it has `contained` percent of its count or more.
    """
    found = materialize(pieces(docs))
    sizes = found.groupBy("lang").agg(F.sum(F.col("times") * word_count()).alias("n"))
    counts = materialize(gram_counts(found, longest, least))
    phrases = counts.where("k > 1")
    free = phrases.join(_inside(phrases), ["lang", "gram"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a"))).select("lang", "gram", "k", "a")
    free = materialize(free)
    lowest = F.array_min(F.transform("cuts", lambda c: F.struct(score("a", c["l"], c["r"]).alias("score"), c["cut"].alias("cut"), c["l"].alias("l"), c["r"].alias("r"))))
    scored = free.join(parts_of(free, counts), ["lang", "gram"]).select("lang", F.col("gram").alias("phrase"), "a", lowest.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    few = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order))).where(F.col("rank") <= best)
    final = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return final.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{MARKS}')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, ws, count(*) AS times FROM (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p) GROUP BY ALL),
o AS (SELECT lang, times, ws, unnest([1, 2, 3]) AS k FROM w),
g AS (SELECT lang, k, times, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS gram FROM o),
f AS MATERIALIZED (SELECT lang, k, gram, sum(times)::BIGINT AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, gram, a, string_split(gram, ' ') AS ws FROM f WHERE k > 1 AND a >= {LEAST}),
i AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS gram, a FROM c WHERE k = 3),
x AS (SELECT lang, gram, max(a) AS longer FROM i GROUP BY ALL),
e AS (SELECT lang, gram, k, a, ws, unnest(range(1, k)) AS cut FROM c),
y AS (SELECT e.lang, e.gram, e.a, cut, fl.a AS l, fr.a AS r, ((1000000::HUGEINT * e.a * e.a) // (fl.a::HUGEINT * fr.a))::BIGINT AS score FROM e
  JOIN f fl ON fl.lang = e.lang AND fl.gram = array_to_string(ws[1:cut], ' ') JOIN f fr ON fr.lang = e.lang AND fr.gram = array_to_string(ws[cut + 1:], ' ')),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS nth FROM y),
s AS (SELECT z.lang, z.gram AS phrase, z.a, l, r, score FROM z LEFT JOIN x ON x.lang = z.lang AND x.gram = z.gram WHERE nth = 1 AND (longer IS NULL OR 100 * longer < {CONTAINED} * z.a)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= {BEST}
"""
