"""Approximate nearest neighbours by a permutation index.

Each vector is represented by its PREFIX nearest pivots in order. Vectors are dealt into blocks by hash; a block's inverted file
posts every vector under each pivot of its prefix with the place it has there. For a query the postings of its own pivots are
added up: a shared pivot at places i and j brings the footrule distance of the two (location-padded) prefixes down by
2 * (PREFIX - max(i, j)), so the sums rank a block by footrule. The best SHARE of a block is reranked by cosine in
double precision. The query set meets the index block by block, dealt out to groups of blocks by a merge join: it is copied for every
group, far more than its own size lets Spark expect, so it must not be broadcast. What leaves a block is K rows per query.

Equal vectors are indexed once, as a class with its least ids: K + 1 of them are all that any answer can need. Pivots are at most
PIVOTS vectors, lowest hash first, so their broadcast is bounded; every vector is indexed.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part; a cosine is defined among vectors of one
length, so each length is a table of its own; a null vec_id takes no part; of several rows of an id that vector counts which hashes
lowest; fewer candidates than K give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, table

#: At most so many pivots; a vector's prefix; rows of a block, about; queries handed over at once.
PIVOTS, PREFIX, BLOCK, QUERIES = 1024, 48, 4096, 1024
#: Groups that blocks are dealt into, at least; blocks and bytes of a group, at most: a task holds one.
GROUPS, TOGETHER, TOGETHER_BYTES = 64, 16, 1 << 26
#: Of each block, this share is reranked, LEAST rows at least.
SHARE, LEAST = 0.2, 256
K = 5


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, key) of the rows that take part, once per id; equal vectors have equal keys."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).where("vec_id is not null").where(usable(F.col("vector")))
    v = v.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # no negative zero
    v = v.withColumn("key", F.concat_ws(":", F.size("vector"), F.hex(F.xxhash64("vector")), F.hex(F.hash("vector"))))
    one = F.min(F.struct(F.col("key"), F.col("vector"))).alias("v")
    return v.groupBy("vec_id").agg(one).select("vec_id", "v.vector", "v.key")


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row its nearest pivots by cosine, nearest first, ties to the smaller number."""
    sim = x / np.linalg.norm(x, axis=1, keepdims=True) @ pivots.T
    if prefix < sim.shape[1]:
        near = np.sort(np.argpartition(-sim, prefix - 1, axis=1)[:, :prefix], axis=1)
    else:
        near = np.tile(np.arange(sim.shape[1]), (len(sim), 1))
    order = np.argsort(-np.take_along_axis(sim, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1).astype(np.int16)


class Block:
    """The inverted file of one block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, permutation: np.ndarray, pivots: int):
        self.ids, self.x, self.norm, self.prefix = ids, x, np.linalg.norm(x, axis=1), permutation.shape[1]
        flat = permutation.reshape(-1)
        order = np.argsort(flat, kind="stable")
        self.row, self.place = order // self.prefix, order % self.prefix
        self.start = np.searchsorted(flat[order], np.arange(pivots + 1))

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest found: ids and cosines."""
        n, take = len(self.ids), max(LEAST, k, round(SHARE * len(self.ids)))
        rows = np.arange(n)
        if take < n:
            spans = [slice(self.start[p], self.start[p + 1]) for p in own]
            lengths = [s.stop - s.start for s in spans]
            row = np.concatenate([self.row[s] for s in spans])
            place = np.maximum(np.concatenate([self.place[s] for s in spans]), np.repeat(np.arange(len(own)), lengths))
            gain = np.bincount(row, self.prefix - place, n)
            rows = np.argpartition(-gain, take - 1)[:take]
        cos = self.x[rows] @ q / (self.norm[rows] * np.linalg.norm(q))
        best = np.lexsort((self.ids[rows], -cos))[:k]
        return self.ids[rows[best]], cos[best]


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, dim)


def build(distinct: DataFrame, pivots: np.ndarray, prefix: int, n: int) -> DataFrame:
    """Index rows (block, ids, x, permutation) of (vec_id, vector), about BLOCK vectors each."""
    dim = pivots.shape[1]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = np.array(pdf["vector"].tolist(), np.float64).reshape(-1, dim)
        return pd.DataFrame({"block": [key[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()], "permutation": [nearest_pivots(x, pivots, prefix).tobytes()]})

    blocks = max(1, -(-n // BLOCK))
    return distinct.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(run, "block int, ids binary, x binary, permutation binary")


def first_vectors(distinct: DataFrame, most: int) -> np.ndarray:
    """The vectors of lowest hash: ids are chosen before a vector moves, so the driver gets these alone and not as many of each task."""
    chosen = distinct.select("vec_id", F.xxhash64("vec_id", F.lit("pivot")).alias("h")).orderBy("h", "vec_id").limit(most)
    rows = distinct.select("vec_id", "vector").join(F.broadcast(chosen), "vec_id").collect()
    return np.array([r["vector"] for r in sorted(rows, key=lambda r: (r["h"], r["vec_id"]))], np.float64)


def search(index: DataFrame, queries: DataFrame, pivots: np.ndarray, prefix: int, n: int, k: int) -> DataFrame:
    """(query, vec_id, score): for each of (query, vector) the k nearest found in every block."""
    dim, blocks = pivots.shape[1], max(1, -(-n // BLOCK))
    together = max(1, min(TOGETHER, TOGETHER_BYTES // (BLOCK * (8 * dim + 2 * prefix + 8))))
    groups = max(min(blocks, GROUPS), -(-blocks // together))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["vector"].tolist(), np.float64).reshape(-1, dim)
        return pd.DataFrame({"ids": [pdf["query"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()], "own": [nearest_pivots(x, pivots, prefix).tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                width = min(prefix, len(pivots))
                block = Block(np.frombuffer(r.ids, np.int64), _matrix(r.x, dim), np.frombuffer(r.permutation, np.int16).reshape(-1, width), len(pivots))
                names, own = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.own, np.int16).reshape(-1, width)
                found = [block.search(q, o, k) for q, o in zip(_matrix(r.q_x, dim), own, strict=True)]
                yield pd.DataFrame({"query": np.repeat(names, [len(i) for i, _ in found]), "vec_id": np.concatenate([i for i, _ in found]), "score": np.concatenate([s for _, s in found])})

    parts = F.pmod(F.xxhash64("query"), F.lit(max(1, -(-n // QUERIES)))).cast("int")
    packed = queries.withColumn("part", parts).groupBy("part").applyInPandas(pack, "ids binary, x binary, own binary")
    # every pack of queries goes to every group of blocks, by an equi-join on the group's number; the join holds a group and streams the packs
    sent = packed.select(F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), "own", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    dealt = index.withColumn("group", F.pmod("block", F.lit(groups))).drop("block")
    return sent.join(dealt.hint("merge"), "group").mapInPandas(run, "query long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) that is_query picks, against all others."""
    rows = materialize(classes(vectors))
    lengths = sorted(r["d"] for r in rows.select(F.size("vector").alias("d")).distinct().collect())
    found = [_nearest(rows.where(F.size("vector") == d), is_query, k) for d in lengths]
    return functools.reduce(DataFrame.unionByName, found, vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double"))


def _nearest(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """nearest() for the classes of one length."""
    # row_number() <= k + 1 is cut before the shuffle, so a very common vector moves little
    least = Window.partitionBy("key").orderBy("vec_id")
    members = materialize(rows.select("key", "vec_id", "vector").withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1))
    distinct = materialize(members.where("r = 1").select("key", "vec_id", "vector"))
    n = distinct.count()
    pivots = first_vectors(distinct, min(PIVOTS, max(1, n // 4)))
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    prefix = min(PREFIX, len(pivots))
    index = materialize(build(distinct.select("vec_id", "vector"), pivots, prefix, n))

    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "key")
    queries = asked.select("key").distinct().join(distinct, "key").select(F.col("vec_id").alias("query"), "vector")
    found = search(index, queries, pivots, prefix, n, k + 1)  # the own class may be among them
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = materialize(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("query", F.col("vec_id").alias("of"), "score"))
    names = distinct.select("key", F.col("vec_id").alias("query"))
    answers = found.join(names.withColumnRenamed("key", "query_key"), "query")
    answers = answers.join(members.select("key", F.col("vec_id").alias("vec_id")).join(names.withColumnRenamed("query", "of"), "key").select("of", "vec_id"), "of")
    per_row = asked.join(answers, asked["key"] == answers["query_key"]).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return per_row.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
