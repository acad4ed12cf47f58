"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

A token is a run of letters and digits or a run of other visible characters; it is hashed to one of 2**BITS buckets. Every bucket
has a fixed sparse vector of +1 and -1 (its index vector). A bucket's word vector is the sum of the index vectors at and around
all its occurrences in the whole corpus, so what is learned here grows with the corpus while the table keeps its size, 2**BITS
rows of DIM numbers, which is what bounds the broadcast. Documents are pooled as mean and standard deviation of their tokens'
unit vectors. The network is fitted in numpy on at most `max_rows` labelled documents, and the temperature of its probabilities on
a tenth of them kept out of the fit.

Defined cases: null or empty text pools to zeros and gets the score of that point; several labels of a document count as
their largest; with no labelled row every score is 0.5; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import beside, materialize, table
from spanlink.llm.toxicity import by_chars, remainder

BITS, DIM, NONZERO, REACH = 14, 32, 2, 2
#: Bound of the labelled sample that the network is fitted on.
MAX_FIT_ROWS = 20_000
THRESHOLD = 0.3
HIDDEN = 32
_CLASS = np.array([0 if c <= 32 else 1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256)], np.uint8)
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens, and for each the number of its text."""
    raw = [(t or "").encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    kind = _CLASS[data]
    starts = np.flatnonzero((kind != 0) & (np.concatenate([[0], kind[:-1]]) != kind))
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    visible = np.flatnonzero(kind)
    owner = np.cumsum(np.bincount(np.searchsorted(visible, starts), minlength=len(visible))) - 1  # token of each visible byte
    place = np.minimum(visible - starts[owner], 63)
    sums = np.add.reduceat((data[visible].astype(np.uint64) + np.uint64(1)) * _POWERS[place], np.searchsorted(visible, starts))
    sums ^= sums >> np.uint64(29)
    bucket = ((sums * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)
    doc = np.searchsorted(np.cumsum([len(r) for r in raw]), starts, side="right")
    return bucket, doc


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero components of each bucket's fixed vector."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((1 << BITS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (1 << BITS, NONZERO))


def add_contexts(bucket: np.ndarray, doc: np.ndarray, places: np.ndarray, signs: np.ndarray, total: np.ndarray) -> None:
    """Add the index vectors at distance 0..REACH of each token to `total`, flat over (bucket, component)."""
    for gap in range(REACH + 1):
        n = len(bucket) - gap
        if n <= 0:
            break
        pair = np.flatnonzero(doc[:n] == doc[gap:]) if gap else np.arange(n)
        a, b = bucket[pair], bucket[pair + gap]
        for left, right in ((a, b), (b, a)) if gap else ((a, a),):
            for j in range(NONZERO):
                total += np.bincount(left * DIM + places[right, j], signs[right, j], len(total))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors by bucket, over all documents; each task sends at most a row per bucket, summed by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        total = np.zeros(DIM << BITS)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in by_chars(texts):
                add_contexts(*tokens(texts[s]), places, signs, total)
        rows = total.reshape(-1, DIM)
        used = np.flatnonzero(np.abs(rows).sum(axis=1))
        yield pd.DataFrame(rows[used].astype(np.float32), columns=[f"v{k}" for k in range(DIM)]).assign(bucket=used)

    parts = docs.select("text").mapInPandas(run, ", ".join(f"v{k} float" for k in range(DIM)) + ", bucket long")
    rows = parts.groupBy("bucket").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(DIM)]).toPandas()
    out = np.zeros((1 << BITS, DIM))
    out[rows["bucket"].to_numpy(np.int64)] = rows[[f"v{k}" for k in range(DIM)]].to_numpy()
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(bucket: np.ndarray, doc: np.ndarray, n: int, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of each of n texts."""
    out = np.zeros((n, 2 * DIM), np.float32)
    if not len(bucket):
        return out
    having, first = np.unique(doc, return_index=True)
    count = np.diff(np.append(first, len(doc)))[:, None]
    v = vectors[bucket]
    mean = np.add.reduceat(v, first, axis=0) / count
    square = np.add.reduceat(v * v, first, axis=0) / count
    out[having] = np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0))], axis=1)
    return out


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, x): pooled features as float32 bytes."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, xs = batch.column("text").to_pylist(), []
        for s in by_chars(texts):
            xs += [x.tobytes() for x in pool(*tokens(texts[s]), s.stop - s.start, vectors)]
        return [pa.array(xs, pa.binary())]

    return beside(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], ["text"], "x binary", lambda: run)


class Network:
    """Inputs, HIDDEN rectified units, one logistic output divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4, seed: int = 11):
        self.mean, self.scale, self.temperature = np.zeros(2 * DIM), np.ones(2 * DIM), 1.0
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, (2 * DIM) ** -0.5, (2 * DIM, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
        if len(y) < 2:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        kept = np.arange(len(y)) % 10 == 9
        self.p[2] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
        xs, ys = (x[~kept] - self.mean) / self.scale, y[~kept]
        m, v, t = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(epochs):
            order = rng.permutation(len(ys))
            for k in range(0, len(order), 128):
                t += 1
                a, b = xs[order[k : k + 128]], ys[order[k : k + 128]]
                h = np.maximum(a @ self.p[0] + self.p[1], 0)
                d = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -35, 35))) - b) / len(b)
                back = np.outer(d, self.p[2]) * (h > 0)
                for i, g in enumerate((a.T @ back, back.sum(axis=0), h.T @ d, d.sum(keepdims=True))):
                    g = g + decay * self.p[i]
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        if kept.any():
            z, yk = self.logit(x[kept]), y[kept]
            tries = np.geomspace(0.5, 8, 60)
            self.temperature = min(tries, key=lambda s: np.mean(np.logaddexp(0, z / s) - yk * z / s))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -35, 35)))


def _matrix(xs) -> np.ndarray:
    return np.frombuffer(b"".join(xs), np.float32).reshape(-1, 2 * DIM).astype(np.float64)


def fit(features: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Network:
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y")).where("y is not null")
    picked = known.select("doc_id", "y", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).orderBy("h", "doc_id").limit(max_rows)
    rows = features.join(F.broadcast(picked), "doc_id").select("h", "doc_id", "y", "x")
    rows = rows.orderBy("h", "doc_id", "x").limit(2 * max_rows).toPandas()  # repeated ids at most double the sample
    return Network(_matrix(rows["x"]), rows["y"].to_numpy(np.float64))


def score(features: DataFrame, network: Network) -> DataFrame:
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(network(_matrix(batch.column("x").to_pylist())))]

    out = beside(features, ["doc_id"], ["x"], "score double", lambda: run)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    features = materialize(pooled(docs, word_vectors(docs)))
    network = fit(features, labels.where(remainder(5) != 0))
    return score(features, network).select("doc_id", (F.coalesce(remainder(5), F.lit(1)) == 0).alias("held_out"), "score", "predicted")
