"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words of lower-cased text are hashed; a document's features are the distinct buckets of its words (whole, and cut to STEMS
bytes, so that inflected forms share a weight), word pairs and pairs with one word between. FTRL-proximal keeps a learning rate per coordinate and an L1 term that leaves most weights at
exactly zero, so what tasks receive is a short list (bucket, weight), at most 2**BITS entries. Scoring streams whole
texts and looks at nothing but the buckets that have a weight.

The model is fitted on at most `max_rows` labelled documents and MAX_FIT_BYTES of features, those whose ids hash lowest; everything is scored.
Defined cases: null or empty text scores as the bias alone; a document with several labels counts as the largest; without
a row that is labelled toxic the model is empty and every score is next to 0; without any label every score is 0.5; an empty model rejects nothing;
repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.llm.common import beside, give_back, materialize, table

BITS = 20
STEMS = (4, 6)
#: Bound of the labelled sample that the model is fitted on.
MAX_FIT_ROWS = 12_000
#: Bound of that sample's features in the task that fits it; rows beyond it, in the order of the hashes, are left out.
MAX_FIT_BYTES = 96 << 20
THRESHOLD = 0.3
#: Characters of text worked on at once.
BATCH_CHARS = 1 << 21
_SPACES = bytes(c if chr(c).isalnum() or c >= 128 or chr(c) in "'-" else 32 for c in range(256))


def word_hashes(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """32-bit hashes of all words, whole and cut to each of STEMS, and the number of words of each text."""
    lists = [(t or "").lower().encode().translate(_SPACES).split() for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = [w for ws in lists for w in ws]
    return [np.fromiter(map(zlib.crc32, ws), np.uint64, len(flat)) for ws in (flat, *([w[:k] for w in flat] for k in STEMS))], counts


def features(forms: list[np.ndarray], counts: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) for words and stems, then pairs of neighbours, then pairs with a word between."""
    doc = np.repeat(np.arange(len(counts)), counts)
    mul, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    for k, form in enumerate(forms):
        yield ((form + np.uint64(1 + (k << 32))) * mul) >> shift, doc
    hashes = forms[0]
    for gap, own in ((1, np.uint64(0xC2B2AE3D27D4EB4F)), (2, np.uint64(0x165667B19E3779F9))):
        same = np.flatnonzero(doc[gap:] == doc[:-gap]) if len(doc) > gap else np.empty(0, np.int64)
        mixed = (hashes[same] + np.uint64(1)) * own + hashes[same + gap]
        yield ((mixed ^ (mixed >> np.uint64(31))) * mul) >> shift, doc[same]


def distinct_features(texts: list[str | None], bits: int = BITS) -> list[np.ndarray]:
    """Sorted distinct buckets of each text."""
    hashes, counts = word_hashes(texts)
    keys = np.unique(np.concatenate([(doc.astype(np.uint64) << np.uint64(bits)) | bucket for bucket, doc in features(hashes, counts, bits)]))
    ends = np.searchsorted(keys, np.arange(1, len(texts) + 1, dtype=np.uint64) << np.uint64(bits))
    return [x.astype(np.uint32) for x in np.split(keys & np.uint64((1 << bits) - 1), ends[:-1])]


def packed(buckets: np.ndarray, bits: int = BITS) -> bytes:
    """Sorted buckets in two bytes each: how many there are of each high part, then the low 16 bits."""
    high = np.bincount(buckets >> 16, minlength=1 << max(0, bits - 16))
    return high.astype("<u4").tobytes() + (buckets & 0xFFFF).astype("<u2").tobytes()


def unpacked(raw: bytes, bits: int = BITS) -> np.ndarray:
    n = 1 << max(0, bits - 16)
    return np.repeat(np.arange(n, dtype=np.uint32) << 16, np.frombuffer(raw, "<u4", n)) | np.frombuffer(raw, "<u2", offset=4 * n)


def fit_ftrl(rows: list[bytes], labels: np.ndarray, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 12.0, l2: float = 1.0, epochs: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets with a weight, their weights, and the bias. Rows (as packed() makes them) are visited in the order given, each epoch."""
    if len(labels) and not np.any(labels):
        return np.empty(0, np.uint32), np.empty(0, np.float32), -35.0
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias, bias_n = 0.0, 0.0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for raw, y in zip(rows, labels, strict=True):
            i = unpacked(raw, bits)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
            bias_n += g * g
            bias -= 0.1 * g / (1 + np.sqrt(bias_n))
    used = np.flatnonzero(np.abs(z) > l1)
    return used.astype(np.uint32), weights(used).astype(np.float32), float(bias)


def score_texts(texts: list[str | None], dense: np.ndarray, bias: float, bits: int = BITS) -> np.ndarray:
    """Probabilities; dense: a weight for each bucket."""
    hashes, counts = word_hashes(texts)
    keys = []
    for bucket, doc in features(hashes, counts, bits):
        hit = np.flatnonzero(dense[bucket.astype(np.int64)])
        keys.append((doc[hit].astype(np.uint64) << np.uint64(bits)) | bucket[hit])
    keys = np.unique(np.concatenate(keys))
    total = np.bincount((keys >> np.uint64(bits)).astype(np.int64), dense[(keys & np.uint64((1 << bits) - 1)).astype(np.int64)], len(texts))
    return 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))


def by_chars(texts: list[str | None], limit: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of at most `limit` characters, one text at least."""
    at, chars = 0, 0
    for k, t in enumerate(texts):
        chars += len(t or "")
        if chars > limit and k > at:
            yield slice(at, k)
            at, chars = k, len(t or "")
    if at < len(texts):
        yield slice(at, len(texts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(h, y, text) of at most max_rows labelled ids, lowest hash first; the broadcast side has that bound."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y")).where("y is not null")
    picked = known.select("doc_id", "y", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).orderBy("h", "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("h", "doc_id", "y", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for s in by_chars(texts):
                yield pdf.iloc[s].drop(columns="text").assign(buckets=[packed(x) for x in distinct_features(texts[s])])
        give_back()

    sample = materialize(labelled_sample(docs, labels, label, max_rows).mapInPandas(run, "h long, doc_id long, y int, buckets binary"))
    if sample.count() > 2 * max_rows:  # repeated ids at most double the sample
        sample = materialize(sample.orderBy("h", "doc_id", "buckets").limit(2 * max_rows))
    if (sample.agg(F.sum(F.length("buckets"))).first()[0] or 0) > MAX_FIT_BYTES:
        sizes = sample.select("h", "doc_id", F.length("buckets").alias("n"))  # 2 * max_rows rows at most
        upto = F.sum("n").over(Window.orderBy("h", "doc_id"))
        within = sizes.withColumn("upto", upto).where(F.col("upto") <= MAX_FIT_BYTES).agg(F.max(F.struct("h", "doc_id")).alias("m")).first()["m"]
        sample = sample.where(F.struct("h", "doc_id") <= F.struct(F.lit(within["h"]), F.lit(within["doc_id"]))) if within else sample.limit(0)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(row for pdf in batches for row in zip(pdf["h"].tolist(), pdf["doc_id"].tolist(), map(bytes, pdf["buckets"]), pdf["y"].tolist(), strict=True))
        used, weights, bias = fit_ftrl([r[2] for r in rows], np.array([r[3] for r in rows], np.float64))
        yield pd.DataFrame({"used": [used.tobytes()], "weights": [weights.tobytes()], "bias": [bias]})

    # the bounded sample is folded in one task, and the driver gets the short model alone
    models = sample.coalesce(1).mapInPandas(train, "used binary, weights binary, bias double").collect()
    if not models:
        return fit_ftrl([], np.empty(0))
    return np.frombuffer(bytes(models[0]["used"]), np.uint32), np.frombuffer(bytes(models[0]["weights"]), np.float32), models[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], extra: list[str] | None = None) -> DataFrame:
    """The id (and columns `extra`) of each row with its score (0 to 1) and prediction."""
    used, weights, bias = model
    keep = ["doc_id", *(extra or [])]

    def start():
        dense = np.zeros(1 << BITS, np.float64)
        dense[used] = weights

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column("text").to_pylist()
            return [pa.array(np.concatenate([np.empty(0), *[score_texts(texts[s], dense, bias) for s in by_chars(texts)]]))]

        return run

    out = beside(docs, keep, ["text"], "score double", start)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold, all columns as they are; all rows, if nothing was labelled."""
    used, weights, bias = model
    if not len(used) and bias == 0:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float64)
        dense[used] = weights
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [score_texts(texts[s], dense, bias) < threshold for s in by_chars(texts)]
            yield batch.filter(pa.array(np.concatenate(parts))) if parts else batch
            del texts, parts, batch
            give_back()

    return docs.mapInArrow(run, docs.schema)


def remainder(parts: int):
    """crc32 of the id's decimal text, mod `parts`."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder(4) != 2))
    return score(docs, model).select("doc_id", (F.coalesce(remainder(4), F.lit(0)) == 2).alias("held_out"), "score", "predicted")
