"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit positions get vectors of radius + 1 bits, none zero, dealt evenly. Each non-zero vector v of that space makes one table
whose mask keeps the positions p with an odd <vector(p), v>. Positions where two fingerprints differ, at most `radius`
of them, span less than the space, so some v is orthogonal to all of them: in that table the differing bits are all
masked out and the pair collides. No pair within the radius is missed.

Work is on distinct fingerprints. A bucket's fingerprints differ only in masked-out bits; for
radius 2 each is posted under itself and each variant with one of those bits flipped. Fingerprints that meet under a variant are
within 2 bits of each other, and all that are within 2 bits meet, so linking each to the least of its meeting place gives
exactly the links' components in rows linear in the bucket, however large it is.

Defined cases: null or empty text has fingerprint 0 and is linked like any other; copies and repeated rows share a
fingerprint; a null doc_id gets a fingerprint and links like any other, but never names a component unless all members are null; rows
are told apart by their contents, so null and repeated ids lose no text; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import beside, broadcast_if_small, materialize, table
from spanlink.llm.graph import components

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Ids, 8 bytes each, beyond which a side is shuffled instead of broadcast.
BROADCAST_IDS = 1_000_000


def hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the ASCII-lower-cased text; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: -width]]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)], np.uint64)


def fingerprint(h: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    ones, step = np.zeros(64, np.int64), 1 << 14
    for k in range(0, len(h), step):
        ones += np.unpackbits(h[k : k + step].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), fp as a signed long, and columns `keep`."""
    keep = keep or []

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        fps = np.array([fingerprint(hashes(t.as_py(), width)) for t in batch.column("text")], np.uint64)
        return [pa.array(fps.view(np.int64))]

    return beside(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, "text"), ["doc_id", *keep], ["text"], "fp long", lambda: run)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits that each table keeps; every pair of 64-bit values within `radius` bits agrees on one of them."""
    space = (1 << radius + 1) - 1
    vectors = [1 + p % space for p in range(64)]
    return [sum(1 << p for p in range(64) if (vectors[p] & v).bit_count() & 1) for v in range(1, space + 1)]


def links(nodes: DataFrame) -> DataFrame:
    """(fp, node), one row per distinct fp, to edges (a, b) of nodes whose components are those of all pairs within 2 bits."""
    masks = covering_masks(RADIUS)
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("mask")) for t, m in enumerate(masks)])).alias("x")
    posted = nodes.select("fp", "node", tables).select("fp", "node", F.col("x.t").alias("t"), F.col("x.mask").alias("mask")).withColumn("kept", F.col("fp").bitwiseAND(F.col("mask")))
    shared = materialize(posted.groupBy("t", "kept").agg(F.count("*").alias("n")).where("n > 1").select("t", "kept"))
    met = posted.join(shared, ["t", "kept"])
    flips = F.array(*[F.lit(_signed(1 << p)) for p in range(64)])
    free = F.filter(flips, lambda bit: bit.bitwiseAND(F.col("mask")) == 0)
    variants = F.explode(F.concat(F.array("fp"), F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit)))).alias("variant")
    spread = met.select("node", variants).distinct()  # a variant means the same in every table
    stars = spread.groupBy("variant").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").select("variant", "b")
    return spread.join(stars, "variant").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def labels(prints: DataFrame) -> DataFrame:
    """(fp, group, component_id) per distinct fp: the least fp, and the least doc_id if any, of all that chains of links within RADIUS bits reach."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = materialize(components(links(nodes.select("fp", F.col("fp").alias("node")))))
    label = nodes.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("group"), "least")
    return label.join(label.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("fp", "group", "component_id")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, prints: DataFrame | None = None) -> DataFrame:
    """(doc_id, fp, component_id) per row: the least doc_id of all that chains of links within RADIUS bits reach."""
    prints = materialize(fingerprints(docs, width=width)) if prints is None else prints
    return prints.join(labels(prints), "fp").select(*[c for c in prints.columns if c != "fp"], "fp", "component_id")


def keyed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text, k1, k2): each row, and a key of 128 bits of all that it holds, null or not; only equal rows share one."""
    columns = [F.col(c) for c in docs.columns]
    key = lambda seed: F.xxhash64(F.lit(seed), *[c.isNull() for c in columns], *columns)
    return docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", key(1).alias("k1"), key(2).alias("k2"))


def one_of_each(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Of each component one row of `docs`: that with the least doc_id (rows without one last), of several the least row key.

    Keys that one row has are looked up; only equal rows are brought together, to keep one.
    """
    rows, key = keyed(docs), ["k1", "k2"]
    prints = materialize(fingerprints(rows, key, width))
    grouped = prints.join(labels(prints).select("fp", "group"), "fp")
    found = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *key)).alias("k")).select("k.k1", "k.k2")
    found = materialize(found.join(prints.groupBy(*key).agg(F.count("*").alias("n")), key))
    single = rows.join(broadcast_if_small(found.where("n = 1").select(*key), BROADCAST_IDS), key, "left_semi")
    several = rows.join(broadcast_if_small(found.where("n > 1").select(*key), BROADCAST_IDS), key, "left_semi").dropDuplicates(key)
    return single.unionByName(several).select("row.*")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
