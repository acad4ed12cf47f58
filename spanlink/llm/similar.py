"""Near duplicates by five-word shingles: what a SimHash radius of 2 bits is too narrow for.

An exact set-similarity join by prefixes. All shingles have one order, those found often in a sample of the documents last, the others by
hash; the order decides the cost only, any gives the same pairs. Two sets of similarity 0.8 have a shingle in common within the first
fifth (and one) of each, so documents that share a shingle there are all candidates there are. The first shingle in common stands even earlier in
the smaller set, within a ninth: 0.8 takes eight ninths of the smaller one at least. Pairs that meet so, and whose sizes allow 0.8, must also have enough
shingles of their prefixes in common: what a set holds beyond its prefix is all that can be added to it. The rest are compared
shingle for shingle. No pair is missed, at 0.8 or above.

Links are found in two rounds, so that large groups don't need all of their pairs. First each set is compared with the one that it shares
most prefix shingles with, out of two of each shingle's sets: the least, and the hub, which has the largest share of common shingles. Of a
text's many altered copies the hub is one with few changes, similar to more of them than any other. Then the candidates are all pairs of sets in
different components of these links: pairs within a component can't change it, so the groups are those of all pairs.

A shingle of many sets would still give all pairs of those that are like each other, but not enough. Each set has BITS parities of its
shingles' hashes. A shingle that only one of two sets has flips one parity, so two sets differ in as many shingles at least as in
parities. Where a shingle has more than SHORT sets, pairs that differ in too many parities are told apart where they meet, and no row is
made of them; no similar pair is lost. A shingle of fewer sets gives at most SHORT rows for each. So rows grow with the sets and with
the similar pairs between components. The comparisons where a shingle's sets meet still number the main component's size times the sets outside it, and all pairs of these.
Sets of several thousand shingles can differ in more than BITS, so that parities tell little of them.

Sets are named by XXH64 of their hashes; equal sets are one node.

Defined cases: null and empty texts have no shingles and are kept; a text of 1 to 4 words is one shingle; null ids are kept; rows of one
doc_id are judged each for itself, rows equal in all columns together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.llm.common import broadcast_if_small, give_back, materialize
from spanlink.llm.graph import components
from spanlink.llm.simhash import BROADCAST_IDS, SEED, hashes, keyed

WIDTH, SIMILARITY = 5, 0.8
#: A shingle goes last if this many documents of a sample, one of SAMPLE, have it; of more than MAX_OFTEN the most frequent.
SAMPLE, OFTEN, MAX_OFTEN = 8, 4, 500_000
#: Parities kept of each set, and how many sets of a shingle meet without them.
BITS, SHORT = 1024, 16
#: In the first round, pairs with a smaller share of their shingles in common within the prefixes wait for the second.
PROMISING = 0.05
EPS = 1e-9


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(hashes(text, WIDTH))


def levels(n: int) -> list[int]:
    """Size classes of a set of n and of one larger by a fourth. The join doesn't need them any more; their test does."""
    return sorted({max(5, int(np.log2(max(1, m / 8)))) for m in (n, n / SIMILARITY)})


def prefix_length(n: int, at_least: float) -> int:
    """Of n shingles in order, how many must be looked at to meet every set that is similar enough."""
    return n - int(np.ceil(at_least * n - EPS)) + 1


def parities(s: np.ndarray) -> np.ndarray:
    """BITS bits as longs: for each remainder of hashes, if an odd number of them has it."""
    odd = np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def often(docs: DataFrame) -> np.ndarray:
    """The hashes, in order, of shingles that many documents have, judged by a sample."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_set(t) for t in pdf["text"]]
            if sets:
                yield pd.DataFrame({"h": np.concatenate(sets).view(np.int64)})
        give_back()

    some = docs.where(F.pmod(F.col("k1"), F.lit(SAMPLE)) == 0).select("text").mapInPandas(run, "h long")
    most = some.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "h").limit(MAX_OFTEN)
    return np.sort(most.select("h").toArrow()["h"].to_numpy().view(np.uint64))  # no Python object for each


def prefixes(docs: DataFrame, last: np.ndarray, at_least: float) -> DataFrame:
    """(doc_id, k1, k2, node, n, prefix, share, bits) of rows with shingles: the set's name, size, first shingles in order, share of common ones and parities."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            node, n, prefix, share, bits = [], [], [], [], []
            for text in pdf["text"]:
                s = shingle_set(text)
                node.append(xxhash.xxh64_intdigest(s.tobytes(), SEED))
                n.append(len(s))
                if len(last) and len(s):
                    common = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s
                    first = np.concatenate([s[~common], s[common]])
                    share.append(common.mean())
                else:
                    first = s
                    share.append(0.0)
                bits.append(parities(s))
                prefix.append(first[: prefix_length(len(s), at_least)].view(np.int64))
            out = pdf.drop(columns="text").assign(node=np.array(node, np.uint64).view(np.int64), n=n, prefix=prefix, share=np.array(share, np.float64), bits=bits)
            yield out[out["n"] > 0]
            del pdf, out, prefix, bits
            give_back()

    return docs.where("doc_id is not null").select("doc_id", "k1", "k2", "text").mapInPandas(run, "doc_id long, k1 long, k2 long, node long, n int, prefix array<long>, share double, bits array<long>")


def shared(rows: DataFrame, at_least: float) -> DataFrame:
    """(h, node, n, early, least, hub): the sets of each prefix shingle that several have; early: it may be the first that a set and one as large or larger share."""
    of = Window.partitionBy("h")
    early = F.col("pos") <= F.col("n") - F.ceil(F.lit(2 * at_least / (1 + at_least)) * F.col("n") - EPS)
    posted = rows.select("node", "n", "share", F.posexplode("prefix").alias("pos", "h")).withColumn("early", early).drop("pos")
    met = posted.select("h", "node", "n", "early", F.min("node").over(of).alias("least"), F.max("node").over(of).alias("most"), F.max(F.struct("share", "node")).over(of).alias("k"))
    return met.where("least <> most").select("h", "node", "n", "early", "least", F.col("k.node").alias("hub")).distinct()


def closest(met: DataFrame) -> DataFrame:
    """(a, b): each set's pair with most shingles in common, out of the least and the hub of each shingle, if these are many."""
    pairs = met.select("node", "n", F.explode(F.array_distinct(F.array("least", "hub"))).alias("other")).where("node <> other").groupBy("node", "other").agg(F.max("n").alias("n"), F.count("*").alias("c"))
    best = pairs.where(F.col("c") >= PROMISING * F.col("n")).groupBy("node").agg(F.max(F.struct("c", "other")).alias("k"))
    return best.select(F.least("node", "k.other").alias("a"), F.greatest("node", "k.other").alias("b")).distinct()


def meeting(open_: DataFrame, at_least: float, near: Column | None = None) -> DataFrame:
    """(a, b), repeatedly: sets of different components that meet at a shingle early enough, with sizes and, where given, parities near enough."""
    side = lambda c: [F.col(k).alias(f"{k}_{c}") for k in ("n", "early", "of", "bits") if k in open_.columns]
    # of a pair in two components one at least is outside the shingle's main one
    x = open_.where("of <> main").select("h", F.col("node").alias("x"), *side("x"))
    y = open_.select("h", F.col("node").alias("y"), "main", *side("y"))
    fits = (F.least("n_x", "n_y") >= at_least * F.greatest("n_x", "n_y") - EPS) & (F.col("early_x") | (F.col("n_x") > F.col("n_y"))) & (F.col("early_y") | (F.col("n_y") > F.col("n_x")))
    met = (F.col("of_x") != F.col("of_y")) & ((F.col("of_y") == F.col("main")) | (F.col("x") < F.col("y"))) & fits
    return x.join(y, "h").where(met if near is None else met & near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def apart(met: DataFrame, found: DataFrame, rows: DataFrame, at_least: float) -> DataFrame:
    """All pairs (a, b) of sets in different components of (node, component) that may be similar by sizes and prefixes."""
    labelled = met.join(found, "node", "left").select("h", "node", "n", "early", F.coalesce("component", "node").alias("of"))
    sizes = labelled.groupBy("h", "of").agg(F.count("*").alias("size"))
    lists = sizes.groupBy("h").agg(F.max(F.struct("size", "of")).alias("k"), F.count("*").alias("kinds"), F.sum("size").alias("size"))
    open_ = materialize(labelled.join(lists.where("kinds > 1").select("h", F.col("k.of").alias("main"), "size"), "h"))
    bits = rows.select("node", "bits").dropDuplicates(["node"])
    long = materialize(open_.where(F.col("size") > SHORT).join(bits, "node"))
    differ = sum(F.bit_count(F.col("bits_x")[k].bitwiseXOR(F.col("bits_y")[k])) for k in range(BITS // 64))
    near = differ <= (1 - at_least) / (1 + at_least) * (F.col("n_x") + F.col("n_y")) + EPS
    pairs = materialize(meeting(open_.where(F.col("size") <= SHORT), at_least).unionByName(meeting(long, at_least, near)).distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = materialize(rows.join(wanted, "node", "left_semi").select("node", "n", "prefix").dropDuplicates(["node"]))
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("prefix").alias(f"prefix_{c}"))
    # prefixes leave ceil(at_least * n) - 1 shingles out
    most = F.size(F.array_intersect("prefix_a", "prefix_b")) + F.ceil(at_least * F.greatest("n_a", "n_b") - EPS) - 1
    return pairs.join(side("a"), "a").join(side("b"), "b").where(most >= at_least / (1 + at_least) * (F.col("n_a") + F.col("n_b")) - EPS).select("a", "b")


def verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, at_least: float) -> DataFrame:
    """The pairs whose sets of shingles are similar enough."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "s": [shingle_set(t).tobytes() for t in pdf["text"]]})
            del pdf
            give_back()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["s_a"], pdf["s_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= at_least * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]
            del pdf
            give_back()

    pairs = materialize(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("node", "k.k1", "k.k2")
    own = docs.select("k1", "k2", "text").join(broadcast_if_small(materialize(one), BROADCAST_IDS), ["k1", "k2"])
    known = materialize(own.select("node", "text").mapInPandas(sets, "node long, s binary"))
    met = pairs.join(known.select(F.col("node").alias("a"), F.col("s").alias("s_a")), "a").join(known.select(F.col("node").alias("b"), F.col("s").alias("s_b")), "b")
    return met.mapInPandas(compare, "a long, b long")


def without_similar(docs: DataFrame, at_least: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` but those that links lead from to a smaller doc_id, or to the lesser row key of the same one."""
    docs = keyed(docs)
    rows = materialize(prefixes(docs, often(docs), at_least))
    met = materialize(shared(rows, at_least))
    first = materialize(verified(closest(met), rows, docs, at_least))
    rest = verified(apart(met, materialize(components(first)), rows, at_least), rows, docs, at_least)
    found = materialize(components(first.unionByName(rest)))
    named = rows.join(found, "node", "left").select(F.coalesce("component", "node").alias("of"), F.struct("doc_id", "k1", "k2").alias("k"))
    least = named.groupBy("of").agg(F.min("k").alias("least"), F.max("k").alias("most")).where("least <> most").select("of", "least")
    gone = materialize(named.join(least, "of").where("k <> least").select(F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")).distinct())
    return docs.join(broadcast_if_small(gone, BROADCAST_IDS), ["k1", "k2"], "left_anti").select("row.*")
