import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from spanlink.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 50 + (50 * c.total() * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(3)
    words = ["Alpha", "beta", "é", "ß1", "x_y", "the", "THE", "İ", "9", "אב", "k-9", "\x7f", "longword" * 40]
    docs = [(2**53 + 1 + d * 7919, " ".join(rng.choices(words, weights=[1, 1, 1, 1, 1, 9, 3, 1, 1, 1, 1, 1, 1], k=rng.randrange(0, 40)))) for d in range(300)]
    docs += [(None, "alpha beta"), (None, None), (4, ""), (4, "beta beta the"), (4, "beta beta the"), (9, "the " * 30000), docs[0], docs[1]]
    items = [(1, "The alpha, É!"), (1, "beta"), (2, None), (3, "..."), (None, "longword" * 40 + " 9"), (2**53 + 3, "the the THE"), (6, "absent"), (7, "İ ß1 אב k y x")]
    return docs, items


@pytest.mark.parametrize(("window", "max_terms"), [(search.WINDOW, search.MAX_TERMS), (64, 3)])
def test_equals_brute_force(spark, made, monkeypatch, window, max_terms):
    docs, items = made
    monkeypatch.setattr(search, "WINDOW", window)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", search.F.lit(1)).withColumn("terms", search.F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", search.F.lit(0))
    got = search.search(df, asked, k=20, max_terms=max_terms)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 20)


def test_windows_close_by_rows_and_postings(monkeypatch):
    import pyarrow as pa

    lists = pa.array([[1]] * 5 + [[1, 2, 3, 4, 5]] + [[]] * 4, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(10), pa.int64()), lists], ["doc_id", "terms"])
    monkeypatch.setattr(search, "WINDOW", 4)
    monkeypatch.setattr(search, "WINDOW_POSTINGS", 3)
    cut = [[i for b in held for i in b.column("doc_id").to_pylist()] for held in search._cut(iter([batch, batch.slice(0, 1)]))]
    assert [i for held in cut for i in held] == [*range(10), 0] and all(cut) and max(map(len, cut)) <= 4
    assert np.all([len(held) == 1 for held in cut if 5 in held])


def test_bytes_and_characters_give_the_same_terms():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aZ09é _-\x00\x7f😀İ. ") for _ in range(30))
        assert [t.decode() for t in search.terms(text.encode())] == terms(text)
