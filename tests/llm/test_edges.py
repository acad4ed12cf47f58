"""All queries of the package on empty tables and on odd rows; held-out accuracy and recall on small made-up tables."""

import random

import numpy as np
import pytest

from spanlink.llm import permutation, quality, toxicity
from spanlink.llm.queries import QUERIES

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, h long, row string",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string, digest string",
    "embeddings": "vec_id long, embedding array<float>, label int, key string",
}


def write(spark, path, tables):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(tables.get(name, []), schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), {})


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    texts = [None, "", " \t\n", "x", "x", "one two three four five six", "é" * 5000, "word " * 20000, "😀 אב token=abcdef", "a\0b"]
    docs = [(k if k else None, t, None, None if k % 2 else "s", None, 0.5, 1, 2, "r") for k, t in enumerate(texts)] + [(5, texts[5], "en", "s", 1, None, None, None, None)] * 3
    long = "<p>" + "y" * 1200
    pages = [(1, "http://a/\r\nb", long, "d"), (2, None, long, "d"), (3, "u", None, "d"), (None, "u", "", None), (4, "u", "z", None), (4, "u", "z", None)]
    v = [1.0, 2.0, 3.0]
    vectors = [(0, v), (50, v), (1, v), (2, [0.0, 0.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, [2.0, 4.0, 6.0]), (100, [-1.0, 0.0, -0.0]), (100, [-1.0, 0.0, -0.0]), (8, [1.0, 1.0]), (None, v)]
    labels = [(5, 1, 0), (5, None, 1), (None, 1, 1), (6, 0, 1), (777, 1, 1)]
    tables = {"documents": docs, "pages": pages, "embeddings": [(*r, 1, "k") for r in vectors], "labels": labels, "benchmark": [(1, texts[5]), (1, texts[5]), (2, None), (None, "x")]}
    return write(spark, tmp_path_factory.mktemp("odd"), tables), docs, pages


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op1_warc_salvage", "op2_permutation_index", "op5_decontamination", "op11_collocations", "op12_lexical_search")])
def test_odd_rows_give_a_row_each(spark, odd, name):
    path, docs, _ = odd
    got = QUERIES[name](spark, path).collect()
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got) == sorted(-1 if d[0] is None else d[0] for d in docs)


def test_odd_pages(spark, odd):
    path, _, pages = odd
    got = sorted((tuple(r) for r in QUERIES["op1_warc_salvage"](spark, path).collect()), key=str)
    assert [(r[0], r[1], r[3], r[4]) for r in got] == [(1, 1203, "revisit", 2), (2, 1203, "response", None), (3, 0, "response", None), (4, 1, "response", None), (4, 1, "response", None), (None, 0, "response", None)]


def test_odd_vectors(spark, odd):
    got = QUERIES["op2_permutation_index"](spark, odd[0]).orderBy("query_id", "rank").collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == {0: [1, 7, 50, 100], 50: [0, 1, 7, 100], 100: [0, 1, 7, 50]}
    assert got[0]["score"] == pytest.approx(1)


def test_odd_items(spark, odd):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, odd[0]).collect()}
    assert got == {(5, 1), (3, None), (4, None)}


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    x[2000:2100] = x[5]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = {}
    for r in permutation.nearest(df, permutation.F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = []
    for q, rows in got.items():
        cos = unit @ unit[q]
        cos[q] = -2
        best = np.lexsort((np.arange(len(x)), -np.round(cos, 12)))[:5]
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5] and all(s == pytest.approx(cos[v], abs=1e-9) for _, v, s in rows)
        hits.append(np.isin(best, [v for _, v, _ in rows]).mean())
    assert len(got) == 120 and np.mean(hits) >= 0.9
    assert [v for _, v, _ in got[2050]] == [5, 2000, 2001, 2002, 2003]


def _area(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    p = labels == 1
    return (rank[p].sum() - p.sum() * (p.sum() - 1) / 2) / (p.sum() * (~p).sum())


def test_held_out_accuracy(spark, tmp_path):
    rng = random.Random(8)
    syllables = ["tha", "re", "on", "ing", "ble", "sh", "an", "ou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for d in range(900):
        words = [word() for _ in range(rng.randrange(30, 120))]
        toxic, good = d % 3 == 0, d % 4 != 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grob" + rng.choice(syllables))
        if not good:
            words = [w + rng.choice(["$$$", "%%%"]) for w in words]
        docs.append((d, " ".join(words), "en", "s", 0, 0.0, 0, 0, ""))
        labels.append((d, int(good), int(toxic)))
    path = write(spark, tmp_path, {"documents": docs, "labels": labels})
    for name, at in (("op4_quality", 1), ("op10_toxicity", 2)):
        held = [r for r in QUERIES[name](spark, path).collect() if r["held_out"]]
        y = np.array([labels[r["doc_id"]][at] for r in held])
        s = np.array([r["score"] for r in held])
        assert len(held) > 100 and ((s >= 0) & (s <= 1)).all() and _area(s, y) > 0.95
        assert np.mean([r["predicted"] == v for r, v in zip(held, y, strict=True)]) > 0.9


def test_token_buckets_follow_words():
    bucket, doc = quality.tokens(["ab$$ ab", None, "$$ é"])
    assert doc.tolist() == [0, 0, 0, 2, 2] and bucket[0] == bucket[2] and bucket[1] == bucket[3] != bucket[0]
    hashes, counts = toxicity.word_hashes(["Ab ab", None])
    assert counts.tolist() == [2, 0] and hashes[0][0] == hashes[0][1]
