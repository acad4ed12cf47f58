"""What the driver doesn't hold."""

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from spanlink.llm import permutation, tokens, toxicity


def test_the_model_is_fitted_in_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"bad{k % 2} word{k % 7}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    want = toxicity.fit(docs, labels)

    fit_ftrl = toxicity.fit_ftrl

    def in_task(*args):
        assert TaskContext.get() is not None
        return fit_ftrl(*args)

    monkeypatch.setattr(toxicity, "fit_ftrl", in_task)
    got = toxicity.fit(docs, labels)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist() and got[2] == want[2]


def test_nothing_labelled_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.without_toxic(docs, model).count() == 1 and model[2] == 0


def test_the_tokenizer_is_asked_once(monkeypatch):
    name = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    first = tokens.packing(name)
    monkeypatch.setattr("tokenizers.Tokenizer", None)
    assert tokens.packing(name) == first


def test_queries_copied_for_blocks_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK", 64)
    monkeypatch.setattr(permutation, "GROUPS", 5)
    x = np.random.default_rng(3).normal(size=(600, 4))
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, vector array<double>").cache()
    pivots = permutation.first_vectors(rows, 8)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    index = permutation.build(rows, pivots, 8, 600).cache()
    found = permutation.search(index, rows.where("vec_id < 7").select(F.col("vec_id").alias("query"), "vector"), pivots, 8, 600, 3)
    got = {}
    for r in found.collect():
        got.setdefault(r["query"], []).append((-r["score"], r["vec_id"]))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    # blocks here are small enough to be reranked whole
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert sorted(got) == list(range(7)) and all(len(v) == 30 for v in got.values())
    assert all([v for _, v in sorted(got[q])[:3]] == np.argsort(-unit @ unit[q])[:3].tolist() for q in got)


def test_pivots_are_the_vectors_of_lowest_hash(spark):
    rows = spark.range(50).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("vector"))
    want = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id").limit(9).collect()]
    assert permutation.first_vectors(rows, 9).tolist() == want
