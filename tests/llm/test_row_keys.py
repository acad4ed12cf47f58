"""Rows without ids and with repeated ids."""

import corpus_pipeline as p
from pyspark.sql import functions as F
from spanlink.llm import mixing, permutation, simhash, tokens

A, B, C, D = (" ".join(f"{c}{k}" for k in range(40)) for c in "abcd")


def _rows(df):
    return sorted(((r["doc_id"], r["text"][:2], r["source"]) for r in df.collect()), key=str)


def test_no_text_is_lost_for_its_id(spark):
    docs = [(None, A, "s"), (None, B, "s"), (None, B, "s"), (None, B, "t"), (1, C, "s"), (None, C, "s"), (2, A, "s"), (2, D, "s"), (2, D, "s"), (None, None, "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").fillna({"text": ""})
    got = _rows(simhash.one_of_each(df))
    assert [r[:2] for r in got] == sorted([(1, "c0"), (2, "a0"), (2, "d0"), (None, "b0"), (None, "")], key=str)
    assert got == _rows(simhash.one_of_each(df.repartition(3, "source", "text")))
    assert got == _rows(p.drop_near_duplicates(spark, df, ""))


def test_texts_without_ids_are_linked(spark):
    prints = spark.createDataFrame([(None, 0), (None, 1), (5, 1 << 40 | 1), (None, 255 << 8)], "doc_id long, fp long")
    assert {r["fp"]: r["component_id"] for r in simhash.near_duplicates(None, prints=prints).collect()} == {0: 5, 1: 5, 1 << 40 | 1: 5, 255 << 8: None}


def test_vectors_of_several_lengths_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (50, [1.0, 0.0, 0.0]), (51, [1.0, 0.2, 0.0]), (51, [0.0, 0.0, 1.0]), (100, [2.0])]
    found = [sorted(map(tuple, permutation.nearest(spark.createDataFrame(order, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect())) for order in (rows, rows[::-1])]
    assert found[0] == found[1]
    assert [(q, r, v) for q, r, v, _ in found[0]] == [(0, 1, 1), (0, 2, 2), (50, 1, 51)]


def test_rows_without_ids_are_mixed_by_their_texts(spark):
    docs = [(None, "a b c " * (k % 5 + 1) + str(k), "x") for k in range(400)] + [(7, f"d {k}", "y") for k in range(400)]
    rows = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string"), max_repeat=3).collect()
    for source in "xy":
        own = [r for r in rows if r["source"] == source]
        taken, target = sum(r["taken"] for r in own), own[0]["target"]
        assert abs(taken - target) < 0.05 * target
    assert len({r["copies"] for r in rows if r["source"] == "x"}) == 2  # y is taken whole, three times


def test_least_id_and_rows_of_one_id_in_archives(spark):
    docs = [(-(1 << 63), "one"), (None, "two"), (None, "three"), (5, "four"), (5, "five")]
    written, _ = tokens.encode_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    back = tokens.digest(tokens.read_archive(written)).orderBy("start").collect()
    assert [r["doc_id"] for r in back] == [None, None, -(1 << 63), 5, 5]
    assert [r["start"] for r in back] == [sum(x["n_tokens"] for x in back[:k]) for k in range(5)]
