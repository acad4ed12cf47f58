"""Ids beyond 2^53 beside null ones, in one partition: none may change on its way through an operator."""

import pytest

from spanlink.llm import decontaminate, quality, simhash, substrings, tokens, toxicity, warc

A, B = 2**53 + 1, 2**53 + 3
WORDS = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(A, WORDS), (None, WORDS), (B, WORDS + " "), (None, "other words")]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=lambda x: (x is None, x))


def test_scores(spark, docs):
    labels = spark.createDataFrame([(A, 1, 1), (B, 0, 0)], "doc_id long, quality int, toxic int")
    features = quality.pooled(docs, quality.word_vectors(docs))
    assert ids(quality.score(features, quality.fit(features, labels))) == [A, B, None, None]
    assert ids(toxicity.score(docs, toxicity.fit(docs, labels))) == [A, B, None, None]


def test_components(docs):
    found = simhash.near_duplicates(docs).where("component_id is not null and fp <> 0").collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found) == [(0, A), (A, A), (B, A)]


def test_repeats(docs):
    assert ids(substrings.remove_repeats(docs)) == [A, B, None, None]


def test_starts_follow_the_order_of_ids(docs):
    written, _ = tokens.encode_documents(docs)
    rows = tokens.read_archive(written).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, A, B]
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(4)]


def test_revisits(spark, tmp_path):
    long = "x" * 1200
    pages = spark.createDataFrame([(A, "u", long), (B, "u", long), (None, "u", "y"), (A + 10, "u", "z")], "page_id long, url string, html string").coalesce(1)
    found = warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}"), payloads=True).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found) == [(0, "response", None), (A, "revisit", B), (B, "response", None), (A + 10, "response", None)]
    assert {r["html"] for r in found} == {long, "y", "z", None}


def test_decontamination_keeps_clean_rows_of_the_same_id(spark):
    dirty = "clean start " + WORDS
    rows = [(7, dirty, "a"), (7, "an unlike clean text of this very id and more", "b"), (None, dirty, "c"), (None, "a clean text without any id at all here", "d"), (B, "x", "e"), (A, WORDS, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string").coalesce(1)
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame([(1, WORDS)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["h"] for r in kept.collect()) == ["b", "d", "e"]
    assert ids(kept) == [7, B, None]
