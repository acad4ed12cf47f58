import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlink.llm import huffman, tokens


@given(st.lists(st.integers(0, 400), min_size=1, max_size=3000), st.integers(9, 20))
@settings(max_examples=40, deadline=None)
def test_huffman_round_trip(ids, limit):
    ids = np.array(ids)
    lengths = huffman.code_lengths(np.bincount(ids), limit)
    assert lengths.max() <= limit and (0.5 ** lengths[lengths > 0].astype(float)).sum() <= 1
    bits, points = huffman.encode(ids, lengths, huffman.canonical_codes(lengths))
    assert (huffman.decode(bits, points, len(ids), huffman.decode_table(lengths)) == ids).all()


def test_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34])  # a plain code would need 8 bits
    assert (huffman.code_lengths(counts, 20) * counts).sum() == 220
    assert huffman.code_lengths(counts, 4).max() == 4


def test_empty_and_single():
    assert huffman.code_lengths(np.zeros(0, np.int64)).size == 0
    lengths = huffman.code_lengths(np.array([0, 7]))
    assert lengths.tolist() == [0, 1]
    bits, points = huffman.encode(np.ones(7, np.int64), lengths, huffman.canonical_codes(lengths))
    assert huffman.decode(bits, points, 7, huffman.decode_table(lengths)).tolist() == [1] * 7


@given(st.lists(st.text(st.sampled_from("ab 'sé1\n\t\x1c 　.<|endoftext|>x\0")), max_size=4))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_ids_of_whole_texts(texts):
    pytest.importorskip("tokenizers")
    encode = tokens.Encoder(tokens.default_tokenizer(), "<u2")
    assert encode.by_piece
    assert encode([*texts, "it's <|endoftext|> so"]) == encode._encode([*texts, "it's <|endoftext|> so"])


def test_archive_of_odd_rows(spark):
    rows = [(5, "one two"), (None, "x"), (3, None), (3, ""), (9, "word " * 5000), (5, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", tokens.F.lit("a clash"))
    written, _ = tokens.encode_documents(docs)
    got = sorted(tokens.read_archive(written).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 3, 3, 5, 5, 9]
    encode = tokens.Encoder(tokens.default_tokenizer(), "<u4")
    texts = ["x", "", "", "one two", "one two", "word " * 5000]
    assert [bytes(r["ids"]) for r in got] == [e + b"\2\0\0\0" for e in encode(texts)]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]).tolist()
    empty, _ = tokens.encode_documents(docs.limit(0))
    assert tokens.digest(tokens.read_archive(empty)).count() == 0
