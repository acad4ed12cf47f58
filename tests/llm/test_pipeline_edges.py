"""The pipeline from end to end on empty tables, on null and repeated ids, and on clashing columns."""

import corpus_pipeline as p

from spanlink.llm.common import materialize
from tests.llm.test_edges import write

WORDS = [f"w{k}" for k in range(60)]


def test_empty_tables(spark, tmp_path):
    assert p.run(spark, write(spark, tmp_path, {})).collect() == []


def test_null_and_repeated_ids(spark, tmp_path):
    text = lambda k: " ".join(WORDS[k * 12 : k * 12 + 12] + [f"x{k}y{j}" for j in range(30)])
    passage = "a benchmark passage of more than a dozen words that nobody would write by chance"
    big = 2**53 + 1
    docs = [(big, text(0)), (None, text(1)), (None, text(2)), (big + 2, text(3)), (7, text(4)), (7, text(4) + " tail"), (7, passage), (None, passage), (None, None), (8, ""), (None, text(0))]
    rows = [(d, t, "en", "s", None, 0.5, 1, 2, "r") for d, t in docs]
    tables = {"documents": rows, "benchmark": [(1, passage), (None, None)], "labels": [(7, 1, 0), (None, 1, 1)]}  # no known row is toxic
    path = write(spark, tmp_path, tables)
    kept = p.table(spark, path, "documents")
    sizes = []
    for _, stage in p.STAGES[:3]:
        kept = materialize(stage(spark, kept, path))
        sizes.append(kept.count())
        assert kept.columns == p.table(spark, path, "documents").columns
    assert sizes[0] == 11
    # one each of the equal texts, of the near copies, of the empty ones and of the passage; then the passage goes, and no clean text with its ids
    left = {(r["doc_id"], (r["text"] or "")[:8]) for r in kept.collect()}
    assert sizes[1:] == [7, 6] and left == {(big, text(0)[:8]), (None, text(1)[:8]), (None, text(2)[:8]), (big + 2, text(3)[:8]), (7, text(4)[:8]), (8, "")}
    out = p.run(spark, path).orderBy("start").collect()
    assert {r["doc_id"] for r in out} >= {big, big + 2, 7, None}
    assert [r["start"] for r in out] == [sum(x["n_tokens"] for x in out[:k]) for k in range(len(out))]
