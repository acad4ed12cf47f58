"""Recordings of a recognizer, replayed through two versions of the rules; models that fail or answer wrongly."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from spanlink.functions import text
from spanlink.operators import recognize
from spanlink.operators.checks import ContractError
from spanlink.operators.digests import content_hash
from spanlink.schemas import LINE, LINKS
from spanlink.sources import recorded
from spanlink.sources.kept import kept


def write(folder, rows, name="a.json.gz"):
    (folder / name).write_bytes(gzip.compress(json.dumps(rows).encode()))
    return str(folder)


def line(k, content, entities, title="b", **more):
    return {"source": "s", "title": title, "index": k, "content": content, "context": "c", "normalized": text._normal(content)[0], "ner": {"entities": entities}} | more


def entity(start, end, label="citation", parts=()):
    return {"label": label, "range": [start, end], "parts": [{"label": x, "range": [a, b]} for x, a, b in parts]}


def engine(prefix, least=0):
    def run(lines, mentions):
        c = mentions.join(lines, LINE).where(F.col("start") >= least)
        ref = F.concat(F.lit(prefix), F.expr("substring(content, start + 1, end - start)"))
        at = {x: text.utf16_offset(F.col("content"), F.col(x)) for x in ("start", "end")}
        cols = {"line_index_base": F.lit(0), **at, "target_ref": ref, "source_path": F.lit(None), "source_hash": content_hash(F.col("content")), "context_ref": F.lit(None), "relative_direction": F.lit(None)}
        return c.select(*LINE, *[v.cast(LINKS[n].dataType).alias(n) for n, v in cols.items()])

    return run


def test_replay(spark, tmp_path):
    rows = [line(0, "<b>ab</b>  cd x", [entity(1, 3, parts=[("NAMED", 0, 1)]), entity(4, 6)]), line(1, "none", []), line(2, "a person here", [entity(2, 8, "person")])]
    write(tmp_path, rows)
    path = write(tmp_path, [line(0, "😀 ef", [entity(2, 4)], "other")], "b.json.gz")
    found = recorded.read_recorded(spark, path, tasks=3)
    assert found.count() == 4 and recorded.violations(found).collect() == []
    spans = {(r["title"], r["line_index"], r["start"], r["end"]) for r in recorded.mentions(found).collect()}
    assert spans == {("b", 0, 3, 5), ("b", 0, 11, 13), ("other", 0, 2, 4)}
    assert [[tuple(p) for p in r["parts"]] for r in recorded.mentions(found).where("end = 5").collect()] == [[("NAMED", 0, 1)]]
    assert recorded.mentions(found, ("person",)).count() == 1
    out = recorded.replay(found, engine("A "), engine("A ", 5), keep=kept)
    assert {r["kind"]: r["n"] for r in out.counts.collect()} == {"unchanged": 1, "removed": 2, "added": 0, "changed": 0}
    out = recorded.replay(found, engine("A "), engine("B "), keep=kept)
    assert {r["kind"]: r["n"] for r in out.counts.collect()} == {"unchanged": 0, "removed": 0, "added": 0, "changed": 3}
    segments = spark.createDataFrame([("A ab",), ("A cd",), ("A ef",)], "ref string")
    with pytest.raises(ContractError, match="after: targets"):
        recorded.replay(found, engine("A "), engine("B "), segments, keep=kept)


def test_broken_recordings(spark, tmp_path):
    rows = [line(0, "ab", [entity(0, 3)]), line(1, "ab", [], normalized="x"), line(2, "ab", []), line(2, "ab", []), line(3, "ab", None)]
    found = recorded.read_recorded(spark, write(tmp_path, rows))
    assert sorted(tuple(r)[2:] for r in recorded.violations(found).collect()) == [(0, "range"), (1, "normalized"), (2, "twice"), (3, "row")]
    with pytest.raises(ContractError, match="recording"):
        recorded.replay(found, engine("A "), engine("A "))


def test_places_of_normal_texts():
    for s in ("", "ab", "<i>a</i> <b> b</b>\t\tc־ד", "x<sup>1</sup> <i class=\"footnote\">n</i> y", "אָ֑ב"):
        flat, places = text._normal(s)
        assert len(flat) == len(places) and places == sorted(places) and all(s[p] == c or c == " " for c, p in zip(flat, places, strict=True))


def test_models_are_asked_again_but_not_believed():
    calls = []

    def lost(texts):
        calls.append(len(texts))
        if len(calls) < 3:
            raise ConnectionError("gone")
        return [[entity(0, 1)] for _ in texts]

    assert recognize._asked(lost, ["ab"], 3) == [[entity(0, 1)]] and calls == [1, 1, 1]
    with pytest.raises(TimeoutError):
        recognize._asked(lambda texts: (_ for _ in ()).throw(TimeoutError()), ["a"], 1)
    for answer in ([], [[entity(0, 3)]], [[entity(1, 1)]], [[{"range": [0, 1]}]], [[entity(0, 1, "x" * 201)]], [[entity(0, 1, parts=[("p", 0, 2)])]], [[{"label": "a", "range": [0, True]}]], [[entity(0, 1) | {"more": 1}]]):
        with pytest.raises(ValueError):
            recognize._asked(lambda texts, answer=answer: answer, ["ab"], 3)


def test_counts_of_a_store(spark):
    from spanlink.sources.artifacts import link_counts

    df = spark.createDataFrame([("s", "a"), ("s", "a"), ("t", "b")], "source string, title string")
    assert sorted(map(tuple, link_counts(df).collect()), key=str) == [("s", "a", 2), ("t", "b", 1), (None, None, 3)]
