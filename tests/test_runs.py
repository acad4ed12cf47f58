"""Snapshots, artifacts, incremental runs and streams, on small books made here."""

import hashlib

import pytest
from pyspark.sql import functions as F

from spanlink.operators import audit, checks, delta, digests, recognize, sequence
from spanlink.plans import incremental
from spanlink.plans.queries import resolve_numbers
from spanlink.schemas import LINES, LINKS
from spanlink.sources import artifacts, snapshot
from spanlink.streaming import follow


def book(spark, rows):
    """Rows (title, line, content[, context])."""
    return spark.createDataFrame([("s", t, i, c, *(rest or (t,))) for t, i, c, *rest in rows], LINES)


def pairs(current, prior):
    return {(r["old_index"], r["new_index"]) for r in delta.reuse(delta.identified(current), delta.identified(prior)).collect()}


def test_digests_by_definition(spark):
    lines = book(spark, [("a", 1, "y😀", "c"), ("a", 0, None, "c")])
    (r,) = digests.book_digests(lines).collect()
    assert r["hash"] == hashlib.sha1("0\0\0c\0" "1\0y😀\0c\0".encode()).hexdigest()[:16]
    got = lines.orderBy("line_index").select(digests.line_fingerprint("content", "context")).collect()
    assert [x[0] for x in got] == [hashlib.blake2b(t.encode(), digest_size=16).hexdigest() for t in ("\0c", "y😀\0c")]


def test_moved_lines_and_other_context(spark):
    old = book(spark, [("b", 0, "a"), ("b", 1, "b"), ("b", 2, "c")])
    new = book(spark, [("b", 0, "a"), ("b", 1, "NEW"), ("b", 2, "c"), ("b", 3, "b")])
    assert pairs(new, old) == {(0, 0), (2, 2), (1, 3)}
    again = delta.recompute(delta.identified(new), delta.reuse(delta.identified(new), delta.identified(old)))
    assert [(r["start"], r["end"]) for r in delta.ranges(again).collect()] == [(1, 2)]
    assert pairs(book(spark, [("b", 0, "a", "other")]), old) == set()


def test_equal_lines_pair_in_order(spark):
    old = book(spark, [("b", k, "x") for k in (1, 2, 5)])
    new = book(spark, [("b", k, "x") for k in (2, 7, 8, 9)])
    assert pairs(new, old) == {(2, 2), (1, 7), (5, 8)}


def test_incremental_run_equals_full_run(spark):
    old = book(spark, [("a", 0, "see 1234"), ("a", 1, "x 777 y 888"), ("gone", 0, "999"), ("same", 0, "555 😀 444")])
    new = book(spark, [("a", 0, "x 777 y 888"), ("a", 1, "new 321"), ("same", 0, "555 😀 444"), ("fresh", 3, "111")])
    links = resolve_numbers(old)
    plan, out = incremental.run(new, old, links, resolve_numbers)
    incremental.check(new, plan, out)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, resolve_numbers(new).collect()), key=str)
    assert {r["title"] for r in plan.changed.collect()} == {"a", "fresh"} and [r["title"] for r in plan.removed.collect()] == ["gone"]
    assert {(r["title"], r["line_index"]) for r in plan.compute.collect()} == {("a", 1), ("fresh", 3)}
    assert {(r["start"], r["end"]) for r in out.where("title = 'same'").collect()} == {(0, 3), (7, 10)}
    again, _ = incremental.run(new, new, out, resolve_numbers)
    assert again.changed.count() == again.removed.count() == again.compute.count() == 0


def test_another_engine_computes_everything_and_still_removes(spark):
    old, new = book(spark, [("a", 0, "1234"), ("gone", 0, "x")]), book(spark, [("a", 0, "1234")])
    plan, out = incremental.run(new, old, resolve_numbers(old), resolve_numbers, same_engine=False)
    assert plan.compute.count() == 1 and [r["title"] for r in plan.removed.collect()] == ["gone"] and out.count() == 1


def test_books_that_lean_on_context_are_computed_whole(spark):
    old = book(spark, [("a", 0, "1234"), ("a", 1, "שם 555"), ("a", 2, "שמים")])
    new = book(spark, [("a", 0, "1234"), ("a", 1, "שם 555"), ("a", 2, "changed")])
    plan = incremental.plan(new, old)
    assert plan.pairs.count() == 0 and plan.compute.count() == 3


def test_renames_chain(spark):
    links = spark.createDataFrame([("Genesis 1:1",), ("Genesis Rabbah 1:1",)], "target_ref string")
    got = incremental.renamed(links, [("Genesis", "B"), ("B", "C")])
    assert [r[0] for r in got.collect()] == ["C 1:1", "Genesis Rabbah 1:1"]


def test_checks_stop_a_bad_run(spark):
    lines = book(spark, [("a", 0, "short")])
    bad = spark.createDataFrame([("s", "a", 0, 0, 2, 9, "x", None, None, None, None)], LINKS)
    with pytest.raises(checks.ContractError, match="end"):
        checks.require(checks.place_violations(bad, lines), "places")
    mentions = spark.createDataFrame([("s", "a", 0, "citation", 0, 5, [("x", 0, 6)])], "source string, title string, line_index int, label string, start int, end int, parts array<struct<label:string,start:int,end:int>>")
    assert checks.entity_violations(mentions).count() == 1
    kinds = {r["kind"]: r["n"] for r in audit.replay_counts(audit.replay_diff(bad, bad.limit(0))).collect()}
    assert kinds == {"unchanged": 0, "added": 0, "removed": 1, "changed": 0}


def test_snapshot_round_trip_and_refusals(spark, tmp_path):
    lines = book(spark, [("a", 1, "x"), ("a", 0, None), ("b", 0, "y")])
    snapshot.write_snapshot(lines, f"{tmp_path}/one")
    back = snapshot.read_snapshot(spark, f"{tmp_path}/one")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, lines.collect()), key=str)
    assert [r["line_index"] for r in snapshot.book(back, "s", "a").collect()] == [0, 1]
    snapshot.write_snapshot(book(spark, [("a", 0, "x"), ("a", 0, "y")]), f"{tmp_path}/two")
    with pytest.raises(checks.ContractError, match="twice"):
        snapshot.read_snapshot(spark, f"{tmp_path}/two")
    spark.createDataFrame([("schema_version", "1")], "key string, value string").write.mode("overwrite").parquet(f"{tmp_path}/one/meta")
    with pytest.raises(checks.ContractError, match="version"):
        snapshot.read_snapshot(spark, f"{tmp_path}/one")
    with pytest.raises(checks.ContractError, match="absent"):
        snapshot.requested(lines, spark.createDataFrame([("s", "zz")], "source string, title string"))


def test_artifacts_round_trip_and_strictness(spark, tmp_path):
    links = spark.createDataFrame([("s", "a/b", 0, 0, 0, 3, "Ref 1", None, "0123456789abcdef", None, None), ("s", "a/b", 1, 0, 2, 3, "ר", None, None, "c", "above")], LINKS)
    artifacts.write_store(links, f"{tmp_path}/store")
    assert artifacts.read_store(spark, f"{tmp_path}/store").count() == 2
    files = artifacts.as_files(links).orderBy("line_index").collect()
    assert files[0]["path"] == "artifacts/s/a_b.jsonl"
    assert files[0]["line"] == '{"book_key":{"canonical_he_title":"a/b","source_name":"s"},"end":3,"line_index":0,"line_index_base":0,"source_hash":"0123456789abcdef","start":0,"target_ref":"Ref 1"}'
    good = tmp_path / "good" / "artifacts" / "s"
    good.mkdir(parents=True)
    (good / "a_b.jsonl").write_text("\n".join([files[0]["line"], "", files[1]["line"]]) + "\n")
    assert sorted(map(tuple, artifacts.read_lines(spark, f"{tmp_path}/good").collect()), key=str) == sorted(map(tuple, links.collect()), key=str)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.jsonl").write_text(files[0]["line"])
    with pytest.raises(checks.ContractError, match="other books"):
        artifacts.read_lines(spark, f"{tmp_path}/other")
    for k, line in enumerate([files[0]["line"].replace('"end"', '"fin"'), files[0]["line"].replace('"end":3', '"end":0'), "{"]):
        bad = tmp_path / f"bad{k}"
        bad.mkdir()
        (bad / "x.jsonl").write_text(line)
        with pytest.raises(checks.ContractError):
            artifacts.read_lines(spark, str(bad))


def test_model_recognizer(spark):
    def load():
        return lambda texts: [[{"label": "citation", "range": [0, len(t)], "parts": [{"label": "NAMED", "range": [0, 1]}]}] if t else [] for t in texts]

    rows = recognize.by_model(book(spark, [("a", 0, "xy"), ("a", 1, None)]), load).collect()
    assert [(r["line_index"], r["start"], r["end"], r["parts"][0]["label"]) for r in rows] == [(0, 0, 2, "NAMED")]


def test_stream_gives_what_the_table_gives(spark, tmp_path):
    rows = [("s", f"t{k % 3}", k // 3, 0, [[], ["a"], ["a", "b"], ["b"]][k * 7 % 4], k % 2 == 0) for k in range(40)]
    schema = "source string, title string, line_index int, pos int, candidates array<string>, same_as_above boolean"
    table = spark.createDataFrame(rows, schema)
    want = {tuple(r)[:4]: r["ref"] for r in sequence.resolve_in_order(table).collect()}
    history = {tuple(r)[:4]: list(r["history"]) for r in sequence.reference_history(sequence.resolve_in_order(table), ["source", "title"], ["line_index", "pos"], "ref").select("source", "title", "line_index", "pos", "history").collect()}
    for part in range(2):
        table.where(F.col("line_index").between(7 * part, 7 * part + 6)).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = follow.resolve_stream(stream).writeStream.format("memory").queryName("resolved").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("resolved").collect()
    assert {tuple(r)[:4]: r["ref"] for r in got} == want
    assert {tuple(r)[:4]: list(r["history"]) for r in got} == history
    seen = []
    lines = spark.readStream.schema(schema).json(f"{tmp_path}/in")
    follow.follow_snapshots(spark, lines, lambda df, v: seen.append((v, df.count())), f"{tmp_path}/ck2").awaitTermination(120)
    assert sum(n for _, n in seen) == 40
