"""Contracts between steps that need files or several runs, and when a look at new lines is enough."""

import hashlib

import pytest

from spanlink.operators import delta, handoff
from spanlink.plans import baseline, incremental
from spanlink.schemas import LINE


def book(spark, contents, title="t"):
    return spark.createDataFrame([("s", title, k, c, "x") for k, c in enumerate(contents)], "source string, title string, line_index int, content string, context string")


def probe(spark, old, new, flags, prior_context=True, seams=(2, 4, 6)):
    prior, current = book(spark, old), book(spark, new)
    ids, was = delta.identified(current), delta.identified(prior)
    known = spark.createDataFrame([("s", "t", k, f) for k, f in enumerate(flags)], "source string, title string, line_index int, entity boolean")
    at = lambda n: spark.createDataFrame([("s", "t", k) for k in seams if k < n], "source string, title string, line_index int")
    counts = delta.seam_counts(prior.select(*LINE).join(known, LINE), at(len(old))).first()["counts"]
    books = spark.createDataFrame([("s", "t", prior_context, counts)], "source string, title string, book_context boolean, ibid_seams array<long>")
    return baseline.probes(ids, was, delta.reuse(ids, was), books, known, at(len(new))).count() == 1


def test_when_a_probe_is_enough(spark):
    """Seven lines in batches of two; lines 2, 3, 5, 6 hold entities."""
    old, flags = list("abcdefg"), [False, False, True, True, False, True, True]
    assert probe(spark, old, list("aBcdefg"), flags)  # a line without entity is edited
    assert not probe(spark, old, list("abCdefg"), flags)  # one with an entity goes
    assert not probe(spark, old, list("abcdfg"), flags)  # the seams move
    assert not probe(spark, old, list("abdcefg"), flags)  # entities change places
    assert not probe(spark, old, list("aBcdefg"), flags, prior_context=False)
    assert not probe(spark, old, list("aBcdefg"), [None, *flags[1:]])
    assert probe(spark, [*old, "h"], old, [*flags, False])  # a trailing line without entity goes
    assert not probe(spark, old, list("tuvwxyz"), [False] * 7)  # nothing is reused


def test_probed_books_in_the_plan(spark):
    old, new = book(spark, ["ראה שם", "b", "c"]), book(spark, ["ראה שם", "B", "c"])
    whole = incremental.plan(new, old)
    assert whole.pairs.count() == 0 and whole.compute.count() == 3 and whole.probed.count() == 0
    flags = spark.createDataFrame([("s", "t", k, k == 0) for k in range(3)], "source string, title string, line_index int, entity boolean")
    books = spark.createDataFrame([("s", "t", True, [])], "source string, title string, book_context boolean, ibid_seams array<long>")
    known = incremental.Known(books, flags, old.select(*LINE).limit(0))
    p = incremental.plan(new, old, known=known)
    assert p.probed.count() == 1 and p.pairs.count() == 2 and [r["line_index"] for r in p.compute.collect()] == [1]
    plan = baseline.planned_books(p.changed, p.compute, p.probed, new)
    row = plan.first()
    assert [tuple(r) for r in row["ranges"]] == [(1, 2)] and [tuple(r) for r in row["context_ranges"]] == [(0, 3)]
    assert baseline.plan_lines(plan).first()["line"] == '{"canonical_he_title":"t","context_ranges":[[0,3]],"ner_ranges":[[1,2]],"source_name":"s"}'
    found = spark.createDataFrame([("s", "t", 1, True)], "source string, title string, line_index int, entity boolean")
    books = handoff.escalated(plan, found)
    assert books.count() == 1 and handoff.escalated(plan, found.withColumn("entity", ~found.entity)).count() == 0
    assert incremental.covered_whole(p, new, books).compute.count() == 3
    links = new.where("line_index = 1")
    assert handoff.inert_violations(plan, books, links).count() == 0 and handoff.inert_violations(plan, books.limit(0), links).count() == 1


def test_bundle_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name, text in (("a/one", "1"), ("two", "22"), ("three", "333")):
        (tmp_path / name).write_text(text)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    files = handoff.read_bundle(spark, str(tmp_path))
    listed = [("a/one", 1, sha("1")), ("two", 3, sha("22")), ("gone", 1, sha("x")), ("../up", 1, sha("x"))]
    got = handoff.bundle_violations(spark.createDataFrame(listed, "path string, size long, sha256 string"), files)
    assert sorted(map(tuple, got.collect())) == [("../up", "path"), ("gone", "missing"), ("three", "unlisted"), ("two", "size")]


def test_plan_identity(spark):
    h = "0" * 64
    plan = spark.createDataFrame([(h, "1" * 64, None, "e")], "request_id string, snapshot_sha256 string, changelog_sha256 string, engine string")
    assert handoff.plan_violations(plan, {"request_id": h, "engine": "e"}).count() == 0
    bad = plan.selectExpr("'zz' AS request_id", "snapshot_sha256", "'q' AS changelog_sha256", "engine")
    assert sorted(r[0] for r in handoff.plan_violations(bad, {"request_id": h, "engine": "f"}).collect()) == ["changelog_sha256 form", "engine", "request_id", "request_id form"]


def test_baselines(spark, tmp_path):
    entry = '{"source_name":"s","canonical_he_title":"t","hash":"0123456789abcdef"}'
    (tmp_path / "v1.json").write_text(f"[{entry}]")
    (tmp_path / "v2.json").write_text(f'{{"engine_fingerprint":"e","books":[{entry}]}}')
    assert [tuple(baseline.read_book_baseline(spark, f"{tmp_path}/v{v}.json").first()) for v in (1, 2)] == [("s", "t", "0123456789abcdef", None), ("s", "t", "0123456789abcdef", "e")]
    lines = book(spark, ["ראה שם", "b", None])
    flags = spark.createDataFrame([("s", "t", k, k == 0) for k in range(3)], "source string, title string, line_index int, entity boolean")
    seams = spark.createDataFrame([("s", "t", 2)], "source string, title string, line_index int")
    files = spark.createDataFrame([("s", "t", "f" * 64)], "source string, title string, sha256 string")
    books = baseline.book_baseline(lines, flags, seams, files, "שם")
    row = books.first()
    assert row["book_context"] and row["ibid_seams"] == [1] and row["artifact_sha256"] == "f" * 64
    kept = baseline.line_baseline(lines, flags)
    assert {r["line_index"]: r["fp"] for r in kept.collect()}[2] == hashlib.blake2b(b"\0x", digest_size=16).hexdigest()
    versions = f"{tmp_path}/versions"
    baseline.write_baseline(f"{tmp_path}/b", "one", baseline.identity(spark, "a" * 64, "e", 1), books, kept, versions)
    assert baseline.in_use(spark, versions) == "one"
    found = baseline.read_baseline(spark, f"{tmp_path}/b", versions, "a" * 64, "e")
    assert found is not None and found[0].count() == 1 and found[1].count() == 3
    assert baseline.read_baseline(spark, f"{tmp_path}/b", versions, "b" * 64, "e") is None
    with pytest.raises(Exception, match="already exists"):
        baseline.write_baseline(f"{tmp_path}/b", "one", baseline.identity(spark, "a" * 64, "e", 1), books, kept, versions)
    meta = baseline.run_meta(spark, "a" * 64, 1, "e", None, None).first()["json"]
    assert meta == '{"engine":{"ambiguity_policy":"drop","bavli_convention":false,"fingerprint":"e"},"generated_at":null,"schema_version":3,"snapshot":{"book_count":1,"sha256":"' + "a" * 64 + '"},"source_export":{"export_tag":null}}'
