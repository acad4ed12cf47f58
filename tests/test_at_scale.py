"""What keeps work in proportion to the input: rows dealt to all tasks, phrases instead of frequent pairs, tables read by column."""

import random

import pytest
from pyspark.sql import functions as F

from spanlink.functions import attribution
from spanlink.operators import quotes, resolve
from spanlink.plans import citation_queries
from spanlink.sources.kept import kept
from tests.test_recover import SCHEMA, catalogs, cite

SMALL = "/root/testdata/sf0.001"


def test_rows_of_one_file_go_to_all_tasks(spark):
    got = citation_queries.numbered(spark, SMALL)
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # and filters on what is spelled from the joined letters stay behind that
    plan = got.where(F.concat("s", F.lit("x"), "p_name").rlike("a"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("RLIKE") < plan.index("Exchange") or "BroadcastHashJoin" in plan.split("Exchange")[0]


def test_long_stretches_by_long_phrases(spark):
    words = lambda s: F.split(F.lit(s), " ")
    corpus = spark.range(1).select(F.lit("w").alias("work"), F.lit(0).alias("order"), F.lit("w 1").alias("ref"), words("a b c d e f a b x a b c d").alias("words"))
    asked = spark.range(2).select("id", F.when(F.col("id") == 0, words("z a b c d e a b q a b c d")).otherwise(words("a b c")).alias("words"))
    of = lambda width: sorted(map(tuple, quotes.stretches(asked, quotes.postings(corpus, width), ["id"], width).where("length >= 4").collect()))
    assert of(4) == of(2) and len(of(4)) == 4
    met = asked.where("id = 1").select("id", "words")
    assert quotes.stretches(met, quotes.postings(corpus, 4), ["id"], 4).count() == 0


def test_repeated_citations_are_read_once():
    attribution._remembered.cache_clear()
    text = 'רש"י פירש בפרק קמא (דף ב.)'
    got = attribution._governing.func(*[__import__("pandas").Series(v) for v in ([text] * 5 + [None], [19] * 6, [len(text)] * 6)])
    assert attribution._remembered.cache_info().misses == 1 and attribution._remembered.cache_info().hits == 4
    assert list(got["commentary"])[:5] == [attribution.commentary_of(text, 19, len(text))] * 5 and got["writer"][5] is None


def test_kept_tables_are_read_by_column(spark):
    df = kept(spark.range(3).select("id", F.array(F.struct(F.lit(1).alias("x"), F.lit(None).cast("string").alias("y"))).alias("parts")))
    assert all(f.endswith(".parquet") for f in df.inputFiles()) and df.inputFiles()
    assert [r["id"] for r in df.orderBy("id").collect()] == [0, 1, 2]


def test_rows_of_the_fold_by_columns(spark):
    import pyarrow as pa

    option = {"kind": "candidate", "offered": None, "ref": "r", "start": 1, "end": None}
    rows = [{"labels": ["a", None], "outcomes": [option] * k, "rebuilt": k > 1, "verse": [1, 2], "address": None if k else "2a", "n": k or None} for k in range(4)]
    batch = pa.RecordBatch.from_pylist(rows)
    for some in (batch, batch.slice(1, 2), batch.slice(4)):
        assert list(resolve._records(some)) == some.to_pylist()


def _alike(spark, several):
    """Books of few kinds of lines, each often; several: some lines hold two citations, so that an own leaf depends on the one before it."""
    there, own = [("IBID", "שם")], ("Gittin", "גיטין", 21, 21)
    kinds = [
        cite(0, "כתובות יג:", [("NAMED", "כתובות")], ["Ketubot 13b"]),
        cite(0, "שם יד.", there),
        cite(0, "שם", there, ["Gittin 9a"]),
        cite(0, "גיטין ט.", [("NAMED", "גיטין")], ["Gittin 9a"]),
        cite(0, "תהלים יח לא, בראשית א ב", [("NAMED", "תהלים"), ("NUMBERED", "יח"), ("NUMBERED", "לא"), ("NAMED", "בראשית"), ("NUMBERED", "א"), ("NUMBERED", "ב")]),
        cite(0, "לקמן יב:", [("RELATIVE", "לקמן")], own=own),
        cite(0, "(דף יב:)", [], ["Gittin 12b"], own=own),
    ]
    lines = [[k] for k in kinds]
    if several:
        both = "כתובות יג: (דף יב:)"
        lines += [[cite(0, both, [("NAMED", "כתובות")], ["Ketubot 13b"], anchor="כתובות יג:"), cite(0, both, [], ["Gittin 12b"], own=own, anchor="(דף יב:)", pos=1)]]
    books = random.Random(5)
    rows = [("s", str(b), k, *c[3:], None, None) for b in range(40) for k in range(5) for c in books.choice(lines)]
    return spark.createDataFrame(rows, SCHEMA + ", context string, place long"), len([c for x in lines for c in x])


@pytest.mark.parametrize("several", [False, True])
def test_lines_of_a_kind_are_resolved_once(spark, monkeypatch, several):
    works, segments, chapters = catalogs(spark)
    segments = segments.withColumn("place", F.lit(5).cast("long"))
    more = [(f"{t} {leaf}", t) for t, leaf in (("Ketubot", "13b"), ("Ketubot", "14a"), ("Gittin", "9a"), ("Gittin", "12b"))]
    segments = segments.unionByName(spark.createDataFrame([(r, t, True, 5) for r, t in more], "ref string, title string, has_text boolean, place long"))
    df, n = _alike(spark, several)
    df = kept(df)
    seen, options = [], resolve.options
    monkeypatch.setattr(resolve, "options", lambda rows, *more: seen.append(rows.where("not rebuilt").count()) or options(rows, *more))
    columns = [*resolve.KEY, "sub", "kind", "ref", "start", "end", "direction", "shown"]
    found = resolve.resolve if several else lambda *a, **k: resolve.resolved(*a, **k).select(*columns)
    run = lambda: sorted(map(str, found(df, segments, works, chapters, keep=kept).collect()))
    by_kind = run()
    assert seen == [n - 1]  # the list of verses is rebuilt
    monkeypatch.setattr(resolve, "KINDS", 0)
    each = run()
    assert seen[1] > 100 and by_kind == each and len(each) > 50
    assert several or {"continued", "given", "own", "candidate"} <= {r.split("kind='")[1].split("'")[0] for r in each}


def test_a_title_that_only_a_mend_gives_is_no_home_by_kind(spark, monkeypatch):
    """Homes without books would let "there" follow a title that no option of its book names: such tables are resolved line by line."""
    works, segments, chapters = catalogs(spark)
    df, _ = _alike(spark, False)
    checked, stepped = resolve.checked, []
    monkeypatch.setattr(resolve, "checked", lambda *a: checked(*a).withColumn("ref", F.replace("ref", F.lit("Gittin 9a"), F.lit("Ketubot 2a"))))
    monkeypatch.setattr(resolve, "folded", lambda rows: stepped.append(1) or rows)
    segments = segments.withColumn("place", F.lit(5).cast("long")).unionByName(spark.createDataFrame([("Gittin 9a", "Gittin", True, 5)], "ref string, title string, has_text boolean, place long"))
    resolve.resolved(kept(df), segments, works, chapters, keep=kept)
    assert stepped == [1]
