"""Queries of the contracts between runs and steps: tables with planted breaks, whole, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanlink.operators import audit, catalog, checks, delta, digests, handoff
from spanlink.plans import baseline
from spanlink.plans.registry import query
from spanlink.plans.stand_ins import CTE, DIGESTS, PAIRS, current_lines, prior_lines, read
from spanlink.schemas import BOOK, LINE


def _pairs(spark, d):
    cur, pri = delta.identified(current_lines(spark, d)), delta.identified(prior_lines(spark, d))
    return cur, pri, delta.reuse(cur, pri)


@query(f"""WITH {PAIRS}, p AS (SELECT source, title, new_index AS line_index FROM pairs UNION ALL SELECT source, title, new_index FROM pairs WHERE new_index % 7 = 3),
c AS (SELECT * FROM p UNION ALL SELECT * FROM again WHERE line_index % 5 <> 1), k AS (SELECT source, title, line_index, count(*) AS times FROM c GROUP BY ALL)
SELECT source, title, line_index, coalesce(times, 0) AS times FROM (SELECT source, title, line_index FROM cur) LEFT JOIN k USING (source, title, line_index) WHERE times IS DISTINCT FROM 1""")
def line_partition_violations(spark, d):
    """Lines covered twice or not at all, as planted."""
    cur, _, pairs = _pairs(spark, d)
    again = delta.recompute(cur, pairs).where("line_index % 5 <> 1")
    return delta.partition_violations(cur, pairs.unionAll(pairs.where("new_index % 7 = 3")), again)


@query(f"""WITH {PAIRS}, g AS (SELECT source, title, sum("end" - "start")::BIGINT AS total, count(*)::INTEGER AS ranges FROM rng GROUP BY ALL),
b AS (SELECT source, title FROM cur GROUP BY ALL) SELECT source, title, row_number() OVER (ORDER BY source COLLATE "binary", title COLLATE "binary") - 1 AS pos, coalesce(total, 0) AS total, coalesce(ranges, 0) AS ranges FROM b LEFT JOIN g USING (source, title)""")
def planned_books(spark, d):
    """The plan in its order: books, the lines to recognize and their ranges."""
    cur, _, pairs = _pairs(spark, d)
    lines = current_lines(spark, d)
    books = baseline.planned_books(digests.book_identities(lines), delta.recompute(cur, pairs), lines.select(*BOOK).limit(0), lines)
    return books.select(*BOOK, F.col("pos").cast("long").alias("pos"), handoff.range_total(F.col("ranges")).alias("total"), F.size("ranges").alias("ranges"))


@query("""WITH b AS (SELECT o_orderkey // 2 AS t, o_orderkey AS k FROM orders), r AS (SELECT t::VARCHAR AS title, k % 9 - 1 AS a, k % 9 + k % 4 AS b, CASE WHEN k % 3 = 0 THEN 0 END AS x, CASE WHEN k % 3 = 0 THEN k % 20 END AS y, count(*) OVER (PARTITION BY t) AS n, CASE WHEN k % 37 = 0 THEN 'zz' ELSE substr(md5(k::VARCHAR), 1, 16) END AS h FROM b)
SELECT 'o' AS source, title, problem FROM (SELECT title, unnest([CASE WHEN h = 'zz' THEN 'hash' END, CASE WHEN a < 0 OR b <= a THEN 'ranges' END, CASE WHEN x IS NOT NULL AND NOT (x <= a AND b <= y AND y - x > b - a) THEN 'context_ranges' END, CASE WHEN n > 1 THEN 'twice' END]) AS problem FROM r) WHERE problem IS NOT NULL""")
def planned_book_violations(spark, d):
    k = F.col("o_orderkey")
    span = lambda a, b: F.array(F.struct(a.cast("int").alias("start"), b.cast("int").alias("end")))
    h = F.when(k % 37 == 0, "zz").otherwise(F.substring(F.md5(k.cast("string")), 1, 16))
    books = read(spark, d, "orders").select(F.lit("o").alias("source"), F.floor(k / 2).cast("string").alias("title"), h.alias("hash"), span(k % 9 - 1, k % 9 + k % 4).alias("ranges"), F.when(k % 3 == 0, span(F.lit(0), k % 20)).alias("context_ranges"))
    return handoff.planned_book_violations(books)


@query("""WITH c AS (SELECT o_orderkey AS k, sha1('o' || chr(0) || o_orderkey) AS id FROM orders), v AS (SELECT k, unnest([CASE WHEN k % 50 = 0 THEN 'plan' END, CASE WHEN k % 50 <> 0 AND k % 7 = 0 THEN 'hash' END, CASE WHEN k % 11 = 0 THEN 'claim' END, CASE WHEN k % 13 = 0 THEN 'twice' END, CASE WHEN k % 3 = 1 AND k % 17 = 0 THEN 'artifact' END]) AS problem, unnest(range(1, 6)) AS _ FROM c)
SELECT 'o' AS source, k::VARCHAR AS title, problem FROM v, range(CASE WHEN k % 13 = 0 THEN 2 ELSE 1 END) WHERE problem IS NOT NULL""")
def completed_violations(spark, d):
    """Completed books against the plan: unknown ones, other hashes, names of other books, repeated ones, other files."""
    k, orders = F.col("o_orderkey"), read(spark, d, "orders")
    base = orders.select("o_orderkey", F.lit("o").alias("source"), k.cast("string").alias("title"), F.substring(F.md5(k.cast("string")), 1, 16).alias("hash"))
    own = handoff.claim_id(F.col("source"), F.col("title"))
    file = F.when(k % 3 == 1, F.concat(own, F.when(k % 17 == 0, ".json").otherwise(".jsonl")))
    done = base.select("o_orderkey", *BOOK, F.when(k % 7 == 0, "0").otherwise(F.col("hash")).alias("hash"), F.when(k % 11 == 0, "x").otherwise(own).alias("claim_id"), file.alias("artifact"))
    done = done.unionAll(done.where(k % 13 == 0)).drop("o_orderkey")
    return handoff.completed_violations(done, base.where(k % 50 != 0).drop("o_orderkey"))


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_partkey::VARCHAR AS t FROM part), b AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_partkey::VARCHAR AS t FROM part WHERE p_partkey <> 150)
SELECT pos, a.t AS bundled, b.t AS planned FROM a FULL JOIN b USING (pos) WHERE a.t IS DISTINCT FROM b.t""")
def order_violations(spark, d):
    """Where an ordered list of books and one that lacks a book differ: everywhere from there on."""
    p = read(spark, d, "part").select(F.lit("p").alias("source"), F.col("p_partkey").cast("string").alias("title"), (F.col("p_partkey") - F.lit(1)).alias("k"))
    first = p.agg(F.min("k").alias("m"))
    a = p.join(F.broadcast(first), F.lit(True)).select(*BOOK, (F.col("k") - F.col("m")).alias("pos"))
    b = a.where("title <> '150'").withColumn("pos", F.when(F.col("title").cast("long") > 150, F.col("pos") - 1).otherwise(F.col("pos")))
    return handoff.order_violations(a, b).select("pos", F.col("bundled.title").alias("bundled"), F.col("planned.title").alias("planned"))


_BATCH = "line_index - line_index % 100 AS batch_start, line_index % 100 AS pos"


@query(f"""WITH {CTE}, e AS (SELECT source, title, {_BATCH}, line_index, sha256(content) AS digest FROM cur),
s AS (SELECT source, title, batch_start, pos, CASE WHEN pos % 29 = 7 THEN line_index + 1 ELSE line_index END AS got, CASE WHEN pos % 31 = 3 THEN sha256('') ELSE digest END AS sent FROM e WHERE pos % 23 <> 5 UNION ALL SELECT source, title, 100000, 0, 0, '' FROM e WHERE line_index = 1)
SELECT source, title, batch_start::INTEGER AS batch_start, pos::INTEGER AS pos, CASE WHEN sent IS NULL THEN 'missing' WHEN digest IS NULL THEN 'unplanned' WHEN got <> line_index THEN 'line' WHEN sent <> digest THEN 'digest' END AS problem FROM s FULL JOIN e USING (source, title, batch_start, pos) WHERE problem IS NOT NULL""")
def batch_violations(spark, d):
    """Recognized lines against the snapshot's, place by place: missing, not asked for, other lines, other texts."""
    i = F.col("line_index")
    e = current_lines(spark, d).select(*BOOK, (i - i % 100).cast("int").alias("batch_start"), (i % 100).cast("int").alias("pos"), "line_index", F.col("content").alias("text"))
    sha = F.when(F.col("pos") % 31 == 3, F.sha2(F.lit(""), 256)).otherwise(F.sha2("text", 256))
    sent = e.where("pos % 23 <> 5").select(*BOOK, "batch_start", "pos", (i + (F.col("pos") % 29 == 7).cast("int")).alias("line_index"), sha.alias("normalized_sha256"))
    more = e.where("line_index = 1").select(*BOOK, F.lit(100000).alias("batch_start"), F.lit(0).alias("pos"), F.lit(0).alias("line_index"), F.lit("").alias("normalized_sha256"))
    return handoff.batch_violations(sent.unionByName(more), e)


@query(f"""WITH {CTE}, p AS (SELECT source, title, line_index, content, length(content) > 20 AS eligible, length(content) > 20 AND line_index % 9 <> 4 AS sent FROM cur)
SELECT source, title, line_index, CASE WHEN sent THEN regexp_matches(content, '[0-9]{{2}}') WHEN NOT eligible THEN false END AS entity FROM p""")
def entity_flags(spark, d):
    """Whether recognition found anything on a line; not known where it should have been sent and wasn't."""
    p = current_lines(spark, d).withColumn("eligible", F.length("content") > 20)
    batches = p.where("eligible and line_index % 9 <> 4").select(*LINE, F.regexp_extract_all("content", F.lit("([0-9]{2})")).alias("entities"))
    return handoff.entity_flags(batches, p.select(*LINE, "eligible"))


@query("SELECT 'c' AS source, c_custkey::VARCHAR AS title FROM customer WHERE c_custkey % 4 = 1 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 < 3)")
def unplanned_partials(spark, d):
    partial = read(spark, d, "customer").where("c_custkey % 4 = 1").select(F.lit("c").alias("source"), F.col("c_custkey").cast("string").alias("title"))
    planned = read(spark, d, "orders").where("o_orderkey % 10 < 3").select(F.lit("c").alias("source"), F.col("o_custkey").cast("string").alias("title")).distinct()
    return handoff.unplanned(partial, planned)


@query(f"""WITH {PAIRS}, n AS (SELECT source, title, count(*) AS n FROM cur GROUP BY ALL), g AS (SELECT source, title, sum("end" - "start") AS total FROM rng GROUP BY ALL), u AS (SELECT source, title, count(*) AS reused FROM pairs GROUP BY ALL),
c AS (SELECT source, title, bool_or(contains(content, 'der ')) AS book_context FROM cur GROUP BY ALL),
m AS (SELECT n.source, n.title, unnest([CASE WHEN coalesce(total, 0) <> n THEN 'whole' END, CASE WHEN coalesce(reused, 0) > 0 THEN 'reuse' END]) AS problem FROM n JOIN c USING (source, title) LEFT JOIN g USING (source, title) LEFT JOIN u USING (source, title) WHERE book_context)
SELECT source, title, problem FROM m WHERE problem IS NOT NULL""")
def stateful_violations(spark, d):
    """Books that lean on their context, planned as if they didn't."""
    cur, _, pairs = _pairs(spark, d)
    lines = current_lines(spark, d)
    books = baseline.planned_books(digests.book_identities(lines), delta.recompute(cur, pairs), lines.select(*BOOK).limit(0), lines)
    plan = books.join(delta.needs_context(lines, "der "), BOOK)
    return handoff.stateful_violations(plan, lines.groupBy(*BOOK).agg(F.count("*").alias("n_lines")), pairs)


@query(f"""WITH {PAIRS}, u AS (SELECT DISTINCT source, title FROM pairs), k AS (SELECT *, title::BIGINT % 6 AS r FROM u)
SELECT source, title, CASE WHEN r = 0 THEN 'baseline' WHEN r = 1 THEN 'unexpected' ELSE 'digest' END AS problem FROM k WHERE r IN (0, 1, 2, 3)""")
def prior_artifact_violations(spark, d):
    """Books with reused lines whose stored file isn't that of the baseline: no baseline, a file too many, another one, none."""
    _, _, pairs = _pairs(spark, d)
    r = F.substring_index("title", " ", -1).cast("long") % 6
    books = prior_lines(spark, d).select(*BOOK).distinct()
    known = books.where(r != 0).select(*BOOK, F.when(~r.isin(1, 5), F.sha2("title", 256)).alias("artifact_sha256"))
    stored = books.where(~r.isin(3, 5)).select(*BOOK, F.when(r == 2, "x").otherwise(F.sha2("title", 256)).alias("sha256"))
    return handoff.prior_artifact_violations(known, stored, pairs)


@query(f"""WITH {PAIRS} SELECT p.source, p.title, p.new_index AS line_index, CASE WHEN p.old_index % 5 = 2 THEN 'hash' ELSE 'context' END AS problem FROM pairs p JOIN cur c ON c.source = p.source AND c.title = p.title AND c.line_index = p.new_index
WHERE p.old_index % 5 = 2 OR c.context <> 'en'""")
def reuse_violations(spark, d):
    """Records of reused lines that don't fit the line at its new number."""
    _, _, pairs = _pairs(spark, d)
    h = F.when(F.col("line_index") % 5 == 2, "0").otherwise(digests.content_hash(F.col("content")))
    links = prior_lines(spark, d).select(*LINE, h.alias("source_hash"), F.lit("en").alias("context_ref"))
    return handoff.reuse_violations(links, pairs, current_lines(spark, d))


@query("""WITH w AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'ci-' || o_orderkey || CASE WHEN o_orderkey % 23 = 0 THEN 'ü' ELSE '' END END AS src, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey % 29 END AS ci, CASE WHEN o_orderkey % 4 < 2 AND o_orderkey % 31 <> 0 THEN 1 END AS ca, CASE WHEN o_orderkey % 19 = 0 THEN 'now' ELSE '2024-01-02T03:04:05Z' END AS made FROM orders),
v AS (SELECT k, unnest([CASE WHEN k % 17 = 0 THEN 'lines_reused' END, CASE WHEN k % 13 = 0 THEN 'sum' END, CASE WHEN src LIKE '%ü' THEN 'checkpoint_source' END, CASE WHEN (ci IS NULL) <> (ca IS NULL) OR least(ci, ca) < 1 THEN 'checkpoint coordinates' END, CASE WHEN ci IS NOT NULL AND src IS NULL THEN 'coordinates without source' END, CASE WHEN made = 'now' THEN 'generated_at' END, CASE WHEN k % 41 = 0 THEN 'run coordinates' END]) AS problem FROM w)
SELECT k AS run_id, problem FROM v WHERE problem IS NOT NULL""")
def work_violations(spark, d):
    """Accounts of runs whose counters, sums or coordinates don't hold."""
    k = F.col("o_orderkey")
    ok = {c: F.lit(1) for c in handoff.COUNTERS} | {"total": F.when(k % 13 == 0, 4).otherwise(3), "lines_reused": F.when(k % 17 == 0, -1).otherwise(k)}
    source = F.when(k % 6 != 0, F.concat(F.lit("ci-"), k.cast("string"), F.when(k % 23 == 0, "ü").otherwise("")))
    work = read(spark, d, "orders").select(
        *[v.alias(c) for c, v in ok.items()],
        source.alias("checkpoint_source"),
        F.when(k % 4 < 2, k % 29).alias("checkpoint_run_id"),
        F.when((k % 4 < 2) & (k % 31 != 0), 1).alias("checkpoint_attempt"),
        F.when(k % 19 == 0, "now").otherwise("2024-01-02T03:04:05Z").alias("generated_at"),
        k.alias("run_id"),
        F.when(k % 41 != 0, 1).alias("attempt"),
    )
    return handoff.work_violations(work)


@query("SELECT p_partkey, p_partkey % 5 = 0 AS canonical FROM part")
def fingerprint_canonical(spark, d):
    k = F.col("p_partkey")
    a, b, tail = F.concat(F.lit("a="), "p_brand"), F.concat(F.lit("b="), F.col("p_size").cast("string")), F.lit("policy=drop;bavli=0")
    forms = [F.concat_ws(";", a, b, tail), F.concat_ws(";", b, a, tail), F.concat_ws(";", a, a, tail), F.concat_ws(";", a, b, F.lit("policy=keep;bavli=0")), F.concat_ws(";", a, F.col("p_brand"), tail)]
    return read(spark, d, "part").select("p_partkey", handoff.is_canonical_fingerprint(F.element_at(F.array(*forms), (k % 5 + 1).cast("int"))).alias("canonical"))


@query("SELECT DISTINCT o_orderkey AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def empty_artifacts(spark, d):
    """Files without a record."""
    files = read(spark, d, "orders").select(F.col("o_orderkey").alias("path"))
    return handoff.empty_artifacts(files, read(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("path")))


@query("SELECT 'artifacts/s' || (p_partkey % 7) || '/' || (p_partkey // 2) || '.jsonl' AS path, CASE WHEN count(*) <> 1 THEN 'books' ELSE 'path' END AS problem FROM part GROUP BY p_partkey % 7, p_partkey // 2 HAVING count(*) <> 1 OR bool_or(p_partkey % 3 = 0)")
def artifact_file_violations(spark, d):
    """Files with several books, or with a book whose file is another."""
    k = F.col("p_partkey")
    t = F.floor(k / 2).cast("string")
    source = F.concat(F.lit("s"), (k % 7).cast("string"))
    return checks.file_violations(read(spark, d, "part").select(F.concat(F.lit("artifacts/"), source, F.lit("/"), t, F.lit(".jsonl")).alias("path"), source.alias("source"), F.when(k % 3 == 0, F.concat(F.lit("other "), k.cast("string"))).otherwise(t).alias("title")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)")
def target_violations(spark, d):
    """Records whose target isn't a known reference."""
    links = read(spark, d, "lineitem").select(F.lit("l").alias("source"), F.col("l_orderkey").cast("string").alias("title"), F.col("l_linenumber").alias("line_index"), F.lit(0).alias("start"), F.lit(1).alias("end"), F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("target_ref"))
    known = read(spark, d, "part").where("p_size <= 25").select(F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("ref"))
    return checks.target_violations(links, known).select(F.col("title").cast("long").alias("l_orderkey"), F.col("line_index").alias("l_linenumber"))


@query("WITH p AS (SELECT p_partkey FROM part WHERE p_size <= 25) SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT * FROM p) OR l_partkey + l_linenumber IN (SELECT * FROM p)")
def leaf_target_exists(spark, d):
    links = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit("part").alias("title"), F.col("l_partkey").alias("section"), (F.col("l_partkey") + F.col("l_linenumber")).alias("to_section"))
    segments = read(spark, d, "part").where("p_size <= 25").select(F.lit("part").alias("title"), F.col("p_partkey").alias("section"))
    return catalog.existing_leaves(links, segments).select("l_orderkey", "l_linenumber")


@query("""WITH r AS (SELECT c_nationkey AS "from", (c_custkey % 400)::VARCHAR AS "to", min(c_custkey) AS review FROM customer GROUP BY ALL HAVING count(*) = 1)
SELECT "from", "to", review FROM r JOIN nation ON "from" = n_nationkey WHERE n_regionkey <> 2""")
def migration_lookup(spark, d):
    """Changed targets that one review speaks for."""
    c = read(spark, d, "customer").select(F.col("c_nationkey").alias("from"), (F.col("c_custkey") % 400).cast("string").alias("to"), F.col("c_custkey").alias("review"))
    pairs = c.select("from", "to").distinct().join(read(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("from")), "from", "left_semi")
    return audit.migrations_for(pairs, c)


@query(f"""WITH {DIGESTS}, e AS (SELECT source, title, hash FROM hc) SELECT '{{"canonical_he_title":"' || title || '","hash":"' || hash || '","source_name":"' || source || '"}}' AS line FROM e""")
def baseline_entries(spark, d):
    """The books' entries of a baseline file."""
    return baseline.book_entries(digests.book_digests(current_lines(spark, d)))
