"""One query per operator over the general tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.functions import numerals, text
from spanlink.operators import audit, batching, catalog, checks, delta, digests, quotes, recognize, resolve, sequence
from spanlink.plans import incremental
from spanlink.plans.registry import ORACLE_SQL, QUERIES, query
from spanlink.plans.stand_ins import CTE, DIGESTS, PAIRS, current_lines, prior_lines, read
from spanlink.schemas import BOOK, LINE, LINKS
from spanlink.sources import artifacts
from spanlink.sources.kept import kept

# digests and the plan of books


@query(f"WITH {CTE} SELECT source, title, line_index, substr(sha1(content), 1, 16) AS content_hash FROM cur")
def content_hash(spark, d):
    return current_lines(spark, d).select(*LINE, digests.content_hash(F.col("content")).alias("content_hash"))


@query(f"WITH {DIGESTS} SELECT * FROM hc")
def book_digest(spark, d):
    return digests.book_digests(current_lines(spark, d))


@query(f"WITH {DIGESTS} SELECT hc.source, hc.title, hc.hash, hp.hash AS prior_hash FROM hc LEFT JOIN hp USING (source, title) WHERE hc.hash IS DISTINCT FROM hp.hash")
def plan_changed(spark, d):
    return digests.changed_books(digests.book_digests(current_lines(spark, d)), digests.book_digests(prior_lines(spark, d)))


@query(f"WITH {DIGESTS} SELECT source, title FROM hp ANTI JOIN hc USING (source, title)")
def plan_removed(spark, d):
    return digests.removed_books(digests.book_digests(current_lines(spark, d)), digests.book_digests(prior_lines(spark, d)))


@query(f"WITH {DIGESTS} SELECT count(*) FILTER (hp.hash IS NULL) AS n_new, count(*) FILTER (hc.hash <> hp.hash) AS n_edited, count(*) FILTER (hc.hash = hp.hash) AS n_same, count(*) FILTER (hc.hash IS NULL) AS n_removed FROM hc FULL JOIN hp USING (source, title)")
def plan_summary(spark, d):
    return digests.plan_summary(digests.book_digests(current_lines(spark, d)), digests.book_digests(prior_lines(spark, d)))


@query(f"WITH {CTE} SELECT DISTINCT source, title FROM cur")
def book_keys(spark, d):
    return current_lines(spark, d).select(*BOOK).distinct()


# the plan of lines


def _ids(spark, d):
    return delta.identified(current_lines(spark, d)), delta.identified(prior_lines(spark, d))


@query(f"WITH {PAIRS} SELECT * FROM ic")
def line_fp(spark, d):
    return delta.identified(current_lines(spark, d))


@query(f"WITH {PAIRS} SELECT * FROM same")
def reuse_same_index(spark, d):
    return delta.same_index(*_ids(spark, d))


@query(f"WITH {PAIRS} SELECT * FROM mv")
def reuse_moved(spark, d):
    return delta.moved(*_ids(spark, d))


@query(f"WITH {PAIRS} SELECT source, title, line_index FROM again")
def lines_to_compute(spark, d):
    cur, pri = _ids(spark, d)
    return delta.recompute(cur, delta.reuse(cur, pri))



@query(f"WITH {PAIRS} SELECT * FROM rng")
def ner_ranges(spark, d):
    return delta.ranges(lines_to_compute(spark, d))


@query(f'WITH {PAIRS} SELECT cur.source, cur.title, cur.line_index FROM cur JOIN rng ON cur.source = rng.source AND cur.title = rng.title AND cur.line_index >= rng."start" AND cur.line_index < rng."end"')
def range_filter(spark, d):
    return delta.in_ranges(current_lines(spark, d).select(*LINE), ner_ranges(spark, d))


@query(f"""WITH {PAIRS}, e AS (SELECT source, title, line_index FROM pri WHERE length(content) % 2 = 0),
o AS (SELECT p.source, p.title, old_index, lag(old_index) OVER (PARTITION BY p.source, p.title ORDER BY new_index) AS b FROM pairs p JOIN e ON p.source = e.source AND p.title = e.title AND p.old_index = e.line_index)
SELECT source, title, bool_and(coalesce(old_index > b, true)) AS kept FROM o GROUP BY ALL""")
def order_preserved(spark, d):
    entities = prior_lines(spark, d).where(F.length("content") % 2 == 0).select(*LINE)
    return delta.order_kept(delta.reuse(*_ids(spark, d)), entities)


@query(f"WITH {CTE} SELECT source, title, bool_or(regexp_matches(content, '(^|[^a-z])(der|the)($|[^a-z])')) AS book_context FROM cur GROUP BY ALL")
def book_context(spark, d):
    return delta.needs_context(current_lines(spark, d), "(?<![a-z])(der|the)(?![a-z])")


@query("""WITH r AS (SELECT c_custkey % 50 AS title, c_custkey % 97 AS "start", c_custkey % 97 + c_custkey % 5 AS "end" FROM customer),
b AS (SELECT *, lag("end") OVER (PARTITION BY title ORDER BY "start", "end") AS b FROM r)
SELECT 'c' AS source, title::VARCHAR AS title, "start", "end" FROM b WHERE "end" <= "start" OR b > "start" """)
def range_overlap_violations(spark, d):
    c = read(spark, d, "customer")
    start = F.col("c_custkey") % 97
    return delta.range_violations(c.select(F.lit("c").alias("source"), (F.col("c_custkey") % 50).cast("string").alias("title"), start.alias("start"), (start + F.col("c_custkey") % 5).alias("end")))


# eligibility and batches


@query(f"WITH {CTE} SELECT source, title, line_index FROM cur WHERE length(trim(content)) > 1 AND NOT regexp_matches(content, '(?i)^[\\s]*<h[1-6](\\s|>)') AND length(regexp_replace(regexp_replace(content, '<[^>]*>', '', 'g'), '[^a-z]', '', 'g')) >= 20")
def eligible_lines(spark, d):
    return current_lines(spark, d).where(text.eligible(F.col("content"), 20, "[^a-z]")).select(*LINE)


@query(f"WITH {CTE} SELECT source, title, count(*) AS n_lines FROM cur GROUP BY ALL")
def largest_first(spark, d):
    return batching.largest_first(current_lines(spark, d))


_BATCHES = f"""WITH RECURSIVE {CTE},
o AS (SELECT source, title, line_index, length(content) AS chars, row_number() OVER (PARTITION BY source, title ORDER BY line_index) - 1 AS place FROM cur),
b AS (SELECT source, title, line_index, place, chars, 1 AS n, chars AS held, place AS batch_start FROM o WHERE place = 0
      UNION ALL
      SELECT o.source, o.title, o.line_index, o.place, o.chars,
             CASE WHEN b.n < 8 AND b.held + o.chars <= 900 THEN b.n + 1 ELSE 1 END,
             CASE WHEN b.n < 8 AND b.held + o.chars <= 900 THEN b.held + o.chars ELSE o.chars END,
             CASE WHEN b.n < 8 AND b.held + o.chars <= 900 THEN b.batch_start ELSE o.place END
      FROM b JOIN o ON o.source = b.source AND o.title = b.title AND o.place = b.place + 1),
seams AS (SELECT source, title, line_index FROM (SELECT source, title, batch_start, min(line_index) AS line_index, row_number() OVER (PARTITION BY source, title ORDER BY batch_start) AS k FROM b GROUP BY source, title, batch_start) WHERE k > 1)"""


def _batches(spark, d):
    return batching.transport_batches(current_lines(spark, d), 8, 900)


@query(f"{_BATCHES} SELECT source, title, line_index, batch_start::INTEGER AS batch_start FROM b")
def transport_batches(spark, d):
    return _batches(spark, d)


@query(f"{_BATCHES} SELECT * FROM seams")
def transport_seams(spark, d):
    return batching.seams(_batches(spark, d))


@query(f"""{_BATCHES}, e AS (SELECT source, title, line_index, CASE WHEN length(content) % 101 = 0 THEN NULL ELSE length(content) % 2 = 0 END AS entity FROM cur),
r AS (SELECT *, coalesce(sum(entity::INTEGER) OVER (PARTITION BY source, title ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n FROM e)
SELECT r.source, r.title, CASE WHEN count(*) FILTER (entity IS NULL) = 0 THEN coalesce(list_sort(list(DISTINCT n) FILTER (s.line_index IS NOT NULL AND n > 0)), []) END AS counts
FROM r LEFT JOIN seams s ON r.source = s.source AND r.title = s.title AND r.line_index = s.line_index GROUP BY ALL""")
def seam_counts(spark, d):
    size = F.length("content")
    lines = current_lines(spark, d).select(*LINE, F.when(size % 101 != 0, size % 2 == 0).alias("entity"))
    return delta.seam_counts(lines, batching.seams(_batches(spark, d)))


@query(f"""{_BATCHES} SELECT b.source, b.title, b.batch_start::INTEGER AS batch_start, count(*) AS lines, sum(len(regexp_extract_all(content, '[^\\s\\x{{85}}\\x{{A0}}]+')))::BIGINT AS words, sum(length(content))::BIGINT AS chars
FROM b JOIN cur USING (source, title, line_index) GROUP BY ALL""")
def batch_sizes(spark, d):
    return batching.batch_sizes(current_lines(spark, d), _batches(spark, d))


# text

@query("""SELECT page_id, regexp_replace(html, '<("[^"]*"|''[^'']*''|[^''">])*>', '', 'g') AS visible FROM pages""")
def visible_text(spark, d):
    return read(spark, d, "pages").select("page_id", text.visible(F.col("html")).alias("visible"))


@query(f"WITH {CTE}, c AS (SELECT source, title, line_index, list_filter(string_split_regex(trim(regexp_extract(substr(content, 1, 60), '([^.:;()\\[\\]]*)$', 1)), '\\s+'), lambda x: x <> '') AS w FROM cur) SELECT source, title, line_index, w[-5:] AS clause FROM c")
def clause_before(spark, d):
    return current_lines(spark, d).select(*LINE, text.clause_before(F.col("content"), F.lit(60), 5).alias("clause"))


@query(f"WITH {CTE} SELECT source, title, line_index, substr(content, 4, 7) AS anchor FROM cur WHERE length(content) >= 10")
def anchor_slice(spark, d):
    return current_lines(spark, d).where(F.length("content") >= 10).select(*LINE, text.utf16_slice(F.col("content"), F.lit(3), F.lit(10)).alias("anchor"))


@query("""SELECT p_partkey, 'artifacts/' || trim(regexp_replace(p_brand || '/' || p_size, '[/\\\\:*?"<>|\\x00-\\x1f]', '_', 'g')) || '/' || trim(regexp_replace(p_type || '?', '[/\\\\:*?"<>|\\x00-\\x1f]', '_', 'g')) || '.jsonl' AS path FROM part""")
def artifact_path(spark, d):
    p = read(spark, d, "part")
    return p.select("p_partkey", text.artifact_path(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")), F.concat("p_type", F.lit("?"))).alias("path"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 2 * p_size - 1 ELSE 2 * p_size END AS section, p_size AS daf, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'b' END AS side FROM part")
def amud_ordinal(spark, d):
    p = read(spark, d, "part").withColumn("section", numerals.amud(F.col("p_size"), F.when(F.col("p_partkey") % 2 == 0, "a").otherwise("b")))
    return p.select("p_partkey", "section", numerals.daf_of(F.col("section")).alias("daf"), numerals.side_of(F.col("section")).alias("side"))


@query("""WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text || ' above' WHEN turn % 3 = 1 THEN text || ' below' ELSE text END AS text FROM conversations)
SELECT conv_id, turn, CASE WHEN regexp_matches(text, 'above|supra') AND NOT regexp_matches(text, 'below|infra') THEN 'above' WHEN regexp_matches(text, 'below|infra') AND NOT regexp_matches(text, 'above|supra') THEN 'below' END AS side FROM t""")
def relative_side(spark, d):
    c = read(spark, d, "conversations")
    t = F.concat("text", F.when(F.col("turn") % 3 == 0, " above").when(F.col("turn") % 3 == 1, " below").otherwise(""))
    return c.select("conv_id", "turn", numerals.relative_side(t).alias("side"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE CASE WHEN l_returnflag = 'R' THEN l_partkey % 100 < l_suppkey % 100 WHEN l_returnflag = 'A' THEN l_partkey % 100 > l_suppkey % 100 ELSE true END")
def stated_side(spark, d):
    direction = F.when(F.col("l_returnflag") == "R", "above").when(F.col("l_returnflag") == "A", "below")
    return read(spark, d, "lineitem").where(numerals.on_stated_side(direction, F.col("l_suppkey") % 100, F.col("l_partkey") % 100)).select("l_orderkey", "l_linenumber")


# catalogs


def _links(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit("part").alias("title"), F.col("l_partkey").alias("section"), (F.col("l_partkey") + F.col("l_linenumber")).alias("to_section"))


def _segments(spark, d):
    return read(spark, d, "part").where("p_size <= 25").select(F.lit("part").alias("title"), F.col("p_partkey").alias("section"))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS section FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)")
def target_exists(spark, d):
    return catalog.existing_targets(_links(spark, d), _segments(spark, d)).select("l_orderkey", "l_linenumber", "section")


@query("WITH p AS (SELECT p_partkey FROM part WHERE p_size <= 25) SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (FROM p) AND l_partkey + l_linenumber IN (FROM p)")
def range_target_exists(spark, d):
    return catalog.existing_ranges(_links(spark, d), _segments(spark, d)).select("l_orderkey", "l_linenumber")


@query("""WITH s AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_partkey % 1000 AS "start", l_partkey % 1000 + 10 * l_linenumber AS "end" FROM lineitem),
i AS (SELECT s_suppkey AS k, 150 * n AS i_start, 150 * n + 40 AS i_end FROM supplier, range(0, 8) r(n))
SELECT l_orderkey, l_linenumber, s.k, i_start::BIGINT AS i_start FROM s JOIN i ON s.k = i.k AND "start" <= i_end AND i_start <= "end" """)
def chapter_overlap(spark, d):
    spans = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", (F.col("l_partkey") % 1000).alias("start"), (F.col("l_partkey") % 1000 + 10 * F.col("l_linenumber")).alias("end"))
    chapters = read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("n"))
    chapters = chapters.select("k", (F.col("n") * 150).cast("long").alias("start"), (F.col("n") * 150 + 40).cast("long").alias("end"))
    return catalog.overlapping(spans, chapters, ["k"], 100).select("l_orderkey", "l_linenumber", "k", "i_start")


@query("SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1")
def drop_ambiguous(spark, d):
    return catalog.unambiguous(read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag")


@query("""WITH n AS (SELECT p_partkey::VARCHAR AS title, unnest([p_brand, p_type]) AS name FROM part), a AS (SELECT title, unnest([name, 'in ' || name]) AS alias FROM n)
SELECT alias, list_sort(list(DISTINCT title)) AS titles FROM a GROUP BY alias""")
def alias_works(spark, d):
    works = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("title"), F.array("p_brand", "p_type").alias("aliases"))
    return catalog.alias_index(works, ["in "])


_HEADS = "SELECT doc_id, source, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')[1:6] AS w FROM documents"


@query(f"""WITH h AS ({_HEADS}), a AS (SELECT array_to_string(w[1:(1 + doc_id % 3)::INTEGER], ' ') AS alias, list_sort(list(DISTINCT source)) AS titles FROM h WHERE doc_id % 4 = 0 AND len(w) > 0 GROUP BY 1),
m AS (SELECT doc_id, n, alias, titles FROM (SELECT doc_id, n, array_to_string(w[1:n], ' ') AS alias FROM h, range(1, 7) r(n) WHERE n <= len(w)) JOIN a USING (alias))
SELECT doc_id, arg_max(alias, n) AS alias, arg_max(titles, n) AS titles FROM m GROUP BY doc_id""")
def longest_alias(spark, d):
    heads = read(spark, d, "documents").select("doc_id", "source", F.slice(F.array_remove(F.split(F.lower("text"), r"\s+"), ""), 1, 6).alias("words"))
    some = heads.where((F.col("doc_id") % 4 == 0) & (F.size("words") > 0))
    aliases = some.select(F.array_join(F.slice("words", F.lit(1), (1 + F.col("doc_id") % 3).cast("int")), " ").alias("alias"), "source")
    aliases = aliases.groupBy("alias").agg(F.array_sort(F.collect_set("source")).alias("titles"))
    return catalog.longest_alias(heads, aliases, "doc_id")


@query("""WITH q AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM benchmark),
e AS (SELECT phrase, min(item_id) AS target FROM (SELECT item_id, array_to_string(w[k:k+3], ' ') AS phrase FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS k FROM b)) GROUP BY phrase HAVING count(*) = 1),
f AS (SELECT doc_id, array_to_string(w[k:k+3], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS k FROM q))
SELECT doc_id AS quote_id, min(target) AS target FROM f JOIN e USING (phrase) GROUP BY doc_id HAVING count(DISTINCT target) = 1""")
def unique_quote(spark, d):
    split = F.array_remove(F.split("text", r"\s+"), "")
    return catalog.unique_quotes(read(spark, d, "documents").select(F.col("doc_id").alias("quote_id"), split.alias("words")), read(spark, d, "benchmark").select(F.col("item_id").alias("target"), split.alias("words")))


_PAIRS = "SELECT {key}, unnest(range(1, len(w))) AS k, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM {table}"


@query(f"""WITH q AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM benchmark),
m AS (SELECT doc_id, item_id, x.k AS q, y.k AS at FROM ({_PAIRS.format(key='doc_id', table='q')}) x JOIN ({_PAIRS.format(key='item_id', table='b')}) y USING (pair)),
first AS (SELECT m.* FROM m LEFT JOIN m p ON p.doc_id = m.doc_id AND p.item_id = m.item_id AND p.q = m.q - 1 AND p.at = m.at - 1 WHERE p.q IS NULL),
s AS (SELECT f.doc_id, f.item_id, f.q, f.at, (SELECT min(l.q) FROM m l LEFT JOIN m n ON n.doc_id = l.doc_id AND n.item_id = l.item_id AND n.q = l.q + 1 AND n.at = l.at + 1 WHERE n.q IS NULL AND l.doc_id = f.doc_id AND l.item_id = f.item_id AND l.q - l.at = f.q - f.at AND l.q >= f.q) - f.q + 2 AS length FROM first f)
SELECT doc_id, item_id::VARCHAR AS work, max(length)::BIGINT AS longest, count(*) AS stretches FROM s WHERE length >= 4 GROUP BY doc_id, item_id""")
def quoted_stretches(spark, d):
    """The longest stretch of four words or more that a document quotes from a benchmark item, and how many there are."""
    split = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), "")
    corpus = read(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("work"), F.lit(0).alias("order"), F.col("item_id").cast("string").alias("ref"), split.alias("words"))
    found = quotes.stretches(read(spark, d, "documents").select("doc_id", split.alias("words")), quotes.postings(corpus, 4), ["doc_id"], 4)
    return found.groupBy("doc_id", "work").agg(F.max("length").alias("longest"), F.count("*").alias("stretches"))


@query("SELECT r_name AS base, 'Notes on ' || r_name AS title FROM region WHERE r_regionkey % 2 = 0")
def direct_commentaries(spark, d):
    r = read(spark, d, "region")
    works = r.select(F.concat(F.lit("Notes on "), "r_name").alias("title"), F.when(F.col("r_regionkey") % 2 == 0, F.array("r_name")).otherwise(F.array(F.lit("x"))).alias("base_titles"))
    return catalog.direct_commentaries(r.select(F.col("r_name").alias("base")), works, ["Notes", "Gloss"])


# mentions and order in a book

_NUMBER = "[0-9]{3,}"


@query(f"""WITH {CTE}, m AS (SELECT source, title, line_index, string_split_regex(content, '{_NUMBER}') AS g, regexp_extract_all(content, '{_NUMBER}') AS h FROM cur WHERE regexp_matches(content, '{_NUMBER}')),
k AS (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM m)
SELECT source, title, line_index, 'citation' AS label, (length(array_to_string(g[1:k], '')) + length(array_to_string(h[1:k-1], '')))::INTEGER AS "start", (length(array_to_string(g[1:k], '')) + length(array_to_string(h[1:k], '')))::INTEGER AS "end" FROM k""")
def mentions_by_rule(spark, d):
    return recognize.by_rule(current_lines(spark, d), _NUMBER)


def _turns(spark, d):
    c = read(spark, d, "conversations").where("conv_id is not null and turn is not null")
    return c.select(F.lit("c").alias("source"), F.col("conv_id").cast("string").alias("title"), F.col("turn").cast("int").alias("line_index"), F.lit(0).alias("pos"), F.when(F.col("role") == "user", F.concat(F.lit("t"), F.col("turn").cast("string"))).alias("ref"), F.length("text").alias("size"), "role")


_T = "t AS (SELECT 'c' AS source, conv_id::VARCHAR AS title, turn::INTEGER AS line_index, 0 AS pos, CASE WHEN role = 'user' THEN 't' || turn END AS ref, length(text) AS size, role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)"


@query(f"WITH {_T} SELECT source, title, line_index, last_value(ref IGNORE NULLS) OVER (PARTITION BY source, title ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS position FROM t")
def heading_position(spark, d):
    return sequence.heading_positions(_turns(spark, d), "ref").select(*LINE, "position")


@query(f"WITH {_T} SELECT source, title, line_index, lag(role) OVER (PARTITION BY source, title ORDER BY line_index) AS previous FROM t")
def previous_citation(spark, d):
    return sequence.previous_mentions(_turns(spark, d), BOOK, ["line_index"], "role").select(*LINE, "previous")


@query(f"""WITH {_T}, k AS (SELECT *, count(ref) OVER (PARTITION BY source, title ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto, count(ref) OVER (PARTITION BY source, title ORDER BY line_index) AS at FROM t)
SELECT a.source, a.title, a.line_index, coalesce(list(b.ref ORDER BY b.at DESC) FILTER (b.ref IS NOT NULL), []) AS history
FROM k a LEFT JOIN k b ON a.source = b.source AND a.title = b.title AND b.ref IS NOT NULL AND b.at <= a.upto AND b.at > a.upto - 3 GROUP BY ALL""")
def ibid_history3(spark, d):
    return sequence.reference_history(_turns(spark, d), BOOK, ["line_index"], "ref").select(*LINE, "history")


_FOLD = f"""WITH RECURSIVE {_T},
o AS (SELECT *, CASE size % 3 WHEN 0 THEN ['r' || size % 7] WHEN 1 THEN []::VARCHAR[] ELSE ['r' || size % 7, 'r' || size % 5] END AS candidates, role = 'assistant' AS above,
      row_number() OVER (PARTITION BY source, title ORDER BY line_index) AS k FROM t),
f AS (SELECT source, title, line_index, pos, k, CASE WHEN NOT above AND len(candidates) = 1 THEN candidates[1] END AS ref FROM o WHERE k = 1
      UNION ALL
      SELECT o.source, o.title, o.line_index, o.pos, o.k, CASE WHEN above THEN CASE WHEN len(candidates) = 0 OR list_contains(candidates, f.ref) THEN f.ref END WHEN len(candidates) = 1 THEN candidates[1] END
      FROM f JOIN o ON o.source = f.source AND o.title = f.title AND o.k = f.k + 1)
SELECT source, title, line_index, pos, ref FROM f"""


def mentions_of_turns(spark, d):
    size = F.col("size")
    a, b = F.concat(F.lit("r"), (size % 7).cast("string")), F.concat(F.lit("r"), (size % 5).cast("string"))
    candidates = F.when(size % 3 == 0, F.array(a)).when(size % 3 == 1, F.array().cast("array<string>")).otherwise(F.array(a, b))
    return _turns(spark, d).select(*LINE, "pos", candidates.alias("candidates"), (F.col("role") == "assistant").alias("same_as_above"))


@query(_FOLD)
def last_emitted(spark, d):
    return sequence.resolve_in_order(mentions_of_turns(spark, d))


# checks

_RECORD = """SELECT source, doc_id::VARCHAR AS title, (doc_id % 9 - 1)::INTEGER AS line_index, (doc_id % 29 = 0)::INTEGER AS line_index_base, (doc_id % 13 - 1)::INTEGER AS "start", (doc_id % 17)::INTEGER AS "end",
CASE WHEN doc_id % 19 = 0 THEN ' ' ELSE 'x' END AS target_ref, CASE WHEN doc_id % 5 = 0 THEN substr(sha1(text), 1, 16) WHEN doc_id % 5 = 1 THEN 'zz' END AS source_hash,
CASE WHEN doc_id % 4 = 0 THEN lang END AS context_ref, CASE WHEN doc_id % 6 = 0 THEN 'above' WHEN doc_id % 6 = 1 THEN 'beside' END AS relative_direction FROM documents"""


@query(f"""WITH r AS ({_RECORD}), b AS (SELECT *, unnest([CASE WHEN line_index < 0 THEN 'line_index' END, CASE WHEN line_index_base <> 0 THEN 'line_index_base' END, CASE WHEN "start" < 0 THEN 'start' END, CASE WHEN "end" <= "start" THEN 'end' END,
CASE WHEN trim(target_ref) = '' THEN 'target_ref' END, CASE WHEN source_hash IS NOT NULL AND NOT regexp_matches(source_hash, '^[0-9a-f]{{16}}$') THEN 'source_hash' END, CASE WHEN (context_ref IS NULL) <> (relative_direction IS NULL) THEN 'context_pair' END,
CASE WHEN relative_direction NOT IN ('above', 'below') THEN 'relative_direction' END]) AS rule FROM r)
SELECT source, title, line_index, "start", "end", rule FROM b WHERE rule IS NOT NULL""")
def record_violations(spark, d):
    i = F.col("doc_id")
    docs = read(spark, d, "documents")
    return checks.record_violations(
        docs.select(
            "source",
            i.cast("string").alias("title"),
            (i % 9 - 1).cast("int").alias("line_index"),
            (i % 29 == 0).cast("int").alias("line_index_base"),
            (i % 13 - 1).cast("int").alias("start"),
            (i % 17).cast("int").alias("end"),
            F.when(i % 19 == 0, " ").otherwise("x").alias("target_ref"),
            F.when(i % 5 == 0, digests.content_hash(F.col("text"))).when(i % 5 == 1, "zz").alias("source_hash"),
            F.when(i % 4 == 0, F.col("lang")).alias("context_ref"),
            F.when(i % 6 == 0, "above").when(i % 6 == 1, "beside").alias("relative_direction"),
        )
    )


@query(f"""WITH {CTE}, r AS (SELECT source, title, CASE WHEN line_index = 3 THEN 999 ELSE line_index END::INTEGER AS line_index, 0 AS "start", 40 AS "end", substr(sha1(content), 1, 16) AS h, 'en' AS c FROM pri)
SELECT r.source, r.title, r.line_index, "start"::INTEGER AS "start", "end"::INTEGER AS "end", CASE WHEN cur.line_index IS NULL THEN 'line' WHEN h <> substr(sha1(content), 1, 16) THEN 'hash' WHEN c <> context THEN 'context' WHEN "end" > length(content) THEN 'end' END AS problem
FROM r LEFT JOIN cur USING (source, title, line_index) WHERE problem IS NOT NULL""")
def reconcile_records(spark, d):
    links = prior_lines(spark, d).select("source", "title", F.when(F.col("line_index") == 3, 999).otherwise(F.col("line_index")).alias("line_index"), F.lit(0).alias("start"), F.lit(40).alias("end"), digests.content_hash(F.col("content")).alias("source_hash"), F.lit("en").alias("context_ref"))
    return checks.place_violations(links, current_lines(spark, d))


@query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT l_orderkey AS o_orderkey FROM lineitem WHERE l_linenumber > 3) USING (o_orderkey)")
def ledger_missing(spark, d):
    return checks.missing(read(spark, d, "orders"), read(spark, d, "lineitem").where("l_linenumber > 3").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query(f"""WITH {PAIRS}, x AS (SELECT source, title, count(*) FILTER (a.line_index IS NULL) AS lacks, count(*) FILTER (b.line_index IS NULL) AS more, count(b.line_index) AS smaller FROM (SELECT source, title, line_index FROM again WHERE line_index > 0) a FULL JOIN (SELECT source, title, line_index FROM again) b USING (source, title, line_index) GROUP BY source, title)
SELECT source, title FROM x WHERE lacks > 0 OR (more = 0 AND smaller > 0)""")
def not_strict_superset(spark, d):
    again = lines_to_compute(spark, d)
    return checks.not_superset(again.where("line_index > 0"), again)


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_spans(spark, d):
    rows = read(spark, d, "lineitem").select(F.lit("l").alias("source"), F.col("l_orderkey").cast("string").alias("title"), F.lit(0).alias("line_index"), F.col("l_partkey").alias("start"), F.lit(0).alias("end"))
    return checks.duplicate_places(rows).select(F.col("title").cast("long").alias("l_orderkey"), F.col("start").alias("l_partkey"), "n")


# audit and lineage

_SIDES = 'a AS (SELECT source, title, line_index, 0 AS "start", 1 AS "end", length(content)::VARCHAR AS before FROM pri), b AS (SELECT source, title, line_index, 0 AS "start", 1 AS "end", length(content)::VARCHAR AS after FROM cur)'
_KIND = "CASE WHEN before IS NULL THEN 'added' WHEN after IS NULL THEN 'removed' WHEN before = after THEN 'unchanged' ELSE 'changed' END AS kind"


def _sides(spark, d):
    return [f(spark, d).select(*LINE, F.lit(0).alias("start"), F.lit(1).alias("end"), F.length("content").cast("string").alias("target_ref")) for f in (prior_lines, current_lines)]


@query(f'WITH {CTE}, {_SIDES} SELECT source, title, line_index, "start"::INTEGER AS "start", "end"::INTEGER AS "end", before, after, {_KIND} FROM a FULL JOIN b USING (source, title, line_index, "start", "end")')
def replay_diff(spark, d):
    return audit.replay_diff(*_sides(spark, d))


@query(f"""WITH {CTE}, {_SIDES}, k AS (SELECT {_KIND} FROM a FULL JOIN b USING (source, title, line_index, "start", "end"))
SELECT v.kind, count(k.kind) AS n FROM (VALUES ('unchanged'), ('added'), ('removed'), ('changed')) AS v(kind) LEFT JOIN k ON k.kind = v.kind GROUP BY v.kind""")
def replay_counts(spark, d):
    return audit.replay_counts(audit.replay_diff(*_sides(spark, d)))


@query("""SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS adopted, count(*) FILTER (o_orderstatus = 'O') AS computed, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failed,
sum(o_orderkey % 10)::BIGINT AS lines_reused, sum(o_orderkey % 7)::BIGINT AS lines_computed, sum(greatest(o_orderkey % 3 - 1, 0))::BIGINT AS replaced FROM orders""")
def provenance(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "adopted").when(F.col("o_orderstatus") == "O", "computed").otherwise("failed")
    k = F.col("o_orderkey")
    return audit.provenance(read(spark, d, "orders").select(status.alias("status"), (k % 10).alias("lines_reused"), (k % 7).alias("lines_computed"), (k % 3).alias("lives")))


@query("SELECT 'brand=' || p_brand || ';size=' || p_size AS fingerprint, unnest(['brand', 'size']) AS part, unnest([p_brand, p_size::VARCHAR]) AS value FROM part")
def fingerprint_components(spark, d):
    p = read(spark, d, "part").select(F.concat(F.lit("brand="), "p_brand", F.lit(";size="), F.col("p_size").cast("string")).alias("fingerprint"))
    return audit.fingerprint_parts(p)



@query("SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber <> 2 EXCEPT ALL SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linenumber > 2")
def multiset_difference(spark, d):
    l = read(spark, d, "lineitem")
    return audit.multiset_difference(l.where("l_linenumber <> 2").select("l_partkey", "l_returnflag"), l.where("l_linenumber > 2").select("l_partkey", "l_returnflag"))


# rules on single citations; the expected answers are given as values


@query(f"""WITH {_T}, c AS (SELECT *, 'Part ' || size % 40 || ':' || size % 3 AS one, 'Part ' || size % 7 || ':' || size % 5 AS two FROM t),
g AS (SELECT DISTINCT 'Part ' || a || ':' || b AS ref FROM range(0, 40) x(a), range(0, 3) y(b) WHERE a % 4 <> 0)
SELECT source, title, line_index, one AS target_ref FROM c JOIN g ON one = g.ref WHERE role <> 'assistant' AND (size % 2 = 0 OR one = two)""")
def resolve_citations(spark, d):
    """Citations of one or two candidates; those of two different ones are dropped, and so are targets without text."""
    size = F.col("size")
    one = F.concat(F.lit("Part "), (size % 40).cast("string"), F.lit(":"), (size % 3).cast("string"))
    two = F.concat(F.lit("Part "), (size % 7).cast("string"), F.lit(":"), (size % 5).cast("string"))
    parts = F.array(F.struct(F.lit("NAMED").alias("label"), F.lit("t").alias("text")))
    t = _turns(spark, d).where("role <> 'assistant'")
    cites = t.select(*LINE, "pos", F.lit("a text").alias("content"), F.lit(0).alias("start"), F.lit(6).alias("end"), parts.alias("parts"), F.when((size % 2 == 0) | (one == two), F.array(one)).otherwise(F.array(one, two)).alias("candidates"), F.lit(None).cast("string").alias("context"), F.lit(None).cast("long").alias("place"))
    segments = spark.range(40).where("id % 4 <> 0").select(F.explode(F.sequence(F.lit(0), F.lit(2))).alias("s"), "id")
    segments = segments.select(F.concat(F.lit("Part "), F.col("id").cast("string"), F.lit(":"), F.col("s").cast("string")).alias("ref"), F.concat(F.lit("Part "), F.col("id").cast("string")).alias("title"), F.col("s").cast("long").alias("place"), F.lit(True).alias("has_text"))
    return resolve.resolve(cites, segments, keep=kept).select(*LINE, "target_ref")


# the whole run


def resolve_numbers(lines: DataFrame) -> DataFrame:
    """A resolver for the general tables: a number of three and more digits is a link to the part of that number, modulo 1000."""
    found = recognize.by_rule(lines, _NUMBER)
    met = found.join(lines, LINE)
    hit = F.substring("content", F.col("start") + 1, F.col("end") - F.col("start"))
    target = F.concat(F.lit("Part "), (F.substring(hit, -3, 3)).cast("int").cast("string"))
    start, end = text.utf16_offset(F.col("content"), F.col("start")), text.utf16_offset(F.col("content"), F.col("end"))
    cols = {"line_index_base": F.lit(0), "start": start, "end": end, "target_ref": target, "source_path": F.lit(None), "source_hash": digests.content_hash(F.col("content")), "context_ref": F.lit(None), "relative_direction": F.lit(None)}
    return met.select(*LINE, *[c.cast(LINKS[n].dataType).alias(n) for n, c in cols.items()])


@query(f"""WITH {CTE}, m AS (SELECT source, title, line_index, content, string_split_regex(content, '{_NUMBER}') AS g, regexp_extract_all(content, '{_NUMBER}') AS h FROM cur WHERE regexp_matches(content, '{_NUMBER}')),
k AS (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM m)
SELECT source, title, line_index, (length(array_to_string(g[1:k], '')) + length(array_to_string(h[1:k-1], '')))::INTEGER AS "start", (length(array_to_string(g[1:k], '')) + length(array_to_string(h[1:k], '')))::INTEGER AS "end",
'Part ' || right(h[k], 3)::INTEGER AS target_ref, substr(sha1(content), 1, 16) AS source_hash FROM k""")
def incremental_run(spark, d):
    """Links of the current snapshot from those of the baseline; the SQL computes them anew, so reuse must lose and add nothing."""
    current, prior = current_lines(spark, d), prior_lines(spark, d)
    _, links = incremental.run(current, prior, resolve_numbers(prior), resolve_numbers)
    return links.select(*LINE, "start", "end", "target_ref", "source_hash")


@query(f"""WITH {CTE} SELECT source, title, count(*) AS n_links FROM (SELECT source, title, unnest(regexp_extract_all(content, '{_NUMBER}')) AS h FROM cur) GROUP BY ROLLUP (source, title) HAVING title IS NOT NULL OR source IS NULL""")
def store_links(spark, d):
    """How many links each book's artifact has, and all together."""
    return artifacts.link_counts(resolve_numbers(current_lines(spark, d)))


_CONTEXT = "(?<![a-z])(der|the)(?![a-z])"
_HASH = "substr(sha1(string_agg(line_index::VARCHAR || chr(0) || content || chr(0) || context || chr(0), '' ORDER BY line_index)), 1, 16) AS hash, bool_or(regexp_matches(content, '(^|[^a-z])(der|the)($|[^a-z])')) AS leans"
_COUNTS = "SELECT source, title, coalesce(list_sort(list(DISTINCT n) FILTER (n > 0 AND line_index % 8 = 0 AND line_index > 0)), []) AS counts FROM (SELECT *, coalesce(sum(entity::INTEGER) OVER (PARTITION BY source, title ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM {}) GROUP BY source, title"


@query(f"""WITH {PAIRS},
hc AS (SELECT source, title, {_HASH} FROM cur GROUP BY ALL), hp AS (SELECT source, title, {_HASH} FROM pri GROUP BY ALL),
e AS (SELECT source, title, line_index, regexp_matches(content, '{_NUMBER}') AS entity FROM pri),
u AS (SELECT e.*, new_index FROM e LEFT JOIN pairs p ON p.source = e.source AND p.title = e.title AND p.old_index = e.line_index),
ec AS (SELECT cur.source, cur.title, cur.line_index, coalesce(u.entity, false) AS entity FROM cur LEFT JOIN u ON u.source = cur.source AND u.title = cur.title AND u.new_index = cur.line_index),
sc AS ({_COUNTS.format('ec')}), sp AS ({_COUNTS.format('e')}),
facts AS (SELECT source, title, count(new_index) AS reused, count(*) FILTER (entity AND new_index IS NULL) AS dropped FROM u GROUP BY ALL),
o AS (SELECT source, title, bool_and(coalesce(line_index > b, true)) AS kept FROM (SELECT *, lag(line_index) OVER (PARTITION BY source, title ORDER BY new_index) AS b FROM u WHERE entity AND new_index IS NOT NULL) GROUP BY ALL),
probed AS (SELECT hc.source, hc.title FROM hc JOIN hp USING (source, title) JOIN facts USING (source, title) JOIN sc USING (source, title) JOIN sp USING (source, title) LEFT JOIN o USING (source, title)
  WHERE hc.hash <> hp.hash AND hc.leans AND hp.leans AND reused > 0 AND dropped = 0 AND coalesce(kept, true) AND sc.counts = sp.counts)
SELECT source, title, coalesce(bool_or(regexp_matches(content, '{_NUMBER}')), false) AS escalated FROM probed LEFT JOIN (SELECT cur.* FROM cur JOIN again USING (source, title, line_index)) USING (source, title) GROUP BY ALL""")
def probed_books(spark, d):
    """Changed books that lean on context and are only probed, and whether their probes find something, so that they are computed whole."""
    current, prior = current_lines(spark, d), prior_lines(spark, d)
    seams = lambda lines: lines.where("line_index % 8 = 0 and line_index > 0").select(*LINE)
    flags = prior.select(*LINE, F.col("content").rlike(_NUMBER).alias("entity"))
    books = delta.needs_context(prior, _CONTEXT).join(delta.seam_counts(flags, seams(prior)).withColumnRenamed("counts", "ibid_seams"), BOOK)
    p = incremental.plan(current, prior, context_pattern=_CONTEXT, keep=kept, known=incremental.Known(books, flags, seams(current)))
    _, whole = incremental.escalate(p, current, lambda lines: recognize.by_rule(lines, _NUMBER))
    return p.probed.join(whole.withColumn("escalated", F.lit(True)), BOOK, "left").select(*BOOK, F.coalesce("escalated", F.lit(False)).alias("escalated"))


from spanlink.plans import citation_queries, contract_queries  # noqa: E402, F401  they register theirs

__all__ = ["ORACLE_SQL", "QUERIES"]
