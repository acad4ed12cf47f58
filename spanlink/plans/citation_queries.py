"""Queries of the citation rules: citations are spelled from the numbers of whole tables, and SQL works with the numbers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanlink.functions import addresses, attribution, numerals, rules, text
from spanlink.functions.numerals import letter_values, spelled
from spanlink.operators import recover, resolve, sequence
from spanlink.plans.registry import query
from spanlink.plans.stand_ins import read, values
from spanlink.schemas import LINE
from spanlink.sources.kept import kept

TOP = 120
#: Rows of `part` with a number n, its letters s, the number that all but the first of them are, and a form f.
NUMBERS = f"""n AS {values([(k, spelled(k), sum(map(letter_values().get, spelled(k)[1:]))) for k in range(1, TOP + 1)], 'n, s, tail')},
p AS (SELECT p_partkey, p_size, p_name, n.n, n.s, n.tail, (p_partkey // {TOP}) % 8 AS f FROM part JOIN n ON n.n = p_partkey % {TOP} + 1)"""


def numbered(spark, d):
    known = spark.createDataFrame([(k, spelled(k)) for k in range(1, TOP + 1)], "n long, s string")
    p = read(spark, d, "part").withColumn("n", F.col("p_partkey") % TOP + 1).withColumn("f", F.floor(F.col("p_partkey") / TOP) % 8)
    # a row is a few bytes in its file and many patterns in a rule: a file's rows are dealt to all tasks, before the join, so that rules' filters stay behind both
    return p.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey").join(F.broadcast(known), "n")


def by_form(*texts):
    """One of several texts by the form f of a row."""
    return F.element_at(F.array(*texts), (F.col("f") % len(texts) + 1).cast("int"))


def with_(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query(f"WITH {NUMBERS} SELECT p_partkey, CASE WHEN f % 4 = 3 THEN CASE WHEN n < 10 THEN NULL ELSE n + 400 END ELSE n END::INTEGER AS value, f % 4 <> 3 AS canonical FROM p WHERE f % 4 <> 3 OR n < 10")
def gematria(spark, d):
    """Numbers plain, with a mark inside, and with one after; and units after which a hundred comes, which is no number."""
    s = F.col("s")
    marked = F.when(F.length(s) > 1, with_(F.expr("substring(s, 1, length(s) - 1)"), '"', F.expr("right(s, 1)"))).otherwise(with_(s, "'"))
    p = numbered(spark, d).withColumn("t", by_form(s, marked, with_(s, "׳"), with_(s, "ת"))).where("f % 4 <> 3 or n < 10")
    return p.select("p_partkey", numerals.numeral(F.col("t")).alias("value"), numerals.is_canonical_numeral(F.col("t")).alias("canonical"))


@query(f"""WITH {NUMBERS} SELECT p_partkey, n AS daf, CASE WHEN f % 4 IN (0, 2) THEN 'a' ELSE 'b' END AS side FROM p
WHERE f < 4 AND NOT (f = 3 AND s = 'ד') UNION ALL SELECT p_partkey, n, CASE WHEN f = 6 THEN 'a' ELSE 'b' END FROM p WHERE f IN (6, 7)""")
def leaf_addresses(spark, d):
    """Addresses in eight forms; what may be a side, a chapter or the word for leaf, or isn't spelled as usual, is none."""
    s = F.col("s")
    forms = by_form(with_(s, "."), with_("דף ", s, ":"), with_(s, ",א"), with_(s, ' ע"ב'), with_('פ"', s, "."), with_("א", s, ","), with_("דף ", s, ' ע"א'), with_(s, " :"))
    return numbered(spark, d).withColumn("a", addresses.daf_address(forms)).where("a is not null").select("p_partkey", "a.daf", "a.side")


@query(f"""WITH {NUMBERS}, k AS (SELECT *, p_size % 40 + 1 AS d, CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'b' END AS side, CASE WHEN f % 2 = 0 THEN 'a' ELSE 'b' END AS said FROM p)
SELECT p_partkey, NOT (d IN (n, tail) AND side = said) AS contradicts, 'Eruvin ' || n || said AS spelled FROM k""")
def address_agreement(spark, d):
    s = F.col("s")
    p = numbered(spark, d).withColumn("r", F.expr("concat('Eruvin ', p_size % 40 + 1, if(p_size % 2 = 0, 'a', 'b'))"))
    p = p.withColumn("a", by_form(with_("עירובין ", s, ", א"), with_("להלן עירובין ", s, ",ב"), with_("עירובין ", s, ' ע"א'), with_(s, " ע״ב")))
    return p.select("p_partkey", rules.address_contradicts(F.col("r"), F.col("a")).alias("contradicts"), rules.spelled_ref(F.col("r"), F.col("a")).alias("spelled"))


@query(f"""WITH {NUMBERS} SELECT p_partkey, CASE WHEN f % 4 IN (0, 1) THEN length(s) + 2 + f % 4 ELSE 0 END::INTEGER AS ends FROM p""")
def leading_markers(spark, d):
    s = F.col("s")
    content = by_form(with_("(", s, ") ", F.col("p_name")), with_(" (", s, ")"), with_(F.col("p_name"), " (", s, ")"), with_("(שם) ", s))
    return numbered(spark, d).select("p_partkey", rules.leading_marker_end(content).alias("ends"))


@query("SELECT p_partkey, p_partkey % 8 IN (0, 1, 3, 6) AS misread FROM part")
def implausible_targets(spark, d):
    cases = [("I Kings", 'מ"א'), ("I Kings", '(מ״א סי {})'), ("I Kings", 'מ"א ב, {}'), ("Amos", "עמ' {}"), ("Amos", "עמוס {}"), ("Amos", "abc עמ' {}"), ("Mishnah Eruvin", 'פ"ק דעירובין {}'), ("Mishnah Eruvin", 'משנה פ"ק עירובין {}')]
    number = F.col("p_size").cast("string")
    pick = lambda texts: F.element_at(F.array(*texts), (F.col("p_partkey") % len(cases) + 1).cast("int"))
    ref = F.concat_ws(" ", pick([F.lit(r) for r, _ in cases]), number)
    anchor = pick([F.replace(F.lit(a), F.lit("{}"), number) for _, a in cases])
    return read(spark, d, "part").select("p_partkey", rules.implausible(ref, anchor).alias("misread"))


_TITLES = "t AS (SELECT p_partkey, 'Note ' || p_partkey || ' על ' || " + "list_extract([" + ", ".join(f"'{t}'" for t in rules.TRACTATES) + "], (p_size % 37 + 1)::INTEGER) || CASE WHEN p_partkey % 3 = 0 THEN ' x' ELSE '' END AS title, list_extract(['Sefaria', 'KSK', 'a', 'b'], (p_partkey % 4 + 1)::INTEGER) AS source FROM part)"


@query(f"WITH {_TITLES} SELECT p_partkey, source NOT IN ('Sefaria', 'KSK') AND p_partkey % 3 <> 0 AS placed FROM t")
def placed_by_pages(spark, d):
    of = lambda items, k: F.element_at(F.array(*[F.lit(x) for x in items]), (k + 1).cast("int"))
    title = F.concat(F.lit("Note "), F.col("p_partkey").cast("string"), F.lit(" על "), of(rules.TRACTATES, F.col("p_size") % 37), F.when(F.col("p_partkey") % 3 == 0, " x").otherwise(""))
    return read(spark, d, "part").select("p_partkey", rules.placed_by_pages(of(("Sefaria", "KSK", "a", "b"), F.col("p_partkey") % 4), title).alias("placed"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 AS t, CASE WHEN l_suppkey % 11 <> 0 THEN l_suppkey % 50 END AS o, l_returnflag AS r, l_linenumber % 2 = 0 AS same, l_linenumber % 3 = 0 AS named FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN o IS NOT NULL AND (named OR same) AND (NOT same OR (r = 'A' AND t < o) OR (r = 'N' AND t > o)) THEN CASE r WHEN 'A' THEN 'above' WHEN 'N' THEN 'below' END END AS direction FROM l""")
def relative_directions(spark, d):
    l = read(spark, d, "lineitem")  # noqa: E741
    anchor = F.when(F.col("l_returnflag") == "A", "לעיל כ").when(F.col("l_returnflag") == "N", "לקמן כ").otherwise("לעיל ולקמן")
    labels = F.when(F.col("l_linenumber") % 3 == 0, F.array(F.lit("RELATIVE"), F.lit("NAMED"))).otherwise(F.array(F.lit("RELATIVE"), F.lit("NUMBERED")))
    own = F.when(F.col("l_suppkey") % 11 != 0, F.col("l_suppkey") % 50)
    return l.select("l_orderkey", "l_linenumber", rules.relative_direction(labels, anchor, F.col("l_linenumber") % 2 == 0, own, F.col("l_partkey") % 50).alias("direction"))


@query("SELECT page_id, trim(regexp_replace(translate(regexp_replace(coalesce(html, '') || '״a׳', '<[^>]*>', ' ', 'g'), '״׳', '\"'''), '[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{1680}\\x{0085}]+', ' ', 'g')) AS plain FROM pages")
def plain_quotes(spark, d):
    return read(spark, d, "pages").select("page_id", text.plain_quotes(F.concat(F.coalesce("html", F.lit("")), F.lit("״a׳"))).alias("plain"))


@query("WITH t AS (SELECT doc_id, repeat('😀', (doc_id % 3)::INTEGER) || text AS t FROM documents) SELECT doc_id, (length(t) + doc_id % 3 + len(regexp_extract_all(substr(t, 1 + (doc_id % 3)::INTEGER), '[\\x{10000}-\\x{10FFFF}]')))::INTEGER AS units FROM t")
def utf16_offsets(spark, d):
    t = F.concat(F.repeat(F.lit("😀"), (F.col("doc_id") % 3).cast("int")), "text")
    return read(spark, d, "documents").select("doc_id", text.utf16_offset(t, F.length(t)).alias("units"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN 'New ' || substr(p_brand, 7) || CASE WHEN p_partkey % 4 = 1 THEN ' ' || p_size ELSE '' END WHEN p_partkey % 4 = 2 THEN p_brand || ' Notes ' || p_size ELSE p_brand || 'x ' || p_size END AS ref FROM part")
def rename_targets(spark, d):
    b, n = F.col("p_brand"), F.col("p_size").cast("string")
    ref = F.element_at(F.array(b, F.concat(b, F.lit(" "), n), F.concat(b, F.lit(" Notes "), n), F.concat(b, F.lit("x "), n)), (F.col("p_partkey") % 4 + 1).cast("int"))
    return read(spark, d, "part").select("p_partkey", text.retitled(ref, b, F.concat(F.lit("New "), F.substring(b, F.lit(7), F.length(b)))).alias("ref"))


@query("""WITH h AS (SELECT 'c' AS source, conv_id::VARCHAR AS title, turn::INTEGER AS line_index, CASE WHEN length(text) % 4 <> 0 THEN length(text) % 4 END AS level, 'h' || length(text) AS heading FROM conversations),
o AS (SELECT a.title, a.line_index, b.level, arg_max(b.heading, b.line_index) AS heading, max(b.line_index) AS at FROM h a JOIN h b ON a.title = b.title AND b.line_index <= a.line_index AND b.level IS NOT NULL GROUP BY ALL),
k AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM o q WHERE q.title = o.title AND q.line_index = o.line_index AND q.level < o.level AND q.at > o.at))
SELECT h.source, h.title, h.line_index, coalesce(string_agg(k.heading, '/' ORDER BY k.level), '') AS stack FROM h LEFT JOIN k USING (title, line_index) GROUP BY ALL""")
def heading_stack(spark, d):
    n = F.length("text")
    lines = read(spark, d, "conversations").select(F.lit("c").alias("source"), F.col("conv_id").cast("string").alias("title"), F.col("turn").cast("int").alias("line_index"), F.when(n % 4 != 0, n % 4).alias("level"), F.concat(F.lit("h"), n.cast("string")).alias("heading"))
    return sequence.heading_stack(lines).select(*LINE, F.array_join("stack", "/").alias("stack"))


# citations rebuilt

_TRACTATES = [("Gittin", "גיטין"), ("Ketubot", "כתובות"), ("Sukkah", "סוכה")]


def _works(spark):
    rows = [(t, [he], "Talmud") for t, he in _TRACTATES] + [("Psalms", ["תהלים"], "Tanakh"), ("Genesis", ["בראשית"], "Tanakh")]
    return spark.createDataFrame(rows, "title string, aliases array<string>, category string")


def _leaves(spark, last=90):
    """Segments of all sides 2a to the last leaf's, of each tractate."""
    sides = spark.createDataFrame(_TRACTATES, "title string, he string").crossJoin(spark.range(3, 2 * last + 1))  # three titles
    leaf = F.concat(((F.col("id") + 1) / 2).cast("int").cast("string"), F.when(F.col("id") % 2 == 1, "a").otherwise("b"))
    return sides.select(F.concat_ws(" ", "title", leaf).alias("ref"), "title", F.lit(True).alias("has_text"))


def _citations(p, content, parts, candidates=None):
    """One citation per row, all of its content; parts: (label, text column) that stand one after the other with single spaces."""
    at, out = F.lit(0), []
    for label, t in parts:
        out.append(F.struct(F.lit(label).alias("label"), t.alias("text"), at.alias("start"), (at + F.length(t)).alias("end")))
        at = at + F.length(t) + 1
    empty = F.array().cast("array<string>")
    listed = F.array(*out) if out else F.array().cast("array<struct<label:string,text:string,start:int,end:int>>")
    own = F.element_at(F.array(*[F.struct(F.lit(a).alias("own_title"), F.lit(b).alias("own_he")) for a, b in _TRACTATES]), (F.col("p_partkey") % 3 + 1).cast("int"))
    section = (F.col("p_size") * 2 + 3).cast("int")
    return p.select(
        F.lit("p").alias("source"), F.lit("b").alias("title"), F.col("p_partkey").cast("int").alias("line_index"), F.lit(0).alias("pos"), content.alias("content"), F.lit(0).alias("start"), F.length(content).alias("end"),
        listed.alias("parts"), (empty if candidates is None else candidates).alias("candidates"), own.alias("own"), section.alias("section"), section.alias("section_last"),
    ).select("*", "own.*").drop("own")


_OWN = "list_extract(['Gittin', 'Ketubot', 'Sukkah'], (p_partkey % 3 + 1)::INTEGER)"


@query(f"""WITH {NUMBERS}, k AS (SELECT *, 2 * p_size + 3 AS o, CASE WHEN f % 4 IN (0, 2) THEN 'above' ELSE 'below' END AS direction, CASE WHEN f % 4 = 3 THEN CASE WHEN p_size % 2 = 0 THEN p_size + 2 ELSE p_size + 2 END ELSE n END AS daf, CASE WHEN f % 4 IN (0, 2) THEN 'a' ELSE 'b' END AS side FROM p)
SELECT p_partkey::INTEGER AS line_index, {_OWN} || ' ' || daf || side AS ref, direction FROM k
WHERE daf BETWEEN 2 AND 90 AND CASE direction WHEN 'above' THEN 2 * daf - (side = 'a')::INTEGER < o ELSE 2 * daf - (side = 'a')::INTEGER > o END""")
def own_relative_leaves(spark, d):
    """Pointing words with an address in the own tractate, with and without its title, and with a side alone."""
    s, own = F.col("s"), F.element_at(F.array(*[F.lit(he) for _, he in _TRACTATES]), (F.col("p_partkey") % 3 + 1).cast("int"))
    content = by_form(with_("לעיל ", s, "."), with_("לקמן דף ", s, ":"), with_("(לעיל ", own, " דף ", s, ".)"), F.lit('להלן ע"ב'))
    return recover.own_relative(_citations(numbered(spark, d), content, []), _leaves(spark)).select("line_index", "ref", "direction")


@query(f"""WITH {NUMBERS} SELECT p_partkey::INTEGER AS line_index, {_OWN} || ' ' || n || 'a' AS ref FROM p WHERE n BETWEEN 2 AND 90 AND f % 8 IN (0, 1, 4)
UNION ALL SELECT p_partkey::INTEGER, {_OWN} || ' ' || n || 'a' FROM p WHERE n BETWEEN 2 AND 90 AND f IN (6, 7) AND n <= 20""")
def own_untitled_leaves(spark, d):
    """Untitled sides that all candidates read in the own tractate; other authors, other works before, and chapters that don't hold them leave them out."""
    s = F.col("s")
    content = by_form(with_("(דף ", s, ".)"), with_("התם (דף ", s, ".)"), with_('רש"י (דף ', s, ".)"), with_("(דף ", s, ".)"), with_("גמרא דף ", s, "."), with_("לעיל דף ", s, "."), with_("פרק קמא (דף ", s, ".)"), with_("פרק קמא (דף ", s, ".)"))
    title = F.element_at(F.array(*[F.lit(t) for t, _ in _TRACTATES]), (F.col("p_partkey") % 3 + 1).cast("int"))
    ref = F.concat(title, F.lit(" "), F.col("n").cast("string"), F.lit("a"))
    other = F.concat(F.lit("Other "), F.col("n").cast("string"), F.lit("a"))
    candidates = F.when(F.col("f") % 8 == 3, F.array(ref, other)).otherwise(F.array(ref, F.concat(F.lit("Rashi on "), ref)))
    c = _citations(numbered(spark, d), content, [], candidates)
    chapters = spark.createDataFrame([(t, "פרק קמא", 3, 40) for t, _ in _TRACTATES], "title string, name string, first int, last int")
    return recover.own_daf(c, _works(spark), _leaves(spark), chapters).select("line_index", "ref")


@query(f"""WITH {NUMBERS} SELECT p_partkey::INTEGER AS line_index, 0 AS k, 'Psalms ' || n || ':' || (p_size % 9 + 1) AS ref FROM p WHERE f % 4 < 2 AND n <= 100
UNION ALL SELECT p_partkey::INTEGER, 1, 'Genesis ' || (p_size % 9 + 1) || ':' || n FROM p WHERE f % 4 < 2 AND n <= 100""")
def split_verse_lists(spark, d):
    """Lists of two verses, cut at comma or semicolon; those joined by a word, and those with a verse that isn't there, stay out whole."""
    p = numbered(spark, d).withColumn("m", F.element_at(F.array(*[F.lit(spelled(k)) for k in range(1, 10)]), (F.col("p_size") % 9 + 1).cast("int")))
    s, m = F.col("s"), F.col("m")
    a, b = with_("תהלים ", s, " ", m), with_("בראשית ", m, " ", s)
    content = by_form(with_(a, ", ", b), with_(a, "; ", b), with_(a, " וגם ", b), with_(a, " ", b))
    c = _citations(p, content, [])
    # the second group stands behind the first and what joins them
    gap = by_form(F.lit(2), F.lit(2), F.lit(5), F.lit(1))
    spans, at = [], F.lit(0)
    for title, x, y in ((F.lit("תהלים"), s, m), (F.lit("בראשית"), m, s)):
        for label, t in (("NAMED", title), ("NUMBERED", x), ("NUMBERED", y)):
            spans.append(F.struct(F.lit(label).alias("label"), t.alias("text"), at.alias("start"), (at + F.length(t)).alias("end")))
            at = at + F.length(t) + 1
        at = at - 1 + gap
    c = c.drop("parts").join(p.select(F.col("p_partkey").cast("int").alias("line_index"), F.array(*spans).alias("parts")), "line_index")
    verses = spark.range(1, 101).select("id", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("k"))
    verses = verses.select(F.explode(F.array(F.struct(F.concat(F.lit("Psalms "), F.col("id"), F.lit(":"), F.col("k")).alias("ref"), F.lit("Psalms").alias("title")), F.struct(F.concat(F.lit("Genesis "), F.col("k"), F.lit(":"), F.col("id")).alias("ref"), F.lit("Genesis").alias("title")))).alias("v")).select("v.*", F.lit(True).alias("has_text"))
    return recover.split_verses(c, _works(spark), verses).select("line_index", "k", "ref")


@query(f"""WITH {NUMBERS} SELECT p_partkey::INTEGER AS line_index, 'Psalms ' || n || CASE WHEN f % 4 = 1 THEN ':' || (p_size % 9 + 1) ELSE '' END AS ref FROM p WHERE f % 4 < 2 AND length(s) > 1 AND n <= 100""")
def geresh_verses(spark, d):
    """A title and numbers with a geresh after several letters; without one, or with a tractate's title, nothing is rebuilt."""
    s = F.col("s")
    p = numbered(spark, d).withColumn("m", F.element_at(F.array(*[F.lit(spelled(k)) for k in range(1, 10)]), (F.col("p_size") % 9 + 1).cast("int")))
    content = by_form(with_("(תהלים ", s, "')"), with_("תהלים ", s, "' ", F.col("m")), with_("תהלים ", s), with_("גיטין ", s, "'"))
    one = spark.range(1, 101).select(F.explode(F.array_append(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: F.concat(F.lit("Psalms "), F.col("id").cast("string"), F.lit(":"), k.cast("string"))), F.concat(F.lit("Psalms "), F.col("id").cast("string")))).alias("ref"))
    segments = one.select("ref", F.lit("Psalms").alias("title"), F.lit(True).alias("has_text"))
    return recover.geresh_verses(_citations(p, content, []), _works(spark), segments).select("line_index", "ref")


@query(f"""WITH {NUMBERS} SELECT p_partkey::INTEGER AS line_index, 'Ketubot ' || n || 'a' AS ref FROM p WHERE f % 4 = 0 AND n BETWEEN 15 AND 28
UNION ALL SELECT p_partkey::INTEGER, 'Gittin ' || n || 'b' FROM p WHERE f % 4 = 1 AND n BETWEEN 2 AND 20 AND n <> 4
UNION ALL SELECT p_partkey::INTEGER, 'Ketubot ' || n || CASE n WHEN 14 THEN 'b' WHEN 28 THEN 'a' ELSE '' END FROM p WHERE f % 4 = 2 AND n BETWEEN 14 AND 28""")
def chapter_led_leaves(spark, d):
    """A chapter, a title and a leaf: the chapter must hold the leaf, and a leaf that it holds one side of is that side."""
    s = F.col("s")
    parts = [("NAMED", by_form(F.lit("בפרק שני דכתובות"), F.lit("פרק קמא דגיטין"), F.lit("פרק שני דכתובות"), F.lit("פרק ב סוכה"))), ("NUMBERED", by_form(with_("דף ", s, "."), with_(s, ' ע"ב'), with_("דף ", s), with_(s, ".")))]
    c = _citations(numbered(spark, d), F.concat(parts[0][1], F.lit(" "), parts[1][1]), parts)
    chapters = spark.createDataFrame([("Ketubot", "פרק שני", 28, 55), ("Gittin", "פרק קמא", 3, 40), ("Sukkah", "פרק קמא", 3, 40)], "title string, name string, first int, last int")
    return recover.chapter_led(c, _works(spark), _leaves(spark), chapters).select("line_index", "ref")


# the resolver in the order of its books

#: Lines of orders as citations of twelve forms f with numbers x and y; letters s of x. Chapters 4, 8, .. and leaves 5, 10, .. have no text.
_ORDERED = f"""n AS {values([(k, spelled(k)) for k in range(1, 31)], 'n, s')},
m AS (SELECT l_orderkey AS o, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k, l_partkey % 30 + 1 AS x, l_suppkey % 9 + 1 AS y, s, (l_partkey // 30 + l_linenumber) % 12 AS f FROM lineitem JOIN n ON n = l_partkey % 30 + 1)"""


def _ordered_citations(spark, d):
    known = spark.createDataFrame([(k, spelled(k)) for k in range(1, 31)], "x long, s string")
    l = read(spark, d, "lineitem").withColumn("x", F.col("l_partkey") % 30 + 1)  # noqa: E741
    k = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    l = l.withColumns({"k": k, "y": F.col("l_suppkey") % 9 + 1, "f": F.floor(F.col("l_partkey") / 30) + F.col("l_linenumber")}).withColumn("f", F.col("f") % 12).join(F.broadcast(known), "x")  # noqa: E741
    s, x, y, next_ = F.col("s"), F.col("x").cast("string"), F.col("y").cast("string"), (F.col("x") + 1).cast("string")
    verse, later = with_("Psalms ", x, ":", y), with_("Psalms ", next_, ":", y)
    leaf = lambda title, n: with_(title + " ", n, "a")
    none = F.array().cast("array<string>")
    forms = [  # content, labels, candidates
        (F.lit("Psalms"), ["NAMED"], F.array(verse)),
        (F.lit("שם"), ["IBID"], F.array(verse, later)),
        (F.lit("שם"), ["IBID"], F.array(leaf("Gittin", next_))),
        (with_("תהלים ", s, "'"), [], none),
        (F.lit("two works"), ["NAMED"], F.array(verse, leaf("Gittin", next_))),
        (with_("(", s, ") a"), ["NUMBERED"], F.array(verse)),
        (F.lit("שם כתובות"), ["IBID", "NAMED"], F.array(leaf("Ketubot", next_))),
        (with_("שם ", s, "."), ["IBID"], none),
        (F.lit("לעיל כ"), ["RELATIVE", "NUMBERED"], F.array(leaf("Gittin", next_))),
        (F.lit('ס"ק ג'), ["NUMBERED"], F.array(with_("Shulchan Arukh, Yoreh De'ah ", x))),
        (F.lit('מ"א'), ["NAMED"], F.array(with_("I Kings ", x, ":", y))),
        (with_("(דף ", s, ".)"), [], F.array(leaf("Gittin", x), leaf("Rashi on Gittin", x))),
    ]
    of = lambda items: F.coalesce(*[F.when(F.col("f") == k, v) for k, v in enumerate(items)])  # one is spelled, not all twelve
    labelled = [F.array(*[F.lit(v) for v in labels]) if labels else none for _, labels, _ in forms]
    content = of([t for t, _, _ in forms])
    rows = l.select(F.lit("l").alias("source"), F.col("l_orderkey").cast("string").alias("title"), F.col("k").cast("int").alias("line_index"), F.lit(0).alias("pos"), "f", "s", content.alias("content"), of(labelled).alias("labels"), of([c for _, _, c in forms]).alias("candidates"))
    part = lambda v: F.struct(v.alias("label"), F.lit("").alias("text"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    pointing, own = F.col("f") == 8, F.col("f") == 11
    return rows.select(
        *LINE, "pos", "content", F.lit(0).alias("start"), F.when(F.col("f") == 5, F.length("s") + 2).otherwise(F.length("content")).alias("end"), F.transform("labels", part).alias("parts"), "candidates",
        F.when(pointing, "Gittin 10a").alias("context"), F.when(pointing, 20).cast("long").alias("place"), F.when(own, "Gittin").alias("own_title"), F.when(own, "גיטין").alias("own_he"), F.when(own, 21).alias("section"), F.when(own, 21).alias("section_last"),
    )


def _ordered_segments(spark):
    n = spark.range(1, 32)
    verses = n.select(F.lit("Psalms").alias("title"), F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.lit(9)), lambda v: with_(":", v.cast("string"))))).alias("v"), "id", (F.col("id") * 10).alias("place"), (F.col("id") % 4 != 0).alias("has_text"))
    leaves = n.where("id > 1").select(F.explode(F.array(F.lit("Gittin"), F.lit("Ketubot"))).alias("title"), F.lit("a").alias("v"), "id", (2 * F.col("id") - 1).alias("place"), (F.col("id") % 5 != 0).alias("has_text"))
    return verses.unionByName(leaves).select(with_(F.col("title"), " ", F.col("id").cast("string"), F.col("v")).alias("ref"), "title", "place", "has_text")


@query(f"""WITH RECURSIVE {_ORDERED},
r(o, k, f, ref, direction, chapter, trusted) AS (
  SELECT DISTINCT o, 0::BIGINT, 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR, NULL::BIGINT, NULL::VARCHAR FROM m
  UNION ALL
  SELECT o, k, f, ref, CASE WHEN f = 8 AND ref IS NOT NULL THEN 'above' END,
    CASE WHEN f IN (3, 7) THEN chapter WHEN f IN (0, 1) AND ref IS NOT NULL THEN c END, CASE WHEN ref IS NOT NULL THEN regexp_extract(ref, '^[A-Z][a-z]+') END
  FROM (SELECT o, k, f, x, c, chapter, CASE
      WHEN f = 0 AND x % 4 <> 0 THEN 'Psalms ' || x || ':' || y
      WHEN f = 1 AND c % 4 <> 0 AND trusted = 'Psalms' THEN 'Psalms ' || c || ':' || y
      WHEN f = 2 AND (x + 1) % 5 <> 0 AND trusted = 'Gittin' THEN 'Gittin ' || (x + 1) || 'a'
      WHEN f = 3 AND length(s) > 1 AND x % 4 <> 0 THEN 'Psalms ' || x
      WHEN f = 6 AND (x + 1) % 5 <> 0 THEN 'Ketubot ' || (x + 1) || 'a'
      WHEN f = 7 AND trusted IN ('Gittin', 'Ketubot') AND x > 1 AND x % 5 <> 0 THEN trusted || ' ' || x || 'a'
      WHEN f = 8 AND (x + 1) % 5 <> 0 AND x < 10 THEN 'Gittin ' || (x + 1) || 'a'
      WHEN f = 11 AND x > 1 AND x % 5 <> 0 THEN 'Gittin ' || x || 'a' END AS ref
    FROM (SELECT m.*, r.chapter, r.trusted, CASE WHEN m.f = 0 THEN x WHEN r.chapter IN (x, x + 1) THEN r.chapter END AS c FROM r JOIN m ON m.o = r.o AND m.k = r.k + 1)))
SELECT o::VARCHAR AS title, k::INTEGER AS line_index, ref AS target_ref, direction AS relative_direction FROM r WHERE ref IS NOT NULL""")
def resolve_ordered(spark, d):
    """Every line of an order as a citation of one of twelve forms; SQL folds the orders by recursion.

    Names, "there" with and without a name, a printed leaf after "there", a rebuilt verse, an untitled own leaf, a pointing word; and
    two works, a line's marker, a note of a code, a misread abbreviation and missing text, which are dropped and clear the history.
    """
    c = _ordered_citations(spark, d)
    chapters = spark.createDataFrame([], resolve.CHAPTERS)
    found = resolve.resolve(c, _ordered_segments(spark), _works(spark), chapters, keep=kept)
    return found.select("title", "line_index", "target_ref", "relative_direction")


@query(f"""WITH {NUMBERS} SELECT p_partkey, list_extract(['self', 'other', 'self', NULL, 'ambiguous', 'ambiguous', NULL, 'other'], (f + 1)::INTEGER) AS writer, CASE WHEN f = 1 THEN 'Rashi' END AS commentary FROM p""")
def governing_writers(spark, d):
    """Writers before and after a printed leaf: the source itself, a commentary, perhaps one, and none."""
    before = by_form(F.lit("פירשתי לעיל "), F.lit('רש"י פירש בפרק קמא '), F.lit(""), F.lit("אמרינן התם "), F.lit("כתב לעיל "), F.lit("פירשתי דבר אחר "), F.lit(""), F.lit("הרב כתב שפירשתי לעיל "))
    after = by_form(F.lit(""), F.lit(""), F.lit(" כתבתי שם"), F.lit(""), F.lit(""), F.lit(""), F.lit(' רש"י לא פירש'), F.lit(""))
    p = numbered(spark, d).withColumns({"before": before, "anchor": with_("(דף ", F.col("s"), ".)")})
    content = F.concat("before", "anchor", after)
    g = attribution.governing(content, F.length("before"), F.length("before") + F.length("anchor"))
    return p.select("p_partkey", g.alias("g")).select("p_partkey", "g.writer", "g.commentary")


@query("""WITH s AS (SELECT p_brand AS title, p_partkey AS place, p_name || ' ' || p_partkey AS segment FROM part WHERE p_size % 3 <> 0),
c AS (SELECT o_orderkey::VARCHAR AS ref, 'Brand#' || (o_orderkey % 5 + 1) || (o_custkey % 5 + 1) AS title, o_custkey AS a, o_custkey + o_orderkey % 60 AS b FROM orders)
SELECT ref, arg_min(segment, place) AS first, arg_max(segment, place) AS last FROM c JOIN s ON c.title = s.title AND place BETWEEN a AND b GROUP BY ref""")
def chapter_ends(spark, d):
    """Intervals trimmed to the first and last place with text."""
    segments = read(spark, d, "part").select(with_(F.col("p_name"), " ", F.col("p_partkey").cast("string")).alias("ref"), F.col("p_brand").alias("title"), F.col("p_partkey").alias("place"), (F.col("p_size") % 3 != 0).alias("has_text"))
    title = with_("Brand#", (F.col("o_orderkey") % 5 + 1).cast("string"), (F.col("o_custkey") % 5 + 1).cast("string"))
    refs = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("ref"), title.alias("title"), F.col("o_custkey").alias("start"), (F.col("o_custkey") + F.col("o_orderkey") % 60).alias("end"))
    return recover.chapter_content(refs, segments)
