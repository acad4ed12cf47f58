"""Citations that the resolver couldn't decide, rebuilt from what they spell; each rule is a join with catalogs and gives (.., ref).

Citations: LINE, pos, content, start, end (code points), parts array<struct<label,text,start,end>> (relative to start), candidates
array<string> (empty: failed). Own places come as own_title and own_he (the tractate that the source's book is or comments on),
section and section_last (sides of leaves, numbered). Works: title, aliases array<string>, category. Segments: ref, title,
has_text. Chapters: title, name, first, last (sides). A rule keeps a citation only when exactly one existing target follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions import addresses, numerals
from spanlink.functions.rules import title_of
from spanlink.functions.text import QUOTED_TAG, clause_before, plain_quotes, without_vowels
from spanlink.operators.catalog import unambiguous
from spanlink.schemas import LINE

KEY = [*LINE, "pos"]
#: One printed side in a list, a fixed pattern: that of an address, without groups.
CHAPTER_SIDE = "(?:דף\\s+|ד['׳]\\s*)?(?:[א-ת]{1,3}|[א-ת]{1,2}[\"״][א-ת]|[א-ת]['׳])(?:\\s*(?:[.:])|\\s*,\\s*(?:[אב])|\\s+ע[\"״](?:[אב]))"
# fixed values: parts and authors of notes on codes, the whole note (part, chapter, note), the author at the end of a clause, what may be before him
CODE_PARTS = {'יו"ד': "Yoreh De'ah", 'חו"מ': "Choshen Mishpat"}
CODE_AUTHORS = {'ש"ך': "Siftei Kohen", 'ט"ז': "Turei Zahav"}
CODE_NOTE = r"""^ו?ב?(יו["]ד|חו["]מ)\s+(?:(?:סימן|סי['"]?)\s+)?([א-ת'"]{1,7})\s+(?:ס["]ק\s*|סק["]?\s*|סעיף\s+קטן\s+)([א-ת'"]{1,7})$"""
CODE_AUTHOR = r"""(?<![א-ת])ו?[כשה]?(?:ה)?(ש["]ך|ט["]ז)(?:\s+ז["]ל)?(?:\s+שם)?(?:\s+בסי'\s+הנ["]ל)?$"""
CODE_LEAD = "^$|(?:כתב|ועיין|ועי'|ולא|קושית|קושיית)$"


def anchor() -> Column:
    return F.expr("substring(content, start + 1, end - start)")


def labels() -> Column:
    return F.transform("parts", lambda p: p["label"])


def part_text(part: Column) -> Column:
    return without_vowels(plain_quotes(part["text"]))


def side_ref(title: Column, daf: Column, side: Column) -> Column:
    return F.concat(title, F.lit(" "), daf.cast("string"), side)


def alias_titles(works: DataFrame, categories: list[str]) -> DataFrame:
    """(alias, work) of the aliases that name one work of these categories, and no other work at all."""
    each = works.select(F.col("title").alias("work"), F.explode("aliases").alias("alias"))
    only = unambiguous(each, ["alias"], "work")
    return only.join(works.where(F.col("category").isin(categories)).select(F.col("title").alias("work")).distinct(), "work", "left_semi")


def existing(found: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows whose ref has text itself or, for a whole leaf or side, in some segment below."""
    have = segments.where("has_text").select(F.explode(F.array_distinct(F.array(F.col("ref"), F.regexp_replace("ref", ":[0-9:]+$", ""), F.regexp_replace("ref", "[ab](:[0-9:]+)?$", "")))).alias("ref"))
    return found.join(have.distinct(), "ref", "left_semi")


def one_ref(found: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The rows of citations that are left with a single ref."""
    kept = unambiguous(found, keys, "ref")
    return found.join(kept, [*keys, "ref"], "left_semi").dropDuplicates([*keys, "ref"])


def split_verses(citations: DataFrame, works: DataFrame, segments: DataFrame) -> DataFrame:
    """A failed list of two to four `title chapter verse` groups, cut at its commas: (KEY, k, start, end, ref); all groups or none."""
    shape = F.array_join(labels(), ",").rlike("^NAMED,NUMBERED,NUMBERED(?:,NAMED,NUMBERED,NUMBERED){1,3}$")
    c = citations.where((F.size("candidates") == 0) & shape).withColumn("groups", (F.size("parts") / 3).cast("int"))
    part = lambda k: F.get("parts", k)
    between = F.transform(F.sequence(F.lit(1), F.col("groups") - 1), lambda k: F.substring(F.col("content"), F.col("start") + part(3 * k - 1)["end"] + 1, part(3 * k)["start"] - part(3 * k - 1)["end"]))
    c = c.where(F.forall(between, lambda gap: gap.rlike(r"^\s*[,;]\s*$")))
    g = c.select(*KEY, "groups", "start", "parts", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("k"))
    name, chapter, verse = (part_text(part(3 * F.col("k") + n)) for n in range(3))
    fine = [x.rlike(f"^{addresses.GERESH_NUMERAL}$") & numerals.is_canonical_numeral(F.regexp_replace(x, "[^א-ת]", "")) for x in (chapter, verse)]
    number = lambda x: numerals.numeral(F.regexp_replace(x, "[^א-ת]", "")).cast("string")
    span = ((F.col("start") + part(3 * F.col("k") + n)[e]).alias(e) for n, e in ((0, "start"), (2, "end")))
    read = g.where(fine[0] & fine[1]).select(*KEY, "groups", "k", *span, name.alias("alias"), F.concat_ws(":", number(chapter), number(verse)).alias("at"))
    found = _verses(read, works, segments)
    whole = F.count("*").over(Window.partitionBy(*KEY)) == F.col("groups")
    return found.withColumn("whole", whole).where("whole").select(*KEY, "k", "start", "end", "ref")


def _verses(read: DataFrame, works: DataFrame, segments: DataFrame) -> DataFrame:
    named = read.join(alias_titles(works, ["Tanakh"]), "alias")
    return existing(named.withColumn("ref", F.concat_ws(" ", "work", "at")), segments)


def geresh_verses(citations: DataFrame, works: DataFrame, segments: DataFrame) -> DataFrame:
    """(KEY, ref) of failed anchors like "Psalms 18' 31'": a geresh after several letters; the shorter title is tried first."""
    c = citations.where(F.size("candidates") == 0).select(*KEY, F.posexplode(addresses.geresh_citation(anchor())).alias("k", "r"))
    at = F.concat_ws(":", F.col("r.chapter").cast("string"), F.col("r.verse").cast("string"))
    found = _verses(c.select(*KEY, "k", F.col("r.title").alias("alias"), at.alias("at")), works, segments)
    return found.groupBy(*KEY).agg(F.min(F.struct("k", "ref")).alias("b")).select(*KEY, "b.ref")


def own_relative(citations: DataFrame, segments: DataFrame) -> DataFrame:
    """(KEY, ref, direction): a pointing word with one address, and at most the own title, within a tractate or its commentary.

    A side alone is of the leaf that the source is on, if it is on one side only. The target must lie where the word says.
    """
    c = citations.where("own_title is not null and section is not null")
    c = c.withColumn("a", addresses.relative_address(anchor(), F.col("own_he"))).where("a is not null and (not a.own_leaf or section = section_last)")
    c = c.withColumn("daf", F.when(F.col("a.own_leaf"), numerals.daf_of(F.col("section"))).otherwise(F.col("a.daf")))
    target = numerals.amud(F.col("daf"), F.col("a.side"))
    on_side = F.when(F.col("a.direction") == "above", target < F.col("section")).otherwise(target > F.col("section_last"))
    return existing(c.where(on_side).select(*KEY, side_ref(F.col("own_title"), F.col("daf"), F.col("a.side")).alias("ref"), F.col("a.direction").alias("direction")), segments)


def names_elsewhere(citations: DataFrame, works: DataFrame) -> DataFrame:
    """KEYs whose clause before the anchor names a work other than own_title, with or without a prefix, or is over 64 words long.

    Aliases are met by their first word and then compared whole, so names of any length are found. Words of clauses may come as `tokens`.
    """
    head = F.regexp_replace(plain_quotes(F.col("content").substr(F.lit(1), F.col("start"))), r"[ (\[]+$", "")  # what opens the citation's own bracket
    tokens = F.col("tokens") if "tokens" in citations.columns else F.transform(clause_before(head, F.length(head), 65), lambda w: F.btrim(w, F.lit("(),;:.[]")))
    c = citations.select(*KEY, "own_title", tokens.alias("tokens"))
    long = c.where(F.size("tokens") > 64).select(*KEY)
    each = c.where("size(tokens) <= 64").select(*KEY, "own_title", "tokens", F.posexplode("tokens").alias("at", "token"))
    first = F.explode(F.array(F.col("token"), *[F.when(F.startswith("token", F.lit(p)), F.substring("token", len(p) + 1, 1000)) for p in addresses.LEAD_PREFIXES if p])).alias("first")
    begun = each.select(*KEY, "own_title", "tokens", "at", first).where("first <> ''")
    aliases = works.select(F.col("title").alias("work"), F.explode("aliases").alias("alias")).distinct().withColumn("words", F.split("alias", " "))
    met = begun.join(aliases.withColumn("first", F.get("words", 0)), "first").where("work <> own_title")
    rest = lambda n: F.slice("tokens", F.col("at") + 2, n)
    whole = rest(F.size("words") - 1) == F.slice("words", 2, F.size("words") - 1)
    other = met.where((F.size("words") == 1) | F.coalesce(whole, F.lit(False))).select(*KEY)
    return other.unionByName(long).distinct()


def in_tractate(ref: Column, tractate: Column) -> Column:
    title = title_of(ref)
    return (title == tractate) | F.endswith(title, F.concat(F.lit(" on "), tractate))


def own_daf(citations: DataFrame, works: DataFrame, segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """(KEY, ref): an untitled side that all candidates read in the own tractate or its commentaries.

    A chapter that leads it must hold it, the own one also the source. A citation that lies next to it, at most three words away, or
    that "there" refers to must be in the same tractate, and the clause before must name no other work.
    """
    before = Window.partitionBy(*LINE).orderBy("start")
    c = citations.withColumn("p_end", F.lag("end").over(before)).withColumn("p_refs", F.lag("candidates").over(before)).where("own_title is not null")
    c = c.withColumn("a", addresses.own_daf_anchor(anchor())).where(F.col("a").isNotNull() & (F.size("candidates") > 0))
    leaf = F.concat(F.col("a.daf").cast("string"), F.col("a.side"))
    same = F.forall("candidates", lambda r: in_tractate(r, F.col("own_title")) & (F.substring_index(F.substring_index(r, " ", -1), ":", 1) == leaf))
    gap = F.when(F.col("p_end").isNotNull(), F.btrim(plain_quotes(F.expr("substring(content, p_end + 1, start - p_end)")), F.lit(" ()[].,:;-–")))
    near = F.coalesce(F.size(F.array_remove(F.split(gap, " "), "")) <= 3, F.lit(False)) | F.array_contains(labels(), "IBID")
    follows = F.coalesce(F.size("p_refs") > 0, F.lit(False)) & F.forall(F.coalesce("p_refs", F.array().cast("array<string>")), lambda r: in_tractate(r, F.col("own_title")))
    c = c.where(same & (~near | follows)).join(names_elsewhere(citations.where("own_title is not null"), works), KEY, "left_anti")
    target = numerals.amud(F.col("a.daf"), F.col("a.side"))
    c = c.select(*KEY, "own_title", "section", F.col("a.chapter").alias("chapter"), target.alias("target"), side_ref(F.col("own_title"), F.col("a.daf"), F.col("a.side")).alias("ref"))
    # one pass for both: what no chapter leads goes past the join
    named = _of_works(chapters).select(F.col("work").alias("led_title"), "name", "first", "last")
    led = c.join(named, F.col("chapter").isNotNull() & (F.col("own_title") == F.col("led_title")), "left")
    own = F.col("chapter").rlike(f"^{addresses.OWN_CHAPTER}$") & F.col("section").between(F.col("first"), F.col("last"))
    holds = F.col("target").between(F.col("first"), F.col("last")) & (own | F.array_contains(addresses.lead_names(F.col("chapter")), F.col("name")))
    return existing(led.where(F.col("chapter").isNull() | holds).select(*KEY, "ref").distinct(), segments)


def _of_works(chapters: DataFrame) -> DataFrame:
    return chapters.select(F.col("title").alias("work"), "name", "first", "last")


def _addressed(found: DataFrame, works: DataFrame) -> DataFrame:
    """(.., work, section, section_last, ref) of (.., alias, address): one side, or a whole leaf of both."""
    whole = F.regexp_extract("address", f"^(?:דף\\s+)?({addresses.UNTITLED_DAF})$", 1)
    letters = F.regexp_replace(whole, "[^א-ת]", "")
    side = addresses.daf_address(F.col("address"))
    daf = F.coalesce(side["daf"], F.when(numerals.is_canonical_numeral(letters), numerals.numeral(letters)))
    c = found.join(alias_titles(works, ["Talmud"]), "alias").withColumn("daf", daf).withColumn("side", side["side"]).where("daf is not null")
    first, last = numerals.amud(F.col("daf"), F.coalesce("side", F.lit("a"))), numerals.amud(F.col("daf"), F.coalesce("side", F.lit("b")))
    return c.withColumn("section", first).withColumn("section_last", last).withColumn("ref", F.concat_ws(" ", "work", F.concat(F.col("daf").cast("string"), F.coalesce("side", F.lit("")))))


def parenthesized(citations: DataFrame, works: DataFrame, segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """(KEY, start, end, ref) of failed citations whose one parenthesis spells a title and an address, after parts that only locate it.

    A chapter that the lead names may narrow a whole leaf to its side, but not drop it.
    """
    text = anchor()
    paren = F.instr(text, "(") - 1
    c = citations.where((F.size("candidates") == 0) & (F.regexp_count(text, F.lit("[(]")) == 1) & ~F.contains(text, F.lit(")"))).withColumn("paren", paren)
    lead, inner = F.filter("parts", lambda p: p["start"] <= F.col("paren")), F.filter("parts", lambda p: p["start"] > F.col("paren"))
    c = c.withColumn("lead", lead).withColumn("inner", inner)
    locates = F.forall("lead", lambda p: (p["end"] <= F.col("paren")) & ((p["label"] == "RELATIVE") | ((p["label"] == "NAMED") & F.trim(part_text(p)).rlike(addresses.CHAPTER_LEAD))))
    kinds = F.transform("inner", lambda p: p["label"])
    c = c.where((F.size("lead") > 0) & locates & (F.array_join(kinds, ",").rlike("^NAMED,NUMBERED$")))
    first, last = F.col("inner")[0], F.try_element_at("inner", F.lit(-1))
    c = c.select(*KEY, "content", F.col("start").alias("from"), part_text(first).alias("alias"), part_text(last).alias("address"), F.expr("substring(content, start + 1, paren)").alias("lead"), (F.col("start") + first["start"]).alias("start"), (F.col("start") + last["end"]).alias("end"))
    return existing(narrowed(_addressed(c, works), chapters, must=False), segments).select(*KEY, "start", "end", "ref")


def chapter_led(citations: DataFrame, works: DataFrame, segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """(KEY, ref) of failed "chapter X of <title> leaf N" citations: title and address are read alone, and the chapter must hold them."""
    shape = F.array_join(labels(), ",").rlike("^(?:NAMED,)+NUMBERED$") | (F.array_join(labels(), ",") == "NAMED,NUMBERED")
    c = citations.where((F.size("candidates") == 0) & shape & ~F.contains(anchor(), F.lit("(")))
    named = F.get("parts", F.size("parts") - 2)
    text = part_text(named)
    # the title is the whole part, if a lead is before it, or its tail from a word that begins with a dalet, without that
    words = F.split(text, " ")
    tails = F.transform(F.filter(F.sequence(F.lit(1), F.size(words)), lambda k: F.coalesce(F.startswith(F.get(words, k), F.lit("ד")), F.lit(False))), lambda k: F.struct(F.array_join(F.slice(words, 1, k), " ").alias("lead"), F.substring(F.array_join(F.slice(words, k + 1, 1000), " "), 2, 1000).alias("alias")))
    before = F.array_join(F.transform(F.slice("parts", 1, F.greatest(F.size("parts") - 2, F.lit(0))), part_text), " ")
    whole = F.when(F.size("parts") > 2, F.struct(before.alias("lead"), text.alias("alias")))
    splits = F.array_compact(F.concat(F.array(whole), F.transform(tails, lambda t: F.struct(F.trim(F.concat_ws(" ", before, t["lead"])).alias("lead"), t["alias"].alias("alias")))))
    c = c.select(*KEY, "content", "start", "end", part_text(F.try_element_at("parts", F.lit(-1))).alias("address"), F.explode(splits).alias("s")).select(*KEY, "content", "start", "end", "address", "s.*")
    found = existing(narrowed(_addressed(c, works), chapters, must=True), segments)
    return one_ref(found.select(*KEY, "ref"))


def narrowed(found: DataFrame, chapters: DataFrame, must: bool) -> DataFrame:
    """Rows (.., content, end, lead, work, daf, side, section, section_last, ref) with a whole leaf narrowed to its one side in the named chapters.

    must: rows that no named chapter holds go. A side that the text writes after the leaf must be the one that is left.
    """
    named = found.withColumn("name", F.explode(addresses.lead_names(F.col("lead")))).join(_of_works(chapters), ["work", "name"]).where("first <= section_last and section <= last")
    spans = named.groupBy(*KEY, "ref").agg(F.max((F.col("first") <= F.col("section")) & (F.col("section") <= F.col("last"))).alias("has_a"), F.max((F.col("first") <= F.col("section_last")) & (F.col("section_last") <= F.col("last"))).alias("has_b"))
    met = found.join(spans, [*KEY, "ref"], "inner" if must else "left")
    only = F.when(F.col("side").isNull() & (F.col("has_a") != F.col("has_b")), F.when(F.col("has_a"), "a").otherwise("b"))
    written = addresses.side_after(F.col("content"), F.col("end"))["side"]
    met = met.withColumn("only", only).where(F.col("only").isNull() | written.isNull() | (written == F.col("only")))
    return met.withColumn("ref", F.concat("ref", F.coalesce("only", F.lit("")))).drop("has_a", "has_b", "only")


def chapter_lists(citations: DataFrame, works: DataFrame, segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """(KEY, k, start, end, ref): a named chapter with one to four printed sides in its parenthesis, each a citation of its own; all or none.

    The chapter's name must be of one tractate: the one that the lead names too, or the only one that has it.
    """
    text = anchor()
    opening = F.instr(text, "(")
    lead = without_vowels(plain_quotes(F.substring(text, F.lit(1), opening - 1)))
    body = F.regexp_replace(F.substring(text, opening + 1, F.length(text)), "[ )]+$", "")
    one = CHAPTER_SIDE
    c = citations.where(F.contains(text, F.lit("(")) & ~F.arrays_overlap(labels(), F.array(*[F.lit(x) for x in ("RELATIVE", "IBID", "DH")])) & (F.regexp_count(text, F.lit("[(]")) == 1) & body.rlike(rf"^\s*(?:{one})(?:\s*[.;]\s*(?:{one})){{0,3}}$"))
    printed, gaps = F.regexp_extract_all(body, F.lit(one), F.lit(0)), F.split(body, one, -1)
    before = lambda k: F.aggregate(F.slice("printed", 1, k), F.lit(0), lambda n, x: n + F.length(x)) + F.aggregate(F.slice("gaps", 1, k + 1), F.lit(0), lambda n, x: n + F.length(x))
    c = c.withColumns({"printed": printed, "gaps": gaps, "from": F.col("start") + opening})
    sides = F.transform("printed", lambda t, k: F.struct(addresses.daf_address(t).alias("a"), (F.col("from") + before(k)).alias("start"), (F.col("from") + before(k) + F.length(t)).alias("end")))
    c = c.select(*KEY, lead.alias("lead"), sides.alias("at")).where(F.forall("at", lambda x: x["a"].isNotNull()))
    titles = works.where("category = 'Talmud'").select(F.col("title").alias("work"), F.explode("aliases").alias("alias"))
    chapters = _of_works(chapters)
    # "<chapter> [of] <title>" or the chapter alone
    words = F.split("lead", " ")
    cuts = F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.struct(F.array_join(F.slice(words, 1, k), " ").alias("lead"), F.regexp_replace(F.array_join(F.slice(words, k + 1, 1000), " "), "^ד?(?:מסכת )?", "").alias("alias")))).alias("s")
    read = c.select(*KEY, "at", cuts).select(*KEY, "at", "s.*").where(F.col("lead").rlike(addresses.CHAPTER_LEAD))
    named = read.withColumn("name", F.explode(addresses.lead_names(F.col("lead"))))
    explicit = named.where("alias <> ''").join(titles, "alias").join(chapters, ["work", "name"])
    alone = named.where("alias = ''").join(chapters, "name").join(explicit.select(*KEY).distinct(), KEY, "left_anti")
    met = explicit.select(*KEY, "at", "work", "first", "last").unionByName(alone.select(*KEY, "at", "work", "first", "last"))
    met = met.join(unambiguous(met, KEY, "work"), [*KEY, "work"], "left_semi")
    each = met.select(*KEY, F.size("at").alias("n"), "work", "first", "last", F.posexplode("at").alias("k", "x")).select("*", "x.*").where(numerals.amud(F.col("a.daf"), F.col("a.side")).between(F.col("first"), F.col("last")))
    found = existing(each.select(*KEY, "n", "k", "start", "end", side_ref(F.col("work"), F.col("a.daf"), F.col("a.side")).alias("ref")).distinct(), segments)
    return found.withColumn("whole", F.count("*").over(Window.partitionBy(*KEY)) == F.col("n")).where("whole").select(*KEY, "k", "start", "end", "ref")


def code_commentary(citations: DataFrame, segments: DataFrame) -> DataFrame:
    """(KEY, ref): a note on a code by its own author. candidates: the code itself, alone.

    The whole anchor must read as part, chapter and note, both numbers spelled as usual, and one of the two authors must end the clause
    before it, after nothing or after a word that hands over to him.
    """
    visible = lambda x: without_vowels(plain_quotes(F.regexp_replace(x, QUOTED_TAG, " ")))
    # every form of the note has this letter
    said = citations.where((F.size("candidates") == 1) & F.contains(anchor(), F.lit("ק"))).select(
        *KEY, F.get("candidates", 0).alias("code"), F.btrim(visible(anchor()), F.lit(" ()[]")).alias("note"), visible(F.substring("content", F.lit(1), F.col("start"))).alias("ahead")
    )
    clause = F.trim(F.regexp_extract(F.regexp_replace("ahead", r"[ (\[]+$", ""), r"([^.:;()\[\]]*)$", 1))
    read = said.withColumns({"clause": clause, "part": F.regexp_extract("note", CODE_NOTE, 1), "numbers": F.transform(F.array(*[F.regexp_extract("note", CODE_NOTE, k) for k in (2, 3)]), lambda t: F.regexp_replace(t, "[^א-ת]", ""))})
    read = read.withColumns({"author": F.regexp_extract("clause", CODE_AUTHOR, 1), "lead": F.trim(F.regexp_replace("clause", CODE_AUTHOR, ""))})
    read = read.where((F.col("part") != "") & (F.col("author") != "") & F.forall("numbers", numerals.is_canonical_numeral) & F.col("lead").rlike(CODE_LEAD))
    spell = lambda names, key: F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), key)
    code = F.concat(F.lit("Shulchan Arukh, "), spell(CODE_PARTS, F.col("part")))
    at = F.array_join(F.transform("numbers", lambda n: numerals.numeral(n).cast("string")), ":")
    target = F.concat(spell(CODE_AUTHORS, F.col("author")), F.lit(" on "), code, F.lit(" "), at)
    found = read.where(title_of(F.col("code")) == code).select(*KEY, target.alias("ref"))
    return found.join(segments.where("has_text").select("ref").distinct(), "ref", "left_semi")


def chapter_content(refs: DataFrame, segments: DataFrame) -> DataFrame:
    """(ref, first, last): the first and last segments with text inside a chapter (ref, title, start, end: places); none if it has none.

    Both ends are as-of lookups: segments and ends of chapters lie in one order per title, and the last segment passed is carried
    along, so a chapter costs two rows however many segments it holds.
    """
    have = segments.where("has_text").select("title", "place", F.lit(0).alias("asks"), F.struct("place", F.col("ref").alias("segment")).alias("held"), F.lit(None).cast("string").alias("ref"))

    def nearest(end: str, order: list[Column]) -> DataFrame:
        asked = refs.select("title", F.col(end).alias("place"), F.lit(1).alias("asks"), F.lit(None).cast(have.schema["held"].dataType).alias("held"), "ref")
        passed = Window.partitionBy("title").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return have.unionByName(asked).withColumn("near", F.last("held", ignorenulls=True).over(passed)).where("asks = 1").select("ref", "title", F.col("near").alias(end))

    segment = F.col("held.segment")
    found = nearest("start", [F.col("place").desc(), "asks", segment.desc()]).join(nearest("end", [F.col("place"), "asks", segment]), ["ref", "title"])
    inside = found.where("start.place <= end.place").select("ref", F.col("start").alias("a"), F.col("end").alias("b"))
    ends = inside.groupBy("ref").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return ends.select("ref", F.col("a.segment").alias("first"), F.col("b.segment").alias("last"))


def preferred(candidates: Column, categories: Column) -> Column:
    """Opt-in choice among refs: a Babylonian tractate before the Jerusalem one of its name, the one Mishnah before the Talmud; else null."""
    jerusalem = F.lit("Jerusalem Talmud ")
    bavli = F.filter(candidates, lambda r: ~F.startswith(r, jerusalem))
    yeru = F.transform(F.filter(candidates, lambda r: F.startswith(r, jerusalem)), lambda r: F.replace(title_of(r), jerusalem, F.lit("")))
    both = F.arrays_zip(candidates.alias("r"), categories.alias("c"))
    mishnah, talmud = F.filter(both, lambda x: x["c"] == "Mishnah"), F.filter(both, lambda x: x["c"] == "Talmud")
    one = (F.size(bavli) == 1) & (F.size(yeru) > 0) & F.array_contains(yeru, title_of(F.get(bavli, 0)))
    return F.when(one, F.get(bavli, 0)).when((F.size(mishnah) == 1) & (F.size(talmud) > 0), F.get(mishnah, 0)["r"])


def positions(lines: DataFrame) -> DataFrame:
    """(LINE, section): the side of a leaf that each line of a paged book (stack array<string> of open headings) is on, if clear."""
    a = addresses.stack_address(F.col("stack"))
    return lines.select(*LINE, numerals.amud(a["daf"], a["side"]).alias("section")).where("section is not null")

