"""Quotations as evidence: a positional inverted index of word pairs (or longer phrases), read along diagonals.

Each pair of adjoining words of the corpus is a posting (pair, work, place). A quotation's pairs meet postings of the same pair; those
with one difference of places lie on a diagonal, and what is consecutive there is a stretch that both have word for word. So one index answers
phrases of any length from two words on: n words are n - 1 pairs in a row. Pairs are compared as text, not by hashes. Where only stretches of
`width` words or more are wanted, postings of so many words find the same ones, and frequent pairs meet nothing.

Corpus: work, order (of segments in a work), ref, words. Quotes: a key, words. An empty side gives an empty result; a null or one-word quotation has
no pairs; equal quotations under different keys are answered each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlink.functions import numerals, text
from spanlink.operators import recover
from spanlink.operators.recover import KEY, anchor

#: Words that make a phrase evidence; words beside a citation that count, before and after it.
PHRASE, BEFORE, AFTER = 4, 24, 8
#: "There", twice at most, with a chapter's and a verse's numbers or a verse's alone; a fixed pattern of the language of citations.
THERE_VERSE = r"^((?:שם|התם)(?: שם)?),? (פסוק )?([א-ת]{1,2}['\"]?[א-ת]?)(?:,? ([א-ת]{1,2}['\"]?[א-ת]?))?$"
#: An abbreviated quotation's ending, and what begins one; fixed patterns.
ELLIPSIS = r"""\s+וג(?:ו['"׳״]|ומר)\s*[,;]?\s*$"""
INTRODUCED = r"""^.*(?:[,.;:!?()\[\]]|(?<![א-ת])(?:ו?שנאמר|דכתיב|כדכתיב|שהרי\s+הוא\s+אומר|ו?שנא['"׳״]|(?:מה\s+)?שכתיב|שכתוב)(?![א-ת]))"""


def postings(corpus: DataFrame, width: int = 2) -> DataFrame:
    """(pair, work, at, ref, left): at: place in the work; ref: where the first word is; left: words of that segment from there on.

    Pairs (phrases of `width` words) go over the ends of segments, as the text does.
    """
    before = Window.partitionBy("work").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    placed = corpus.where(F.size("words") > 0).withColumn("from", F.coalesce(F.sum(F.size("words")).over(before), F.lit(0)))
    each = placed.select("work", "ref", "from", F.size("words").alias("n"), F.posexplode("words").alias("k", "word"))
    each = each.select("work", "ref", "word", (F.col("from") + F.col("k")).alias("at"), (F.col("n") - F.col("k")).alias("left"))
    along = Window.partitionBy("work").orderBy("at")
    following = each.withColumns({f"next{k}": F.lead("word", k).over(along) for k in range(1, width)})
    pair = F.concat_ws(" ", "word", *[f"next{k}" for k in range(1, width)])
    return following.where(F.col(f"next{width - 1}").isNotNull()).select(pair.alias("pair"), "work", "at", "ref", "left")


def stretches(quotes: DataFrame, index: DataFrame, keys: list[str], width: int = 2) -> DataFrame:
    """(keys, work, q, at, length): longest stretches of `width` words and more that a quotation has in common with a work; q: place in the quotation.

    index: postings of that width.
    """
    pairs = F.transform(F.sequence(F.lit(0), F.size("words") - width), lambda k: F.array_join(F.slice("words", k + 1, width), " "))
    asked = quotes.where(F.size("words") >= width).select(*keys, F.posexplode(pairs).alias("q", "pair"))
    met = asked.join(index.select("pair", "work", "at"), "pair").withColumn("diagonal", F.col("at") - F.col("q"))
    row = F.row_number().over(Window.partitionBy(*keys, "work", "diagonal").orderBy("q"))
    runs = met.withColumn("run", F.col("q") - row).groupBy(*keys, "work", "diagonal", "run").agg(F.min("q").alias("q"), F.count("*").alias("pairs"))
    return runs.select(*keys, "work", "q", (F.col("q") + F.col("diagonal")).alias("at"), (F.col("pairs") + width - 1).alias("length"))


def phrases(found: DataFrame, keys: list[str], width: int = PHRASE) -> DataFrame:
    """(keys, q, work, at, in_work, in_all): the phrases of `width` words in stretches, with how often the work and all works have them."""
    steps = F.explode(F.sequence(F.lit(0), F.col("length") - width)).alias("k")
    each = found.where(F.col("length") >= width).select(*keys, "work", "q", "at", steps).select(*keys, "work", (F.col("q") + F.col("k")).alias("q"), (F.col("at") + F.col("k")).alias("at"))
    count = lambda *by: F.count("*").over(Window.partitionBy(*keys, "q", *by))
    return each.withColumns({"in_work": count("work"), "in_all": count()})


def printed(rows: DataFrame) -> DataFrame:
    """Rows whose anchor is "there" with numbers of a verse, or of a chapter and a verse: with theres and numbers."""
    plain = F.btrim(recover.part_text(F.struct(text.bare(anchor()).alias("text"))), F.lit(" ()[]"))
    c = rows.withColumn("plain", plain).where(F.col("plain").rlike(THERE_VERSE))
    group = lambda k: F.regexp_extract("plain", THERE_VERSE, k)
    letters = F.transform(F.filter(F.array(group(3), group(4)), lambda t: t != ""), lambda t: F.regexp_replace(t, "[^א-ת]", ""))
    c = c.withColumns({"theres": F.size(F.split(group(1), " ")), "letters": letters, "verse_only": group(2) != ""})
    fine = F.forall("letters", numerals.is_canonical_numeral) & ~(F.col("verse_only") & (F.size("letters") == 2)) & ~((F.col("theres") == 2) & (F.size("letters") == 2))
    return c.where(fine).withColumn("numbers", F.transform("letters", numerals.numeral)).drop("plain", "letters", "verse_only")


def _verse(title: Column, numbers: Column) -> Column:
    return F.concat(title, F.lit(" "), F.array_join(F.transform(numbers, lambda n: n.cast("string")), ":"))


def _sides(rows: DataFrame) -> DataFrame:
    """(KEY, side, words): quotation words that adjoin a citation before (0) and after it (1), and an abbreviated quotation as a whole (2)."""
    near = text.adjoining_quote_words(F.col("content"), F.col("start"), F.col("end"), BEFORE, AFTER)
    head = F.rtrim(F.regexp_replace(F.regexp_replace(F.substring("content", F.lit(1), F.col("start")), text.QUOTED_TAG, " "), r"[ (\[]+$", ""))
    short = F.when(head.rlike(ELLIPSIS), text.quote_words(F.regexp_replace(F.regexp_replace(head, ELLIPSIS, ""), INTRODUCED, "")))
    c = rows.withColumns({"near": near, "short": short})
    side = lambda k, words: c.select(*KEY, F.lit(k).alias("side"), words.alias("words"))
    return side(0, F.col("near.before")).unionByName(side(1, F.col("near.after"))).unionByName(side(2, F.col("short")).where(F.size("words").between(2, 8)))


def evidence(citations: DataFrame, corpus: DataFrame, works: DataFrame) -> DataFrame:
    """(KEY, ref, decides) of verses that the words beside "there" with printed numbers quote.

    A phrase of four words that its work has once is evidence for the verse that holds it. It decides by itself if no other work has it
    either, all such phrases are of one work, and the printed numbers are that verse's: two numbers name it, a single one must agree with a
    candidate. An abbreviated quotation of two to eight words decides as a whole, for candidates only. A clause that names another
    work, the quotation left aside, decides nothing.
    """
    labels = recover.labels()
    rows = printed(citations.where(F.array_contains(labels, "IBID") & ~F.arrays_overlap(labels, F.array(F.lit("NAMED"), F.lit("DH")))))
    sides = _sides(rows)
    index = postings(corpus)
    found = stretches(sides, index, [*KEY, "side"])
    places = index.select("work", "at", "ref", "left")
    four = phrases(found.where("side < 2"), [*KEY, "side"]).where("in_work = 1").join(places, ["work", "at"]).where(F.col("left") >= PHRASE)
    four = four.join(sides, [*KEY, "side"]).withColumn("phrase", F.array_join(F.slice("words", F.col("q") + 1, PHRASE), " "))
    proofs = four.groupBy(*KEY, "work", "ref").agg(F.max(F.col("in_all") == 1).alias("alone"), F.lit(False).alias("short"))
    whole = found.where("side = 2").join(sides.where("side = 2").select(*KEY, F.size("words").alias("n")), KEY).where("length = n")
    once = F.count("*").over(Window.partitionBy(*KEY)) == 1
    whole = whole.withColumn("once", once).where("once").join(places, ["work", "at"]).where(F.col("left") >= F.col("n"))
    proofs = proofs.unionByName(whole.select(*KEY, "work", "ref", F.lit(True).alias("alone"), F.lit(True).alias("short")))

    works_of = F.size(F.collect_set(F.when(F.col("alone") & ~F.col("short"), F.col("work"))).over(Window.partitionBy(*KEY)))
    c = proofs.withColumn("works", works_of).join(rows.select(*KEY, "content", "start", "numbers", "theres", "candidates"), KEY)
    offered = F.exists("candidates", lambda r: r == F.col("ref"))
    last = F.substring_index(F.col("ref"), ":", -1) == F.try_element_at("numbers", F.lit(-1)).cast("string")
    named = F.col("ref") == _verse(F.col("work"), F.col("numbers"))
    by_phrase = ~F.col("short") & F.col("alone") & (F.col("works") == 1) & F.when(F.size("numbers") == 2, named).otherwise(offered & last)
    by_whole = F.col("short") & offered & last & F.when(F.size("numbers") == 2, named & (F.col("theres") == 1)).otherwise(F.col("theres") == 2)
    c = c.withColumn("fits", by_phrase | by_whole)
    said = four.select(*KEY, "phrase").unionByName(sides.where("side = 2").select(*KEY, F.array_join("words", " ").alias("phrase")))
    quoted = said.groupBy(*KEY).agg(F.collect_set("phrase").alias("quoted"))
    head = F.regexp_replace(F.substring("content", F.lit(1), F.col("start")), r"[ (\[]+$", "")  # what opens the citation's own bracket
    clause = text.unquoted(text.clause_before(head, F.length(head), 65), F.col("quoted"))
    asked = c.where("fits").join(quoted, KEY).select(*KEY, F.col("work").alias("own_title"), clause.alias("tokens")).distinct()
    elsewhere = recover.names_elsewhere(asked, works).withColumn("elsewhere", F.lit(True))
    c = c.join(elsewhere, KEY, "left").withColumn("fits", F.col("fits") & F.col("elsewhere").isNull())
    verses = F.size(F.collect_set(F.when(F.col("fits"), F.col("ref"))).over(Window.partitionBy(*KEY)))
    return c.withColumn("decides", F.col("fits") & (verses == 1)).groupBy(*KEY, "ref").agg(F.max("decides").alias("decides"))
