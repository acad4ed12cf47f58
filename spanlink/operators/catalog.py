"""Joins of mentions with catalogs of works, segments and chapters, under the rule that what is ambiguous is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def existing_targets(links: DataFrame, segments: DataFrame) -> DataFrame:
    """Links whose (title, section) is a segment with text."""
    return links.join(segments.select("title", "section").distinct(), ["title", "section"], "left_semi")


def existing_leaves(links: DataFrame, segments: DataFrame) -> DataFrame:
    """Links (title, section, to_section) that a whole leaf implies: either side's text is enough."""
    have = segments.select("title", F.col("section").alias("s")).distinct()
    sides = links.select("title", "section", "to_section").distinct().withColumn("s", F.explode(F.array_distinct(F.array("section", "to_section"))))
    return links.join(sides.join(have, ["title", "s"]).select("title", "section", "to_section").distinct(), ["title", "section", "to_section"], "left_semi")


def existing_ranges(links: DataFrame, segments: DataFrame) -> DataFrame:
    """Links (title, section, to_section) both ends of which have text."""
    have = segments.select("title", F.col("section")).distinct()
    return links.join(have, ["title", "section"], "left_semi").join(have.withColumnRenamed("section", "to_section"), ["title", "to_section"], "left_semi")


def overlapping(spans: DataFrame, intervals: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of spans and intervals (both keys, start, end inclusive) that overlap; interval columns come as i_start and i_end.

    Both sides are posted in buckets `width` wide, so that the join is an equi-join; a pair is kept in the first bucket that both touch.
    """
    both = intervals.withColumnRenamed("start", "i_start").withColumnRenamed("end", "i_end")
    a = spans.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    b = both.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("i_start") / width), F.floor(F.col("i_end") / width))))
    met = a.join(b, [*keys, "bucket"]).where("start <= i_end and i_start <= end")
    return met.where(F.col("bucket") == F.floor(F.greatest("start", "i_start") / width)).drop("bucket")


def unambiguous(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value) where the key has exactly one different value; all others are dropped."""
    return rows.groupBy(*keys).agg(F.count_distinct(value).alias("kinds"), F.min(value).alias(value)).where("kinds = 1").drop("kinds")


def alias_index(works: DataFrame, prefixes: list[str]) -> DataFrame:
    """(alias, titles): every alias of works (title, aliases), plain and behind a prefix, with the set of works it may mean."""
    each = works.select("title", F.explode("aliases").alias("name"))
    forms = F.explode(F.array(F.col("name"), *[F.concat(F.lit(p), F.col("name")) for p in prefixes]))
    return each.select("title", forms.alias("alias")).groupBy("alias").agg(F.array_sort(F.collect_set("title")).alias("titles"))


def longest_alias(mentions: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """For each mention (key, words array) the alias (alias, titles) that covers most of its first words.

    The words' leading stretches are exploded, so the join is on equality.
    """
    heads = F.explode(F.transform(F.sequence(F.lit(1), F.size("words")), lambda n: F.struct(n.alias("n"), F.array_join(F.slice("words", 1, n), " ").alias("alias"))))
    met = mentions.where(F.size("words") > 0).select(key, heads.alias("h")).select(key, "h.n", "h.alias").join(aliases, "alias")
    return met.groupBy(key).agg(F.max(F.struct("n", "alias", "titles")).alias("best")).select(key, "best.alias", "best.titles")


def windows_of(words: Column, width: int) -> Column:
    """All runs of `width` words, joined by spaces, with their positions."""
    last = F.size(words) - width
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.struct(k.alias("at"), F.array_join(F.slice(words, k + 1, width), " ").alias("phrase")))
    return F.when(last >= 0, each).otherwise(F.slice(each, 1, 0))


def unique_quotes(quotes: DataFrame, corpus: DataFrame, width: int = 4) -> DataFrame:
    """(quote_id, target): quotes (quote_id, words) whose phrases point to one place of the corpus (target, words) only.

    Only phrases that occur once in the corpus are evidence; a quote with evidence for several targets is dropped. Phrases meet as two
    hashes of 64 bits of their words. The corpus is counted by itself: it is the catalog, and small beside the quotes, whose own phrases
    are only looked up, and not shuffled at all where what is left of the corpus can be broadcast.
    """

    def each(rows: DataFrame, key: str) -> DataFrame:
        phrase = lambda k: [F.get("words", k + n) for n in range(width)]
        hashes = F.transform(F.sequence(F.lit(0), F.size("words") - width), lambda k: F.struct(F.xxhash64(*phrase(k)).alias("h1"), F.xxhash64(F.lit(1), *phrase(k)).alias("h2")))
        return rows.where(F.size("words") >= width).select(key, F.explode(hashes).alias("w")).select(key, "w.*")

    evidence = each(corpus, "target").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("target").alias("target")).where("n = 1").select("h1", "h2", "target")
    return unambiguous(each(quotes, "quote_id").join(evidence, ["h1", "h2"]), ["quote_id"], "target")


def direct_commentaries(bases: DataFrame, works: DataFrame, families: list[str]) -> DataFrame:
    """(base, title): works called `<family> on <base>` that name the base among their base_titles."""
    named = bases.select("base", F.explode(F.array(*[F.concat(F.lit(f"{f} on "), F.col("base")) for f in families])).alias("title"))
    return named.join(works, "title").where(F.array_contains("base_titles", F.col("base"))).select("base", "title")

