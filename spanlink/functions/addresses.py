"""Addresses that citations and headings spell, as column functions.

A leaf's side is a struct (daf int, side "a" or "b"). Each reader takes a whole text or null: what isn't one clear address is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanlink.functions.numerals import is_canonical_numeral, numeral, relative_side
from spanlink.functions.text import QUOTED_TAG, bare, plain_quotes, without_vowels

# fixed patterns: a leaf without its title, one address with its side, a pointing word, a number with a geresh
UNTITLED_DAF = "[א-ת]{1,3}|[א-ת]{1,2}[\"״][א-ת]|[א-ת]['׳]"
#: Groups: 1 prefix, 2 leaf, 3 mark, 4 side after a comma, 5 named side.
DAF_ADDRESS = rf"(דף\s+|ד['׳]\s*)?({UNTITLED_DAF})(?:\s*([.:])|\s*,\s*([אב])|\s+ע[\"״]([אב]))"
RELATIVE_WORD = r"[וד]?(?:לקמן|לעיל|להלן)(?:\s+בסמוך)?(?:\s*\(\s*|\s+)"
#: Groups: 1 prefix, 2 leaf, 3 mark, 4 side, 5 side as a word.
HEADING_ADDRESS = rf"(דף\s+)?({UNTITLED_DAF})(?:\s*([.:])|\s+ע[\"״'׳]([אב])|\s+עמוד\s+([אב]))?"
HEADING_SIDE = "(?:ע[\"״'׳]|עמוד\\s+)([אב])"
GERESH_NUMERAL = "(?:[א-ת]{1,3}['׳‘’]?|[א-ת]{1,2}(?:[\"״“”]|'')[א-ת])"
MULTI_LETTER_GERESH = "[א-ת]{2,3}['׳‘’]"
SIDE_AFTER = rf"^(?:\s|{QUOTED_TAG})*(?:([.:])|ע[\"״]([אב]))".replace('<("', '<(?:"')
CHAPTER_LEAD = "^ו?[במ]?(?:פרק|פ['׳]|ריש|סוף|ס[\"״]פ|ר[\"״]פ|רפ[\"״]|ספ[\"״])(?![א-ת])"
OWN_CHAPTER = "ו?[בד]?(?:פירקין|פרקין)"
CHAPTER_EDGE = "^ו?[במ]?(?:ריש|סוף|שלהי) "
LEAD_PREFIXES = ("", "ו", "ב", "מ", "ד", "ל", "וב", "ומ", "דב", "דמ")
GEMARA = "ו?[במ]?(?:גמרא|גמ['\"]?)"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is named."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), 0)


def _side(mark: Column, *letters: Column) -> Column:
    letter = F.coalesce(*[F.when(x != "", x) for x in letters])
    return F.when((mark == ".") | ((mark == "") & (letter == "א")), "a").when((mark == ":") | ((mark == "") & (letter == "ב")), "b")


def _letters(token: Column) -> Column:
    return F.regexp_replace(token, "[^א-ת]", "")


def readings(token: Column) -> Column:
    """Numbers that a token may spell: all of its letters after the word for leaf, or those after a one-letter prefix."""
    letters = _letters(F.substring_index(token, "דף", -1))
    rest = F.when(F.length(letters) > 1, numeral(F.substring(letters, F.lit(2), F.length(letters))))
    return F.array_distinct(F.array_compact(F.array(numeral(letters), rest)))


def spelled_addresses(anchor: Column) -> Column:
    """All `leaf, side` and `leaf, named side` addresses of an anchor: (dafs, the numbers it may be; side)."""
    found = []
    for pattern in (r"(\S+?)\s*,\s*([אב])(?![א-ת])", "(\\S+)\\s+ע[\"'״׳]([אב])(?![א-ת])"):
        both = F.arrays_zip(F.regexp_extract_all(anchor, F.lit(pattern), F.lit(1)).alias("t"), F.regexp_extract_all(anchor, F.lit(pattern), F.lit(2)).alias("s"))
        found.append(F.transform(both, lambda x: F.struct(readings(x["t"]).alias("dafs"), F.when(x["s"] == "א", "a").otherwise("b").alias("side"))))
    return F.filter(F.concat(*found), lambda a: F.size(a["dafs"]) > 0)


def _one_address(text: Column, pattern: str, first: int) -> Column:
    """(daf, side) by the five groups from `first` on; null for what may be something else.

    Side b spelled as a leaf may be leaf 72; a letter pe with a mark is a chapter; a numeral that isn't spelled as usual is a slip; a
    lone dalet may be the word for leaf.
    """

    def read(g: Column) -> Column:
        prefix, daf, mark, comma, amud = (g[k] for k in range(5))
        letters = _letters(daf)
        unclear = daf.rlike("^ע[\"״'׳][אב]$") | daf.rlike("^פ[\"'״׳]") | ~is_canonical_numeral(letters)
        unclear = unclear | ((letters == "ד") & ~F.startswith(prefix, F.lit("דף")) & ((daf != "ד") | (amud != "")))
        return F.when((daf != "") & ~unclear, F.struct(numeral(letters).alias("daf"), _side(mark, comma, amud).alias("side")))

    return let(text, lambda t: let(F.array(*[F.regexp_extract(t, pattern, first + k) for k in range(5)]), read))


def daf_address(text: Column) -> Column:
    """The address that a text is as a whole."""
    return _one_address(text, f"^(?:{DAF_ADDRESS})$", 1)


def trailing_address(text: Column) -> Column:
    """(daf, side, lead): the address that a text ends with, and what stands before it."""
    pattern = rf"(?:^|(?<=[\s(])){DAF_ADDRESS}$"

    def read(t: Column) -> Column:
        lead = F.btrim(F.regexp_replace(t, pattern, ""), F.lit(" ()"))
        return let(_one_address(t, pattern, 1), lambda a: F.when(a.isNotNull(), F.struct(a["daf"].alias("daf"), a["side"].alias("side"), lead.alias("lead"))))

    return let(text, read)


def relative_address(anchor: Column, own_title: Column) -> Column:
    """(daf, side, direction, own_leaf) of "below 11b", "above, <own title> leaf 23a" or "below, side b" as a whole anchor.

    own_title: the Hebrew title of the source's own tractate. own_leaf: the anchor names a side only, of the leaf that the source is on.
    """

    def read(word: Column, rest: Column) -> Column:
        own = F.startswith(rest, F.concat(own_title, F.lit(" ")))
        address = daf_address(F.when(own, F.ltrim(F.substring(rest, F.length(own_title) + 1, F.length(rest)))).otherwise(rest))
        only = F.regexp_extract(rest, "^ע[\"״]([אב])$", 1)

        def found(a: Column) -> Column:
            side = F.coalesce(a["side"], F.when(only == "א", "a").when(only == "ב", "b"))
            direction = relative_side(word)
            return F.when((word != "") & direction.isNotNull() & side.isNotNull(), F.struct(a["daf"].alias("daf"), side.alias("side"), direction.alias("direction"), (only != "").alias("own_leaf")))

        return let(address, found)

    text = bare(without_vowels(plain_quotes(anchor)))
    return let(text, lambda t: let(F.regexp_replace(t, f"^{RELATIVE_WORD}", ""), lambda rest: read(F.regexp_extract(t, f"^{RELATIVE_WORD}", 0), rest)))


def own_daf_anchor(anchor: Column) -> Column:
    """(daf, side, lead): one explicit side that at most "there" or the word for the Talmud leads, or a chapter, which then must hold it; null if it points up or down."""

    def read(t: Column) -> Column:
        def found(a: Column) -> Column:
            plain = a["lead"].rlike(rf"^(?:(?:שם|התם)\s*)?(?:{GEMARA})?$|^{GEMARA}\s+(?:שם|התם)$")
            chapter = a["lead"].rlike(CHAPTER_LEAD) | a["lead"].rlike(f"^{OWN_CHAPTER}$") | a["lead"].rlike("^ו?[במ]?[רס]?פ[\"']")
            return F.when(plain | chapter, F.struct(a["daf"].alias("daf"), a["side"].alias("side"), F.when(~plain, a["lead"]).alias("chapter")))

        return F.when(~t.rlike("לעיל|לקמן|להלן"), let(trailing_address(t), found))

    return let(without_vowels(plain_quotes(bare(anchor))), read)


def lead_names(lead: Column) -> Column:
    """The chapter names that a lead may spell: with or without its word for a chapter's edge and a prefix."""
    plain = plain_quotes(lead)
    leads = F.array(plain, F.regexp_replace(plain, CHAPTER_EDGE, ""))

    def without(p: str) -> Column:
        return F.transform(leads, lambda x: F.when(F.startswith(x, F.lit(p)) & (F.length(x) > len(p)), F.substring(x, F.lit(len(p) + 1), F.length(x))))

    return F.array_distinct(F.array_compact(F.concat(*map(without, LEAD_PREFIXES))))


def side_after(content: Column, end: Column) -> Column:
    """(side, end, colon): the side that a mark or word after code point `end` writes, past white space and tags."""
    rest = F.substring(content, end + 1, F.length(content))
    mark, letter = (F.regexp_extract(rest, SIDE_AFTER, k) for k in (1, 2))
    length = F.length(F.regexp_extract(rest, SIDE_AFTER, 0))
    return F.when(rest.rlike(SIDE_AFTER), F.struct(_side(mark, letter).alias("side"), (end + length).alias("end"), (mark == ":").alias("colon")))


def closing_end(content: Column, start: Column, end: Column) -> Column:
    """`end`, or past a mark that was cut off, if the anchor ends in a numeral and a bracket or "there" follows the mark."""
    anchor = plain_quotes(F.substring(content, start + 1, end - start))
    token = F.regexp_extract(anchor, rf"(?:^|[\s(])({UNTITLED_DAF})$", 1)
    after = side_after(content, end)
    tail = F.ltrim(plain_quotes(F.substring(content, after["end"] + 1, F.length(content))))
    return F.when((token != "") & is_canonical_numeral(_letters(token)) & tail.rlike("^(?:[)\\]]|ו?שם(?![א-ת]))"), F.coalesce(after["end"], end)).otherwise(end)


def heading_address(text: Column, canonical: bool = True) -> Column:
    """(daf, side or null) of a heading like "leaf 23b"; a bare letter is a section's number and none."""
    pattern = f"^(?:{HEADING_ADDRESS})$"
    prefix, daf, mark, amud, word = (F.regexp_extract(text, pattern, k) for k in range(1, 6))
    valid = is_canonical_numeral(_letters(daf)) if canonical else numeral(_letters(daf)).isNotNull()
    side = _side(mark, amud, word)
    return F.when(text.rlike(pattern) & valid & (side.isNotNull() | (prefix != "")), F.struct(numeral(_letters(daf)).alias("daf"), side.alias("side")))


def stack_address(stack: Column) -> Column:
    """(daf, side) of the innermost heading of a leaf in a stack of headings, outermost first; null on any doubt.

    Any other heading of a leaf must spell the same side, others only if they spell one at all.
    """
    is_leaf = lambda h: F.startswith(h, F.lit("דף"))
    places = F.filter(F.sequence(F.lit(0), F.size(stack) - 1), lambda k: is_leaf(F.get(stack, k)))
    nearest = F.when(F.size(stack) > 0, F.array_max(places))
    address = heading_address(F.get(stack, nearest))

    def agrees(k: Column) -> Column:
        text = F.get(stack, k)
        only = F.regexp_extract(text, f"^{HEADING_SIDE}$", 1)
        other = F.coalesce(heading_address(text, canonical=False), F.when(only != "", F.struct(address["daf"].alias("daf"), F.when(only == "א", "a").otherwise("b").alias("side"))))
        same = (other["daf"] == address["daf"]) & other["side"].eqNullSafe(address["side"])
        return (k == nearest) | F.when(other.isNull(), ~is_leaf(text)).otherwise(same)

    return F.when(address["side"].isNotNull() & F.forall(F.sequence(F.lit(0), F.size(stack) - 1), agrees), address)


def geresh_citation(anchor: Column) -> Column:
    """(title, chapter, verse or null) readings of a whole anchor whose numbers have a geresh after several letters: shortest title first."""
    text = bare(anchor)

    def reading(lazy: str) -> Column:
        pattern = rf"^([א-ת][א-ת\"״'׳‘’ ]*{lazy})\s+({GERESH_NUMERAL})(?:\s*,?\s+({GERESH_NUMERAL}))?$"
        title, chapter, verse = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
        tokens = F.filter(F.array(chapter, verse), lambda x: x != "")
        fine = F.exists(tokens, lambda x: x.rlike(f"^{MULTI_LETTER_GERESH}$")) & F.forall(tokens, lambda x: is_canonical_numeral(_letters(x)))
        name = F.regexp_replace(F.trim(title), "(?<= [א-ת])['׳‘’]$", "")
        return F.when(text.rlike(pattern) & fine, F.struct(name.alias("title"), numeral(_letters(chapter)).alias("chapter"), F.when(verse != "", numeral(_letters(verse))).alias("verse")))

    return F.array_distinct(F.array_compact(F.array(reading("?"), reading(""))))


def address_spans(anchor: Column) -> Column:
    """(start, end, daf, side) of every address printed in an anchor, in order; daf is null where it isn't clear which.

    A numeral with a prefixed dalet, and any with an explicit side, is that number; a leaf's word itself is no leaf.
    """
    pattern = rf"(?<![א-ת]){DAF_ADDRESS}"
    hits = F.regexp_extract_all(anchor, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(anchor, pattern, -1), F.lit(1), F.size(hits))
    steps = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    before = lambda k: F.aggregate(F.slice(steps, F.lit(1), k), F.lit(0), lambda n, s: n + F.length(s["gap"]) + F.length(s["hit"]))

    def span(x: Column, k: Column) -> Column:
        prefix, daf, mark, comma, amud = (F.regexp_extract(x["hit"], f"^{DAF_ADDRESS}$", g) for g in range(1, 6))
        whole = _letters(daf)
        cut = F.when(F.startswith(whole, F.lit("ד")) & ~is_canonical_numeral(whole), F.substring(whole, F.lit(2), F.length(whole))).otherwise(whole)
        said = (F.coalesce(comma, F.lit("")) != "") | (amud != "") | F.startswith(prefix, F.lit("דף")) | (cut != whole)
        start = before(k) + F.length(x["gap"])
        plain = daf_address(x["hit"])
        number = F.when(said & is_canonical_numeral(cut), numeral(cut)).when(~said, plain["daf"])
        return F.struct(start.cast("int").alias("start"), (start + F.length(x["hit"])).cast("int").alias("end"), number.alias("daf"), F.when(number.isNotNull(), _side(mark, comma, amud)).alias("side"))

    leaf_word = lambda x: (F.regexp_extract(x["hit"], f"^{DAF_ADDRESS}$", 2) == "דף") & (F.regexp_extract(x["hit"], f"^{DAF_ADDRESS}$", 1) == "")
    spans = F.transform(steps, lambda x, k: F.when(~leaf_word(x), span(x, k)))
    return F.array_compact(spans)
