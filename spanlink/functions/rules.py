"""Rules that accept, mend or veto one resolved citation, as column functions.

An anchor is the citation's own text. References are `Title`, `Title 4`, `Title 4:7` or, in tractates, `Title 4a`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanlink.functions.addresses import let, readings, side_after, spelled_addresses
from spanlink.functions.numerals import amud, numeral, relative_side, side_of
from spanlink.functions.text import plain_quotes, without_vowels

#: Titles of tractates whose leaves can place the lines of a commentary, fixed values.
TRACTATES = (
    "ברכות", "שבת", "עירובין", "פסחים", "ראש השנה", "יומא", "סוכה", "ביצה", "תענית", "מגילה", "מועד קטן", "חגיגה", "יבמות", "כתובות", "נדרים", "נזיר", "סוטה", "גיטין", "קידושין",
    "בבא קמא", "בבא מציעא", "בבא בתרא", "סנהדרין", "מכות", "שבועות", "עבודה זרה", "הוריות", "זבחים", "מנחות", "חולין", "בכורות", "ערכין", "תמורה", "כריתות", "מעילה", "תמיד", "נדה",
)
#: Sources whose books are placed by other means, fixed values.
PLACED_SOURCES = ("Sefaria", "KSK")
#: Abbreviations that are read as books though they aren't: (title, pattern of the anchor, a word that makes it one), fixed values.
MISREAD = (
    ("I Kings", "(?U)^\\W*מ[\"'״׳]א(?:\\W*$|\\s+(?:סי|ס[\"'״׳]ק|סק))", None),
    ("Amos", "(?U)^\\W*עמ[\"'׳]", None),
    ("Mishnah Eruvin", "פ[\"'״׳]ק\\s+ד?עירובין", "משנה"),
)
#: Words that may be prose where a number of this code would stand, fixed values.
PROSE_NUMBERS = ("לא", "כ'", 'מה"נ')
_LEAF = "^(.+?) ([0-9]+)([ab])(?::[0-9:]+)?(?:-([0-9]+)([ab]))?(?::|$)"


def title_of(ref: Column) -> Column:
    return F.regexp_replace(ref, " [0-9][0-9:ab-]*$", "")


def of_book(ref: Column, title: str) -> Column:
    return (ref == title) | F.startswith(ref, F.lit(title + " "))


def placed_by_pages(source: Column, title: Column) -> Column:
    """Whether a book's own page headings place its lines: a commentary on a tractate, from a source not placed otherwise."""
    named = F.contains(title, F.lit(" על ")) & F.substring_index(title, " על ", -1).isin(*TRACTATES)
    return ~source.isin(*PLACED_SOURCES) & named


def leading_marker_end(content: Column) -> Column:
    """Where a numeral in parentheses at the start of a line ends, 0 if there is none; "there" isn't one."""
    pattern = "^\\s*\\(([א-ת'\"׳״]+)\\)"
    token = F.regexp_extract(content, pattern, 1)
    letters = F.regexp_replace(token, "['\"׳״]", "")
    whole = F.length(F.regexp_extract(content, pattern, 0))
    fine = content.rlike(pattern) & numeral(token).isNotNull() & (letters != "שם") & ~letters.rlike("[ךםןףץ]")
    return F.when(fine, whole).otherwise(0)


def is_line_marker(content: Column, end: Column) -> Column:
    """Whether a citation that ends there is no more than the line's own number."""
    return end <= leading_marker_end(content)


def implausible(ref: Column, anchor: Column) -> Column:
    """Whether the target is a known misreading of the anchor's abbreviation."""
    bad = F.lit(False)
    for title, pattern, unless in MISREAD:
        hit = of_book(ref, title) & anchor.rlike(pattern)
        bad = bad | (hit & ~F.contains(anchor, F.lit(unless)) if unless else hit)
    return bad


def _sides(ref: Column) -> Column:
    """The sides of leaves that a tractate reference is about."""
    first = amud(F.regexp_extract(ref, _LEAF, 2).try_cast("int"), F.regexp_extract(ref, _LEAF, 3))
    last = amud(F.regexp_extract(ref, _LEAF, 4).try_cast("int"), F.regexp_extract(ref, _LEAF, 5))
    return F.array_compact(F.array(first, last))


def address_contradicts(ref: Column, anchor: Column) -> Column:
    """Whether the anchor spells sides of leaves none of which is the target's."""

    def contradicts(spelled: Column) -> Column:
        sections = F.flatten(F.transform(spelled, lambda a: F.transform(a["dafs"], lambda daf: amud(daf, a["side"]))))
        return (F.size(spelled) > 0) & ~F.arrays_overlap(sections, _sides(ref))

    return ref.rlike(_LEAF) & let(spelled_addresses(anchor), contradicts)


def spelled_ref(ref: Column, anchor: Column) -> Column:
    """The one address that the anchor spells, in the target's tractate; null if there are none or several."""

    def the_one(spelled: Column) -> Column:
        section = amud(F.get(F.get(spelled, 0)["dafs"], 0), F.get(spelled, 0)["side"])
        leaf = let(section, lambda x: F.concat(F.floor((x + 1) / 2).cast("string"), side_of(x)))
        return F.when(F.size(spelled) == 1, F.concat_ws(" ", F.regexp_extract(ref, _LEAF, 1), leaf))

    return F.when(ref.rlike(_LEAF), let(spelled_addresses(anchor), the_one))


def marked_second_side(ref: Column, content: Column, start: Column, end: Column, leafed: Column) -> Column:
    """Where a whole leaf's colon ends that makes it the second side; null without one or at the end of the line.

    leafed: whether the target's book has leaves. The anchor's last word must spell the leaf, or the colon belongs to something else.
    """
    tokens = F.array_remove(F.split(F.trim(F.regexp_replace(F.substring(content, start + 1, end - start), "<[^>]*>", "")), r"\s+"), "")
    leaf = F.regexp_extract(ref, "^.+ ([0-9]+)$", 1).try_cast("int")
    spells = F.array_contains(readings(F.try_element_at(tokens, F.lit(-1))), leaf)

    def second(after: Column) -> Column:
        more = F.trim(F.regexp_replace(F.substring(content, after["end"] + 1, F.length(content)), "<[^>]*>", "")) != ""
        return F.when(after["colon"] & more & (F.size(tokens) > 0) & spells, after["end"])

    return F.when(leafed & leaf.isNotNull(), let(side_after(content, end), second))


def relative_direction(labels: Column, anchor: Column, same_book: Column, own: Column, target: Column) -> Column:
    """above or below, when a pointing citation has a number or a name and lies where it says; null drops it.

    Without a name it must stay in its own book; own and target are places in the order of that book, and without an own place nothing
    is proven.
    """
    side = relative_side(anchor)
    named = F.array_contains(labels, "NAMED")
    numbered = F.array_contains(labels, "NUMBERED") | F.array_contains(labels, "RANGE")
    placed = ~same_book | ((side == "above") & (target < own)) | ((side == "below") & (target > own))
    return F.when(F.array_contains(labels, "RELATIVE") & own.isNotNull() & (named | numbered) & (named | same_book) & placed, side)


def base_code_note(title: Column, anchor: Column) -> Column:
    """Whether the anchor's note marker belongs to a commentary, not to the code that was resolved."""
    marker = F.regexp_replace(plain_quotes(anchor), "<[^>]*>", "").rlike("(?<![א-ת])ו?[בלמכ]?(ס[\"']ק|סק[\"']|סעיף\\s+קטן)")
    return F.startswith(title, F.lit("Shulchan Arukh,")) & marker


def unproven_number(title: Column, parts: Column) -> Column:
    """Whether a number of this code may as well be prose; parts: struct of label and text."""
    return F.startswith(title, F.lit("Mishneh Torah,")) & F.exists(parts, lambda p: (p["label"] == "NUMBERED") & without_vowels(plain_quotes(p["text"])).isin(*PROSE_NUMBERS))

