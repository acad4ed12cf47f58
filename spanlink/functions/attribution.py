"""Who governs a citation: the source itself, a named writer, or perhaps one, by the words right before and after it.

Words get classes, and a backward walk from the citation reads them. Locating words ("above", "there", a chapter, a tractate) are
consumed; a quoting verb, a contrast or any other word ends what a writer before it governs.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spanlink.functions import addresses, numerals
from spanlink.functions.rules import TRACTATES

# The words that write, name a writer, quote, contrast or locate.
SELF = (
    r"ו?[כדשבמל]{0,3}(?:כתבתי|כתבנו|פירשתי|פירשנו|ב[י]?ארתי|ב[י]?ארנו|הארכתי|הארכנו|אמרתי|אמרנו|הבאתי|הבאנו|הוכחתי|הוכחנו)[הו]?"
    r"|ו?[כדש]{0,3}(?:פרישית|פרישנא|כתיבנא|פרשינן|אפרש|אבאר|נרחיב)|ו?כד?כתבינן|ו?כד?פי[\"\']"
)
SELF_AFTER = r"ו?(?:הארכתי|הארכנו|פירשתי|פירשנו|ביארתי|ביארנו|בארתי|בארנו|כתבתי|כתבנו|הבאתי|הבאנו|הוכחתי|הוכחנו|אמרתי|אמרנו|אפרש|נרחיב)"
WRITES = r"ו?[כדשבמל]{0,3}(?:פירש|פרש|כתב|מפורש|פי[\"\']|פרש[\"\']י)"
CITES = r"ו?[דכבשמל]?(?:כתב|כתבו|פירש|פירשו|פירוש|לפרש|מפרש|מפרשים|פי[\"\']|כמ[\"]ש|כמש[\"]כ)"
WRITER = r"ו?[בכלמד]?(?:רש[\"\']י|ר[\"\']ת|קונטרס|קונט\'|תוספות|תוס[\"\'])"
FAMILY = r"ו?[בכלמד]?(?:רש[\"\']י|קונטרס|קונט\'|תוספות|תוס[\"\'])|פרש[\"\']י"
QUOTES = r"ו?[דכבשמ]{0,2}(?:אמרינן|אמרו|אמר|קאמר|פריך|תנא|תנן|תניא|משמע|מוכח|מייתי|איתא|גרסינן|אשכחן|מפורש|מפרשינן|קתני|מצינו|פוסק|מסיק|מסקינן|פסלינן|קיי[\"״]ל)"
WEAK = r".*(?:אמרתי|אמרנו|הבאתי|הבאנו|הוכחתי|הוכחנו).*"
FROM_PLACE = r"ו?מ(?:פרק|פ[\"\']|ריש|סוף|שלהי|ההיא).*"
CONTRASTS = frozenset("אבל אלא ומיהו מיהו ואילו והא נראה ונראה וההיא ואמר ואמרינן ואיתא ואשכחן והאמר ואף ואם".split())
LOCATES = frozenset(
    "שם התם לעיל לקמן להלן למעלה למטה בסמוך טעם טעמא זה לה נמי כבר וכן בארוכה באורך בקצרה בפירקין בפרקין פירקין פרקין ברישמכילתין ברישמכלתין במקומו במקומה באריכות בסוף בריש בשלהי בו קצת".split()
)
POINTS = frozenset("לעיל לקמן להלן למעלה למטה שם ולעיל ולקמן ולהלן ולמעלה ולמטה ושם".split())
JOINED_PLACES = frozenset("ולעיל ולקמן ולהלן ובסמוך".split())
OPENINGS = (("דבר", "זה"), ("ענין", "זה"), ("דינין", "אלו"))
NAMED_BOOKS = frozenset("הרב רבנו רבינו הגאון ספר חידושי בחידושי".split())
#: Abbreviations of discourse that name nobody.
DISCOURSE = frozenset(
    'אע"ג וא"ת א"ת וי"ל י"ל צ"ל א"כ א"נ ה"ל דה"ל וה"ל והל"ל הל"ל דהל"ל ע"י ע"כ א"ל כ"ע לכ"ע דכ"ע י"ס ס"ד מ"מ מ"ל נ"מ ה"נ כ"ש א"א כדפ"ל ת"ל כר"ע ר"ע דל"ל דה"נ ה"מ בד"א אע"פ כה"ג ב"ד ס"ל'.split()
)

_TAGS = re.compile(r"""<(?:"[^"]*"|'[^']*'|[^'">])*>""")
_VOWELS = re.compile("[֑-ׇ]")
_CLAUSE = re.compile(r"[^.:;()\[\]]*$")
_ADDRESS = re.compile(addresses.DAF_ADDRESS)
_LAST_ADDRESS = re.compile(rf"(?:^|(?<=[\s(])){addresses.DAF_ADDRESS}$")
_NUMERAL = re.compile(numerals.CANONICAL)
_TITLE = re.compile(r"ו?[בדל]?(?:מסכת )?(?:" + "|".join(map(re.escape, TRACTATES)) + r")(?: .+)?")
_CHAPTER = re.compile(addresses.CHAPTER_LEAD)
_KINDS = {k: re.compile(p) for k, p in (("self", SELF), ("self_after", SELF_AFTER), ("writes", WRITES), ("cites", CITES), ("writer", WRITER), ("family", FAMILY), ("quotes", QUOTES), ("weak", WEAK), ("from", FROM_PLACE))}


def _is(kind: str, word: str) -> bool:
    return _KINDS[kind].fullmatch(word) is not None


def _plain(s: str) -> str:
    return re.sub(r"\s+", " ", _TAGS.sub(" ", s).translate(str.maketrans("״׳", "\"'"))).strip()


def words_of(s: str) -> list[str]:
    return [w.strip("(),;:.[]") for w in _VOWELS.sub("", _plain(s)).split()]


def _clause(s: str, most: int = 24) -> list[str]:
    """The last words of a prefix, back to the end of the clause before; a bracket that opens the citation itself ends none."""
    return words_of(_CLAUSE.search(s.rstrip(" (["))[0])[-most:]


def _ends_scope(words: list[str]) -> bool:
    return any(_is("quotes", w) or w in CONTRASTS for w in words)


def _quotes_next(words: list[str]) -> bool:
    """Whether a quotation of the base text begins, with "also" before its verb at most."""
    return any(_is("quotes", w) for w in words[: 1 + (words[:1] == ["נמי"])][-1:])


def _coordinates(words: list[str], places: frozenset[str] = frozenset()) -> bool:
    return any(w.startswith("ו") and w not in places for w in words)


def locates_only(words: list[str]) -> bool:
    """Whether words are locating ones alone: neutral ones, then at most one chapter or tractate."""
    rest = list(words)
    while rest and rest[-1] in ("לעיל", "לקמן", "להלן", "שם", "התם"):
        rest.pop()
    near = [k for k in range(len(rest) - 1) if rest[k] == "סמוך" and rest[k + 1] in ("לתחילתו", "לסופו")]
    rest = [w for k, w in enumerate(rest) if k not in near and k - 1 not in near]
    if tuple(rest[:2]) in OPENINGS:
        rest = rest[2:]
    while rest and (rest[0] in LOCATES or rest[0].lstrip("ו") in LOCATES):
        rest = rest[1:]
    place = " ".join(rest)
    # a proof from another discussion is no writing there
    return not place or not _is("from", place) and bool(_TITLE.fullmatch(place) or _CHAPTER.match(place))


def _following(content: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """Words attached behind a citation, and those behind its own parenthesis."""
    tail = re.sub(r"^[.:]\s*[)\]]\s*", "", _TAGS.sub(" ", content[end:]).lstrip(" )]"))
    heading = re.match(r"ו?שם\s+ב?ד[\"']ה\s+(?:[א-ת\"']+\s*){1,8}[)\]]\s*", _plain(tail))
    if heading:
        tail = _plain(tail)[heading.end() :]
    attached = re.match(r"\([^()]{1,80}\)\s*", tail)
    if not attached and content[start:end].rstrip().endswith("("):
        closing = re.match(r"[^()]{1,80}\)\s*", tail)
        attached = closing if closing and _ADDRESS.search(_plain(closing[0])) else None
    behind = words_of(tail[attached.end() :] if attached else tail)[:8]
    return behind[:4] if attached else words_of(tail)[:4], behind


def _after(words: list[str]) -> str | None:
    """What the words right behind say; `maybe` leaves the words before to decide."""
    if not words:
        return None
    first, rest = words[0], words[1:]
    against = _is("writer", first) and rest[:1] == ["לא"]
    compares = first.startswith("כ") and _is("writes", first[1:])
    if not first.startswith("ו") and not against and not compares:
        names = _is("writer", first) and (first.startswith("ב") or any(_is("writes", w) or w == 'ד"ה' for w in rest))
        if names or _is("writes", first) and any(_is("writer", w) for w in words[:3]) or re.fullmatch("פרש[\"']י", first):
            return "other"
    there = ("שם", "ושם", "התם")
    if rest and (_is("self_after", first) and rest[0] in ("שם", "התם") or first.lstrip("ו") == "נרחיב" and rest[0] == "בה" or first in there and _is("self_after", rest[0])):
        return "self"
    return "maybe" if _is("writer", first) and not first.startswith("ו") and not against else None


def _named_before(before: list[str], lead: list[str], behind: list[str]) -> str | None:
    """The nearest named commentary, if it writes and only locating words lie between it and the citation."""
    at = next((k for k in reversed(range(len(before))) if _is("family", before[k])), None)
    if at is None or len(before) - at > 8:
        return None
    name, gap = before[at], before[at + 1 :]
    if gap[:1] in (["גופיה"], ["עצמו"]):
        gap = gap[1:]
    verb_before, verb_after = at > 0 and _is("writes", before[at - 1]), bool(gap) and _is("writes", gap[0])
    gap = gap[verb_after:] + lead
    combined = name.startswith("פרש")
    if not (verb_before or verb_after or combined or name.startswith("ב")):
        return None
    bare = not (verb_before or verb_after or combined)
    behind = behind[1:] if behind[:1] in (["שם"], ["ושם"]) else behind
    if _coordinates(gap) and (bare or _quotes_next(behind)):
        return None
    return _family(name) if locates_only(gap) and not _ends_scope(gap) else None


def _family(word: str) -> str:
    return "Tosafot" if "תוס" in word else "Rashi"


def _named_after(words: list[str]) -> set[str] | None:
    """Commentaries named by the three words behind; None if what follows may make "Tosafot" the name of another work."""
    found = set()
    for k, word in enumerate(words[:3]):
        if not _is("family", word):
            continue
        rest = words[k + 1 :]
        rest = rest[1:] if rest[:1] == ["שם"] else rest
        if _family(word) == "Tosafot" and rest and not re.fullmatch("[ברס]?ד[\"']ה", rest[0]) and not _is("writes", rest[0]) and not (rest[0].startswith("ו") and not _is("writer", rest[0])):
            return None
        found.add(_family(word))
    return found


def _self_before(before: list[str], lead: list[str], behind: list[str], maybe: bool) -> str | None:
    words = before + lead
    at = next((k for k in reversed(range(len(words))) if _is("self", words[k])), None)
    if at is None:
        cited = any(re.fullmatch(r"ו?(?:כתב|כתבו|פירש|פירשו|פירוש|פי[\"'])", w) and len(before) - k <= 6 and all(x.lstrip("ו") in {"לעיל", "לקמן", "להלן", "שם", "התם", "בסמוך", "כבר"} and not x.startswith("ו") for x in before[k + 1 :]) for k, w in enumerate(before))
        return "ambiguous" if maybe or cited else None
    word, gap = words[at], words[at + 1 :]
    weak, stem = _is("weak", word), word.lstrip("ו")
    compares = stem.startswith("כ") and _is("self", stem[1:]) or bool(re.fullmatch("כד?פי[\"']", stem)) or "כמו" in words[max(0, at - 2) : at]
    joined = _coordinates(gap, JOINED_PLACES)
    if len(before) - at - 1 > 6 or len(gap) > 12 or _ends_scope(gap) or joined and (compares or weak or _quotes_next(behind)):
        return None
    if weak and any(_is("from", w) for w in gap):
        return None
    if not locates_only(before[at + 1 :] if at < len(before) else gap) or weak and not POINTS.intersection(gap):
        return "ambiguous"
    by = words[max(0, at - 4) : at]
    if any(_is("writes", w) or _is("cites", w) for w in by):
        # a predicate before makes the own word one that is quoted from a book or an abbreviated name
        named = any(re.search("[א-ת][\"'][א-ת]", w) and w not in DISCOURSE and not _NUMERAL.match(re.sub("[^א-ת]", "", w)) for w in by)
        if named or NAMED_BOOKS.intersection(by):
            return "other"
    return "other" if any(_is("writer", w) for w in words[max(0, at - 2) :]) else "self"


def governed_by(content: str, start: int, end: int) -> tuple[str | None, str | None]:
    """(writer, commentary). writer: self, other, ambiguous, or None where no writer governs the citation; commentary: the one, Rashi or Tosafot, that is named as the writer."""
    after, behind = _following(content, start, end)
    said = _after(after)
    before = None if said == "self" else _prefix_family(content, start, end, behind)
    if said in ("self", "other"):
        writer = said
    elif before:
        writer = "other"
    else:
        prefix, anchor = _TAGS.sub(" ", content[:start]), _TAGS.sub(" ", content[start:end])
        # printed places don't end a list of writings, and editorial brackets keep their words
        open_ = re.sub(r"\(([^()]*)\)", lambda m: " " if _ADDRESS.match(_VOWELS.sub("", _plain(m[1]))) else f" {m[1]} ", prefix)
        writer = _self_before(_clause(re.sub(r"[\[\]]", " ", open_)), words_of(_plain(anchor.split("(", 1)[0])), behind, said == "maybe")
    named = _named_after(after) if writer == "other" else None
    if named is None:
        return writer, None
    families = named | ({before} if before else set())
    return writer, families.pop() if len(families) == 1 else None


def writer_of(content: str, start: int, end: int) -> str | None:
    return governed_by(content, start, end)[0]


def commentary_of(content: str, start: int, end: int) -> str | None:
    return governed_by(content, start, end)[1]


def _prefix_family(content: str, start: int, end: int, behind: list[str]) -> str | None:
    prefix, anchor = _TAGS.sub(" ", content[:start]), _TAGS.sub(" ", content[start:end])
    lead = _plain(anchor.split("(", 1)[0])
    place = re.search(r"\([^()]+\)", anchor)
    inner = words_of(anchor[place.end() :]) if place else []
    address = None if "(" in anchor else _LAST_ADDRESS.search(lead)
    locator = lead[: address.start()] if address and _NUMERAL.match(re.sub("[^א-ת]", "", address[2])) else lead
    return _named_before(_clause(prefix), words_of(locator), inner + behind)


#: Lines up to so many characters are remembered, the last of them: most citations are short and come again.
REMEMBERED, SHORT = 1 << 13, 256


@functools.lru_cache(REMEMBERED)
def _remembered(content: str, start: int, end: int) -> tuple[str | None, str | None]:
    return governed_by(content, start, end)


@F.pandas_udf(StructType([StructField("writer", StringType()), StructField("commentary", StringType())]))
def _governing(content: pd.Series, start: pd.Series, end: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if c is None else (_remembered if len(c) <= SHORT else governed_by)(c, a, b) for c, a, b in zip(content.tolist(), start.tolist(), end.tolist(), strict=True)]
    return pd.DataFrame(rows, columns=["writer", "commentary"], dtype=object)


def governing(content: Column, start: Column, end: Column) -> Column:
    """(writer, commentary): `governed_by` for columns; spans in code points, not null."""
    return _governing(content, start.cast("int"), end.cast("int"))
