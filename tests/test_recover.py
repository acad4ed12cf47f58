"""Addresses, and citations rebuilt from them: each rule with cases that it is for and cases that it must leave alone."""

import itertools
import re

from pyspark.sql import functions as F

from spanlink.functions import addresses, numerals, text
from spanlink.operators import recover

SCHEMA = (
    "source string, title string, line_index int, pos int, content string, start int, end int, parts array<struct<label:string,text:string,start:int,end:int>>, "
    "candidates array<string>, own_title string, own_he string, section int, section_last int"
)


def ask(spark, texts, column):
    return [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(column).collect()]


def plain(x):
    return tuple(plain(v) for v in x) if isinstance(x, (tuple, list)) else x


def cite(k, content, spelled, candidates=(), own=(None, None, None, None), anchor=None, pos=0):
    """A citation of `anchor` (or all) in content, whose parts (label, text) are found one after the other."""
    anchor = anchor or content
    start, at, parts = content.index(anchor), 0, []
    for label, t in spelled:
        at = anchor.index(t, at)
        parts.append((label, t, at, at + len(t)))
        at += len(t)
    return ("s", "b", k, pos, content, start, start + len(anchor), parts, list(candidates), *own)


def by_line(df, *columns):
    return {r["line_index"]: plain(tuple(r[c] for c in columns)) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def catalogs(spark):
    works = [("Psalms", ["תהלים"], "Tanakh"), ("Genesis", ["בראשית"], "Tanakh"), ("Ketubot", ["כתובות"], "Talmud"), ("Gittin", ["גיטין"], "Talmud"), ("Sukkah", ["סוכה"], "Talmud"), ("A", ["אחד"], "Talmud"), ("B", ["אחד"], "Tanakh")]
    segments = [("Psalms 18:31", "Psalms"), ("Psalms 3:4", "Psalms"), ("Genesis 1:2", "Genesis")] + [(f"{t} {d}{s}:1", t) for t in ("Ketubot", "Gittin", "Sukkah") for d in range(2, 41) for s in "ab"]
    chapters = [("Ketubot", "פרק שני", 29, 54), ("Ketubot", "פרק שלישי", 55, 80), ("Sukkah", "פרק קמא", 3, 38), ("Gittin", "פרק קמא", 3, 40), ("Sukkah", "פרק לולב", 57, 80)]
    return (
        spark.createDataFrame(works, "title string, aliases array<string>, category string"),
        spark.createDataFrame([(r, t, True) for r, t in segments], "ref string, title string, has_text boolean"),
        spark.createDataFrame(chapters, "title string, name string, first int, last int"),
    )


def test_readings_and_addresses(spark):
    assert ask(spark, ["דל״ג", "בטו", "דף כג", "abc", "טו"], addresses.readings(F.col("t"))) == [[33], [15], [23, 3], [], [15, 6]]
    got = ask(spark, ["יא:", 'דף כ"ג.', "ב,א", 'צה ע"ב', 'ע"ב.', 'פ"ב.', "פנ:", 'ד ע"ב', "ד' .", 'דף ד ע"ב', "יא", None], addresses.daf_address(F.col("t")))
    assert plain(got) == ((11, "b"), (23, "a"), (2, "a"), (95, "b"), None, None, None, None, None, (4, "b"), None, None)
    got = ask(spark, ["דף כג:", 'דף כג ע"ב', "דף כג עמוד ב", "צ' ע\"א", "א", "דף א", "כג ופרק"], addresses.heading_address(F.col("t")))
    assert plain(got) == ((23, "b"), (23, "b"), (23, "b"), (90, "a"), None, (1, None), None)


def test_canonical_numerals():
    letters = list(numerals.letter_values())
    words = [""] + ["".join(p) for n in (1, 2, 3) for p in itertools.product(letters, repeat=n)]
    assert sorted(w for w in words if re.search(numerals.CANONICAL, w)) == sorted(numerals.spelled(n) for n in range(1, 400))


def test_positions_from_heading_stacks(spark):
    stacks = [["שבת", "דף כג:"], ["דף כג:", 'ע"ב'], ["דף כג:", 'ע"א'], ["דף כג"], ["דף כג.", "דף כג:"], ["פרק א"], []]
    lines = spark.createDataFrame([("s", "b", k, s) for k, s in enumerate(stacks)], "source string, title string, line_index int, stack array<string>")
    assert by_line(recover.positions(lines), "section") == {0: 46, 1: 46}


def test_relative_addresses(spark):
    works, segments, _ = catalogs(spark)
    own = ("Gittin", "גיטין", 21, 21)  # 11a
    rows = [
        cite(0, "לקמן יב:", [], own=own),
        cite(1, "לעיל גיטין דף ט.", [], own=own),
        cite(2, 'לקמן ע"ב', [], own=own),
        cite(3, "לעיל יב:", [], own=own),
        cite(4, "לקמן כתובות דף יב.", [], own=own),
        cite(5, 'לקמן ע"ב', [], own=("Gittin", "גיטין", 21, 22)),
        cite(6, "לקמן שם", [], own=own),
        cite(7, "לקמן צט.", [], own=own),
        cite(8, "לעיל (דף ט:)", [], own=own),
    ]
    got = by_line(recover.own_relative(spark.createDataFrame(rows, SCHEMA), segments), "ref", "direction")
    assert got == {0: ("Gittin 12b", "below"), 1: ("Gittin 9a", "above"), 2: ("Gittin 11b", "below"), 8: ("Gittin 9b", "above")}


def test_untitled_leaves_of_the_own_tractate(spark):
    works, segments, chapters = catalogs(spark)
    own, both = ("Ketubot", "כתובות", 41, 41), ["Ketubot 21a", "Rashi on Ketubot 21a"]
    rows = [
        cite(0, "עיין (דף כא.)", [], both, own, "(דף כא.)"),
        cite(1, "התם (דף כא.)", [], both, own),
        cite(2, 'רש"י (דף כא.)', [], both, own),
        cite(3, "בגיטין כתב (דף כא.)", [], both, own, "(דף כא.)"),
        cite(4, "(דף כא.)", [], ["Gittin 21a"], own),
        cite(5, "גיטין ט. ודף כא.", [], ["Gittin 9a"], own, "גיטין ט."),
        cite(5, "גיטין ט. ודף כא.", [], both, own, "דף כא.", pos=1),
        cite(6, "פרק שני (דף כא.)", [], both, own),
        cite(7, "פרק שלישי (דף כא.)", [], both, own),
        cite(8, "בפירקין (דף כא.)", [], both, own),
    ]
    assert by_line(recover.own_daf(spark.createDataFrame(rows, SCHEMA), works, segments, chapters), "ref") == {k: "Ketubot 21a" for k in (0, 1, 6, 8)}


def test_verses(spark):
    works, segments, _ = catalogs(spark)
    n = lambda *p: [("NAMED" if k % 3 == 0 else "NUMBERED", t) for k, t in enumerate(p)]
    rows = [
        cite(0, "תהלים יח לא, בראשית א ב", n("תהלים", "יח", "לא", "בראשית", "א", "ב")),
        cite(1, "תהלים יח לא, בראשית א ט", n("תהלים", "יח", "לא", "בראשית", "א", "ט")),
        cite(2, "תהלים יח לא וגם בראשית א ב", n("תהלים", "יח", "לא", "בראשית", "א", "ב")),
        cite(3, "תהלים יח לא, בראשית א ב", n("תהלים", "יח", "לא", "בראשית", "א", "ב"), ["Psalms 18"]),
        cite(4, "אחד א ב; תהלים ג ד", n("אחד", "א", "ב", "תהלים", "ג", "ד")),
    ]
    got = recover.split_verses(spark.createDataFrame(rows, SCHEMA), works, segments).orderBy("k").collect()
    assert [(r["line_index"], r["start"], r["end"], r["ref"]) for r in got] == [(0, 0, 11, "Psalms 18:31"), (0, 13, 23, "Genesis 1:2")]
    rows = [cite(0, "(תהלים יח' לא')", []), cite(1, "תהלים יח לא", []), cite(2, "תהלים יח' צט'", []), cite(3, "כתובות יח' ב'", []), cite(4, "תהלים יח' ל״א", [])]
    assert by_line(recover.geresh_verses(spark.createDataFrame(rows, SCHEMA), works, segments), "ref") == {0: "Psalms 18:31", 4: "Psalms 18:31"}


def test_chapters(spark):
    works, segments, chapters = catalogs(spark)
    rows = [
        cite(0, "בפרק שני (כתובות דף יח.", [("NAMED", "בפרק שני"), ("NAMED", "כתובות"), ("NUMBERED", "דף יח.")]),
        cite(1, "רש״י (כתובות דף יח.", [("NAMED", "רש״י"), ("NAMED", "כתובות"), ("NUMBERED", "דף יח.")]),
        cite(2, "בפרק שני (כתובות דף כז", [("NAMED", "בפרק שני"), ("NAMED", "כתובות"), ("NUMBERED", "דף כז")]),
    ]
    got = by_line(recover.parenthesized(spark.createDataFrame(rows, SCHEMA), works, segments, chapters), "ref", "start")
    assert got == {0: ("Ketubot 18a", 10), 2: ("Ketubot 27", 10)}
    rows = [
        cite(0, "בפרק שני דכתובות דף יח.", [("NAMED", "בפרק שני דכתובות"), ("NUMBERED", "דף יח.")]),
        cite(1, "בפרק שלישי דכתובות דף יח.", [("NAMED", "בפרק שלישי דכתובות"), ("NUMBERED", "דף יח.")]),
        cite(2, "פרק שלישי כתובות דף כח", [("NAMED", "פרק שלישי"), ("NAMED", "כתובות"), ("NUMBERED", "דף כח")]),
        cite(3, "פרק לולב סוכה דף כח", [("NAMED", "פרק לולב"), ("NAMED", "סוכה"), ("NUMBERED", "דף כח")]),
    ]
    assert by_line(recover.chapter_led(spark.createDataFrame(rows, SCHEMA), works, segments, chapters), "ref") == {0: "Ketubot 18a", 2: "Ketubot 28"}
    rows = [
        cite(0, "בפרק קמא דסוכה (יג, ב. יד, א)", [("NAMED", "בפרק קמא דסוכה")]),
        cite(1, "בפרק קמא (יג, ב)", [("NAMED", "בפרק קמא")]),
        cite(2, "בפרק לולב (ל, ב)", [("NAMED", "בפרק לולב")]),
        cite(3, "בפרק קמא דסוכה (יג, ב. לד, א)", [("NAMED", "בפרק קמא דסוכה")]),
        cite(4, "בפרק לולב (ל, ב)", [("IBID", "בפרק")]),
    ]
    got = recover.chapter_lists(spark.createDataFrame(rows, SCHEMA), works, segments, chapters).orderBy("line_index", "k").collect()
    assert [(r["line_index"], r["k"], r["ref"]) for r in got] == [(0, 0, "Sukkah 13b"), (0, 1, "Sukkah 14a"), (2, 0, "Sukkah 30b")]


def test_notes_on_codes(spark):
    ref = "Shulchan Arukh, Yoreh De'ah 5"
    segments = spark.createDataFrame([("Siftei Kohen on Shulchan Arukh, Yoreh De'ah 20:3", "x", True)], "ref string, title string, has_text boolean")
    a = 'יו"ד סי\' כ ס"ק ג'
    rows = [cite(0, f'ועיין ש"ך {a}', [], [ref], anchor=a), cite(1, f'הבית יוסף והש"ך {a}', [], [ref], anchor=a), cite(2, f'ט"ז {a}', [], [ref], anchor=a), cite(3, a, [], [ref])]
    assert by_line(recover.code_commentary(spark.createDataFrame(rows, SCHEMA), segments), "ref") == {0: "Siftei Kohen on Shulchan Arukh, Yoreh De'ah 20:3"}


def test_small_readers(spark):
    col = F.col("t")
    assert plain(ask(spark, ['עיין דף כג: וגם לד, א ועוד ע"ב.'], addresses.address_spans(col))) == (((5, 11, 23, "b"), (16, 21, 34, "a"), (27, 31, None, None)),)
    cut = [("ראה נא: ושם", 6), ("ראה נא: סוף", 6), ("ראה נא.)", 6), ("ראה דבר: ושם", 7)]
    got = spark.createDataFrame(cut, "c string, e int").select(addresses.closing_end(F.col("c"), F.lit(0), F.col("e"))).collect()
    assert [r[0] for r in got] == [7, 6, 7, 7]
    assert ask(spark, ["a/b", "/a", "../a", "", "a/../b", "a\0", ".", None], text.is_safe_path(col)) == [True, False, False, False, False, False, False, False]
    assert ask(spark, ["<b>אֹתָם&nbsp;הָלְכוּ</b>־אַתֶּם"], text.quote_words(col)) == [["אותם", "הלכו", "אתם"]]
    assert ask(spark, ['(רש"י), <i>פירש</i>: שם.'], text.attribution_tokens(col)) == [['רש"י', "פירש", "", "שם"]]
    c = "מלה (אחת) שתים שלש (בראשית א) ארבע"
    got = spark.range(1).select(text.adjoining_quote_words(F.lit(c), F.lit(c.index("בראשית")), F.lit(c.index(") ארבע"))).alias("w")).first()["w"]
    assert plain(got) == (("שתים", "שלש"), ("ארבע",))
    assert ask(spark, ["x"], text.unquoted(F.array(*[F.lit(w) for w in "אמר בְּרֵאשִׁית ברא אלקים את רשי".split()]), F.array(F.lit("בראשית ברא אלקים את")))) == [["אמר", "רשי"]]
    got = spark.createDataFrame([("<b>אב</b>  ג־ד",)], "t string").select(text.normalized(col).alias("n")).first()["n"]
    assert got["text"] == " אב ג ד" and [("<b>אב</b>  ג־ד")[k] for k in got["places"]][1:3] == ["א", "ב"] and len(got["places"]) == len(got["text"])
    refs, kinds = F.array(F.lit("Shabbat 2a"), F.lit("Jerusalem Talmud Shabbat 2a")), F.array(F.lit("Talmud"), F.lit("Talmud"))
    assert ask(spark, ["x"], recover.preferred(refs, kinds)) == ["Shabbat 2a"]
    assert ask(spark, ["x"], recover.preferred(F.array(F.lit("Mishnah Shabbat 2"), F.lit("Shabbat 2a")), F.array(F.lit("Mishnah"), F.lit("Talmud")))) == ["Mishnah Shabbat 2"]
    assert ask(spark, ["x"], recover.preferred(F.array(F.lit("A 1"), F.lit("B 1")), F.array(F.lit("x"), F.lit("y")))) == [None]


def test_chapter_content(spark):
    segments = spark.createDataFrame([("A 1:1", "A", 1, False), ("A 1:2", "A", 2, True), ("A 1:5", "A", 5, True), ("A 2:1", "A", 9, True)], "ref string, title string, place int, has_text boolean")
    refs = spark.createDataFrame([("A 1", "A", 1, 6), ("A 3", "A", 20, 30)], "ref string, title string, start int, end int")
    assert [plain(tuple(r)) for r in recover.chapter_content(refs, segments).collect()] == [("A 1", "A 1:2", "A 1:5")]
