"""Each rule with a case that it is for and one that it must leave alone."""

from pyspark.sql import functions as F

from spanlink.functions import rules, text
from spanlink.operators import resolve
from spanlink.sources.kept import kept

F_TEXT = "content string"


def ask(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_books_placed_by_pages(spark):
    rows = [("x", "רשי על שבת"), ("x", "על שבת"), ("Sefaria", "רשי על שבת"), ("x", "רשי על ספר"), ("x", "א על ב על ראש השנה")]
    assert ask(spark, rows, "s string, t string", rules.placed_by_pages(F.col("s"), F.col("t"))) == [True, False, False, False, True]


def test_same_place_words(spark):
    rows = [("ראה שם",), ("בשם",), ("ושם.",), ("שמים",), ("לשם",), ("אשם",), ("כשם",)]
    assert ask(spark, rows, F_TEXT, F.col("content").rlike(text.SAME_PLACE)) == [True, True, True, False, True, False, True]


def test_leading_markers(spark):
    rows = [("(כג) text",), (" (ט\"ו) x",), ("(שם) x",), ("(גכ) x",), ("(שבת) x",), ("text (כג)",), ("(רלג)",)]
    assert ask(spark, rows, F_TEXT, rules.leading_marker_end(F.col("content"))) == [4, 6, 0, 0, 0, 0, 5]


def test_implausible_targets(spark):
    rows = [("I Kings 3", 'מ"א'), ("I Kings 3", 'מ"א סי כ'), ("I Kings 3", 'מ"א ג, ד'), ("Amos 4", "עמ' 4"), ("Amos 4", "עמוס ד"), ("Mishnah Eruvin 1", 'פ"ק דעירובין'), ("Mishnah Eruvin 1", 'משנה פ"ק עירובין'), ("Eruvin 2a", 'פ"ק דעירובין'), ("I Kings 3", 'abc מ"א')]
    assert ask(spark, rows, "r string, a string", rules.implausible(F.col("r"), F.col("a"))) == [True, True, False, True, False, True, False, False, False]


def test_spelled_addresses(spark):
    rows = [("Eruvin 20b", 'להלן עירובין טו, ע"ב'), ("Eruvin 15b", 'עירובין טו, ע"ב'), ("Eruvin 20b", "עירובין"), ("Eruvin 20b", 'טו ע"א, טז ע"א'), ("Genesis 3", 'טו ע"א')]
    assert ask(spark, rows, "r string, a string", rules.address_contradicts(F.col("r"), F.col("a"))) == [True, False, False, True, False]
    assert ask(spark, rows, "r string, a string", rules.spelled_ref(F.col("r"), F.col("a"))) == ["Eruvin 15b", "Eruvin 15b", None, None, None]


def test_second_side_mark(spark):
    rows = [
        ("Shabbat 21", "דף כא: ושם", 5, True),
        ("Shabbat 21", "דף כא:", 5, True),
        ("Shabbat 21", "דף כא<b>:</b>ושם", 5, True),
        ("Shabbat 21", "דף כא. ושם", 5, True),
        ("Shabbat 21a", "דף כא: ושם", 5, True),
        ("Genesis 21", "פרק כא: ושם", 6, False),
        ("Shabbat 22", "דף כא: ושם", 5, True),
    ]
    column = rules.marked_second_side(F.col("r"), F.col("c"), F.lit(0), F.col("e"), F.col("l"))
    assert ask(spark, rows, "r string, c string, e int, l boolean", column) == [6, None, 9, None, None, None, None]


def test_relative_directions(spark):
    rows = [
        (["RELATIVE", "NUMBERED"], "לעיל כ", True, 9, 3),
        (["RELATIVE", "NUMBERED"], "לעיל כ", True, 3, 9),
        (["RELATIVE", "NUMBERED"], "לקמן כ", True, 3, 9),
        (["RELATIVE", "NUMBERED"], "לקמן כ", False, 3, 9),
        (["RELATIVE", "NAMED"], "לקמן כ", False, 9, 3),
        (["RELATIVE"], "לעיל", True, 9, 3),
        (["NUMBERED"], "לעיל כ", True, 9, 3),
        (["RELATIVE", "NUMBERED"], "לעיל ולקמן", True, 9, 3),
        (["RELATIVE", "NAMED"], "לקמן כ", False, None, 3),
    ]
    column = rules.relative_direction(F.col("l"), F.col("a"), F.col("s"), F.col("o"), F.col("t"))
    assert ask(spark, rows, "l array<string>, a string, s boolean, o int, t int", column) == ["above", None, "below", None, "below", None, None, None, None]


def test_code_vetoes(spark):
    rows = [("Shulchan Arukh, Yoreh De'ah", 'יו"ד סי כ ס"ק ג'), ("Shulchan Arukh, Yoreh De'ah", 'יו"ד סי כ'), ("Other", 'ס"ק ג')]
    assert ask(spark, rows, "t string, a string", rules.base_code_note(F.col("t"), F.col("a"))) == [True, False, False]
    rows = [("Mishneh Torah, X", [("NUMBERED", "לא")]), ("Mishneh Torah, X", [("NUMBERED", "כג")]), ("Other", [("NUMBERED", "לא")]), ("Mishneh Torah, X", [("NAMED", "לא")])]
    assert ask(spark, rows, "t string, p array<struct<label:string,text:string>>", rules.unproven_number(F.col("t"), F.col("p"))) == [True, False, False, False]


def test_pick_decides_only_there():
    assert resolve.pick(["A 1:2"], False, None) == "A 1:2" and resolve.pick([], True, "A 1") is None
    assert resolve.pick(["A 1:2", "A 3:2"], True, "A 3:9") == "A 3:2"
    assert resolve.pick(["A 1:2", "A 3:2"], False, "A 3:9") is None
    assert resolve.pick(["A 1:2", "B 3:2"], True, "A 3:9") is None
    assert resolve.pick(["A 3:1", "A 3:2"], True, "A 3:9") is None
    assert resolve.pick(["A 3", "A 4"], True, "A 3") is None


def test_resolve_end_to_end(spark):
    parts = lambda *labels: [(x, "t") for x in labels]
    rows = [
        ("s", "b", 0, 0, "😀 ראה א ב", 2, 7, parts("NAMED"), ["A 1:2"], None, None),
        ("s", "b", 1, 0, "שם ג", 0, 4, parts("IBID"), ["A 1:3", "A 2:3"], None, None),
        ("s", "b", 2, 0, "שם", 0, 2, parts("IBID"), ["B 4"], None, None),
        ("s", "b", 3, 0, "two works", 0, 3, parts("NAMED"), ["A 1:2", "B 4"], None, None),
        ("s", "b", 4, 0, "(כג) x", 0, 4, parts("NUMBERED"), ["B 4"], None, None),
        ("s", "b", 5, 0, "missing", 0, 7, parts("NAMED"), ["B 9"], None, None),
        ("s", "b", 6, 0, "לעיל כ", 0, 6, parts("RELATIVE", "NUMBERED"), ["B 4"], "B 7", 7),
        ("s", "b", 7, 0, "לקמן כ", 0, 6, parts("RELATIVE", "NUMBERED"), ["B 4"], "B 7", 7),
        ("s", "b", 8, 0, "שבת כא: ושם", 0, 6, parts("NAMED"), ["Shabbat 21"], None, None),
        ("s", "b", 9, 0, "בראשית ג: ושם", 0, 8, parts("NAMED"), ["Genesis 3"], None, None),
        ("s", "b", 10, 0, "לעיל כ", 0, 6, parts("RELATIVE", "NAMED"), ["B 4"], None, 7),
    ]
    schema = "source string, title string, line_index int, pos int, content string, start int, end int, parts array<struct<label:string,text:string>>, candidates array<string>, context string, place long"
    segments = [("A 1:2", "A", 2, True), ("A 1:3", "A", 3, True), ("A 2:3", "A", 9, True), ("B 4", "B", 4, True), ("B 9", "B", 9, False), ("Shabbat 21b", "Shabbat", 42, True), ("Genesis 3", "Genesis", 3, True)]
    got = resolve.resolve(spark.createDataFrame(rows, schema), spark.createDataFrame(segments, "ref string, title string, place long, has_text boolean"), keep=kept)
    found = {r["line_index"]: (r["start"], r["end"], r["target_ref"], r["relative_direction"]) for r in got.collect()}
    assert found == {0: (3, 8, "A 1:2", None), 1: (0, 4, "A 1:3", None), 6: (0, 6, "B 4", "above"), 8: (0, 7, "Shabbat 21b", None), 9: (0, 8, "Genesis 3", None)}
