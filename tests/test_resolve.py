"""The ordered resolver: what history decides, step by step, and all rules together on a table of books."""

import pytest

from spanlink.functions import attribution
from spanlink.operators import resolve
from spanlink.sources.kept import kept
from spanlink.streaming import follow
from tests.test_recover import SCHEMA, catalogs, cite


def row(labels=(), candidates=(), ok=None, offers=(), **more):
    """A row for `step`; ok: which candidates passed (all); offers: (kind, ref) of rebuilt targets."""
    passed = list(candidates) if ok is None else list(ok)
    option = lambda kind, offered, ref: {"kind": kind, "offered": offered, "ref": ref, "start": 0, "end": 1, "direction": None, "shown": None}
    base = {"labels": list(labels), "candidates": list(candidates), "rebuilt": False, "resets": bool(candidates), "own_context": False, "address": None, "homes": [], "verse": [], "evidence": [], "start": 0, "end": 1}
    return base | {"outcomes": [option("candidate", c, c) for c in passed] + [option(k, None, r) for k, r in offers]} | more


def run(*rows):
    history, out = resolve.History(), []
    for r in rows:
        history, taken = resolve.step(history, r)
        out.append(taken and taken["ref"])
    return out, history


THERE = row(["IBID"], ["A 3:2", "A 4:2"])


def test_a_dropped_citation_is_no_antecedent():
    assert run(row(candidates=["A 3:1"]), THERE)[0] == ["A 3:1", "A 3:2"]
    assert run(row(candidates=["A 3:1"], ok=[]), THERE)[0] == [None, None]
    assert run(row(candidates=["A 3:1"]), row(candidates=["B 1:1"], ok=[]), THERE)[0] == ["A 3:1", None, None]
    assert run(row(candidates=["A 3:1"]), row(candidates=["B 1:1", "C 1:1"]), THERE)[0] == ["A 3:1", None, None]


def test_failed_and_rebuilt_citations_leave_what_was_emitted_last():
    named = row(["IBID", "NAMED"], ["A 3:2", "A 4:2"])
    assert run(row(candidates=["A 3:1"]), row(), named)[0] == ["A 3:1", None, "A 3:2"]
    assert run(row(candidates=["A 3:1"]), row(offers=[("geresh", "Z 9")]), named)[0] == ["A 3:1", "Z 9", "A 3:2"]
    assert run(row(offers=[("geresh", "A 3:1")]), named)[0] == ["A 3:1", None]
    # but they are what the next one follows: another work before an unnamed "there" vetoes it
    assert run(row(candidates=["A 3:1"]), row(offers=[("geresh", "Z 9")]), THERE)[0] == ["A 3:1", "Z 9", None]
    assert run(row(candidates=["A 3:1"]), row(), THERE)[0] == ["A 3:1", None, None]


def test_lists_reset_once():
    part = lambda ref, resets: row(offers=[("given", ref)], rebuilt=True, resets=resets)
    named = row(["IBID", "NAMED"], ["A 3:2", "A 4:2"])
    assert run(row(candidates=["A 3:1"]), part("Z 1a", True), part("Z 2a", False), named)[0] == ["A 3:1", "Z 1a", "Z 2a", None]
    assert run(row(candidates=["A 3:1"]), part("Z 1a", False), part("Z 2a", False), named)[0] == ["A 3:1", "Z 1a", "Z 2a", "A 3:2"]


def test_own_references_keep_history_only_if_the_candidate_agrees():
    assert run(row(["RELATIVE"], ["A 3a"], offers=[("own", "A 3a")]))[1] == ("A 3a", "A 3a")
    assert run(row(["RELATIVE"], ["A 4a"], offers=[("own", "A 3a")]))[1] == (None, "A 3a")
    assert run(row(["NAMED"], ["A 1:1"], own_context=True))[0] == [None]


def test_there_continues_the_proven_work_before():
    leaf = row(["IBID"], address="5a", homes=["A"])
    assert run(row(candidates=["A 3a"]), leaf, leaf)[0] == ["A 3a", "A 5a", "A 5a"]
    assert run(row(candidates=["B 3a"]), leaf)[0] == ["B 3a", None]
    assert run(row(candidates=["A 3a"]), row(), leaf)[0] == ["A 3a", None, None]
    verse = row(["IBID"], verse=[7], evidence=["A 3:7"])
    assert run(row(candidates=["A 3:1"]), verse)[0] == ["A 3:1", "A 3:7"]
    assert run(row(candidates=["A 4:1"]), verse)[0] == ["A 4:1", None]
    assert run(row(candidates=["A 4:1"]), row(["IBID"], verse=[3, 7], evidence=["A 3:7"]))[0] == ["A 4:1", "A 3:7"]
    # its own proof lets "there" leave the work before
    assert run(row(candidates=["A 3:1"]), row(["IBID"], ["Q 1:1"]))[0] == ["A 3:1", None]
    assert run(row(candidates=["A 3:1"]), row(["IBID"], ["Q 1:1"], offers=[("quoted", "Q 2:2")]))[0] == ["A 3:1", "Q 2:2"]


def test_books_of_all_rules(spark):
    works, segments, chapters = catalogs(spark)
    segments = segments.withColumn("place", resolve.F.lit(5).cast("long"))
    more = [("Gone 3:2", "Gone"), ("Gone 4:2", "Gone"), ("Ketubot 13b", "Ketubot"), ("Ketubot 14a", "Ketubot"), ("Gittin 9a", "Gittin"), ("Psalms 18", "Psalms"), ("Sukkah 13b", "Sukkah"), ("Sukkah 14a", "Sukkah"), ("Ketubot 18a", "Ketubot"), ("Gittin 12b", "Gittin"), ("Rashi on Gittin 9a:1", "Rashi on Gittin")]
    segments = segments.unionByName(spark.createDataFrame([(r, t, True, 5) for r, t in more], "ref string, title string, has_text boolean, place long"))
    n = lambda *p: [("NAMED" if k % 3 == 0 else "NUMBERED", t) for k, t in enumerate(p)]
    there, own = [("IBID", "שם")], ("Gittin", "גיטין", 21, 21)
    books = {
        "gone": [cite(0, "גון א", [("NAMED", "גון")], ["Gone 3:1"]), cite(1, "שם ב", there, ["Gone 3:2", "Gone 4:2"])],
        "lists": [cite(0, "תהלים יח לא, בראשית א ב", n("תהלים", "יח", "לא", "בראשית", "א", "ב")), cite(1, "בפרק קמא דסוכה (יג, ב. יד, א)", [("NAMED", "בפרק קמא דסוכה")], ["Sukkah 13b"])],
        "there": [cite(0, "כתובות יג:", [("NAMED", "כתובות")], ["Ketubot 13b"]), cite(1, "שם יד.", there), cite(2, "שם", there, ["Gittin 9a"]), cite(3, "שם טו.", there)],
        "writer": [cite(0, 'רש"י פירש בפרק קמא דסוכה (יג, ב)', [("NAMED", "בפרק קמא דסוכה")], anchor="בפרק קמא דסוכה (יג, ב)")],
        "paren": [cite(0, "בפרק שני (כתובות דף יח.", [("NAMED", "בפרק שני"), ("NAMED", "כתובות"), ("NUMBERED", "דף יח.")])],
        "own": [cite(0, "לקמן יב:", [("RELATIVE", "לקמן")], own=own), cite(1, "בכתובות כתב לקמן יב:", [("RELATIVE", "לקמן")], own=own, anchor="לקמן יב:")],
        "shown": [cite(0, 'רש"י פירש גיטין ט.', [("NAMED", "גיטין")], ["Gittin 9a"], anchor="גיטין ט."), cite(1, "שם יב:", there)],
        "geresh": [cite(0, "(תהלים יח' לא')", []), cite(1, "שם לא", there, ["Psalms 18:31"])],
    }
    rows = [("s", b, *c[2:], None, None) for b, cites in books.items() for c in cites]
    df = spark.createDataFrame(rows, SCHEMA + ", context string, place long")
    found = kept(resolve.resolved(df, segments, works, chapters, keep=kept))
    got = {}
    for r in found.collect():
        got.setdefault(r["title"], []).append((r["line_index"], r["sub"], r["kind"], r["ref"]))
    assert [(r["ref"], r["shown"]) for r in found.where("shown is not null").collect()] == [("Gittin 9a", "Rashi on Gittin 9a")]
    assert {b: sorted(x) for b, x in got.items()} == {
        "lists": [(0, 0, "given", "Psalms 18:31"), (0, 1, "given", "Genesis 1:2"), (1, 0, "given", "Sukkah 13b"), (1, 1, "given", "Sukkah 14a")],
        "there": [(0, 0, "candidate", "Ketubot 13b"), (1, 0, "continued", "Ketubot 14a")],
        "paren": [(0, 0, "parenthesized", "Ketubot 18a")],
        "own": [(0, 0, "own", "Gittin 12b")],
        "shown": [(0, 0, "candidate", "Gittin 9a"), (1, 0, "continued", "Gittin 12b")],
        "geresh": [(0, 0, "geresh", "Psalms 18:31"), (1, 0, "candidate", "Psalms 18:31")],
    }


@pytest.mark.parametrize(
    ("before", "anchor", "after", "want"),
    [
        ("פירשתי לעיל ", "(דף ב.)", "", "self"),
        ('רש"י פירש ', "שבועות ב.", "", "other"),
        ("", "שבועות ב.", ' פרש"י', "other"),
        ("", "שבועות ב.", " כתבתי שם", "self"),
        ("", "שבועות ב.", " ושם ביארנו", "self"),
        ("אמרינן ", "שבועות ב.", "", None),
        ("כתב לעיל ", "שבועות ב.", "", "ambiguous"),
        ("בתוספות ", "שבועות ב.", "", "other"),
        ("תוספות ", "שבועות ב.", "", None),
        ("פירש רש\"י בפרק קמא ", "(דף ב.)", "", "other"),
        ("פירש רש\"י דבר אחר ", "(דף ב.)", "", None),
        ("אמרתי דבר ", "שבועות ב.", "", "ambiguous"),
        ("כמו שפירשתי ואמרינן ", "שבועות ב.", "", None),
        ("פירשתי מפרק קמא ", "(דף ב.)", "", "ambiguous"),
        ("", "שבועות ב.", ' רש"י', "ambiguous"),
        ("", "שבועות ב.", ' רש"י לא פירש', None),
        ("", "שבועות ב.", ' ורש"י פירש', None),
        ("הרב כתב שפירשתי ", "לעיל ב.", "", "other"),
        ("פירשתי לעיל. ", "שבועות ב.", "", None),
        ("פירשתי אבל לעיל ", "(דף ב.)", "", None),
        ("<b>פֵּירַשְׁתִּי</b> [לעיל] ", "(דף ב.)", "", "self"),
        ('רש"י פירש (', "שבועות ב.", ")", "other"),
        ("פירשתי לעיל (", "שבועות ב.", ")", "self"),
        ("", "", "", None),
    ],
)
def test_who_governs_a_citation(before, anchor, after, want):
    text = before + anchor + after
    assert attribution.writer_of(text, len(before), len(before) + len(anchor)) == want


@pytest.mark.parametrize(
    ("before", "after", "want"),
    [
        ('רש"י פירש ', "", "Rashi"),
        ("בתוספות ", "", "Tosafot"),
        ("", ' בתוס\' ד"ה אמר', "Tosafot"),
        ("", ' פרש"י', "Rashi"),
        ("", ' תוספות רי"ד פירש', None),
        ('רש"י פירש ', ' בתוס\' ד"ה', None),
        ("פירשתי לעיל ", "", None),
    ],
)
def test_commentaries_named_at_a_citation(before, after, want):
    assert attribution.commentary_of(f"{before}שבועות ב.{after}", len(before), len(before) + 9) == want


def test_streams_fold_as_tables_do(spark, tmp_path):
    rows = [row(candidates=["A 3:1"]), THERE, row(candidates=["B 1"], ok=[]), THERE, row(candidates=["A 4:9"]), THERE]
    kinds = "source string, title string, line_index int, pos int, sub int, labels array<string>, candidates array<string>, rebuilt boolean, resets boolean, own_context boolean, start int, end int, "
    kinds += f"outcomes array<{resolve.OPTION}>, address string, homes array<string>, verse array<int>, evidence array<string>"
    names = [f.split()[0] for f in kinds.split(", ")]
    table = [{"source": "s", "title": b, "line_index": k, "pos": 0, "sub": 0} | r for b in "xy" for k, r in enumerate(rows)]
    df = spark.createDataFrame([tuple(r[n] if n != "outcomes" else [tuple(o.values()) for o in r[n]] for n in names) for r in table], kinds)
    want = sorted(tuple(r) for r in resolve.folded(df).collect())
    assert [w[6] for w in want if w[1] == "x"] == ["A 3:1", "A 3:2", "A 4:9", "A 4:2"]
    for part, lines in enumerate(("line_index < 2", "line_index >= 2")):
        df.where(lines).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{part}")
    got = []
    for part in (0, 1):  # the history goes on from the checkpoint
        df.where(("line_index < 2", "line_index >= 2")[part]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/all")
        q = follow.fold_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/all")).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select(*[f.split()[0] for f in resolve.FOLDED.split(", ")]).collect())
    assert got == want
