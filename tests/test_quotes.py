"""Stretches against brute force, and quotations beside "there" as evidence."""

import random

from pyspark.sql import functions as F

from spanlink.operators import quotes, resolve
from spanlink.sources.kept import kept

CORPUS = "work string, order int, ref string, words array<string>"


def brute(asked, corpus):
    out = set()
    for key, words in asked:
        for work in {c[0] for c in corpus}:
            whole = [w for c in sorted(corpus) if c[0] == work for w in c[3]]
            for q in range(len(words)):
                for at in range(len(whole)):
                    n = 0
                    while q + n < len(words) and at + n < len(whole) and words[q + n] == whole[at + n]:
                        n += 1
                    if n > 1 and not (q and at and words[q - 1] == whole[at - 1]):
                        out.add((key, work, q, at, n))
    return out


def test_stretches_equal_brute_force(spark):
    rng = random.Random(4)
    text = lambda n: [rng.choice("abcd") for _ in range(n)]
    corpus = [(w, k, f"{w} {k}", text(rng.randrange(0, 6))) for w in "XYZ" for k in range(12)]
    asked = [(k, text(rng.randrange(0, 14))) for k in range(12)] + [(90, None), (91, ["a"])]
    index = quotes.postings(spark.createDataFrame(corpus, CORPUS))
    got = quotes.stretches(spark.createDataFrame(asked, "id int, words array<string>"), index, ["id"])
    assert {tuple(r) for r in got.collect()} == brute([a for a in asked if a[1]], corpus)
    every = quotes.phrases(got, ["id"], 3).collect()
    count = {}
    for r in every:
        count[r["id"], r["q"]] = count.get((r["id"], r["q"]), 0) + 1
    assert every and all(r["in_all"] == count[r["id"], r["q"]] for r in every)
    assert quotes.stretches(spark.createDataFrame([], "id int, words array<string>"), index, ["id"]).collect() == []


VERSES = [
    ("Genesis", 1, "Genesis 1:1", "בראשית ברא אלקים את השמים ואת הארץ"),
    ("Genesis", 2, "Genesis 1:2", "והארץ היתה תהו ובהו וחשך על פני תהום"),
    ("Genesis", 3, "Genesis 2:2", "ויכל אלקים ביום השביעי מלאכתו אשר עשה"),
    ("Psalms", 1, "Psalms 1:1", "אשרי האיש אשר לא הלך בעצת רשעים"),
    ("Psalms", 2, "Psalms 1:2", "כי אם בתורת חפצו והארץ היתה תהו ובהו"),
]


def there(k, content, anchor, candidates=(), labels=("IBID",)):
    start = content.index(anchor)
    return ("s", "b", k, 0, content, start, start + len(anchor), [(x, anchor, 0, len(anchor)) for x in labels], list(candidates), None, None)


def test_quotations_beside_there(spark):
    corpus = spark.createDataFrame([(w, o, r, t.split()) for w, o, r, t in VERSES], CORPUS)
    works = spark.createDataFrame([("Genesis", ["בראשית"], "Tanakh"), ("Psalms", ["תהלים"], "Tanakh"), ("Gittin", ["גיטין"], "Talmud")], resolve.WORKS)
    rows = [
        there(0, "אשרי האיש אשר לא הלך (שם א א)", "שם א א"),  # a phrase that one verse has
        there(1, "אשרי האיש אשר לא הלך (שם א ב)", "שם א ב"),  # another verse printed
        there(2, "והארץ היתה תהו ובהו (שם א ב)", "שם א ב"),  # two works have it
        there(3, "ביום השביעי מלאכתו אשר (שם ב)", "שם ב"),  # no chapter, no candidate
        there(4, "ביום השביעי מלאכתו אשר (שם ב)", "שם ב", ["Genesis 2:2", "Psalms 1:2"]),
        there(5, "(שם א א) אשרי האיש אשר לא הלך", "שם א א"),  # behind the bracket
        there(6, "בגיטין אשרי האיש אשר לא הלך (שם א א)", "שם א א"),  # another work
        there(7, "שנאמר חפצו והארץ וגו' (שם שם ב)", "שם שם ב", ["Psalms 1:2"]),
        there(8, "שכתוב בעצת רשעים וגו' (שם שם א)", "שם שם א", ["Psalms 1:1"]),
        there(9, "שכתוב בעצת רשעים וגו' (שם שם א)", "שם שם א", ["Genesis 1:1"]),
        there(10, "בעצת רשעים כי אם (שם א א)", "שם א א"),  # over the end of a verse
        there(11, "אשרי האיש אשר לא (תהלים א א)", "תהלים א א", labels=("NAMED",)),
    ]
    c = spark.createDataFrame(rows, "source string, title string, line_index int, pos int, content string, start int, end int, parts array<struct<label:string,text:string,start:int,end:int>>, candidates array<string>, context string, place long")
    found = kept(quotes.evidence(c, corpus, works))
    got = {}
    for r in found.collect():
        got.setdefault(r["line_index"], set()).add((r["ref"], r["decides"]))
    assert {k: {r for r, d in x if d} for k, x in got.items() if any(d for _, d in x)} == {0: {"Psalms 1:1"}, 4: {"Genesis 2:2"}, 5: {"Psalms 1:1"}, 7: {"Psalms 1:2"}, 8: {"Psalms 1:1"}}
    assert {r for r, _ in got[2]} == {"Genesis 1:2", "Psalms 1:2"} and 10 not in got and 11 not in got and 3 in got
    # in the fold: evidence continues the verse before, what decides leaves its work
    segments = spark.createDataFrame([(r, w, o, True) for w, o, r, _ in VERSES], "ref string, title string, place long, has_text boolean")
    rows = [("s", "a", 0, 0, "x", 0, 1, [("NAMED", "x", 0, 1)], ["Genesis 1:1"], None, None), *[(*there(k + 1, t, a)[:1], "a", *there(k + 1, t, a)[2:]) for k, (t, a) in enumerate([("והארץ היתה תהו ובהו (שם ב)", "שם ב"), ("אשרי האיש אשר לא הלך (שם א א)", "שם א א")])]]
    c = spark.createDataFrame(rows, c.schema)
    taken = resolve.resolved(c, segments, quoted=kept(quotes.evidence(c, corpus, works)), keep=kept)
    assert [(r["line_index"], r["kind"], r["ref"]) for r in taken.orderBy("line_index").collect()] == [(0, "candidate", "Genesis 1:1"), (1, "continued", "Genesis 1:2"), (2, "quoted", "Psalms 1:1")]


def test_empty_corpus(spark):
    index = quotes.postings(spark.createDataFrame([], CORPUS))
    assert quotes.stretches(spark.createDataFrame([(1, ["a", "b"])], "id int, words array<string>"), index, ["id"]).agg(F.count("*")).first()[0] == 0
