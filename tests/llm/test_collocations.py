import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from spanlink.llm import collocations


def brute(docs, longest, least, best):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    rows = {}
    for (lang, ws), a in candidates.items():
        if any(m == lang and len(x) > len(ws) and 100 * b >= 50 * a and any(x[i : i + len(ws)] == ws for i in range(len(x))) for (m, x), b in candidates.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        s, k = min(cuts)
        rows.setdefault(lang, []).append((-s, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, own in rows.items() for rank, (s, a, p, l, r) in enumerate(sorted(own)[:best], 1))  # noqa: E741


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    words = ["new", "york", "City", "of", "the", "é", "a\x00b", "x\x0by", " ", "THE", "word\x1fone", "İ", "ＡB"]
    sep = [" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n", "!?"]
    docs = []
    for _ in range(250):
        docs.append((rng.choice(["en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(sep) for _ in range(rng.randrange(0, 60)))))
    return [*docs, *docs[:40], ("en", None), (None, ""), ("fr", " .\t! "), ("en", "new york city " * 300), ("en", "of of of of\n" * 50)]


@pytest.mark.parametrize(("longest", "best", "chunk"), [(3, 2000, 1 << 21), (3, 7, 11), (5, 30, 100)])
def test_equals_brute_force(spark, made, longest, best, chunk, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_LEAST", 1)
    monkeypatch.setattr(collocations, "HOT_SHARE", 1 / 50)
    df = spark.createDataFrame(made, "lang string, text string").repartition(3).withColumn("n", collocations.F.lit("clash")).withColumn("piece", collocations.F.lit(1))
    got = sorted(map(tuple, collocations.collocations(df, longest=longest, best=best).collect()))
    assert got == brute(made, longest, 10, best) and len(got) > 10


def test_chunks_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 4)
    rows = [("en", "a b c", 2), ("de", "a b c d e f", 1), ("en", "a", 1), ("en", "b c", 5), ("de", "b c", 7)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "piece", "times"), r, strict=True)) for r in rows])
    cut = list(collocations._chunks(iter([batch, batch.slice(0, 2)])))
    assert [c.column("piece").to_pylist() for c in cut] == [["a b c"], ["a b c d e f"], ["a", "b c"], ["b c"], ["a b c"], ["a b c d e f"]]
    total, place = Counter(), {}
    for c in cut:
        for bucket, *block in collocations.blocks(c, 3, 5):
            text, grams = collocations.opened([tuple(block)])
            names = text.to_pylist()
            for r in (r for b in grams for r in b.to_pylist()):
                gram = " ".join(names[r[w]] for w in ("w0", "w1", "w2") if r[w])
                total[names[r["lang"]], gram] += r["n"]
                assert place.setdefault((names[r["lang"]], gram), bucket) == bucket
    want = Counter()
    for lang, piece, times in rows + rows[:2]:
        ws = piece.split()
        for k in (1, 2, 3):
            for i in range(len(ws) - k + 1):
                want[lang, " ".join(ws[i : i + k])] += times
    assert total == want and len(set(place.values())) > 1


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12 + 7, 10**12 + 9, 10**13 + 1)], "a long, l long, r long")
    got = df.select(collocations.score("a", collocations.F.col("l"), collocations.F.col("r"))).first()[0]
    assert got == 10**6 * (10**12 + 7) ** 2 // ((10**12 + 9) * (10**13 + 1))
