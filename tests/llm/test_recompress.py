import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from spanlink.llm import recompress

W = 13


def brute(rows, width=W):
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in rows]
    first = {}
    for (d, _), ws in zip(rows, words, strict=True):
        if d is not None:
            for i in range(len(ws) - width + 1):
                key = tuple(ws[i : i + width])
                first[key] = min(d, first.get(key, d))
    out = []
    for (d, _), ws in zip(rows, words, strict=True):
        gone = np.zeros(len(ws), bool)
        for i in range(len(ws) - width + 1):
            if d is not None and first[tuple(ws[i : i + width])] < d:
                gone[i : i + width] = True
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((d, len(ws), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed=4, n=80):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "b", "É", "the", "x\x1fy", " "]) + rng.choice(["", "", "1", "ü"])
    text = lambda k: rng.choice([" ", "\n", " \t"]).join(word() for _ in range(k))
    shared = [text(k) for k in (12, 13, 14, 40, 200)] + ["no " * 30, "to be " * 20]
    docs = [(2**53 + 1 + 2 * k, f"{text(rng.randrange(40))} {rng.choice(shared)} {text(rng.randrange(30))} {rng.choice(['', *shared])}") for k in range(n)]
    return [*docs, (None, docs[0][1]), (None, shared[4]), (3, None), (4, ""), (5, " \n"), (docs[1][0], docs[1][1]), (1, shared[3]), (6, "y " * 12), (7, "y " * 13), (8, "y " * 14), (9, shared[4] + " " + docs[3][1])]


@pytest.mark.parametrize("rounds", [(4,), (1, 2, 1), (0,)])
def test_equals_brute_force(spark, rounds):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("name", recompress.F.lit("clash")).withColumn("file", recompress.F.lit(1))
    got = recompress.remove_repeats(df, rounds=rounds, keep_text=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == brute(rows)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_long_texts_are_read_in_stretches(spark, monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice("abc") + rng.choice("de") for _ in range(4000))
    rows = [(1, text[:9000]), (2, text), (3, "zz " * 50 + text[3000:] + " qq" * 40)]
    ids, texts = pa.array([r[0] for r in rows]), [r[1].encode() for r in rows]
    monkeypatch.setattr(recompress, "_read", lambda path: iter([(ids, texts)]))
    monkeypatch.setattr(recompress, "CHUNK_BYTES", 100)
    monkeypatch.setattr(recompress, "UNIT_WORDS", 64)
    everything = np.sort(recompress.symbol_rows("", W, (2,), np.empty(0, np.uint64))["name"])
    rows = lambda: {k: (a, m) for *k, a, m in zip(*[x.tolist() for x in recompress.window_rows("", W, (2,), everything).values()], strict=True) for k in [tuple(k)]}
    small = rows()
    monkeypatch.setattr(recompress, "UNIT_WORDS", 1 << 18)
    assert rows() == small and len(small) > 4000
    assert len({tuple(t.decode().split()[i : i + W]) for t in texts for i in range(len(t.split()) - W + 1)}) == len(small)


def test_interiors_depend_on_the_window_alone():
    rng = np.random.default_rng(0)
    for _ in range(60):
        window = rng.integers(0, 6, W).astype(np.uint64)
        seen = set()
        for _ in range(6):
            before, after = (rng.integers(0, 6, rng.integers(0, 9)).astype(np.uint64) for _ in range(2))
            names = np.concatenate([before, window, after])
            parse = recompress.Parse(names, np.zeros(len(names), np.int64), W, np.ones(len(names), bool))
            interiors = []
            for k, steps in enumerate((2, 2)):
                parse.round(k, steps)
                w = len(before)
                lo, hi = parse.lo[w], parse.hi[w]
                interiors.append((lo - w, hi - w, tuple(parse.name[parse.at[lo] : parse.at[hi]].tolist()) if lo < hi else ()))
            seen.add((*interiors, int(parse.window_names()[w])))
        assert len(seen) == 1


def test_windows_of_one_name_are_told_apart():
    side = (np.array([5, 7, 7, 7, 9], np.uint64), np.array([1, 2, 3, 4, 1], np.uint64), np.array([10, 20, 30, 40, 50]))
    got = recompress._least_of(np.array([7, 7, 5, 9, 8, 7], np.uint64), np.array([4, 2, 1, 2, 1, 9], np.uint64), side)
    none = np.iinfo(np.int64).max
    assert got.tolist() == [40, 20, 10, none, none, none]
