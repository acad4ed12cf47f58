import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from spanlink.llm import substrings, suffix


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.integers(0, rng.integers(1, 5), rng.integers(1, 60))
        order = sorted(range(len(x)), key=lambda i: x[i:].tolist())
        assert suffix.suffix_array(x, 100).tolist() == order
        lcp = suffix.common_prefixes(x, np.array(order), 100)
        for k in range(1, len(x)):
            a, b = x[order[k - 1] :], x[order[k] :]
            m = min(len(a), len(b))
            same = np.flatnonzero(a[:m] != b[:m])
            assert lcp[k] == (same[0] if len(same) else m)
        wanted = rng.random(len(x)) < 0.3
        part = suffix.suffix_array(x, 100, wanted).tolist()
        assert part == [k for k in order if k in set(part)] and set(np.flatnonzero(wanted)) <= set(part)
    assert suffix.suffix_array(np.empty(0, np.int64), 9).size == 0


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[k : k + 200] for r in raw for k in range(len(r) - 199))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for k in range(len(r) - 199):
            if seen[r[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((len(r), len(r) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed=2, n=60):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    shared = [text(k) for k in (199, 200, 201, 260, 700)]
    docs = [text(rng.randrange(600)) + rng.choice(shared) + text(rng.randrange(500)) + rng.choice(["", *shared]) for _ in range(n)]
    near = list(docs[0] + docs[1])
    near[300] = "X"
    return [*docs, None, "", docs[3], docs[3], "of " * 300, "x" * 250, "x" * 199, "".join(near), docs[0] + docs[1], "short"]


def _check(spark, texts):
    df = spark.createDataFrame([(k if k else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3).withColumn("h", substrings.F.lit("clash"))
    got = {r["doc_id"] or 0: tuple(r)[1:5] for r in substrings.remove_repeats(df).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts)


def test_equals_brute_force(spark):
    _check(spark, corpus())


@pytest.mark.parametrize("group", [1, 3])  # with 1, all that differs under an anchor comes down to windows
def test_split_groups_give_the_same(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    _check(spark, corpus(7))


def test_empty(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
