import random
from collections import Counter

from spanlink.llm import decontaminate


def _shingles(text):
    w = (text or "").lower().split()
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(docs, items, at_least=0.8):
    found = {}
    for d, text in docs:
        s = _shingles(text)
        for i, item in items:
            t = _shingles(item)
            if not s or not t:
                continue
            for a in range(max(1, len(s) - len(t) + 1)):
                x, y = Counter(s[a : a + len(t)]), Counter(t)
                sim = sum((x & y).values()) / sum((x | y).values())
                if sim >= at_least and sim > found.get((d, i), 0):
                    found[d, i] = sim
    return found


def test_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(rng.choice([6, 20, 36, 50])))) for k in range(12)] + [(12, "one two"), (13, None), (14, ""), (15, "a a a a a a a a a")]
    docs = []
    for d in range(60):
        words = [word() for _ in range(rng.randrange(0, 200))]
        if rng.random() < 0.6:
            planted = rng.choice(items)[1] or ""
            planted = planted.upper().split()
            if planted and rng.random() < 0.5:
                planted[rng.randrange(len(planted))] = "CHANGED"
            at = rng.randrange(len(words) + 1)
            words[at:at] = planted
        docs.append((d, " ".join(words)))
    docs += [(100, None), (101, ""), (102, "One\tTwo"), (None, items[1][1]), (103, "a " * 50), docs[3], (104, (items[2][1] + " ") * 40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", decontaminate.F.lit("clash"))
    b = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(d, b).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 20
    kept = decontaminate.without_contaminated(d, b)
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(-1)) == sorted(-1 if x is None else x for x, _ in docs if x not in {k for k, _ in want})
    assert decontaminate.contaminated(d.limit(0), b).count() == 0 and decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_blocks_cover_the_radius():
    rng = random.Random(1)
    masks = [(1 << y) - (1 << x) for _, x, y in decontaminate._BLOCKS]
    assert sum(masks) == (1 << 64) - 1
    for _ in range(300):
        diff = sum(1 << p for p in rng.sample(range(64), decontaminate.RADIUS))
        assert any(not diff & m for m in masks)


def test_pairs_just_above_the_limit(spark):
    """Copies with words changed until the similarity is 0.80 to 0.85: none may be lost to the radius."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(60 + k))) for k in range(30)]
    docs = []
    for k, text in items:
        for _ in range(4):
            words = text.split()
            at = rng.randrange(2)
            while brute([(0, " ".join(words))], [(k, text)], 0.8).get((0, k), 0) >= 0.85:
                kept = words[at]
                words[at] = word()
                if not brute([(0, " ".join(words))], [(k, text)], 0.8):
                    words[at] = kept
                at = (at + 1) % len(words)
            docs.append((len(docs), " ".join([word() for _ in range(rng.randrange(30))] + words)))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items) and len(got) == len(docs) and min(got.values()) < 0.83
