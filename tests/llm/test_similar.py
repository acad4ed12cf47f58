import random

from spanlink.llm import similar


def _set(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_one_of_each_group_stays_and_others_are_left_alone(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(40)]
    docs = []
    for d in range(60):
        words = [word() for _ in range(rng.randrange(60, 900))]
        if d % 2:
            words[10:10] = passage
        docs.append((d, " ".join(words)))
    for k in range(120):
        words = docs[k % 30][1].split()
        for _ in range(max(1, len(words) // 120)):
            words[rng.randrange(len(words))] = "changed"
        docs.append((100 + k, " ".join(words)))
    docs += [(500, None), (501, ""), (502, "a b"), (503, "A  b"), (None, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("part", similar.F.lit("clash"))
    left = {r["doc_id"] for r in similar.without_similar(df).collect()}
    sets = {d: _set(t) for d, t in docs if d is not None}
    sim = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    gone = set(sets) - left
    assert all(any(sim(d, o) >= 0.8 for o in sets if o < d) for d in gone) and None in left and {500, 501, 502} <= left and 503 in gone
    missed = [d for d in left if d and any(o < d and sim(d, o) >= 0.8 for o in left - {None} if sets[o] and sets[d])]
    assert len(gone) > 60 and len(missed) <= 2
    assert similar.without_similar(df.limit(0)).count() == 0


def test_levels_cover_partners():
    for n in range(1, 3000, 7):
        for m in range(n, int(n / 0.8) + 1, 11):
            assert set(similar.levels(n)) & set(similar.levels(m)[:1])


def _kept(sets):
    """The least of each component of all pairs, by brute force."""
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {d for d in sets if root(d) == d}


def _left(spark, docs):
    return sorted(r["doc_id"] for r in similar.without_similar(spark.createDataFrame(docs, "doc_id long, text string")).collect())


def test_middle_members_of_a_large_group_are_compared(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(404)]
    docs = []
    for d in range(300):
        words = list(base)
        for p in rng.sample(range(5, 399), rng.randrange(3, 7)):
            words[p] = f"e{d}x{p}"
        docs.append((d, " ".join(words)))
    rng.shuffle(docs)
    want = _kept({d: _set(t) for d, t in docs})
    assert _left(spark, docs) == sorted(want) == [0]


def test_no_pair_just_above_the_threshold_is_missed(spark):
    rng = random.Random(12)
    word = lambda: f"v{rng.randrange(10**7)}"
    shared = [word() for _ in range(30)]
    docs = []
    for k in range(150):
        n = rng.choice([5, 8, 30, 130, 250, 409, 511])
        words = [word() for _ in range(n + 4)]
        if k % 3 == 0:
            words[:2] = shared[: len(words) // 2]
        other = list(words)
        if k % 2:
            other += [word() for _ in range(n // 4)]  # similarity of 0.8 or a little more
        else:
            for p in range(2, 2 + int(5 * n / 9 / 5 * 0.98) // 5 * 5, 5):
                other[p] = word()  # spoils up to five shingles each: 0.80 to 0.85 for most sizes
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    sets = {d: _set(t) for d, t in docs}
    near = [len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) for d in range(0, 300, 2)]
    assert sum(0.8 <= x <= 0.85 for x in near) >= 50
    assert _left(spark, docs) == sorted(_kept(sets))


def test_rows_of_one_id_are_judged_each_for_itself(spark):
    text = " ".join(f"a{k}" for k in range(50))
    df = spark.createDataFrame([(1, text), (7, text), (7, "quite another text altogether of seven words")], "doc_id long, text string")
    assert sorted((r[0], r[1][:5]) for r in similar.without_similar(df).collect()) == [(1, "a0 a1"), (7, "quite")]


def test_pairs_of_common_passages_meet_early_or_not_at_all(spark):
    rng = random.Random(13)
    passage = [f"p{k}" for k in range(100)]
    docs = [(d, " ".join([*passage[:80], *(f"r{d}x{k}" for k in range(24))])) for d in range(60)]  # similar to no other
    docs += [(100 + d, f"{t} more") for d, t in docs[:20]]
    rng.shuffle(docs)
    rows = similar.prefixes(similar.keyed(spark.createDataFrame(docs, "doc_id long, text string")), similar.np.empty(0, "u8"), 0.8)
    met = similar.shared(rows, 0.8)
    early = {(r["h"], r["node"]): r["early"] for r in met.collect()}
    assert 0 < sum(early.values()) < 0.75 * len(early)
    # of shingles in the order of the prefixes, each pair of 0.8 meets where the smaller set's is early
    sets = {d: similar.shingle_set(t) for d, t in docs}
    for d in range(20):
        x, y = sets[d], sets[100 + d]
        first = min(set(x.tolist()) & set(y.tolist()))
        node = similar.xxhash.xxh64_intdigest(x.tobytes(), similar.SEED)
        signed = [int(similar.np.uint64(v).view(similar.np.int64)) for v in (first, node)]
        assert early[signed[0], signed[1]]
    assert _left(spark, docs) == sorted(_kept({d: _set(t) for d, t in docs})) == list(range(60))


def test_a_crowd_of_copies_that_are_not_similar_makes_few_candidates(spark):
    rng = random.Random(14)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    docs = []
    for d in range(120):
        words = list(base)
        for p in rng.sample(range(5, 145), 1 if d % 20 == 7 else rng.randrange(4, 8)):
            words[p] = f"e{d}x{p}"
        docs.append((d, " ".join(words)))
    sets = {d: _set(t) for d, t in docs}
    alike = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    rows = similar.materialize(similar.prefixes(similar.keyed(spark.createDataFrame(docs, "doc_id long, text string")), similar.np.empty(0, "u8"), 0.8))
    of = {r["node"]: r["doc_id"] for r in rows.collect()}
    none = spark.createDataFrame([], "node long, component long")
    got = {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in similar.apart(similar.shared(rows, 0.8), none, rows, 0.8).collect()}
    assert alike <= got and 10 < len(alike) < len(got) + 1 < 2 * len(alike) + 200  # of 7140
    assert _left(spark, docs) == sorted(_kept(sets))


def test_the_hub_is_compared_with_its_copies(spark):
    rng = random.Random(15)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    docs = [(50, " ".join(base))]
    for d in range(50):
        words = list(base)
        for p in rng.sample(range(5, 145), 3):
            words[p] = f"e{d}x{p}"
        docs.append((d, " ".join(words)))
    frame = similar.keyed(spark.createDataFrame(docs, "doc_id long, text string"))
    last = similar.np.sort(similar.shingle_set(docs[0][1]))
    rows = similar.materialize(similar.prefixes(frame, last, 0.8))
    of = {r["node"]: r["doc_id"] for r in rows.collect()}
    pairs = {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in similar.closest(similar.shared(rows, 0.8)).collect()}
    assert sum(50 in p for p in pairs) >= 40


def test_sets_differ_in_as_many_shingles_as_in_parities():
    rng = similar.np.random.default_rng(16)
    for n in (0, 1, 90, 3000):
        pool = rng.integers(0, 1 << 63, 2 * n, dtype="u8")
        x, y = similar.np.unique(pool[: n + n // 3]), similar.np.unique(pool[n // 3 :])
        bits = (similar.parities(x) ^ similar.parities(y)).view("u8")
        assert sum(int(b).bit_count() for b in bits) <= len(similar.np.setxor1d(x, y)) and len(bits) * 64 == similar.BITS
