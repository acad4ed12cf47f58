import random
import zlib

import numpy as np
import pytest

from spanlink.llm import huffman, mixing, simhash, tokens, toxicity


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [" ".join(word() for _ in range(30)) for _ in range(4)]
    rows, labels = [], []
    for d in range(300):
        words = [word() for _ in range(rng.randrange(40, 120))]
        toxic = d % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilethingone", "vilethingtwo"]))
        if d % 11 == 3:
            words[5:5] = items[d % 4].split()
        rows.append((d, " ".join(words), "en", None if d % 17 == 0 else f"src{d % 5}", 0))
        if d % 2 or d % 10 == 0:
            labels.append((d, 1, int(toxic)))
    rows += [(1000 + k, rows[k][1].upper(), "en", "src1", 0) for k in range(1, 40, 2)]
    rows += [(2000, None, "en", "src2", 0), (2001, "", None, "src2", None)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_and_run(spark, corpus):
    import corpus_pipeline as p

    path, rows, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clean = p.drop_toxic(spark, docs, path)
    assert clean.schema == docs.schema
    ids = {r["doc_id"] for r in clean.collect()}
    assert ids == {d for d, t, *_ in rows if "vilething" not in (t or "").lower()}
    once = p.drop_near_duplicates(spark, clean, path)
    left = {r["doc_id"] for r in once.collect()}
    texts = {}
    for d, t, *_ in sorted(r for r in rows if r[0] in ids):
        texts.setdefault((t or "").lower(), d)
    assert once.schema == docs.schema and once.count() == len(left) and left == set(texts.values())
    pure = p.drop_contaminated(spark, once, path)
    assert {r["doc_id"] for r in pure.collect()} == {d for t, d in texts.items() if not any(i in t for i in items)}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(pure).collect()}
    mix = p.mix(spark, pure, path)
    assert mix.schema == docs.schema
    taken = sorted(r["doc_id"] for r in mix.collect())
    assert taken == sorted(d for d, n in copies.items() for _ in range(n)) and max(copies.values()) <= 3
    encode = tokens.Encoder(tokens.default_tokenizer(), "<u4")
    known = {d: t or "" for d, t, *_ in rows}
    want, start = [], 0
    for d in taken:
        raw = encode([known[d]])[0] + b"\2\0\0\0"
        want.append((d, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    assert sorted(tuple(r) for r in p.run(spark, path).collect()) == want


def test_mix_near_targets(spark):
    rng = random.Random(9)
    docs = [(k, "w " * rng.randrange(1, 30), f"s{rng.randrange(7)}") for k in range(4000)]
    rows = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["source"], [r["target"], r["source_size"], 0])[2] += r["taken"]
        assert r["copies"] <= 3
    assert sum(t for t, _, _ in by.values()) == pytest.approx(sum(s for _, s, _ in by.values()))
    for target, size, taken in by.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 60
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for _ in range(rng.randrange(6)):
            for _ in range(rng.randrange(1, 3)):
                f ^= 1 << rng.randrange(64)
            fps.append(f)
    fps += fps[:20]
    prints = spark.createDataFrame([(k, simhash._signed(f)) for k, f in enumerate(fps)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(None, prints=prints).collect()}
    name = list(range(len(fps)))
    for _ in fps:
        for a in range(len(fps)):
            for b in range(a):
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    name[a] = name[b] = min(name[a], name[b])
    assert [got[k] for k in range(len(fps))] == name


def test_covering_masks():
    rng = random.Random(2)
    masks = simhash.covering_masks()
    for _ in range(2000):
        diff = sum(1 << p for p in rng.sample(range(64), 2))
        assert any(not diff & m for m in masks)


def test_fingerprint_by_definition():
    import xxhash

    text = "A bb\tC d\x0bE é " * 9
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(len(w) - 2)]
    assert simhash.fingerprint(simhash.hashes(text)) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(simhash.hashes(None)) == 0


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "y " * 9)], "doc_id long, text string").withColumn("score", toxicity.F.lit(1))
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.5] * 4
    assert huffman.BLOCK and np.isfinite(toxicity.score_texts([None], np.zeros(1 << toxicity.BITS), 0.0)).all()
