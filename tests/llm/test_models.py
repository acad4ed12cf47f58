"""The two models against plain versions that work number by number."""

import math
import random

import numpy as np
import pytest

from spanlink.llm import quality, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def some_texts(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 30))) for _ in range(n)] + [None, "", "alpha", "ALPHA beta-gamma"]


def plain_ftrl(rows, labels, alpha, beta, l1, l2, epochs):
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(epochs):
        for buckets, y in zip(rows, labels, strict=True):
            before = {i: weight(i) for i in buckets}
            g = 1 / (1 + math.exp(-(sum(before.values()) + bias))) - y
            for i in buckets:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / alpha * before[i]
            bias_n += g * g
            bias -= 0.1 * g / (1 + math.sqrt(bias_n))
    return {i: weight(i) for i in z if abs(z[i]) > l1}, bias


def test_ftrl_equals_a_plain_version_and_scores_are_its_sums():
    texts = some_texts(120, 3)
    y = np.array([float("alpha beta" in (t or "") or "zeta" in (t or "")) for t in texts])
    rows = toxicity.distinct_features(texts)
    want, want_bias = plain_ftrl([r.tolist() for r in rows], y, 1.0, 1.0, 0.5, 1.0, 3)
    used, weights, bias = toxicity.fit_ftrl([toxicity.packed(r) for r in rows], y, l1=0.5, epochs=3)
    assert set(used.tolist()) == set(want) and 0 < len(want) < len(set().union(*map(set, rows)))
    assert weights == pytest.approx([want[i] for i in used.tolist()], abs=1e-6) and bias == pytest.approx(want_bias)
    dense = np.zeros(1 << toxicity.BITS, np.float32)
    dense[used] = weights
    plain = [1 / (1 + math.exp(-(sum(want.get(i, 0.0) for i in r.tolist()) + want_bias))) for r in rows]
    assert toxicity.score_texts(texts, dense, bias) == pytest.approx(plain, abs=1e-5)


def test_packed_buckets_come_back():
    rng = np.random.default_rng(0)
    for n in (0, 1, 500):
        buckets = np.unique(rng.integers(0, 1 << toxicity.BITS, n)).astype(np.uint32)
        assert (toxicity.unpacked(toxicity.packed(buckets)) == buckets).all()


def test_word_vectors_and_pooling_equal_plain_sums(spark):
    texts = some_texts(40, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    places, signs = quality.index_vectors()
    index = lambda b: np.bincount(places[b], signs[b], quality.DIM)
    each = [quality.tokens([t])[0].tolist() for t in texts]
    sums = {}
    for tokens in each:
        for a, left in enumerate(tokens):
            for b, right in enumerate(tokens):
                if abs(a - b) <= quality.REACH:
                    sums[left] = sums.get(left, 0) + index(right)
    vectors = quality.word_vectors(docs)
    for bucket, total in sums.items():
        assert vectors[bucket] == pytest.approx(total / max(np.linalg.norm(total), 1e-9), abs=1e-5)
    assert not np.delete(vectors, list(sums), axis=0).any()
    got = {r["doc_id"]: np.frombuffer(r["x"], np.float32) for r in quality.pooled(docs, vectors).collect()}
    for k, tokens in enumerate(each):
        v = vectors[tokens].astype(float)
        want = np.concatenate([v.mean(axis=0), v.std(axis=0)]) if tokens else np.zeros(2 * quality.DIM)
        assert got[k] == pytest.approx(want, abs=2e-3)


def test_network_forward_and_temperature():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2 * quality.DIM))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    net = quality.Network(x, y)
    for row in x[:5]:
        inputs = (row - net.mean) / net.scale
        hidden = [max(0.0, sum(inputs[i] * net.p[0][i, j] for i in range(len(inputs))) + net.p[1][j]) for j in range(len(net.p[1]))]
        z = sum(h * w for h, w in zip(hidden, net.p[2], strict=True)) + net.p[3][0]
        assert net(row[None])[0] == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, z / net.temperature)))))
    kept = np.arange(len(y)) % 10 == 9
    loss = lambda s: np.mean([math.log1p(math.exp(-z / s if v else z / s)) for z, v in zip(net.logit(x[kept]), y[kept], strict=True)])
    assert all(loss(net.temperature) <= loss(s) + 1e-12 for s in np.geomspace(0.5, 8, 60))
    assert np.mean((net(x) > 0.5) == y) > 0.85
