"""Fitted and planned numbers against plain computations on small cases."""

import itertools
import random

import numpy as np

from notegrove.llm import packing, quality


def test_discriminant_is_a_density_ratio(spark):
    """Moments summed in Spark, shrunk covariances and posteriors computed with inverses."""
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    mix = rng.normal(size=(d, d)) * 0.3 + np.eye(d)
    x = np.concatenate([rng.normal(size=(60, d)) @ mix, rng.normal(size=(40, d)) * 1.5 + 0.5])
    y = np.array([0] * 60 + [1] * 40)
    rows = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y, strict=True)], "x array<double>, label int").repartition(4)
    model = quality.Discriminant.fit(quality.moments(rows))
    covariance = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    common = 0.6 * covariance[0] + 0.4 * covariance[1]
    logs = []
    for c in (0, 1):
        s = (1 - quality.SHRINK_POOLED) * covariance[c] + quality.SHRINK_POOLED * common
        s = (1 - quality.SHRINK_DIAGONAL) * s + quality.SHRINK_DIAGONAL * np.diag(np.diag(common))
        z = x - x[y == c].mean(0)
        logs.append(-0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(s), z) - 0.5 * np.linalg.slogdet(s)[1])
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + np.log(0.4 / 0.6), -40, 40)))
    assert np.allclose(model.scores(x), want, atol=1e-6)


def fillings(sizes, capacity):
    most = [range(capacity // s + 1) for s in sizes]
    return [f for f in itertools.product(*most) if 0 < sum(n * s for n, s in zip(f, sizes, strict=True)) <= capacity]


def test_configurations_are_optimal():
    """The programme's columns meet the counts, and its prices value no filling above one
    sequence: by duality no other mix of fillings takes fewer."""
    rnd = random.Random(3)
    for _ in range(60):
        capacity = rnd.randrange(20, 60)
        sizes = np.array(sorted(rnd.sample(range(capacity // 6 + 1, capacity + 1), rnd.randrange(1, 5)), reverse=True))
        counts = np.array([rnd.randrange(1, 400) for _ in sizes], float)
        basis, amount = packing.configurations(sizes, counts, capacity)
        assert np.allclose(basis @ amount, counts) and (amount >= 0).all()
        assert (sizes @ basis <= capacity).all()
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        assert max(np.dot(prices, f) for f in fillings(sizes, capacity)) <= 1 + 2 * packing.GAP


def least_bins(lengths, capacity):
    """The least number of sequences, by trying all assignments of the longest first."""
    best = len(lengths)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                put(i + 1, [*rest, room - lengths[i]])
        put(i + 1, [*bins, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


def test_plans_of_few_pieces_are_nearly_least():
    rnd, more, total = random.Random(5), 0, 0
    for _ in range(80):
        lengths = [rnd.randrange(300, 4097) for _ in range(rnd.randrange(1, 11))]
        found = packing.plan({n: lengths.count(n) for n in lengths})
        used = {s + i for s, n in zip(found["sequence"], found["repeat"], strict=True) for i in range(n)}
        least = least_bins(lengths, 4096)
        assert least <= len(used) <= least + 1
        more, total = more + len(used) - least, total + least
    assert more <= 0.03 * total
