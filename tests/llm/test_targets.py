"""Targets of the mixture against the contract's words, carried out one by one."""

import random
from fractions import Fraction

import pytest

from capturebase.llm import mixing
from capturebase.llm._store import Store


def brute(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(order)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        target = {s: Fraction(most * sizes[s]) if s in capped else (left * w[s] / free) for s in order}
        above = {s for s in order if target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    g = random.Random(seed)
    names = [*("é", "z", "Z", "", "a b", "\U0001f600", "￿"), *(f"s{i}" for i in range(g.choice((0, 3, 60)))), *([None] if seed % 2 else [])]
    rows = [(i, s, g.choice((0, 1, 7, 10**g.randint(0, 6)))) for i, s in enumerate(g.choices(names, k=200) + names)]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    got = mixing.targets(Store(spark), spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)).collect()
    want = brute(sizes)
    assert {r.source for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) <= 1e-9 * (1 + r.target)


def test_targets_of_nothing(spark):
    assert mixing.targets(Store(spark), spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0
    got = mixing.targets(Store(spark), spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")).collect()
    assert sorted((str(r.source), r.target) for r in got) == [("None", 0.0), ("a", 0.0)]


def test_pivot_keeps_the_sum_and_the_chances():
    import numpy as np

    g = np.random.default_rng(4)
    p = g.random(9) * 0.98 + 0.01
    total = np.zeros(9)
    for seed in range(4000):
        q, held = mixing.pivot(list(range(9)), p, seed)
        assert abs(q.sum() - p.sum()) < 1e-9 and all(x in (0.0, 1.0) for i, x in enumerate(q) if i != held)
        total += q
    assert np.abs(total / 4000 - p).max() < 0.04
