"""The signatures' promise, and joins of large groups, against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from capturebase.llm import ngram_join
from capturebase.llm._text import utf8


def sets_of(pairs):
    """Rows of hashes as shingle_sets gives them."""
    h, row = [], []
    for i, s in enumerate(pairs):
        h += sorted(s)
        row += [i] * len(s)
    return np.array(h, np.uint64), np.array(row)


def similar(g, n, frequent=()):
    """Two sets of similarity 3/4 or a little more, the second of n shingles or up to a third fewer or more."""
    a = {g.getrandbits(64) for _ in range(n - min(len(frequent), n // 2))} | set(list(frequent)[: n // 2])
    while True:
        drop, add = g.randint(0, n // 3), g.randint(0, n // 3)
        b = set(g.sample(sorted(a), len(a) - min(drop, len(a) - 1))) | {g.getrandbits(64) for _ in range(add)}
        if 100 * len(a & b) >= 75 * len(a | b) and (100 * len(a & b) <= 80 * len(a | b) or n < 12):
            return a, b


@pytest.mark.parametrize("n_frequent", [0, 40, 5000])
def test_similar_sets_share_a_signature(n_frequent):
    g = random.Random(n_frequent)
    frequent = sorted(g.getrandbits(64) for _ in range(n_frequent))
    sizes = [*range(1, 80), *(g.randint(80, 3000) for _ in range(120))]
    pairs = [s for n in sizes for _ in range(4 if n < 200 else 1) for s in similar(g, n, frequent)]
    h, row = sets_of(pairs)
    sigs = defaultdict(set)
    for s, r in zip(*(x.tolist() for x in ngram_join.signatures(h, row, np.array(frequent, np.uint64))), strict=True):
        sigs[r].add(s)
    assert [i for i in range(0, len(pairs), 2) if not sigs[i] & sigs[i + 1]] == []
    total = sum(map(len, pairs))
    assert sum(map(len, sigs.values())) < 2.5 * total + 3 * len(pairs)


def test_signatures_are_enumerated_choices():
    """A set without one shingle keeps the signature that leaves the shingle's part out, and loses the two others of its group."""
    g = random.Random(3)
    a = {g.getrandbits(64) for _ in range(200)}
    h, row = sets_of([a, *(a - {x} for x in sorted(a))])
    sigs = defaultdict(set)
    for s, r in zip(*(x.tolist() for x in ngram_join.signatures(h, row, np.zeros(0, np.uint64))), strict=True):
        sigs[r].add(s)
    lost = [len(sigs[0] - sigs[r]) for r in range(1, 201)]
    assert set(lost) <= {0, 1, 2, 3} and lost.count(2) > 60 and len(sigs[0]) > 90


def brute(texts):
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()) for w in words]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, a in enumerate(sets):
        common = defaultdict(int)
        for x in a:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, k in common.items():
            if 100 * k >= 75 * (len(a) + len(sets[j]) - k):
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_chains_and_large_groups(spark, monkeypatch):
    """Near copies that differ from the first by steps, so that many are not linked to it but through others; small blocks and flushes."""
    g = random.Random(12)
    base = [f"w{g.randrange(10**6)}" for _ in range(60)]
    texts = []
    for _ in range(12):
        now = list(base)
        for _ in range(25):
            now = list(now)
            for _ in range(g.choice((1, 1, 1, 2))):
                now[g.randrange(60)] = f"x{g.randrange(10**6)}"
            texts.append(" ".join(now))
    texts += [" ".join(base)] * 200 + [" ".join(f"w{g.randrange(10**6)}" for _ in range(g.randint(1, 30))) for _ in range(100)]
    g.shuffle(texts)
    want = brute(texts)
    assert 10 < len({r for _, r in want.values()}) - 100 < 200
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    for block, flush, small in ((2048, 1 << 20, 64), (7, 500, 0), (2048, 1 << 20, 0), (20, 500, 10)):
        monkeypatch.setattr(ngram_join, "SMALL", small)
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "FLUSH", flush)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()} == want


def test_one_group_of_thousands_of_near_copies(spark):
    """2,500 edited copies of one text, none of which is the text itself, against all pairs."""
    g = random.Random(40)
    base, texts = [f"w{i}" for i in range(60)], []
    for _ in range(2500):
        now = list(base)
        for _ in range(g.choice((1, 1, 2, 3))):
            now[g.randrange(60)] = f"x{g.randrange(300)}"
        texts.append(" ".join(now))
    sets = [{" ".join(t[i : i + 5]) for i in range(56)} for t in (x.split() for x in texts)]
    counts = defaultdict(int)
    for x in sets:
        for w in x:
            counts[w] += 1
    column = {w: k for k, w in enumerate(w for w, c in counts.items() if c > 1)}
    m = np.zeros((len(sets), len(column)), np.float32)
    for i, x in enumerate(sets):
        m[i, [column[w] for w in x if w in column]] = 1
    common, n = m @ m.T, np.array([len(x) for x in sets])
    linked = 100 * common >= 75 * (n[:, None] + n[None] - common)
    np.fill_diagonal(linked, True)
    root = np.arange(len(sets))
    while True:
        now = np.where(linked, root[None], len(sets)).min(1)
        now = now[now]
        if (now == root).all():
            break
        root = now
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()}
    assert len(set(root)) > 1 and got == dict(enumerate(root.tolist()))


def test_a_document_with_several_texts_joins_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (6, a + " z"), (7, a), (7, b), (8, b + " y"), (9, "alone here"), (None, a), (10, None), (11, " ")]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("5", "5"), ("6", "5"), ("7", "5"), ("7", "5"), ("8", "5"), ("9", "9"), ("None", "None"), ("10", "10"), ("11", "11")])
    kept = ngram_join.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(d), str(t)) for d, t in rows if d not in (6, 7, 8))


def test_parities_bound_the_difference():
    g = random.Random(5)
    for n in (3, 40, 700, 9000):
        for _ in range(5):
            a, b = similar(g, n)
            h, row = sets_of([a, b])
            p = [np.frombuffer(x, np.uint8)[None] for x in ngram_join.parities(h, row, 2)]
            size = min(x.shape[1] for x in p)
            assert np.bitwise_count(ngram_join._folded(p[0], size) ^ ngram_join._folded(p[1], size)).sum() <= len(a ^ b)


def test_shingles_of_words():
    h, row = ngram_join.shingle_sets(*utf8(pa.array(["a b c d e f", "A B", "", None, "x"], pa.large_string())))
    assert np.bincount(row, minlength=5).tolist() == [2, 1, 0, 0, 1]
