"""Longest verbatim matches, their places and lengths, against brute force."""

import random
import re

import numpy as np
import pytest

from capturebase.llm import decontaminate


def split(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(texts, items):
    out = []
    for d, t in enumerate(texts):
        w = split(t)
        for name, item in items:
            v = split(item)
            need = min(13, len(v))
            for i in range(len(w)):
                for j in range(len(v)):
                    if w[i] != v[j] or (i and j and w[i - 1] == v[j - 1]):
                        continue
                    n = 0
                    while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                        n += 1
                    if n >= need:
                        out.append((d, str(name), i, j, n))
    return sorted(out)


@pytest.mark.parametrize("max_words", [decontaminate.MAX_TEST_WORDS, 60])
def test_matches(spark, max_words):
    g = random.Random(21)
    vocabulary = [f"w{i}" for i in range(8)]
    say = lambda n: " ".join(g.choice(vocabulary) for _ in range(n))
    items = [(1, say(60)), (2, say(25)), (3, say(13)), (3, say(14)), (4, say(7)), (5, "z"), (6, ""), (7, None), (8, "w1 " * 40)]
    cut = lambda t, a, n: " ".join(split(t)[a : a + n])
    texts = [say(30), items[0][1].upper(), f"{say(5)} {cut(items[0][1], 10, 30)} q {cut(items[1][1], 0, 13)}", f"{items[4][1]}. {items[4][1]}!", f"{cut(items[2][1], 0, 12)} q", "z z", "", None, "w1 " * 30, f"{items[2][1]} {items[3][1]} {items[0][1]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(docs, tests, max_words)
    want = brute(texts, items)
    assert len(want) > 20 and max(x[-1] for x in want) >= 60
    assert sorted(tuple(r) for r in got.collect()) == want
    by = {r.doc_id: (r.n_matches, r.longest, r.n_hit) for r in decontaminate.contamination(docs, tests, max_words).collect()}
    for d in range(len(texts)):
        mine = [x for x in want if x[0] == d]
        assert by[d] == (len(mine), max([x[-1] for x in mine], default=0), len({k for _, _, i, _, n in mine for k in range(i, i + n)}))
    assert decontaminate.matches(docs.limit(0), tests).count() == 0 and decontaminate.matches(docs, tests.limit(0)).count() == 0


def test_hit_words_counts_a_word_once():
    row, place, length = np.array([0, 0, 0, 2, 2]), np.array([3, 0, 2, 5, 5]), np.array([4, 3, 2, 1, 2])
    assert decontaminate.hit_words(4, row, place, length).tolist() == [7, 0, 2, 0]
