"""The likelihood ratio and the verdict of op10 against a plain computation with the same hashes."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from capturebase.llm import quality


def test_llr_and_kept(spark):
    g = random.Random(31)
    vocabulary = [f"w{i}" for i in range(50)] + ["é", "日本", "#"]
    texts = [" ".join(g.choice(vocabulary[: 10 + 5 * (i % 9)]) for _ in range(g.choice((0, 1, 2, 25, 60)))) for i in range(60)] + [None, "", " \n\t "]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, texts[4])], "doc_id long, text string")
    trusted = {i for i in range(0, 60, 7)}
    words = lambda t: [w for w in re.split(r"[ \t-\r]+", t or "") if w]
    every = sorted({w for t in texts for w in words(t)})
    one = {r.w: r.h for r in spark.createDataFrame([(w,) for w in every], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    pairs = sorted({(one[a], one[b]) for t in texts for a, b in zip(words(t), words(t)[1:], strict=False)})
    two = {(r.a, r.b): r.h % quality.BUCKETS for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}

    def grams(t):
        w = [one[x] for x in words(t)]
        return [x % quality.BUCKETS for x in w] + [two[x] for x in zip(w, w[1:], strict=False)]

    rows = [*enumerate(texts), (3, texts[3]), (None, texts[4])]
    raw, own = Counter(), Counter()
    for d, t in rows:
        raw.update(grams(t))
        if d in trusted:
            own.update(grams(t))
    n_raw, n_own, m = sum(raw.values()), sum(own.values()), quality.BUCKETS
    p = lambda b: (raw[b] + 1) / (n_raw + m)
    ratio = lambda b: math.log((own[b] + m * p(b)) / (n_own + m) / p(b))
    want = sorted((str(d), round(sum(map(ratio, grams(t))) / max(1, len(grams(t))), 7)) for d, t in rows)
    for threshold in (quality.THRESHOLD, 0.0, 0.01):
        got = quality.judge(docs, spark.createDataFrame([(d,) for d in [*trusted, None, 999]], "doc_id long"), threshold).collect()
        assert sorted((str(r.doc_id), round(r.llr, 7) + 0.0) for r in got) == [(d, x + 0.0) for d, x in want]
        assert all(r.kept == (not r.base_failed and r.llr >= threshold) for r in got)
    assert {r.kept for r in got} == {True, False}
