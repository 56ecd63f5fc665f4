"""A benchmark beyond one block gives the same rows as in one."""

import random

from capturebase.llm import decontaminate


def test_blocks_lose_nothing(spark):
    g = random.Random(11)
    word = lambda: g.choice(("w", "é", "Z", "日本")) + str(g.randrange(60))
    items = [(i % 25, " ".join(word() for _ in range(g.choice((0, 1, 5, 13, 30, 300))))) for i in range(40)] + [(90, None), (None, "w1"), (91, "?! " * 200)]
    whole = [t.split() for _, t in items if t]
    texts = []
    for _ in range(120):
        w = g.choice(whole)
        k = g.randrange(max(1, len(w) - 12))
        texts.append(", ".join([*(word() for _ in range(g.randrange(60))), *w[k : k + g.randrange(1, 40)], "end"]))
    docs = spark.createDataFrame([*enumerate([*texts, "", None])], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(decontaminate.contamination(docs, benchmark))
    assert sum(r[5] for r in want) > 20
    for max_words in (30, 200, 1000):
        assert rows(decontaminate.contamination(docs, benchmark, max_words)) == want
    clean = {r.doc_id for r in decontaminate.decontaminate(docs, benchmark, 200).collect()}
    assert clean == {r[0] for r in want if not r[5]}
