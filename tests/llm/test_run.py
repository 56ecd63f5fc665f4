"""The pipeline as a whole: what run() returns, from texts to masked, mixed copies."""

import os

import pytest

import corpus_pipeline
from capturebase.llm._store import Store

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "stone river light garden window paper silver morning forest letter bridge summer number yellow market simple".split()


def lay(spark, folder, docs, labels, items):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def text(k, n=40):
    return " ".join(f"{WORDS[(k * 7 + i * i) % 16]}{(k * 31 + i * 17) % 97 if i % 3 else ''}x{k}" for i in range(n))


def test_run(spark, tmp_path):
    docs = [(i, text(i), "en", f"s{i % 3}", 0) for i in range(90)]
    docs += [(100 + i, text(i), "en", "s0", 0) for i in range(5)] + [(200 + i, f"{text(i)} tail", "en", "s1", 0) for i in range(5)]
    item = " ".join(f"bench{i}" for i in range(30))
    docs += [(300 + i, f"{text(50 + i, 10)} more {i} {item}", "en", "s2", 0) for i in range(4)]
    docs += [(400 + i, f"{text(60 + i)} write to me{i}@mail.example.com or +1 (988) 555-24{i}5 soon", "en", "s1", 0) for i in range(8)]
    docs += [(500, None, "en", "s1", 0), (501, "", "en", None, 0), (None, text(700), "en", "s0", 0)]
    lay(spark, tmp_path, docs, [(i, 1, 0) for i in range(0, 90, 2)], [(1, item)])
    opened = len(Store.opened)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by = {r.doc_id: r for r in out}
    assert len(by) == len(out) and not {d for d in by if d is not None and 100 <= d < 400}
    texts = {d[0]: d[1] for d in docs}
    assert all(r.copies in (1, 2) and r.taken == r.copies * r.size for r in out)
    for d, r in by.items():
        if d is not None and 400 <= d < 500:
            assert "[EMAIL]" in r.text and "[PHONE]" in r.text and "@" not in r.text
        else:
            assert r.text == texts[d]
    total = sum(r.taken for r in out)
    words = sum(len((t or "").split()) for d, t, *_ in docs if d is None or not 100 <= d < 400)
    assert 1.2 * words < total < 1.8 * words
    assert sum(os.path.isdir(s.root.removeprefix("file:")) for s in Store.opened[opened:]) <= 1


@pytest.mark.parametrize("n_labels", [0, 3])
def test_run_over_nothing(spark, tmp_path, n_labels):
    lay(spark, tmp_path, [], [(i, 1, i % 2) for i in range(n_labels)], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
