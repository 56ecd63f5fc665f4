"""The mixture is applied: what run() returns are texts with their copies."""

import corpus_pipeline
from capturebase.llm import mixing


def test_draw_keeps_texts_and_deals_the_same_copies(spark):
    rows = [(i, f"{'w ' * (i % 40)}{i}", f"s{i % 3}" if i % 4 else None, "en") for i in range(400)]
    rows += [(7, "a b c", "s1", "en"), (7, "d e f", "s1", "de"), (7, "d e f", "s1", "de"), (None, "x y", "s0", "en"), (None, None, None, None), (None, None, None, None)]
    docs = spark.createDataFrame([(*r, -1) for r in rows], "doc_id long, text string, source string, lang string, copies int")
    out = mixing.draw(docs)
    got = out.collect()
    key = lambda r: tuple(str(x) for x in r)
    assert out.columns == ["doc_id", "text", "source", "lang", "size", "source_size", "target", "copies", "taken"]
    assert sorted(((r.doc_id, r.text, r.source, r.lang) for r in got), key=key) == sorted(rows, key=key)
    assert sorted((tuple(r[c] for c in ("doc_id", "source", "size", "source_size", "target", "copies", "taken")) for r in got), key=key) == sorted((tuple(r) for r in mixing.mix(docs).collect()), key=key)
    assert all(r.size == len((r.text or "").split()) and r.taken == r.copies * r.size for r in got)
    assert mixing.draw(docs.limit(0)).count() == 0


def test_run_returns_the_chosen_documents_with_text(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} " * (1 + i % 5), "en", f"s{i % 3}", 0) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-1:])
    out = corpus_pipeline.run(spark, str(tmp_path))
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = out.collect()
    assert {r.doc_id: r.copies for r in got} == want and len(got) == len(want) < 300
    assert all(r.text == texts[r.doc_id] for r in got) and set(docs.columns) <= set(out.columns)
