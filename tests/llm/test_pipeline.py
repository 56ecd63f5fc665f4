"""The pipeline's stages on the smallest tables, each held against a brute-force version over its own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from capturebase.llm import mixing, pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        done = spark.read.parquet(f"{root}/{name}")
        out.append((docs, done))
        docs = done
    return {name: x for (name, _), x in zip(corpus_pipeline.STAGES, out, strict=True)}


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", text or "") if w]


def test_columns_and_subsets(steps):
    for name, (before, after) in steps.items():
        if name != "mixing":
            assert after.columns == before.columns
        assert set(ids(after)) <= set(ids(before)) and len(ids(after)) == len(set(ids(after)))


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    before, after = steps["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, every = set(ids(after)), ids(before)
    assert all(labels[d] == 0 or d in kept or labels[d] == 1 for d in labels)
    toxic, clean = [d for d in every if labels.get(d) == 1], [d for d in every if labels.get(d) == 0]
    assert sum(d in kept for d in clean) >= 0.99 * len(clean)
    assert not toxic or sum(d not in kept for d in toxic) >= 0.6 * len(toxic)


def test_one_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    texts = {r.doc_id: words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) for r in before.collect()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for d, w in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    assert sorted(ids(after)) == sorted(d for d in order if find(d) == d)


def test_contaminated_documents_go(spark, steps):
    before, after = steps["decontamination"]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = split(r.text)
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    lengths, want = sorted({len(x) for x in windows}), set()
    for r in before.collect():
        w, hit = split(r.text), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            want.add(r.doc_id)
    assert set(ids(after)) == want


def test_personal_data_is_masked(steps):
    before, after = steps["personal_data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert sorted(ids(after)) == sorted(texts)
    for r in after.collect():
        spans = pii.base_spans(texts[r.doc_id] or "")
        assert not {texts[r.doc_id][a:b] for k, a, b in spans if k == 0} & set(re.findall(r"\S+", r.text or ""))
        assert (r.text or "").count("[") >= (1 if spans else 0)


def test_mixture_is_near_its_targets(steps):
    before, after = steps["mixing"]
    assert sorted(ids(after)) == sorted(ids(before))
    by = after.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert by and all(abs(r.taken - r.target) <= r.most + 1 for r in by)
    assert after.where("taken > 2 * size").count() == 0
    again = mixing.mix(before)
    assert sorted(map(tuple, again.select("doc_id", "taken").collect())) == sorted(map(tuple, after.select("doc_id", "taken").collect()))
