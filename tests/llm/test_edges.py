"""Nulls in any column, empty and very long texts, repeated rows, ties, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from capturebase.llm import decontaminate, langid, licenses, mixing, ngram_join, pii, quality, suffix_dedup, toxicity, url_cascade

CLASHING = "n_words long, n_hit long, score double, predicted int, component_id long, root long, doc long, size long, copies long, h long, spans string, key string, __text string, __scored string"
N_CLASHING = CLASHING.count(",") + 1
LONG = "word " * 60_000 + "x" * 200_000 + " bob@example.com é " + "0123456789" * 3000
ROWS = [
    (1, "plain words of one text that goes on for some time and then ends here as it must", "en", "a", 10),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", None, "b", 4),
    (5, LONG, "en", "b", len(LONG)),
    (5, LONG, "en", "b", len(LONG)),
    (None, "text without a number", "de", None, 3),
    (None, None, None, None, None),
    (7, "ein anderer text steht hier und wird gelesen von allen die ihn lesen wollen und können", "de", "a", 5),
    (8, "ein anderer text steht hier und wird gelesen von allen die ihn lesen wollen und können", "de", None, 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *[None] * N_CLASHING) for r in ROWS], f"{SCHEMA}, {CLASHING}").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, None, None), (7, 0, 1), (7, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "plain words of one text that goes on for some time and then ends here"), (2, None), (3, ""), (None, "ein anderer text"), (1, "und wird")], "item_id long, text string")


OPERATORS = {
    "suffix_dedup": lambda d, labels, b: suffix_dedup.remove_repeats(d),
    "ngram_join": lambda d, labels, b: ngram_join.near_duplicates(d),
    "pii": lambda d, labels, b: pii.find_spans(d),
    "mask": lambda d, labels, b: pii.mask(d),
    "decontaminate": lambda d, labels, b: decontaminate.contamination(d, b),
    "mixing": lambda d, labels, b: mixing.mix(d),
    "langid": lambda d, labels, b: langid.identify(d),
    "toxicity": lambda d, labels, b: toxicity.classify(d, labels),
    "licenses": lambda d, labels, b: licenses.scan_licenses(d),
    "quality": lambda d, labels, b: quality.judge(d, labels),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_once(docs, labels, benchmark, name):
    out = OPERATORS[name](docs, labels, benchmark)
    rows = out.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 0, 1, 2, 3, 4, 5, 5, 7, 8]
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    by = {}
    for r in rows:
        if r.doc_id is not None:
            by.setdefault(r.doc_id, []).append(tuple(r))
    assert name == "mixing" or len(set(by[5])) == 1


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(docs, labels, benchmark, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["decontaminate", "toxicity", "quality"])
def test_nothing_to_learn_from(docs, labels, benchmark, name):
    assert OPERATORS[name](docs, labels.limit(0), benchmark.limit(0)).count() == len(ROWS)


def test_values(docs, labels, benchmark):
    hit = {r.doc_id: r for r in decontaminate.contamination(docs, benchmark).collect() if r.doc_id}
    assert (hit[1].contaminated, hit[1].n_items, hit[7].n_items, hit[2].n_words, hit[3].contaminated) == (True, 1, 1, 0, False)
    same = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect() if r.doc_id}
    assert same == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 7: 7, 8: 7}
    spans = {r.doc_id: r for r in pii.find_spans(docs).collect() if r.doc_id}
    at = LONG.index("bob@")
    assert spans[5].n_email == 1 and f"email:{at}:{at + 15}" in spans[5].spans
    cut = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect() if r.doc_id}
    assert cut[5].n_bytes == len(LONG.encode()) and cut[5].n_removed > 400_000 and cut[2].n_bytes == 0
    kept = {r.doc_id: r.kept for r in quality.judge(docs, labels).collect()}
    assert not any(kept[i] for i in (2, 3, 4))
    taken = mixing.mix(docs).collect()
    assert all(0 <= r.taken <= 2 * r.size for r in taken)


@pytest.mark.parametrize("stage", ["toxicity", "near_duplicates", "decontamination", "personal_data"])
def test_filtering_stages_keep_columns(docs, labels, benchmark, stage):
    filled = docs.select(*docs.columns[:5], *[F.lit("7").cast(docs.schema[c].dataType).alias(c) for c in docs.columns[5:]])
    f = {"toxicity": lambda d: toxicity.drop_toxic(d, labels), "near_duplicates": ngram_join.drop_near_duplicates, "decontamination": lambda d: decontaminate.decontaminate(d, benchmark), "personal_data": pii.mask}[stage]
    out = f(filled)
    assert out.columns == filled.columns
    rows = out.collect()
    assert rows and all(float(r[c]) == 7 for r in rows for c in docs.columns[5:])
    assert f(filled.limit(0)).count() == 0
    if stage == "decontamination":
        assert 1 not in {r.doc_id for r in rows} and len(rows) == 9 - 2
    if stage == "near_duplicates":
        assert 8 not in {r.doc_id for r in rows} and len(rows) == 9


def test_urls(spark):
    pages = spark.createDataFrame([(1, None, 1, "x"), (1, None, 1, "x"), (2, "", None, None), (None, "http://a.org/", 2, None), (3, "http://" + "a." * 3000 + "org/" + "p" * 100_000, 3, "y")], "page_id long, url string, key long, rule string")
    out = url_cascade.filter_urls(pages, [("block", "org", "/")], spark.createDataFrame([(None,), ("",)], "host string")).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in out if r.rule) == [(0, "org/", "block"), (3, "org/", "block")]
    assert [(r.host, r.path, r.verdict) for r in out if not r.rule] == [("", "", "allow")] * 3
    assert url_cascade.filter_urls(pages.limit(0), [("block", "org", "/")]).count() == 0
