import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capturebase.llm import decontaminate, langid, licenses, mixing, ngram_join, pii, quality, suffix_dedup, toxicity, url_cascade
from capturebase.llm._text import utf8
from capturebase.llm.queries import RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, path string, rule string"


def make(spark, texts, source=None, lang=None):
    return spark.createDataFrame([(i, t, lang, source, 0, "p", "r") for i, t in enumerate(texts)], DOCS)


def odd_texts(seed=1):
    g = random.Random(seed)
    word = lambda: "".join(g.choice("abcde") for _ in range(g.randint(1, 6)))
    base = [" ".join(word() for _ in range(g.randint(1, 90))) for _ in range(30)]
    near = [" ".join(w if g.random() > 0.04 else word() for w in t.split(" ")) for t in base for _ in range(3)]
    return [*base, *near, *base[:5], "", None, " \n ", "of " * 300, "É" * 250, base[0] + base[1] + base[0], "a" * 5000]


def words(t):
    return [w for w in re.split(r"[ \t-\r]+", t or "") if w]


def test_url_rules(spark):
    urls = ["http://A.example.ORG/es/1?x", "https://example.org/en/1", "http://org", "x", None, "ftp://com/de/", "http://blog.x.com/fr/a#b", "http://bad.net/", "http://www.bad.net", "http://..", "http://notbad.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    r = {x.page_id: (x.rule, x.verdict) for x in url_cascade.filter_urls(pages, RULES, spark.createDataFrame([("bad.net",)], "host string")).collect()}
    assert [r[i] for i in range(len(urls))] == [("example.org/es/", "block"), ("example.org/en/1", "block"), (None, "allow"), (None, "allow"), (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"), (None, "block"), (None, "block"), (None, "allow"), (None, "allow")]
    assert url_cascade.filter_urls(pages.limit(0), RULES).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    c = url_cascade.Cascade(spark, keys, keys.where("key like '%7'"))
    assert len(c.levels) > 1
    assert keys.where(c.contains(F.col("key")) != F.col("key").endswith("7")).count() == 0
    small = url_cascade.Cascade(spark, keys, keys.where("key like '%7'"), 200)
    assert small.n_shards > 3
    assert small.mark(keys, {"on": F.col("key")}).where(F.col("on") != F.col("key").endswith("7")).count() == 0
    assert url_cascade.Cascade(spark, keys.limit(0), keys.limit(0)).mark(keys, {"on": F.col("key")}).where("on").count() == 0


def test_url_rules_of_equal_length_and_sharded_lists(spark):
    urls = ["http://a.bc.d/ef", "http://a.bc.d/e", "http://x.y/", None, "http://l7.com", "http://l8.com", "http://www.l17.com/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("allow", "a.bc.d", "/e"), ("block", "bc.d", "/ef"), ("block", "c.d", "/"), ("allow", "y", "/"), ("block", "x.y", "")]
    listed = spark.range(50).where("id % 10 = 7").select(F.concat(F.lit("l"), "id", F.lit(".com")).alias("host"))
    for size in (20, 1 << 20):
        r = {x.page_id: (x.rule, x.verdict) for x in url_cascade.filter_urls(pages, rules, listed, max_bytes=size).collect()}
        assert [r[i] for i in range(len(urls))] == [("a.bc.d/e", "allow"), ("a.bc.d/e", "allow"), ("x.y", "block"), (None, "allow"), (None, "block"), (None, "allow"), (None, "block")]


def test_suffix_dedup_matches_brute_force(spark):
    texts = odd_texts()
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.remove_repeats(make(spark, texts)).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        dead = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                dead[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        spans = sum(dead[p] and not (p and dead[p - 1]) for p in range(len(b)))
        want[i] = (len(b), sum(dead), spans, hashlib.sha256(bytes(c for c, d in zip(b, dead, strict=True) if not d)).hexdigest())
    assert got == want
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.remove_repeats(make(spark, texts), sort_all=True).collect()} == want
    assert suffix_dedup.remove_repeats(make(spark, texts).limit(0)).count() == 0


def test_texts_of_one_id_are_documents_of_their_own(spark):
    g = np.random.default_rng(5)
    say = lambda n: "".join(chr(x) for x in g.integers(33, 127, n))
    passage, unique = say(300), say(600)
    rows = [(1, passage), (7, unique), (7, say(100) + passage), (None, say(200) + passage), (None, say(50) + passage + "x"), (None, say(400)), (7, unique)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in out)
    #: The null ids are smallest; of their two passages the one whose text has the smaller hash is first.
    assert [x for x in got if x[0] == "7"] == [("7", 400, 300), ("7", 600, 0), ("7", 600, 0)] and ("1", 300, 300) in got
    assert sorted(x[2] for x in got if x[0] == "None") == [0, 0, 300]
    assert {r.kept.decode() for r in out if r.doc_id == 7} == {unique, rows[2][1][:100]}


def test_busy_anchors_are_dealt_out(spark, monkeypatch):
    texts = odd_texts()
    want = sorted(map(tuple, suffix_dedup.remove_repeats(make(spark, texts)).collect()))
    monkeypatch.setattr(suffix_dedup, "BUSY", 1)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(make(spark, texts)).collect())) == want


def test_suffix_array_orders_suffixes():
    t = np.random.default_rng(0).integers(0, 4, 400).astype(np.int16)
    sa = suffix_dedup.suffix_array(t)
    assert sorted(sa) == list(range(400))
    full = [bytes(t[i:].astype(np.uint8)) for i in sa if t[i]]
    cut = [x.split(b"\0")[0] for x in full]
    assert cut == sorted(cut)


def test_ngram_join_matches_brute_force(spark):
    texts = odd_texts(2)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.near_duplicates(make(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for _ in root:
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert ngram_join.drop_near_duplicates(make(spark, texts)).count() == len(set(root))


def test_small_sets_share_a_signature():
    g = random.Random(1)
    whole = [[f"{g.randrange(1 << 30):x}" for _ in range(n)] for n in range(8, 20) for _ in range(400)]
    texts = [" ".join(w[:k]) for w in whole for k in (len(w), len(w) - 1)]
    h, row = ngram_join.shingle_sets(*utf8(pa.array(texts, pa.large_string())))
    sets = defaultdict(set)
    for sig, r in zip(*(x.tolist() for x in ngram_join.signatures(h, row, np.zeros(0, np.uint64))), strict=True):
        sets[r].add(sig)
    assert all(sets[i] & sets[i + 1] for i in range(0, len(texts), 2))


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in ngram_join.near_duplicates(df).collect()) == [("1", "1"), ("1", "1"), ("2", "2"), ("None", "None")]
    for f in (suffix_dedup.remove_repeats, licenses.scan_licenses):
        assert f(df).count() == 4


def test_pii_base_spans_match_the_patterns():
    t = "x a.b+c@d-e.fg.h, 10.0.0.255; 1.2.3.256; 4539 1488 0343 6467; 4539148803436468; +1 (988) 555-2485; +12 @ a@b @x.y"
    got = [(pii.KINDS[k], t[a:b]) for k, a, b in pii.base_spans(t)]
    assert got == [("email", "a.b+c@d-e.fg.h"), ("ip", "10.0.0.255"), ("card", "4539 1488 0343 6467"), ("phone", "+1 (988) 555-2485")]


def test_pii_learns_and_masks(spark):
    g = random.Random(4)
    texts = [f"on the {g.choice('abc')} call +1 ({g.randint(200, 999)}) 555-{g.randint(1000, 9999)} or write bo.{g.randint(10, 99)}@mail{g.randint(1, 9)}.example.com now" for _ in range(80)] + ["clean words only", "", None]
    out = pii.find_spans(make(spark, texts)).orderBy("doc_id").collect()
    assert all(r.n_email == 1 and r.n_phone == 1 for r in out[:80])
    assert [r.spans for r in out[80:]] == ["", "", ""]
    masked = {r.doc_id: r.text for r in pii.mask(make(spark, texts)).collect()}
    assert "[EMAIL]" in masked[0] and "[PHONE]" in masked[0] and masked[80] == texts[80] and masked[82] is None


def test_contamination_matches_brute_force(spark):
    g = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [" ".join(g.choice(vocabulary) for _ in range(n)) for n in (30, 20, 13, 5, 1, 0)]
    texts = [" ".join([*(g.choice(vocabulary) for _ in range(20)), *items[i % 4].upper().split()[: g.randint(1, 30)], "é9"]) for i in range(40)] + ["", None, "..."]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(make(spark, texts), spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string")).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for k, t in enumerate(items):
        w = split(t)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(k))
    for d, t in enumerate(texts):
        w = split(t)
        hit, found = set(), set()
        for x, ids in windows.items():
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    found |= ids
        assert got[d] == (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))


def test_mixing(spark):
    g = random.Random(8)
    rows = [(i, " ".join("w" * g.randint(1, 400)) if i % 50 else None, "en", f"s{i % 3}" if i % 4 else None, 0, "", "") for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    run = lambda d: {r.doc_id: tuple(r) for r in mixing.mix(d, bucket_rows=64).collect()}
    a = run(df)
    assert a == run(df.repartition(7)) and len(a) == 3000
    assert all(r[-1] <= 2 * r[2] for r in a.values())
    by = defaultdict(lambda: [0, 0.0])
    for r in a.values():
        by[r[1]][0] += r[-1]
        by[r[1]][1] = r[4]
    assert all(abs(taken - target) <= 0.02 * target + 400 for taken, target in by.values())
    assert mixing.mix(df.limit(0)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.97
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 34", None)], "doc_id long, text string, lang string")
    assert [x.lang_pred for x in langid.identify(odd).collect()] == ["und", "und"]


def test_toxicity(spark):
    g = random.Random(9)
    rows = [(i, " ".join(g.choice("one two three four five six".split()) for _ in range(40)) + (" you awful idiot" if i % 5 == 2 else ""), int(i % 5 == 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.classify(df.drop("toxic"), df.select("doc_id", "toxic")).join(df.select("doc_id", "toxic"), "doc_id")
    assert out.where("predicted <> toxic").count() == 0
    odd = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert toxicity.classify(odd, df.select("doc_id", "toxic").limit(0)).count() == 2


def test_licenses(spark):
    mit = dict(licenses.LICENSES)["MIT"]
    texts = ["Copyright (c) 2020 Me\n" + mit.upper().replace(",", " ;"), mit.replace("sublicense", "sub-license"), mit + " more", None, ""]
    assert [r.license_id for r in licenses.scan_licenses(make(spark, texts)).orderBy("doc_id").collect()] == ["MIT", "MIT", None, None, None]


def test_quality_base_rules_match_brute_force(spark):
    texts = odd_texts(3) + ["a b\na b\n\nx # | <\n" * 3, "x y z " * 40 + "\n" + "x y z " * 40]
    trusted = spark.range(20).select(F.col("id").alias("doc_id"))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(make(spark, texts), trusted).collect()}
    for d, t in enumerate(texts):
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i : i + 8])].append(i)
        again = len({k for x in at.values() if len(x) > 1 for i in x for k in range(i, i + 8)})
        assert got[d] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), again, len(w) < 20 or 100 * again > 30 * len(w))


@pytest.mark.parametrize("f", [lambda d: pii.find_spans(d), lambda d: ngram_join.near_duplicates(d), lambda d: quality.judge(d, d), lambda d: langid.identify(d)])
def test_empty_tables(spark, f):
    assert f(make(spark, ["x"]).limit(0)).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).where("held_out").join(labels, "doc_id")
    r = out.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted")))).first()
    assert r[0] > 0.85 and r[1] < 0.01
