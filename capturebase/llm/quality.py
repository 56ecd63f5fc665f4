"""Quality rules and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus. DataFrame functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import Store, small_side

BUCKETS = 1 << 15
WINDOW = 8
#: Mean log-likelihood ratio an n-gram below which a document goes.
THRESHOLD = -0.25


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _grams(hashes: str) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    h = F.col(hashes)
    one = F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int"))
    two = F.transform(h, lambda x, i: F.pmod(F.xxhash64(x, F.get(h, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.when(F.size(h) > 0, F.concat(one, F.slice(two, F.lit(1), F.size(h) - 1)))


def ratios(docs: DataFrame, trusted: DataFrame, store: Store) -> DataFrame:
    """One row: for each bucket the log of its share in the trusted documents over its share in all.

    The trusted multinomial is smoothed towards the raw one with as many counts as there are buckets.
    """
    ids = store.put(trusted.select("doc_id").where("doc_id is not null").distinct(), "trusted")
    marked = docs.select("doc_id", "text").join(small_side(ids.withColumn("on", F.lit(1)), 64 * ids.count()), "doc_id", "left")
    grams = marked.select("on", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h")).select("on", F.explode(_grams("h")).alias("b"))
    counts = grams.groupBy("b").agg(F.count("*").alias("raw"), F.count("on").alias("own"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b"))
    dense = every.join(F.broadcast(store.put(counts, "counts")), "b", "left").select("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("own", F.lit(0)).alias("own"))
    total = dense.agg(F.sum("raw").alias("n_raw"), F.sum("own").alias("n_own"))
    n_raw, n_own = total.select("n_raw").scalar(), total.select("n_own").scalar()
    p = (F.col("raw") + 1) / (n_raw + BUCKETS)
    row = F.log((F.col("own") + BUCKETS * p) / (n_own + BUCKETS) / p)
    return store.put(dense.select("b", row.alias("r")).agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "r"))), lambda s: s["r"]).alias("r")), "ratios")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr and kept for every row.

    ``trusted`` (column doc_id) names the target documents; without any, all ratios are 0. A null, empty or blank text has no words,
    fails the base rules and has llr 0. Repeated rows stay; an empty table gives no rows.
    """
    #: BUCKETS numbers whatever the input, so they go into the plan as one constant.
    table = F.from_json(F.lit(json.dumps(ratios(docs, trusted, Store(docs.sparkSession)).first()[0])), "array<double>")
    text = F.coalesce("text", F.lit(""))
    first = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("w"))
    lines = F.split("text", "\n", -1)
    lined = first.select(
        "doc_id", F.transform("w", lambda w: F.xxhash64(w)).alias("h"), F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.when(F.instr("text", "\n") > 0, F.filter(lines, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))).alias("lines"),
    )
    h = F.col("h")
    starts = F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(F.slice(h, i + 1, F.lit(WINDOW))))
    wide = lined.select(
        "doc_id", "h", _grams("h").alias("g"), "word_chars", "n_symbols",
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"), starts.alias("win"),
    )
    some = F.size(F.array_distinct("win")) < F.size("win")
    mean = F.aggregate("g", F.lit(0.0), lambda a, b: a + F.get(table, b)) / F.size("g")
    placed = wide.select(
        "doc_id", F.size("h").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.round(F.coalesce(mean, F.lit(0.0)), 9).alias("llr"),
        F.when(some, F.array_sort(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"),
    )
    s = F.col("s")
    again = F.transform(s, lambda e, j: F.when((e["x"] == F.get(s, j - 1)["x"]) | (e["x"] == F.get(s, j + 1)["x"]), e["i"]))
    hit = placed.withColumn("at", F.array_sort(F.filter(again, lambda i: i.isNotNull())))
    at = F.col("at")
    covered = F.aggregate(F.transform(at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, n: a + n)
    done = hit.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "llr", (~failed & (F.col("llr") >= threshold)).alias("kept"))
