"""One query for each operator, with production parameters over whole tables, and the SQL that it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, licenses, mixing, ngram_join, pii, quality, suffix_dedup, toxicity, url_cascade

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Stands for a list of unwanted hosts from outside: those whose MD5 begins with one of three digits.
LISTED = "substr(md5(host), 1, 1) < '3'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    host = url_cascade.split_url(F.col("url"))[0]
    return url_cascade.filter_urls(pages, RULES, pages.select(host.alias("host")).distinct().where(LISTED)).select("page_id", "host", "path", "rule", "verdict")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels").where("quality = 1"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_url_filter, op2_suffix_dedup, op3_ngram_join, op4_pii, op5_decontamination, op6_mixing, op7_language, op8_toxicity, op9_licenses, op10_quality, pipeline)}

_URL = """
with cut as (select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
split as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
rules(own, rhost, rpath) as (values %s),
ranked as (select s.*, r.*, row_number() over (partition by page_id order by length(rhost) + length(rpath) desc nulls last, length(rhost) desc) as k
  from split s left join rules r on (s.host = r.rhost or ends_with(s.host, '.' || r.rhost)) and starts_with(s.path, r.rpath)),
listed as (select distinct host as lhost from split where host <> '' and %s)
select page_id, host, path, rhost || rpath as rule,
  coalesce(own, case when exists (select 1 from listed where host = lhost or ends_with(host, '.' || lhost)) then 'block' else 'allow' end) as verdict
from ranked where k = 1
"""

_LICENSE = """
with names(license_id, digest) as (values %s),
own as (select doc_id, sha256(%s) as canonical_sha256 from documents)
select doc_id, canonical_sha256, license_id from own left join names on digest = canonical_sha256
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": _URL % (", ".join(f"({', '.join(map(_quoted, r))})" for r in RULES), LISTED),
    "op9_licenses": _LICENSE % (", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in licenses.known_digests()), licenses.canonical_sql("coalesce(text, '')")),
}
