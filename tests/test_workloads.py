import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from capturebase.functions import columns
from capturebase.operators import relational, validators
from capturebase.plans import registry, workloads

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in "nation customer supplier part orders lineitem events".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _norm(x):
    return None if x is None else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = duck.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(_norm(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)


NOTICE = "publication_ref string, source_format string, publication_date date, dispatch_date date, buyer_country_iso string, buyer_country string, primary_cpv string, additional_cpv array<string>, change_reference_status string"


def _n(ref, country="PL", more=()):
    return (ref, "x", dt.date(2023, 11, 15), None, None, country, None, list(more), None)


def test_overlap_audit_is_symmetric_and_null_safe(spark):
    a = spark.createDataFrame([_n("1-2023"), _n("2-2023"), _n("3-2023", "DE")], NOTICE)
    b = spark.createDataFrame([_n("2-2023"), _n("3-2023", "FR"), _n("4-2023")], NOTICE)
    rows = lambda x, y: sorted((r.finding, r.publication_ref) for r in workloads.overlap_audit(x, y).collect())
    assert rows(a, b) == [("content_differs", "3-2023"), ("only_in_a", "1-2023"), ("only_in_b", "4-2023")]
    assert rows(b, a) == [("content_differs", "3-2023"), ("only_in_a", "4-2023"), ("only_in_b", "1-2023")]
    assert rows(a, a) == []
    c = spark.createDataFrame([_n("2-2023", more=["45000000"])], NOTICE)
    d = spark.createDataFrame([_n("2-2023", more=["45000000", "72000000"])], NOTICE)
    assert rows(c, d) == [("content_differs", "2-2023")] and rows(c, c) == []


def test_identity_and_dates(spark):
    df = spark.createDataFrame([("000995_2020.xml",), ("995-2020",), ("0-2023",), ("995-2020\n",), ("x",), (None,)], "v string").select(columns.identity(F.col("v")).alias("k"))
    assert [r.k and tuple(r.k) for r in df.collect()] == [(995, 2020), (995, 2020), None, None, None, None]
    df = spark.createDataFrame([("20231115",), ("2023-11-15Z",), ("20231315",), (" ",), (None,)], "v string").select(columns.notice_date(F.col("v")).alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2023, 11, 15), dt.date(2023, 11, 15), None, None, None]


def test_latest_keeps_outer_rows_once(spark):
    outer = spark.createDataFrame([(1,), (2,)], "k long")
    inner = spark.createDataFrame([(1, 5, "a"), (1, 7, "b")], "k long, i long, s string")
    assert sorted(map(tuple, relational.join_latest(outer, inner, "k", "i").collect())) == [(1, 7, "b"), (2, None, None)]


def test_unknown_breaks_a_constraint(spark):
    rows = [(1, "verified", dt.datetime(2024, 1, 1), 2, 2, None, 0, 0, "x"), (2, "verified", dt.datetime(2024, 1, 1), 2, 2, 2, 0, 0, "x")]
    df = spark.createDataFrame(rows, "attempt_id long, state string, finished_at timestamp, announced_total long, api_distinct_count long, local_distinct_count long, only_local_count long, only_api_count long, api_keys_sha256 string")
    assert [tuple(r) for r in validators.attempt_violations(df).collect()] == [(1, "verified without equal counts")]


def test_empty_calendar(spark):
    from capturebase.plans.adapter import from_star_schema

    assert workloads.monthly_coverage_calendar(spark, from_star_schema(spark, SF), "2024-02-01", "2024-01-01").count() == 0


def test_orders_are_total_with_nulls_last(spark):
    from capturebase.plans.adapter import tables

    t = tables(spark, SF)
    rows = workloads.official_change_references(t).collect()
    refs = [(r.source_package_id, r.capture_id, *(int(x) for x in reversed(r.publication_ref.split("-"))), r.ordinal is None, r.ordinal or 0) for r in rows]
    assert refs == sorted(refs) and len(refs) > 100
    rows = workloads.latest_capture_per_publication(t).collect()
    keys = [(r.publication_year, r.publication_number) for r in rows]
    assert keys == sorted(set(keys)) and len(rows[0]) == 18
    up = spark.createDataFrame([(1, None), (2, 3), (3, 1)], "a long, b long")
    assert [r.a for r in workloads.ordered(up, "b").collect()] == [3, 2, 1]
    assert [type(r.packages) for r in workloads.overlapping_identities(t).limit(1).collect()] == [list]


def test_built_tables_need_no_shuffle_for_the_newest_observation(spark):
    from capturebase.operators.relational import latest_per_key
    from capturebase.plans.adapter import tables

    t = tables(spark, SF)
    plan = latest_per_key(t.notice, workloads.IDENTITY, [F.desc("capture_id")])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
