"""The star-schema test tables laid out as captures: a supplier is a capture of one of 60 monthly packages, a line item an observed notice.

``tables`` builds the seven tables once for each session and folder, as a loader would, and reads them from then on; the widest one lies in
buckets of the notice's identity, so that the surfaces which look for an identity's newest observation need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturebase.operators.relational import latest_per_key
from capturebase.sources.shared import shared_dir

from .surfaces import Tables

IDENTITY = ("publication_year", "publication_number")


def _one_of(values: tuple[str, ...], k):
    return F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))


def _at(seconds):
    return F.timestamp_seconds(seconds)


def from_star_schema(spark: SparkSession, sf_dir: str) -> Tables:
    """The seven tables, not yet built."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sup = read("supplier").select("s_suppkey", F.concat(F.lit("monthly/"), F.date_format(F.add_months(F.lit("2019-01-01").cast("date"), (F.col("s_suppkey") % 60).cast("int")), "yyyy-MM")).alias("source_package_id"))
    pub = sup.where("s_suppkey % 4 >= 2").groupBy("source_package_id").agg(F.max("s_suppkey").alias("capture_id"))
    li = read("lineitem").select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", "l_shipdate", "l_returnflag", "l_tax")
    one = latest_per_key(li, ["l_suppkey", "l_linenumber", "l_orderkey"], [F.desc("l_partkey"), F.desc("l_shipdate")])
    people = read("orders").select("o_orderkey", "o_custkey").join(read("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    people = people.join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at any scale
    buyer, parts = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("n_name")), read("part").select("p_partkey", "p_type", "p_size", "p_brand")
    has_cpv, none = F.col("p_size") % 10 != 0, F.array().cast("array<string>")
    notice = one.join(people, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("l_suppkey").alias("capture_id"), (F.col("l_linenumber") + 2000).alias("publication_year"), F.col("l_orderkey").alias("publication_number"), F.col("l_shipdate").cast("date").alias("publication_date"),
        F.col("l_returnflag").alias("source_format"), F.concat(F.lit("v"), "l_linenumber").alias("schema_version"), F.when(F.col("l_returnflag") != "A", F.concat(F.lit("0"), "l_linenumber")).alias("notice_version"),
        F.when(F.col("l_tax") > 0.02, F.date_sub(F.col("l_shipdate").cast("date"), 3)).alias("dispatch_date"),
        buyer.alias("buyer_country"), F.when(buyer.isNotNull() & (F.col("n_regionkey") != 0), F.concat(F.lit("I"), "n_nationkey")).alias("buyer_country_iso"),
        F.when(buyer.isNotNull(), "present").otherwise("absent").alias("buyer_country_status"), F.when(has_cpv, F.col("p_type")).alias("primary_cpv"), F.when(has_cpv, "present").otherwise("absent").alias("primary_cpv_status"),
        F.when(F.col("l_partkey") % 3 == 0, none).when(F.col("l_partkey") % 3 == 1, F.array("p_brand")).otherwise(F.array("p_brand", "p_type")).alias("additional_cpv"),
        F.when(F.col("l_partkey") % 7 == 0, "present").when(F.col("l_partkey") % 7 == 1, "absent").when(F.col("l_partkey") % 7 == 2, F.lit(None)).otherwise("not_applicable").alias("change_reference_status"),
    )
    target, year = F.col("publication_number") + 1, F.col("publication_year")
    value = F.when(F.col("publication_number") % 3 == 0, F.concat_ws("-", target, year)).when(F.col("publication_number") % 3 == 1, F.concat(F.lit("00"), target, F.lit("-"), year)).otherwise(F.concat(F.lit("OJ "), target))
    reference = notice.where("change_reference_status = 'present'").select("capture_id", *IDENTITY, F.lit(0).alias("ordinal"), value.alias("value"), F.lit("notice-id-ref").alias("scheme_name"))
    #: Counts come from the line items alone; the joins of a notice add no rows.
    each = li.groupBy("l_suppkey", "l_linenumber", "l_orderkey").agg(F.count("*").alias("k"))
    counts = each.groupBy(F.col("l_suppkey").alias("capture_id")).agg(F.count("*").alias("loaded"), F.sum("k").alias("members"))
    key, mark = F.col("s_suppkey"), F.col("pointer") == F.col("s_suppkey")
    status = F.when(key % 4 == 0, "loading").when(mark, "published").otherwise("superseded")
    capture = sup.join(pub.withColumnRenamed("capture_id", "pointer"), "source_package_id", "left").join(counts, key == F.col("capture_id"), "left").select(
        key.alias("capture_id"), "source_package_id", key.alias("acquisition_ordinal"), status.alias("status"), F.lit("3").alias("contract_version"),
        F.concat(F.lit("sha"), key).alias("artifact_sha256"), (key * 1000).alias("artifact_bytes"), (key % 3 != 0).alias("coverage_verified"), F.when(key % 5 == 0, F.col("members")).otherwise(F.col("loaded")).alias("member_count"), F.col("loaded").alias("distinct_notice_count"), F.col("loaded").alias("loaded_row_count"),
        F.lit(None).cast("string").alias("failure_reason"), _at(key * 7200).alias("acquired_at"), F.when(status != "loading", _at(key * 7200 + 600)).alias("published_at"), F.lit(500).alias("batch_size"),
    )
    e = read("events")
    k, state = F.col("event_id"), _one_of(("verified", "mismatch", "verified", "unavailable", "empty_unconfirmed", "in_progress"), F.col("event_id") % 6)
    told = ~state.isin("unavailable", "in_progress")
    said = lambda v: F.when(told, v)
    sample = lambda p, n: F.when(told, F.when(n > 0, F.array(F.concat(F.lit(p), k))).otherwise(none))
    attempt = e.select(
        k.alias("attempt_id"), F.col("user_id").alias("capture_id"), state.alias("state"), F.when(~state.isin("verified", "in_progress"), F.concat(state, F.lit(" "), k % 10)).alias("reason"), F.col("ts").cast("timestamp").alias("started_at"), F.when(state != "in_progress", F.timestamp_add("SECOND", (k % 97).cast("int"), F.col("ts").cast("timestamp"))).alias("finished_at"),
        F.concat(F.lit("PD "), "user_id").alias("query_text"), F.lit("ALL").alias("query_scope"), F.lit("1").alias("verifier_version"), F.concat(F.lit("sha"), "user_id").alias("artifact_sha256"), F.lit("3").alias("contract_version"), said(k % 1000).alias("announced_total"),
        said(k % 1000 + k % 3).alias("api_record_count"), said(k % 1000).alias("api_distinct_count"), said(k % 3).alias("api_duplicate_count"), (k % 1000 + k % 5).alias("local_distinct_count"), said(k % 5).alias("only_local_count"), said(k % 2).alias("only_api_count"),
        sample("l", k % 5).alias("only_local_sample"), sample("a", k % 2).alias("only_api_sample"), said(k % 7 + 1).alias("pages_fetched"), said(k % 7 + 2).alias("http_attempts"), said(F.sha2(k.cast("string"), 256)).alias("api_keys_sha256"), F.lit("sorted").alias("key_digest_recipe"),
    )
    last = attempt.groupBy("capture_id").agg(F.max("attempt_id").alias("verification_attempt_id"))
    phase = _one_of(("completed", "failed", "source_verified", "capture_published", "artifact_ready", "starting"), F.when(mark, F.lit(0)).otherwise(key % 6))
    run = sup.join(pub.withColumnRenamed("capture_id", "pointer"), "source_package_id", "left").join(last, key == F.col("capture_id"), "left").select(
        key.alias("run_id"), "source_package_id", F.floor(key / 60 + 1).alias("attempt_ordinal"), phase.alias("phase"), F.when(phase != "starting", F.concat(F.lit("packages/"), key)).alias("artifact_path"), (key * 1000).alias("artifact_bytes"), key.alias("capture_id"), "verification_attempt_id", F.concat(F.lit("sha"), key).alias("artifact_sha256"),
        _at(key * 3600).alias("started_at"), _at(key * 3600 + key % 50).alias("updated_at"), F.when(phase == "completed", _at(key * 3600 + 60)).alias("completed_at"), F.when((phase == "failed") & (key % 5 > 0), F.concat(F.lit("broken "), key)).alias("last_error"),
    )
    sealed = pub.where("capture_id % 7 <> 0").join(last, "capture_id", "left").join(counts, "capture_id", "left").select(
        "source_package_id", F.col("capture_id").alias("run_id"), "capture_id", "verification_attempt_id", F.concat(F.lit("sha"), "capture_id").alias("artifact_sha256"), F.lit("3").alias("contract_version"), F.col("loaded").alias("notice_count"), _at(F.col("capture_id") * 3600 + 90).alias("sealed_at"),
    )
    return Tables(capture, notice, reference, pub, attempt, run, sealed)


_built: dict[tuple[str, str], Tables] = {}


def build(spark: SparkSession, t: Tables, buckets: int | None = None) -> Tables:
    """The tables as files in the shared folder: notices and references in buckets of their identity, the others as they come."""
    folder, n = shared_dir(spark), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        if name not in ("notice", "reference"):
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        table = f"{name}_{folder.rsplit('-', 1)[-1]}"
        df.repartition(n, *IDENTITY).write.bucketBy(n, *IDENTITY).sortBy(*IDENTITY).option("path", path).format("parquet").saveAsTable(table)
        return spark.table(table)

    notice = put("notice", t.notice)
    reference = put("reference", t.reference)
    return Tables(put("capture", t.capture), notice, reference, put("published", t.published), put("attempt", t.attempt), put("run", t.run), put("checkpoint", t.checkpoint))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The built tables of a folder; built at the first call of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(spark, from_star_schema(spark, sf_dir))
    return _built[key]


#: The same in DuckDB SQL.
ADAPTER_SQL = """
sup as (select s_suppkey, 'monthly/' || strftime(date '2019-01-01' + to_months(cast(s_suppkey % 60 as integer)), '%Y-%m') as source_package_id from supplier),
published as (select source_package_id, max(s_suppkey) as capture_id from sup where s_suppkey % 4 >= 2 group by 1),
one as (select * from lineitem qualify row_number() over (partition by l_suppkey, l_linenumber, l_orderkey order by l_partkey desc, l_shipdate desc) = 1),
notice_capture as (select l_suppkey as capture_id, l_linenumber + 2000 as publication_year, l_orderkey as publication_number, cast(l_shipdate as date) as publication_date, l_returnflag as source_format, 'v' || l_linenumber as schema_version, case when l_returnflag <> 'A' then '0' || l_linenumber end as notice_version,
  case when l_tax > 0.02 then cast(cast(l_shipdate as date) - 3 as date) end as dispatch_date, case when c_mktsegment <> 'MACHINERY' then n_name end as buyer_country,
  case when c_mktsegment <> 'MACHINERY' and n_regionkey <> 0 then 'I' || n_nationkey end as buyer_country_iso, case when c_mktsegment <> 'MACHINERY' then 'present' else 'absent' end as buyer_country_status,
  case when p_size % 10 <> 0 then p_type end as primary_cpv, case when p_size % 10 <> 0 then 'present' else 'absent' end as primary_cpv_status,
  case l_partkey % 3 when 0 then cast([] as varchar[]) when 1 then [p_brand] else [p_brand, p_type] end as additional_cpv,
  case l_partkey % 7 when 0 then 'present' when 1 then 'absent' when 2 then null else 'not_applicable' end as change_reference_status
  from one left join (orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey) on l_orderkey = o_orderkey left join part on l_partkey = p_partkey),
reference as (select capture_id, publication_year, publication_number, 0 as ordinal, case publication_number % 3 when 0 then (publication_number + 1) || '-' || (publication_year)
  when 1 then '00' || (publication_number + 1) || '-' || (publication_year) else 'OJ ' || (publication_number + 1) end as value, 'notice-id-ref' as scheme_name from notice_capture where change_reference_status = 'present'),
counts as (select capture_id, count(*) as loaded, (select count(*) from lineitem where l_suppkey = capture_id) as members from notice_capture group by 1),
capture as (select s_suppkey as capture_id, sup.source_package_id, s_suppkey as acquisition_ordinal, case when s_suppkey % 4 = 0 then 'loading' when published.capture_id = s_suppkey then 'published' else 'superseded' end as status,
  '3' as contract_version, 'sha' || s_suppkey as artifact_sha256, s_suppkey % 3 <> 0 as coverage_verified, case when s_suppkey % 5 = 0 then members else loaded end as member_count, loaded as distinct_notice_count, loaded as loaded_row_count,
  s_suppkey * 1000 as artifact_bytes, make_timestamp(s_suppkey * 7200 * 1000000) as acquired_at
  from sup left join published using (source_package_id) left join counts on counts.capture_id = s_suppkey),
attempt as (select *, case when told then k % 1000 end as announced_total, case when state <> 'in_progress' then started_at + to_seconds(k % 97) end as finished_at,
  case when state not in ('verified', 'in_progress') then state || ' ' || (k % 10) end as reason, 'PD ' || capture_id as query_text, 'ALL' as query_scope, '1' as verifier_version,
  case when told then k % 1000 + k % 3 end as api_record_count, case when told then k % 1000 end as api_distinct_count, case when told then k % 3 end as api_duplicate_count, k % 1000 + k % 5 as local_distinct_count,
  case when told then k % 5 end as only_local_count, case when told then k % 2 end as only_api_count, case when told then case when k % 5 > 0 then 'l' || k else '' end end as only_local_sample,
  case when told then case when k % 2 > 0 then 'a' || k else '' end end as only_api_sample, case when told then k % 7 + 1 end as pages_fetched, case when told then k % 7 + 2 end as http_attempts, case when told then sha256(cast(k as varchar)) end as api_keys_sha256
  from (select *, attempt_id as k, state not in ('unavailable', 'in_progress') as told from
  (select event_id as attempt_id, user_id as capture_id, ['verified','mismatch','verified','unavailable','empty_unconfirmed','in_progress'][event_id % 6 + 1] as state, ts as started_at, 'sha' || user_id as artifact_sha256, '3' as contract_version from events))),
latest as (select capture_id, max(attempt_id) as verification_attempt_id from attempt group by 1),
run as (select *, make_timestamp(started_s * 1000000) as started_at, make_timestamp(updated_s * 1000000) as updated_at, case when phase = 'completed' then make_timestamp((started_s + 60) * 1000000) end as completed_at,
  cast(floor(run_id / 60 + 1) as bigint) as attempt_ordinal, case when phase <> 'starting' then 'packages/' || run_id end as artifact_path, run_id * 1000 as artifact_bytes, case when phase = 'failed' and run_id % 5 > 0 then 'broken ' || run_id end as last_error
  from (select s_suppkey as run_id, sup.source_package_id, ['completed','failed','source_verified','capture_published','artifact_ready','starting'][case when published.capture_id = s_suppkey then 1 else s_suppkey % 6 + 1 end] as phase,
  s_suppkey as capture_id, verification_attempt_id, 'sha' || s_suppkey as artifact_sha256, s_suppkey * 3600 as started_s, s_suppkey * 3600 + s_suppkey % 50 as updated_s from sup left join published using (source_package_id) left join latest on latest.capture_id = s_suppkey)),
checkpoint as (select source_package_id, p.capture_id as run_id, p.capture_id, verification_attempt_id, 'sha' || p.capture_id as artifact_sha256, '3' as contract_version, loaded as notice_count, make_timestamp((p.capture_id * 3600 + 90) * 1000000) as sealed_at
  from published p left join latest using (capture_id) left join counts using (capture_id) where p.capture_id % 7 <> 0),
history as (select n.*, c.source_package_id, c.acquisition_ordinal, c.status as capture_status, c.contract_version, n.publication_number || '-' || n.publication_year as publication_ref from capture c join notice_capture n using (capture_id) where c.status in ('published', 'superseded')),
notice as (select n.*, c.source_package_id, c.acquisition_ordinal, n.publication_number || '-' || n.publication_year as publication_ref from published p join capture c using (capture_id) join notice_capture n using (capture_id)),
distinct_notice as (select * from notice qualify row_number() over (partition by publication_year, publication_number order by acquisition_ordinal desc, capture_id desc) = 1),
package_status as (select k.source_package_id, cp.source_package_id is not null as has_checkpoint, cp.capture_id as checkpoint_capture_id, cp.verification_attempt_id as checkpoint_attempt_id, cp.artifact_sha256 as checkpoint_artifact_sha256, cp.sealed_at as checkpoint_sealed_at, cp.notice_count as checkpoint_notice_count, pub.capture_id as published_capture_id,
  coalesce(cp.capture_id = pub.capture_id, false) as capture_still_published, coalesce(cap.coverage_verified, false) as coverage_verified, l.attempt_id as latest_attempt_id, l.state as latest_verification_state,
  coalesce(cp.capture_id = pub.capture_id and cap.status = 'published' and cap.coverage_verified and cap.artifact_sha256 = cp.artifact_sha256 and cap.contract_version = cp.contract_version and cap.member_count = cp.notice_count
    and cap.distinct_notice_count = cp.notice_count and cap.loaded_row_count = cp.notice_count and r.phase = 'completed' and r.source_package_id = cp.source_package_id and r.capture_id = cp.capture_id
    and r.verification_attempt_id = cp.verification_attempt_id and r.artifact_sha256 = cp.artifact_sha256 and l.attempt_id = cp.verification_attempt_id and l.state = 'verified' and l.artifact_sha256 = cp.artifact_sha256
    and l.contract_version = cp.contract_version, false) as checkpoint_is_current, o.run_id as open_run_id, o.phase as open_run_phase, o.started_at as open_run_started_at, o.last_error as open_run_last_error
  from (select source_package_id from capture union select source_package_id from run union select source_package_id from checkpoint) k left join checkpoint cp using (source_package_id) left join run r on r.run_id = cp.run_id
  left join published pub on pub.source_package_id = k.source_package_id left join capture cap on cap.capture_id = pub.capture_id
  left join (select * from attempt qualify row_number() over (partition by capture_id order by attempt_id desc) = 1) l on l.capture_id = pub.capture_id
  left join (select * from run where phase not in ('completed', 'failed') qualify row_number() over (partition by source_package_id order by run_id desc) = 1) o on o.source_package_id = k.source_package_id)
"""
