"""Every registered query and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturebase.functions import columns
from capturebase.operators import relational, validators
from capturebase.sources.archives import COUNTRIES

from . import views
from . import workloads as w
from .adapter import ADAPTER_SQL, tables
from .surfaces import Tables, notices

A, B = "monthly/2019-03", "monthly/2019-07"
WANTED = [f"monthly/2019-{m:02d}" for m in range(1, 13)]
CUTOFF = 40


def _shown(df: DataFrame) -> DataFrame:
    """Arrays joined by | and times written out, so that two engines write them alike; the workloads themselves return the values."""
    form = {"array<string>": lambda c: F.array_join(c, "|"), "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")}
    return df.select(*[form[kind](c).alias(c) if kind in form else F.col(c) for c, kind in df.dtypes])


def _over(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _shown(f(tables(spark, sf_dir)))


def _times(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c.rpartition('.')[2]}" for c in columns)


def _resumed(t: Tables) -> dict[str, DataFrame]:
    """What is left where two of seven batches were never committed."""
    batched = t.notice.withColumn("batch", F.col("publication_number") % 7)
    committed = batched.select("batch").distinct().where("batch not in (2, 5)")
    return relational.without_uncommitted(batched, committed, "batch", {"references": (t.reference, ["capture_id", *w.IDENTITY])})


def _read(name: str, f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


_state = ", ".join(w.STATE)
_content = ", ".join(w.CONTENT)
_last = "qualify row_number() over (partition by publication_year, publication_number order by acquisition_ordinal desc, capture_id desc) = 1"
_named: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "monthly_notice_counts": (_over(w.monthly_notice_counts), "select cast(date_trunc('month', publication_date) as date) as publication_month, coalesce(buyer_country_iso, buyer_country, '(absent)') as buyer_country, case when primary_cpv_status = 'present' then left(primary_cpv, 2) || '000000' else '(absent)' end as cpv_division, count(*) as notice_count from distinct_notice group by 1, 2, 3"),
    "latest_capture_per_publication": (_over(w.latest_capture_per_publication), f"select {_state} from history {_last}"),
    "acquisition_cutoff_state": (_over(lambda t: w.latest_capture_per_publication(t, CUTOFF)), f"select {_state} from (select * from history where acquisition_ordinal <= {CUTOFF}) {_last}"),
    "official_change_references": (_over(lambda t: w.official_change_references(t)), "select h.source_package_id, h.capture_id, h.capture_status, h.publication_ref, h.change_reference_status, r.ordinal, r.value, r.scheme_name, case when r.value is null then null when regexp_full_match(r.value, '[0-9]{1,8}-[1-9][0-9]{3}') then 'publication_reference' else 'unresolved_shape' end as value_shape, d.publication_ref as resolved_target, case when r.value is null or not regexp_full_match(r.value, '[0-9]{1,8}-[1-9][0-9]{3}') then null else d.publication_ref is not null end as target_loaded from history h left join reference r using (capture_id, publication_year, publication_number) left join distinct_notice d on try_cast(nullif(regexp_extract(r.value, '^([0-9]{1,8})-([1-9][0-9]{3})$', 1), '') as bigint) = d.publication_number and try_cast(nullif(regexp_extract(r.value, '^([0-9]{1,8})-([1-9][0-9]{3})$', 2), '') as bigint) = d.publication_year"),
    "monthly_coverage_calendar": (lambda spark, d: _shown(w.monthly_coverage_calendar(spark, tables(spark, d), "2018-11-01", "2024-02-01")), "select m.month, 'monthly/' || strftime(m.month, '%Y-%m') as source_package_id, case when p.source_package_id is null then 'no package record' when checkpoint_is_current then 'processed' when latest_verification_state = 'empty_unconfirmed' then 'empty source, unconfirmed' when latest_verification_state = 'unavailable' then 'verification unavailable' when latest_verification_state = 'in_progress' then 'verification in progress' when latest_verification_state = 'mismatch' then 'discrepancy' when has_checkpoint then 'retired checkpoint' when latest_verification_state = 'verified' then 'verified, no checkpoint' else 'verification not yet run' end as calendar_state, checkpoint_notice_count, coverage_verified, " + _times("checkpoint_sealed_at") + " from (select cast(unnest(generate_series(date '2018-11-01', date '2024-02-01', interval 1 month)) as date) as month) m left join package_status p on p.source_package_id = 'monthly/' || strftime(m.month, '%Y-%m')"),
    "cross_package_overlap_audit": (_over(lambda t: w.cross_package_overlap_audit(t, A, B)), f"select 'only_in_a' as finding, publication_ref, null as detail from notice where source_package_id = '{A}' and publication_ref not in (select publication_ref from notice where source_package_id = '{B}') union all select 'only_in_b', publication_ref, null from notice where source_package_id = '{B}' and publication_ref not in (select publication_ref from notice where source_package_id = '{A}') union all select 'content_differs', publication_ref, 'a: format=' || source_format || ' date=' || publication_date || ' country=' || coalesce(buyer_country_iso, buyer_country, '') || ' cpv=' || coalesce(primary_cpv, '') || ' refs=' || coalesce(change_reference_status, '') from (select {_content} from notice where source_package_id = '{A}' and publication_ref in (select publication_ref from notice where source_package_id = '{B}') except select {_content} from notice where source_package_id = '{B}')"),
    "load_reconciliation": (_over(w.load_reconciliation), "select c.source_package_id, c.capture_id, acquisition_ordinal, status, p.capture_id is not null as is_published, member_count, distinct_notice_count, loaded_row_count, member_count = distinct_notice_count and distinct_notice_count = loaded_row_count as reconciles, coverage_verified as source_coverage_verified from capture c left join published p on p.capture_id = c.capture_id"),
    "overlapping_identities": (_over(w.overlapping_identities), "select publication_ref, count(*) as package_count, string_agg(source_package_id, '|' order by source_package_id) as packages from notice group by 1 having count(*) > 1"),
    "field_completeness": (_over(w.field_completeness), "select count(*) as notices, count(*) filter (where buyer_country_status = 'present') as with_country, count(*) filter (where primary_cpv_status = 'present') as with_primary_cpv, count(*) filter (where dispatch_date is not null) as with_dispatch_date from distinct_notice"),
    "coverage_status": (_over(w.coverage_status), "select c.source_package_id, c.capture_id, acquisition_ordinal, distinct_notice_count as capture_notices, case state when 'verified' then 'verified' when 'mismatch' then 'mismatch' when 'unavailable' then 'source unavailable' when 'empty_unconfirmed' then 'unconfirmed empty' when 'in_progress' then 'verification in progress' else 'never verified' end as coverage_state, attempt_id, coverage_verified as source_coverage_verified, strftime(started_at, '%Y-%m-%d %H:%M:%S') as verification_started_at, strftime(finished_at, '%Y-%m-%d %H:%M:%S') as verification_finished_at, announced_total as source_announced_total, api_distinct_count as source_distinct_notices, only_local_count, only_api_count, reason from published p join capture c using (capture_id) left join lateral (select * from attempt a where a.capture_id = c.capture_id order by attempt_id desc limit 1) on true"),
    "verification_history": (_over(w.verification_history), "select source_package_id, capture_id, attempt_id, row_number() over k as attempt_ordinal, lag(state) over k as previous_state, state, reason, " + _times("started_at", "finished_at") + ", epoch_us(finished_at) / 1000000 - epoch_us(started_at) / 1000000 as duration_s, " + ", ".join(w.ATTEMPT[3:]) + " from attempt join capture using (capture_id) window k as (partition by capture_id order by attempt_id)"),
    "ingest_status": (_over(w.ingest_status), "select source_package_id, checkpoint_capture_id, checkpoint_attempt_id, latest_attempt_id, checkpoint_artifact_sha256, open_run_last_error, " + _times("checkpoint_sealed_at", "open_run_started_at") + ", case when not has_checkpoint then 'never checkpointed' when checkpoint_is_current then 'processed' when not capture_still_published then 'retired by a later acquisition' else 'retired by a later coverage check' end as checkpoint_state, checkpoint_notice_count, published_capture_id, coalesce(latest_verification_state, 'never verified') as latest_verification_state, coverage_verified, open_run_id, open_run_phase from package_status"),
    "ingest_history": (_over(w.ingest_history), "select r.source_package_id, run_id, phase, case phase when 'completed' then 'checkpoint sealed' when 'failed' then 'terminal failure, not resumable' when 'source_verified' then 'interrupted before the checkpoint' when 'capture_published' then 'interrupted before coverage was confirmed' when 'artifact_ready' then 'interrupted before the capture was published' else 'interrupted before an artifact was accepted' end as reached, artifact_path, artifact_bytes, r.artifact_sha256, r.capture_id, attempt_ordinal, c.acquisition_ordinal as capture_acquisition_ordinal, c.status as capture_status, verification_attempt_id, a.state as verification_state, last_error, " + _times("r.started_at", "r.updated_at", "r.completed_at") + ", cast(case when phase = 'completed' then 60 else updated_s - started_s end as double) as elapsed_s from run r left join (select capture_id, acquisition_ordinal, status from capture) c on c.capture_id = r.capture_id left join (select attempt_id, state from attempt) a on a.attempt_id = verification_attempt_id"),
    "checkpoint_summary": (_over(lambda t: w.checkpoint_summary(t, WANTED)), f"select count(*) as known, count(*) filter (where checkpoint_is_current) as current, cast(sum(checkpoint_notice_count) as bigint) as notices from package_status where source_package_id in ({', '.join(map(repr, WANTED))})"),
    "capture_composition": (_over(w.composition), "select capture_id, count(*) as n, count(buyer_country) as with_country, min(publication_date) filter (where primary_cpv_status = 'present') as first_date, max(publication_date) filter (where primary_cpv_status = 'present') as last_date from notice_capture group by 1"),
    "verified_distinct": (_over(w.verified_distinct), "select count(*) as verified_distinct from (select distinct publication_year, publication_number from notice join package_status using (source_package_id) where checkpoint_is_current)"),
    "published_count": (_over(lambda t: notices(t).agg(F.count("*").alias("observations"), F.countDistinct("publication_year", "publication_number").alias("identities"))), "select count(*) as observations, count(distinct (publication_year, publication_number)) as identities from notice"),
    "distinct_key_digest": (_over(lambda t: relational.key_digest(notices(t), w.IDENTITY, ["source_package_id"])), "select source_package_id, count(*) as n_keys, sha256(string_agg(publication_year || ':' || publication_number, chr(10) order by publication_year, publication_number)) as keys_sha256 from notice group by 1"),
    "capture_key_difference": (_over(lambda t: t.notice.where("capture_id = 2").select(*w.IDENTITY).subtract(t.notice.where("capture_id = 3").select(*w.IDENTITY)).orderBy(*w.IDENTITY).limit(20)), "select publication_year, publication_number from notice_capture where capture_id = 2 except select publication_year, publication_number from notice_capture where capture_id = 3 order by 1, 2 limit 20"),
    "capture_key_difference_back": (_over(lambda t: t.notice.where("capture_id = 3").select(*w.IDENTITY).subtract(t.notice.where("capture_id = 2").select(*w.IDENTITY)).orderBy(*w.IDENTITY).limit(20)), "select publication_year, publication_number from notice_capture where capture_id = 3 except select publication_year, publication_number from notice_capture where capture_id = 2 order by 1, 2 limit 20"),
    "code_counts": (_over(lambda t: t.notice.select("capture_id", *w.IDENTITY, F.coalesce(F.size("additional_cpv"), F.lit(0)).alias("n_codes"), (F.col("additional_cpv") == F.array("primary_cpv")).alias("only_primary"))), "select capture_id, publication_year, publication_number, coalesce(cast(len(additional_cpv) as integer), 0) as n_codes, case when primary_cpv is not null or len(additional_cpv) <> 1 then additional_cpv = [primary_cpv] else false end as only_primary from notice_capture"),
    "rows_after_resume": (_over(lambda t: _resumed(t)["rows"].select("capture_id", *w.IDENTITY)), "select capture_id, publication_year, publication_number from notice_capture where publication_number % 7 not in (2, 5)"),
    "references_after_resume": (_over(lambda t: _resumed(t)["references"].select("capture_id", *w.IDENTITY, "value")), "select capture_id, publication_year, publication_number, value from reference r where not exists (select 1 from notice_capture n where n.capture_id = r.capture_id and n.publication_year = r.publication_year and n.publication_number = r.publication_number and n.publication_number % 7 in (2, 5))"),
    "top_packages": (_over(lambda t: relational.top_categories(notices(t), "source_package_id")), "select source_package_id, count(*) as n from notice group by 1 order by n desc, source_package_id limit 20"),
    "next_attempt_ordinal": (_over(lambda t: t.run.groupBy("source_package_id").agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("next_ordinal"))), "select source_package_id, coalesce(max(run_id), 0) + 1 as next_ordinal from run group by 1"),
    "replaced_checkpoints": (_over(lambda t: relational.replace_rows(t.checkpoint.select("source_package_id", "notice_count"), t.checkpoint.where("capture_id % 2 = 0").select("source_package_id", (F.col("notice_count") + 1).alias("notice_count")), ["source_package_id"])), "select source_package_id, case when capture_id % 2 = 0 then notice_count + 1 else notice_count end as notice_count from checkpoint"),
    "parsed_identities": (_read("events", lambda e: e.select("event_id", columns.identity(F.concat(F.lit("000"), F.col("user_id"), F.lit("_"), F.col("event_id") % 3000)).alias("k")).select("event_id", "k.publication_number", "k.publication_year")), "select event_id, case when event_id % 3000 >= 1000 and user_id > 0 then user_id end as publication_number, case when event_id % 3000 >= 1000 and user_id > 0 then cast(event_id % 3000 as integer) end as publication_year from events"),
    "rejected_runs": (_over(lambda t: validators.run_violations(t.run)), "select run_id, case when phase = 'failed' then 'failed without a reason' end as violation from run where phase = 'failed' and last_error is null"),
}
# The same values as codes of the archives' countries.
_countries = ", ".join(f"('{a}', '{b}')" for a, b in COUNTRIES.items())
_named |= {
    "sql_cutoff_state": (lambda spark, d: views.sql(spark, tables(spark, d), "select publication_ref, capture_id, capture_status, contract_version, source_coverage_verified from (select *, row_number() over (partition by publication_year, publication_number order by acquisition_ordinal desc, capture_id desc) as k from notice_history where acquisition_ordinal <= :cutoff) where k = 1", cutoff=CUTOFF), f"select publication_ref, h.capture_id, capture_status, h.contract_version, coverage_verified as source_coverage_verified from (select * from history where acquisition_ordinal <= {CUTOFF} {_last}) h join capture using (capture_id)"),
    "notice_change_reference_history": (_over(lambda t: views.views(t)["notice_change_reference_history"]), "select c.source_package_id, capture_id, acquisition_ordinal, status as capture_status, publication_number || '-' || publication_year as publication_ref, publication_year, publication_number, ordinal, value, 'notice-id-ref' as scheme_name from reference join capture c using (capture_id) where status in ('published', 'superseded')"),
    "capture_status": (_over(lambda t: views.views(t)["capture_status"].select("capture_id", "status", "is_published", "artifact_sha256", "member_count", "source_coverage_verified", "verification_attempt_id", "verification_state")), "select c.capture_id, status, p.capture_id is not null as is_published, c.artifact_sha256, member_count, coverage_verified as source_coverage_verified, attempt_id as verification_attempt_id, state as verification_state from capture c left join published p on p.capture_id = c.capture_id left join (select * from attempt qualify row_number() over (partition by capture_id order by attempt_id desc) = 1) a on a.capture_id = c.capture_id"),
    "verification_attempt": (_over(lambda t: views.views(t)["verification_attempt"].select("attempt_id", "capture_id", "source_package_id", "acquisition_ordinal", "state", "announced_total")), "select attempt_id, capture_id, c.source_package_id, acquisition_ordinal, state, announced_total from attempt join capture c using (capture_id)"),
    "ingest_run": (_over(lambda t: views.views(t)["ingest_run"].select("run_id", "phase", "capture_id", "capture_status", "verification_attempt_id", "verification_state")), "select run_id, phase, r.capture_id, c.status as capture_status, verification_attempt_id, state as verification_state from run r left join capture c on c.capture_id = r.capture_id left join attempt a on a.attempt_id = verification_attempt_id"),
    "package_ingest_status": (_over(lambda t: views.views(t)["package_ingest_status"].select("source_package_id", "has_checkpoint", "checkpoint_run_id", "checkpoint_attempt_id", "checkpoint_artifact_sha256", "checkpoint_is_current", "open_run_id", "checkpoint_contract_version", "published_contract_version")), "select s.source_package_id, has_checkpoint, cp.run_id as checkpoint_run_id, cp.verification_attempt_id as checkpoint_attempt_id, cp.artifact_sha256 as checkpoint_artifact_sha256, checkpoint_is_current, open_run_id, cp.contract_version as checkpoint_contract_version, c.contract_version as published_contract_version from package_status s left join checkpoint cp using (source_package_id) left join capture c on c.capture_id = published_capture_id"),
    "changed_states": (_over(w.changed_states), "select capture_id, attempt_id, previous_state, state from (select *, lag(state) over (partition by capture_id order by attempt_id) as previous_state from attempt) where state is distinct from previous_state"),
    "current_attempts": (_over(w.current_attempts), "select a.capture_id, a.attempt_id, a.state from attempt a join capture c using (capture_id) where coverage_verified and state = 'verified' and attempt_id = (select max(b.attempt_id) from attempt b where b.capture_id = a.capture_id)"),
    "duplicate_identities": (_read("lineitem", lambda x: validators.duplicate_identities(x.select(F.col("l_suppkey").alias("capture_id"), F.col("l_linenumber").alias("publication_year"), F.col("l_orderkey").alias("publication_number")))), "select l_suppkey as capture_id, l_linenumber as publication_year, l_orderkey as publication_number, count(*) as n from lineitem group by all having count(*) > 1"),
    "rejected_captures": (_over(lambda t: validators.capture_violations(t.capture.withColumn("member_count", F.col("member_count") - 600))), "select capture_id, 'counts' as violation from capture where coalesce(member_count - 600 < 0, true) or coalesce(distinct_notice_count < 0, true)"),
    "blank_references": (_over(lambda t: validators.blank_references(t.reference.withColumn("value", F.when(F.col("publication_number") % 3 == 0, F.col("value")).when(F.col("publication_number") % 3 == 1, " "))).select("capture_id", "publication_year", "publication_number", "value")), "select capture_id, publication_year, publication_number, case publication_number % 3 when 1 then ' ' end as value from reference where publication_number % 3 <> 0"),
    "country_codes": (_read("nation", lambda x: x.select("n_nationkey", columns.country(F.when(F.col("n_nationkey") % 5 > 0, F.concat(F.lit(" "), F.substring("n_name", 1, 2), F.when(F.col("n_nationkey") % 2 == 0, F.substring("n_name", 3, 1)).otherwise(""))), COUNTRIES).alias("c")).select("n_nationkey", "c.*")), f"with codes(a, b) as (values {_countries}), named as (select n_nationkey, case when n_nationkey % 5 > 0 then upper(substr(n_name, 1, case when n_nationkey % 2 = 0 then 3 else 2 end)) end as c from nation) select n_nationkey, c as buyer_country, case when length(c) = 2 and regexp_full_match(c, '[A-Z]+') then c else b end as buyer_country_iso, case when c is null then 'absent' else 'present' end as buyer_country_status from named left join codes on a = c"),
    "notice_dates": (_read("orders", lambda x: x.select("o_orderkey", columns.notice_date(F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'+01:00'"))).alias("day"))), "select o_orderkey, case when o_orderkey % 3 < 2 then cast(o_orderdate as date) end as day from orders"),
    "json_fields": (_read("events", lambda x: x.select("event_id", F.from_json("props", "k long")["k"].alias("k"))), "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events"),
}
_PLAIN = {"parsed_identities", "duplicate_identities", "country_codes", "notice_dates", "json_fields"}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for k, (f, _) in _named.items()}
ORACLE_SQL: dict[str, str] = {k: q if k in _PLAIN else f"with {ADAPTER_SQL} {q}" for k, (_, q) in _named.items()}
