"""The analytical workloads over the read surfaces. Each has a documented grain and a total order, nulls last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capturebase.functions.columns import REFERENCE, matched, month_of, seconds, text
from capturebase.operators.relational import join_latest, latest_per_key

from .surfaces import Tables, attempts, capture_status, distinct_notices, history, notices, package_status, runs

IDENTITY = ["publication_year", "publication_number"]
# The columns of each report, in order.
STATE = [
    "publication_ref", *IDENTITY, "source_package_id", "capture_id", "acquisition_ordinal", "capture_status", "contract_version", "source_format", "schema_version", "notice_version",
    "publication_date", "buyer_country", "buyer_country_iso", "buyer_country_status", "primary_cpv", "primary_cpv_status", "change_reference_status",
]
#: Nine columns that decide whether two observations of a notice differ.
CONTENT = ["publication_ref", "source_format", "publication_date", "dispatch_date", "buyer_country_iso", "buyer_country", "primary_cpv", "additional_cpv", "change_reference_status"]
ATTEMPT = [
    "reason", "started_at", "finished_at", "query_text", "query_scope", "verifier_version", "announced_total", "api_record_count", "api_distinct_count", "api_duplicate_count",
    "local_distinct_count", "only_local_count", "only_api_count", "only_local_sample", "only_api_sample", "pages_fetched", "http_attempts", "api_keys_sha256",
]
COVERAGE = {"verified": "verified", "mismatch": "mismatch", "unavailable": "source unavailable", "empty_unconfirmed": "unconfirmed empty", "in_progress": "verification in progress"}
REACHED = {"completed": "checkpoint sealed", "failed": "terminal failure, not resumable", "source_verified": "interrupted before the checkpoint", "capture_published": "interrupted before coverage was confirmed", "artifact_ready": "interrupted before the capture was published"}


def _label(column: str, labels: dict[str, str], otherwise: str):
    out = F
    for code, label in labels.items():
        out = out.when(F.col(column) == code, label)
    return out.otherwise(otherwise)


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted by ``columns``, nulls last, whatever the engine's habit."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])


def monthly_notice_counts(t: Tables) -> DataFrame:
    """Month x country x division."""
    counts = distinct_notices(t).groupBy(
        F.trunc("publication_date", "MONTH").alias("publication_month"), F.coalesce("buyer_country_iso", "buyer_country", F.lit("(absent)")).alias("buyer_country"),
        F.when(F.col("primary_cpv_status") == "present", F.concat(F.left("primary_cpv", F.lit(2)), F.lit("000000"))).otherwise("(absent)").alias("cpv_division"),
    ).agg(F.count("*").alias("notice_count"))
    return ordered(counts, "publication_month", "buyer_country", "cpv_division")


def latest_capture_per_publication(t: Tables, cutoff: int | None = None) -> DataFrame:
    """Identity: its newest complete observation; with ``cutoff``, the newest up to that ordinal."""
    h = history(t)
    h = h if cutoff is None else h.where(F.col("acquisition_ordinal") <= cutoff)
    return ordered(latest_per_key(h, IDENTITY, [F.desc("acquisition_ordinal"), F.desc("capture_id")]).select(*STATE), *IDENTITY)


def resolved_references(t: Tables) -> DataFrame:
    """Reference, with the published notice that its value names, if it has that shape and the notice is there. Values of another shape, which
    have no key to join by, don't take part in the join."""
    r = t.reference.select("capture_id", *IDENTITY, "ordinal", "value", "scheme_name", matched(F.col("value"), REFERENCE, 1).try_cast("long").alias("_n"), matched(F.col("value"), REFERENCE, 2).try_cast("int").alias("_y"))
    named = F.col("_n").isNotNull() & F.col("_y").isNotNull()
    target = notices(t).select(F.col("publication_number").alias("_n"), F.col("publication_year").alias("_y"), F.lit(True).alias("_there")).distinct()
    found = r.where(named).join(target, ["_n", "_y"], "left").withColumn("resolved_target", F.when(F.col("_there"), F.concat_ws("-", "_n", "_y")))
    rest = r.where(~named).select("*", F.lit(None).cast("string").alias("resolved_target"))
    kept = ["capture_id", *IDENTITY, "ordinal", "value", "scheme_name", "resolved_target"]
    return found.select(*kept).unionAll(rest.select(*kept))


def official_change_references(t: Tables) -> DataFrame:
    """Notice x reference, one row at least for each notice."""
    shape, value = F.col("value").rlike(REFERENCE), F.col("value")
    h = history(t).select("source_package_id", "capture_id", "capture_status", "publication_ref", *IDENTITY, "change_reference_status")
    joined = h.join(resolved_references(t), ["capture_id", *IDENTITY], "left")
    return ordered(joined, "source_package_id", "capture_id", *IDENTITY, "ordinal").select(
        "source_package_id", "capture_id", "capture_status", "publication_ref", "change_reference_status", "ordinal", "value", "scheme_name",
        F.when(value.isNull(), None).when(shape, "publication_reference").otherwise("unresolved_shape").alias("value_shape"), "resolved_target",
        F.when(value.isNull() | ~shape, None).otherwise(F.col("resolved_target").isNotNull()).alias("target_loaded"),
    )


def monthly_coverage_calendar(spark: SparkSession, t: Tables, first: str, last: str) -> DataFrame:
    """Month; an empty range gives no rows. The order of the states is their precedence."""
    months = spark.range(1).where(F.lit(first).cast("date") <= F.lit(last).cast("date")).select(F.explode(F.sequence(F.lit(first).cast("date"), F.greatest(F.lit(first).cast("date"), F.lit(last).cast("date")), F.expr("interval 1 month"))).alias("month"))
    p = package_status(t).withColumn("month", month_of(F.col("source_package_id"))).where("month is not null").withColumnRenamed("source_package_id", "_id")
    is_ = lambda state: F.col("latest_verification_state") == state
    state = F.when(F.col("_id").isNull(), "no package record").when(F.col("checkpoint_is_current"), "processed").when(is_("empty_unconfirmed"), "empty source, unconfirmed").when(is_("unavailable"), "verification unavailable")
    state = state.when(is_("in_progress"), "verification in progress").when(is_("mismatch"), "discrepancy").when(F.col("has_checkpoint"), "retired checkpoint").when(is_("verified"), "verified, no checkpoint").otherwise("verification not yet run")
    return ordered(months.join(p, "month", "left").select("month", F.concat(F.lit("monthly/"), F.date_format("month", "yyyy-MM")).alias("source_package_id"), state.alias("calendar_state"), "checkpoint_notice_count", "coverage_verified", "checkpoint_sealed_at"), "month")


def overlap_audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Finding: identities in one of two sets of notices only, and shared ones whose content differs. Each side holds an identity once, as a
    package does, so both meet in one join."""
    sides = [df.select("publication_ref", F.struct(*CONTENT[1:]).alias(name)) for df, name in ((left, "a"), (right, "b"))]
    c = lambda name: F.col(f"a.{name}")
    detail = F.concat(F.lit("a: format="), text(c("source_format")), F.lit(" date="), text(c("publication_date")), F.lit(" country="), text(F.coalesce(c("buyer_country_iso"), c("buyer_country"))), F.lit(" cpv="), text(c("primary_cpv")), F.lit(" refs="), text(c("change_reference_status")))
    finding = F.when(F.col("b").isNull(), "only_in_a").when(F.col("a").isNull(), "only_in_b").when(~F.col("a").eqNullSafe(F.col("b")), "content_differs")
    found = sides[0].join(sides[1], "publication_ref", "full").select(finding.alias("finding"), "publication_ref", F.when(finding == "content_differs", detail).alias("detail")).where("finding is not null")
    return ordered(found, "finding", "publication_ref")


def cross_package_overlap_audit(t: Tables, package_a: str, package_b: str) -> DataFrame:
    n = notices(t)
    return overlap_audit(n.where(F.col("source_package_id") == package_a), n.where(F.col("source_package_id") == package_b))


def load_reconciliation(t: Tables) -> DataFrame:
    """Capture."""
    c = F.col
    reconciles = (c("member_count") == c("distinct_notice_count")) & (c("distinct_notice_count") == c("loaded_row_count"))
    return ordered(capture_status(t), "source_package_id", "acquisition_ordinal").select("source_package_id", "capture_id", "acquisition_ordinal", "status", "is_published", "member_count", "distinct_notice_count", "loaded_row_count", reconciles.alias("reconciles"), c("coverage_verified").alias("source_coverage_verified"))


def overlapping_identities(t: Tables) -> DataFrame:
    """Identity in more than one package, and the ordered array of these."""
    many = notices(t).groupBy("publication_ref").agg(F.count("*").alias("package_count"), F.array_sort(F.collect_list("source_package_id")).alias("packages")).where("package_count > 1")
    return ordered(many, "publication_ref")


def field_completeness(t: Tables) -> DataFrame:
    c = F.col
    return distinct_notices(t).agg(F.count("*").alias("notices"), F.count_if(c("buyer_country_status") == "present").alias("with_country"), F.count_if(c("primary_cpv_status") == "present").alias("with_primary_cpv"), F.count_if(c("dispatch_date").isNotNull()).alias("with_dispatch_date"))


def coverage_status(t: Tables) -> DataFrame:
    """Published capture, with its newest attempt if there is one."""
    df = join_latest(capture_status(t).where("is_published").drop("artifact_sha256", "contract_version"), t.attempt, "capture_id", "attempt_id")
    as_ = lambda old, new: F.col(old).alias(new)
    return ordered(df, "source_package_id").select(
        "source_package_id", "capture_id", "acquisition_ordinal", as_("distinct_notice_count", "capture_notices"), as_("coverage_verified", "source_coverage_verified"), _label("state", COVERAGE, "never verified").alias("coverage_state"), "attempt_id",
        as_("started_at", "verification_started_at"), as_("finished_at", "verification_finished_at"), as_("announced_total", "source_announced_total"), as_("api_distinct_count", "source_distinct_notices"), "only_local_count", "only_api_count", "reason",
    )


def verification_history(t: Tables) -> DataFrame:
    """Attempt, numbered within its capture, with the state before it and its seconds."""
    w = Window.partitionBy("capture_id").orderBy("attempt_id")
    numbered = attempts(t).select("source_package_id", "capture_id", "attempt_id", F.row_number().over(w).alias("attempt_ordinal"), F.lag("state").over(w).alias("previous_state"), "state", *ATTEMPT[:3], seconds(F.col("started_at"), F.col("finished_at")).alias("duration_s"), *ATTEMPT[3:])
    return ordered(numbered, "capture_id", "attempt_id")


def ingest_status(t: Tables) -> DataFrame:
    """Package."""
    state = F.when(~F.col("has_checkpoint"), "never checkpointed").when(F.col("checkpoint_is_current"), "processed").when(~F.col("capture_still_published"), "retired by a later acquisition").otherwise("retired by a later coverage check")
    return ordered(package_status(t), "source_package_id").select(
        "source_package_id", state.alias("checkpoint_state"), "checkpoint_notice_count", "checkpoint_sealed_at", "checkpoint_capture_id", "published_capture_id", "checkpoint_attempt_id", "latest_attempt_id",
        F.coalesce("latest_verification_state", F.lit("never verified")).alias("latest_verification_state"), "coverage_verified", "checkpoint_artifact_sha256", "open_run_id", "open_run_phase", "open_run_started_at", "open_run_last_error",
    )


def ingest_history(t: Tables) -> DataFrame:
    """Run, with the seconds that it took so far."""
    return ordered(runs(t), "source_package_id", "attempt_ordinal").select(
        "source_package_id", "run_id", "attempt_ordinal", "phase", _label("phase", REACHED, "interrupted before an artifact was accepted").alias("reached"), "artifact_path", "artifact_bytes", "artifact_sha256", "capture_id",
        F.col("acquisition_ordinal").alias("capture_acquisition_ordinal"), "capture_status", "verification_attempt_id", "verification_state", "last_error", "started_at", "updated_at", "completed_at",
        seconds(F.col("started_at"), F.coalesce("completed_at", "updated_at")).alias("elapsed_s"),
    )


def checkpoint_summary(t: Tables, wanted: list[str]) -> DataFrame:
    """How many of the wanted packages are known and current, and their notices."""
    s = package_status(t).where(F.col("source_package_id").isin(*wanted))
    return s.agg(F.count("*").alias("known"), F.count_if("checkpoint_is_current").alias("current"), F.sum("checkpoint_notice_count").alias("notices"))


def composition(t: Tables) -> DataFrame:
    """Capture: rows, those with a country, and the range of months of those with a code."""
    on = F.col("primary_cpv_status") == "present"
    return t.notice.groupBy("capture_id").agg(F.count("*").alias("n"), F.count_if(F.col("buyer_country").isNotNull()).alias("with_country"), F.min(F.when(on, F.col("publication_date"))).alias("first_date"), F.max(F.when(on, F.col("publication_date"))).alias("last_date"))


def verified_distinct(t: Tables) -> DataFrame:
    """The gate: distinct identities of packages whose checkpoint is current."""
    return notices(t).join(package_status(t).where("checkpoint_is_current").select("source_package_id"), "source_package_id").select(*IDENTITY).distinct().agg(F.count("*").alias("verified_distinct"))


def changed_states(t: Tables) -> DataFrame:
    """Attempt whose state is not that of the one before it; the first of a capture has none before it, and counts."""
    before = F.lag("state").over(Window.partitionBy("capture_id").orderBy("attempt_id"))
    return t.attempt.select("capture_id", "attempt_id", before.alias("previous_state"), "state").where(~F.col("state").eqNullSafe(F.col("previous_state")))


def current_attempts(t: Tables) -> DataFrame:
    """Capture that is covered, with its newest attempt if that verified it: what a checkpoint may cite."""
    newest = t.attempt.groupBy("capture_id").agg(F.max_by(F.struct("attempt_id", "state"), "attempt_id").alias("a")).select("capture_id", "a.*")
    return newest.join(t.capture.where("coverage_verified").select("capture_id"), "capture_id").where("state = 'verified'")
