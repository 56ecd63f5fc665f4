"""The read surfaces over captures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturebase.operators.relational import join_latest, latest_per_key

COMPLETE = ("published", "superseded")
OPEN = ("completed", "failed")


@dataclass(frozen=True)
class Tables:
    """capture, notice_capture, reference, published, attempt, run, checkpoint."""

    capture: DataFrame
    notice: DataFrame
    reference: DataFrame
    published: DataFrame
    attempt: DataFrame
    run: DataFrame
    checkpoint: DataFrame


def _ref() -> object:
    return F.concat_ws("-", "publication_number", "publication_year").alias("publication_ref")


def history(t: Tables) -> DataFrame:
    """Notices of all complete captures, superseded ones included."""
    c = t.capture.where(F.col("status").isin(*COMPLETE)).select("capture_id", "source_package_id", "acquisition_ordinal", F.col("status").alias("capture_status"), "contract_version", "coverage_verified", "acquired_at", "published_at")
    return t.notice.join(c, "capture_id").select("*", _ref())


def reference_history(t: Tables) -> DataFrame:
    c = t.capture.where(F.col("status").isin(*COMPLETE)).select("capture_id", "source_package_id", "acquisition_ordinal", F.col("status").alias("capture_status"))
    return t.reference.join(c, "capture_id").select("*", _ref())


def notices(t: Tables) -> DataFrame:
    """Notices of published captures: one row for each notice and package."""
    c = t.published.select("capture_id").join(t.capture.select("capture_id", "source_package_id", "acquisition_ordinal", "coverage_verified", "acquired_at", "published_at"), "capture_id")
    return t.notice.join(c, "capture_id").select("*", _ref())


def attempts(t: Tables) -> DataFrame:
    """Attempts with the package and ordinal of their captures."""
    return t.attempt.join(t.capture.select("capture_id", "source_package_id", "acquisition_ordinal"), "capture_id")


def runs(t: Tables) -> DataFrame:
    """Runs with what is known of their captures and attempts."""
    c = t.capture.select("capture_id", "acquisition_ordinal", F.col("status").alias("capture_status"))
    a = t.attempt.select(F.col("attempt_id").alias("verification_attempt_id"), F.col("state").alias("verification_state"))
    return t.run.join(c, "capture_id", "left").join(a, "verification_attempt_id", "left")


def distinct_notices(t: Tables) -> DataFrame:
    """One row for each published identity, of its newest acquisition."""
    return latest_per_key(notices(t), ["publication_year", "publication_number"], [F.desc("acquisition_ordinal"), F.desc("capture_id")])


def capture_status(t: Tables) -> DataFrame:
    return t.capture.join(t.published.select("capture_id", F.lit(True).alias("_p")), "capture_id", "left").select(t.capture["*"], F.col("_p").isNotNull().alias("is_published"))


def package_status(t: Tables) -> DataFrame:
    """One row for each known package, with whether its checkpoint still holds; anything unknown means that it doesn't."""
    ids = t.capture.select("source_package_id").union(t.run.select("source_package_id")).union(t.checkpoint.select("source_package_id")).distinct()
    cp = t.checkpoint.select("source_package_id", *[F.col(c).alias(f"cp_{c}") for c in t.checkpoint.columns if c != "source_package_id"])
    pub = t.published.select("source_package_id", F.col("capture_id").alias("published_capture_id"))
    cap = t.capture.select(F.col("capture_id").alias("published_capture_id"), *[F.col(c).alias(f"cap_{c}") for c in ("status", "coverage_verified", "artifact_sha256", "contract_version", "member_count", "distinct_notice_count", "loaded_row_count")])
    run = t.run.select(F.col("run_id").alias("cp_run_id"), *[F.col(c).alias(f"run_{c}") for c in ("phase", "source_package_id", "capture_id", "verification_attempt_id", "artifact_sha256")])
    last = t.attempt.select(F.col("capture_id").alias("published_capture_id"), F.col("attempt_id").alias("latest_attempt_id"), F.col("state").alias("latest_verification_state"), F.col("artifact_sha256").alias("latest_sha"), F.col("contract_version").alias("latest_contract"))
    going = t.run.where(~F.col("phase").isin(*OPEN)).select("source_package_id", F.col("run_id").alias("open_run_id"), F.col("phase").alias("open_run_phase"), F.col("started_at").alias("open_run_started_at"), F.col("last_error").alias("open_run_last_error"))
    df = ids.join(cp, "source_package_id", "left").join(pub, "source_package_id", "left").join(cap, "published_capture_id", "left").join(run, "cp_run_id", "left")
    df = join_latest(join_latest(df, last, "published_capture_id", "latest_attempt_id"), going, "source_package_id", "open_run_id")
    same = [
        ("cp_capture_id", "published_capture_id"), ("cap_artifact_sha256", "cp_artifact_sha256"), ("cap_contract_version", "cp_contract_version"), ("cap_member_count", "cp_notice_count"),
        ("cap_distinct_notice_count", "cp_notice_count"), ("cap_loaded_row_count", "cp_notice_count"), ("run_source_package_id", "source_package_id"), ("run_capture_id", "cp_capture_id"),
        ("run_verification_attempt_id", "cp_verification_attempt_id"), ("run_artifact_sha256", "cp_artifact_sha256"), ("latest_attempt_id", "cp_verification_attempt_id"), ("latest_sha", "cp_artifact_sha256"), ("latest_contract", "cp_contract_version"),
    ]
    holds = (F.col("cap_status") == "published") & F.col("cap_coverage_verified") & (F.col("run_phase") == "completed") & (F.col("latest_verification_state") == "verified")
    for a, b in same:
        holds &= F.col(a) == F.col(b)
    return df.select(
        "source_package_id", F.col("cp_run_id").isNotNull().alias("has_checkpoint"), F.col("cp_run_id").alias("checkpoint_run_id"), F.col("cp_capture_id").alias("checkpoint_capture_id"), F.col("cp_verification_attempt_id").alias("checkpoint_attempt_id"),
        F.col("cp_artifact_sha256").alias("checkpoint_artifact_sha256"), F.col("cp_sealed_at").alias("checkpoint_sealed_at"), F.col("cp_contract_version").alias("checkpoint_contract_version"), F.col("cp_notice_count").alias("checkpoint_notice_count"), "published_capture_id",
        F.coalesce(F.col("cp_capture_id") == F.col("published_capture_id"), F.lit(False)).alias("capture_still_published"), F.coalesce("cap_coverage_verified", F.lit(False)).alias("coverage_verified"),
        "latest_attempt_id", "latest_verification_state", F.coalesce(holds, F.lit(False)).alias("checkpoint_is_current"), "open_run_id", "open_run_phase", "open_run_started_at", "open_run_last_error",
    )
