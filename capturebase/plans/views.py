"""The read surfaces as named views, for SQL text with named parameters: ``sql(spark, tables, "... where acquisition_ordinal <= :cutoff", cutoff=5)``.

Only these names are registered: what is unpublished or partial can't be reached through them. Catalyst expands a view into the query, so
filters and columns reach the scan below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturebase.operators.relational import join_latest

from . import surfaces
from .surfaces import Tables

# The columns of each view, in order.
_OBSERVED = "publication_ref string, publication_year int, publication_number long, source_format string, schema_version string, notice_version string, publication_date date, publication_date_raw string, dispatch_date date, dispatch_date_raw string, buyer_country string, buyer_country_iso string, buyer_country_status string, primary_cpv string, primary_cpv_status string, additional_cpv array<string>"
COLUMNS = {
    "notice": f"source_package_id string, capture_id long, acquisition_ordinal long, {_OBSERVED}, source_coverage_verified boolean, published_at timestamp, change_reference_status string",
    "distinct_notice": f"source_package_id string, capture_id long, acquisition_ordinal long, {_OBSERVED}, source_coverage_verified boolean, published_at timestamp, change_reference_status string",
    "notice_history": f"source_package_id string, capture_id long, acquisition_ordinal long, capture_status string, contract_version string, {_OBSERVED}, change_reference_status string, source_coverage_verified boolean, acquired_at timestamp, published_at timestamp",
    "notice_change_reference_history": "source_package_id string, capture_id long, acquisition_ordinal long, capture_status string, publication_ref string, publication_year int, publication_number long, ordinal int, value string, scheme_name string",
    "capture_status": "source_package_id string, capture_id long, acquisition_ordinal long, status string, is_published boolean, artifact_sha256 string, artifact_bytes long, contract_version string, member_count long, distinct_notice_count long, loaded_row_count long, source_coverage_verified boolean, failure_reason string, acquired_at timestamp, published_at timestamp, batch_size long, verification_attempt_id long, verification_state string, verification_started_at timestamp, verification_finished_at timestamp",
    "verification_attempt": "attempt_id long, capture_id long, source_package_id string, acquisition_ordinal long, state string, reason string, started_at timestamp, finished_at timestamp, query_text string, query_scope string, verifier_version string, artifact_sha256 string, contract_version string, announced_total long, api_record_count long, api_distinct_count long, api_duplicate_count long, local_distinct_count long, only_local_count long, only_api_count long, only_local_sample array<string>, only_api_sample array<string>, pages_fetched long, http_attempts long, api_keys_sha256 string, key_digest_recipe string",
    "ingest_run": "run_id long, source_package_id string, attempt_ordinal long, phase string, artifact_path string, artifact_sha256 string, artifact_bytes long, capture_id long, acquisition_ordinal long, capture_status string, verification_attempt_id long, verification_state string, last_error string, started_at timestamp, updated_at timestamp, completed_at timestamp",
    "package_ingest_status": "source_package_id string, has_checkpoint boolean, checkpoint_run_id long, checkpoint_capture_id long, checkpoint_attempt_id long, checkpoint_artifact_sha256 string, checkpoint_notice_count long, checkpoint_sealed_at timestamp, published_capture_id long, capture_still_published boolean, coverage_verified boolean, latest_attempt_id long, latest_verification_state string, checkpoint_is_current boolean, open_run_id long, open_run_phase string, open_run_started_at timestamp, open_run_last_error string, checkpoint_contract_version string, published_contract_version string",
}


def _shaped(df: DataFrame, name: str) -> DataFrame:
    """The view's columns in their types; null where the tables don't have them."""
    wanted = [c.split(" ") for c in COLUMNS[name].split(", ")]
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in wanted])


def _picked(df: DataFrame, **names: str) -> DataFrame:
    """Columns under new names, without those that the table doesn't have."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items() if old in df.columns])


def views(t: Tables) -> dict[str, DataFrame]:
    covered = lambda df: df.withColumnRenamed("coverage_verified", "source_coverage_verified")
    last = _picked(t.attempt, capture_id="capture_id", verification_attempt_id="attempt_id", verification_state="state", verification_started_at="started_at", verification_finished_at="finished_at")
    status = surfaces.package_status(t).join(_picked(t.capture, published_capture_id="capture_id", published_contract_version="contract_version"), "published_capture_id", "left")
    out = {
        "notice": covered(surfaces.notices(t)),
        "distinct_notice": covered(surfaces.distinct_notices(t)),
        "notice_history": covered(surfaces.history(t)),
        "notice_change_reference_history": surfaces.reference_history(t),
        "capture_status": covered(join_latest(surfaces.capture_status(t), last, "capture_id", "verification_attempt_id")),
        "verification_attempt": surfaces.attempts(t),
        "ingest_run": surfaces.runs(t),
        "package_ingest_status": status,
    }
    return {name: _shaped(df, name) for name, df in out.items()}


def register(t: Tables) -> None:
    """Temporary views of the session, under their names."""
    for name, df in views(t).items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, t: Tables, text: str, **parameters: object) -> DataFrame:
    """A query over the views; parameters are bound as values, never pasted into the text."""
    register(t)
    return spark.sql(text, args=parameters or None)
