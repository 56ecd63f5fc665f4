"""Constraints as DataFrames of the rows that break them; a commit asserts that they are empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capturebase.functions.columns import is_true


SHOWN = 20  # entries of a sample


def _violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row for each broken rule; a rule that comes out unknown is broken."""
    broken = F.filter(F.array(*(F.when(~is_true(ok), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    return df.select(*key, F.explode(broken).alias("violation"))


def duplicate_identities(notice: DataFrame) -> DataFrame:
    return notice.groupBy("capture_id", "publication_year", "publication_number").agg(F.count("*").alias("n")).where("n > 1")


def attempt_violations(attempt: DataFrame) -> DataFrame:
    c = F.col
    ended = c("finished_at").isNotNull() == (c("state") != "in_progress")
    equal = (c("announced_total") == c("api_distinct_count")) & (c("api_distinct_count") == c("local_distinct_count")) & (c("only_local_count") == 0) & (c("only_api_count") == 0) & (c("announced_total") > 0) & c("api_keys_sha256").isNotNull()
    nothing = (c("announced_total") == 0) & (c("local_distinct_count") == 0)
    rules = {f"more than {SHOWN} in {k}": F.coalesce(F.size(k), F.lit(0)) <= SHOWN for k in ("only_local_sample", "only_api_sample") if k in attempt.columns}
    return _violations(attempt, ["attempt_id"], rules | {"finish time": ended, "verified without equal counts": (c("state") != "verified") | is_true(equal), "empty with counts": (c("state") != "empty_unconfirmed") | is_true(nothing)})


def run_violations(run: DataFrame) -> DataFrame:
    c = F.col
    reason = c("last_error").isNotNull() if "last_error" in run.columns else F.lit(False)
    return _violations(run, ["run_id"], {"completed without a time": (c("phase") == "completed") == c("completed_at").isNotNull(), "failed without a reason": (c("phase") != "failed") | reason})


def capture_violations(capture: DataFrame) -> DataFrame:
    c = F.col
    return _violations(capture, ["capture_id"], {"status": c("status").isin("acquiring", "loading", "loaded", "published", "superseded", "failed"), "counts": (c("member_count") >= 0) & (c("distinct_notice_count") >= 0) & (c("loaded_row_count") >= 0)})


def blank_references(reference: DataFrame) -> DataFrame:
    return reference.where(~is_true(F.trim("value") != ""))
