"""Control-plane projections: tasks, closures, bounded lists, freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUBLISHED = (100, 199)
LIST_LIMIT = 200
#: Characters of a line in a log tail.
LOG_LINE = 4000


def published(rows: DataFrame) -> DataFrame:
    """Rows in a published state; the range reaches the scan."""
    return rows.where(F.col("state_code").between(*PUBLISHED))


def watermark(rows: DataFrame) -> DataFrame:
    """Count and newest change of the published rows."""
    return published(rows).agg(F.count("*").alias("published_count"), F.max("modified_at").alias("max_modified_at"))


def freshness(caches: DataFrame, current: DataFrame) -> DataFrame:
    """The state of every cache (cached_count, cached_max: its watermark, null without a manifest; expected_sha256, found_sha256) against the current watermark.

    missing without a manifest, invalid if the artifact's hash is not the manifest's, else fresh or stale.
    """
    same = F.col("cached_count").eqNullSafe(F.col("published_count")) & F.col("cached_max").eqNullSafe(F.col("max_modified_at"))
    intact = F.col("expected_sha256").eqNullSafe(F.col("found_sha256"))
    state = F.when(F.col("cached_count").isNull(), "missing").when(~intact, "invalid").when(same, "fresh").otherwise("stale")
    return caches.crossJoin(current).withColumn("state", state)  # one row of watermark


def bounded_list(rows: DataFrame, order: list, limit: int) -> DataFrame:
    """The first ``limit`` rows and one more, which tells that there are more."""
    if not 1 <= limit <= LIST_LIMIT:
        raise ValueError(f"limit {limit} is not between 1 and {LIST_LIMIT}")
    return rows.orderBy(*order).limit(limit + 1)


#: States of tasks that have ended; those whose diagnostics are worth reading; states of jobs that have ended.
TERMINAL = ("completed", "failed", "cancelled", "canceled", "blocked", "stale")
TROUBLED = ("failed", "blocked", "stale")
JOB_ENDED = ("succeeded", "failed", "cancelled", "interrupted")


def task_state(rows: DataFrame) -> DataFrame:
    """Whether a task has ended; its diagnostics are recommended if it ended badly or its result did not pass or is not valid."""
    status = F.coalesce(F.nullif(F.trim("worker_status"), F.lit("")), F.lit("unknown"))
    passed = F.trim("domain_status").eqNullSafe(F.lit("passed")) & F.trim("domain_validity").eqNullSafe(F.lit("valid"))
    return rows.withColumn("is_terminal", status.isin(*TERMINAL)).withColumn("diagnostics", status.isin(*TROUBLED) | ((status == "completed") & ~passed))


def closure_ready(rows: DataFrame) -> DataFrame:
    """Whether a closure can be calculated: passed, complete, valid, with a scope and a policy (blank ones count as none)."""
    given = [F.nullif(F.trim(c), F.lit("")).isNotNull() for c in ("scope_hash", "policy_fingerprint")]
    state = [F.trim(c).eqNullSafe(F.lit(x)) for c, x in (("run_status", "passed"), ("scan_completeness", "complete"), ("certificate_validity", "valid"))]
    return rows.withColumn("ready", state[0] & state[1] & state[2] & given[0] & given[1])


def job_state(state, alive, exit_code, has_process):
    """Reported state set right by what the process did: one that has not ended and whose process is gone has ended by its exit code, or was cancelled or interrupted."""
    gone = ~state.isin(*JOB_ENDED) & ~alive
    return F.when(~gone, state).when(exit_code == 0, "succeeded").when(exit_code.isNotNull(), "failed").when(state == "cancelling", "cancelled").when(has_process, "interrupted").otherwise(state)


def log_line(line):
    """A line of a log tail; a longer one is cut and ends in an ellipsis."""
    return F.when(F.length(line) <= LOG_LINE, line).otherwise(F.concat(F.substring(line, 1, LOG_LINE), F.lit("…")))
