"""State of ingest items: status events folded into the queue, and the retry schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the retry policy
MAX_ATTEMPTS = 3
RETRY_MIN_SECONDS = 4
RETRY_MAX_SECONDS = 10


def fold_status_events(events: DataFrame) -> DataFrame:
    """``(ingest_id, status, last_error, errors)`` after all events ``(ingest_id, ord, status, error)``.

    The last event gives the status; an empty error neither counts nor replaces the last one.
    """
    failed = F.col("error").isNotNull() & (F.col("error") != "")
    return events.groupBy("ingest_id").agg(
        F.max_by("status", "ord").alias("status"),
        F.max_by("error", F.when(failed, F.col("ord"))).alias("last_error"),
        F.count_if(failed).alias("errors"),
    )


def apply_status_events(queue: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """The queue after the events; events of unknown items change nothing."""
    changes = fold_status_events(events).select(
        F.col("ingest_id").alias("_id"), F.col("status").alias("_status"),
        F.col("last_error").alias("_error"), F.col("errors").alias("_errors"),
    )
    joined = queue.join(changes, F.col("ingest_id") == F.col("_id"), "left")
    changed = F.col("_id").isNotNull()
    next_values = {
        "status": F.when(changed, F.col("_status")).otherwise(F.col("status")),
        "retries": (F.col("retries") + F.coalesce("_errors", F.lit(0))).cast("int"),
        "last_error": F.coalesce("_error", "last_error"),
        "updated_at": F.when(changed, as_of).otherwise(F.col("updated_at")),
    }
    return joined.select(*[next_values[c].alias(c) if c in next_values else F.col(c) for c in queue.columns])


def retry_wait(attempt: Column) -> Column:
    """Seconds to wait after the given attempt: doubling, within the fixed bounds."""
    return F.least(F.lit(RETRY_MAX_SECONDS), F.greatest(F.lit(RETRY_MIN_SECONDS), F.pow(F.lit(2), attempt - 1))).cast("int")


def retry_schedule(attempts: DataFrame, key: str = "pdf_url", at: str = "at") -> DataFrame:
    """``(key, attempts, last_at, next_at)`` of items that have not succeeded.

    ``attempts`` has the key, ``ok`` and the time. ``next_at`` is NULL once the attempts are used up.
    """
    state = attempts.groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"), F.max(at).alias("last_at"), F.bool_or("ok").alias("done")
    )
    wait = F.make_dt_interval(secs=retry_wait(F.col("attempts")).cast("decimal(18,6)"))
    next_at = F.when(F.col("attempts") < MAX_ATTEMPTS, F.col("last_at") + wait)
    return state.filter(~F.col("done")).select(key, "attempts", "last_at", next_at.alias("next_at"))


def accepted_fetches(fetch_log: DataFrame) -> DataFrame:
    """Fetched bodies that came with status 200, with their SHA-256 and size."""
    ok = fetch_log.filter(F.col("status") == 200)
    return ok.withColumn("sha256", F.sha2("content", 256)).withColumn("size", F.length("content").cast("bigint"))


def http_reason(status: Column) -> Column:
    return F.concat(F.lit("HTTP "), F.coalesce(status.cast("string"), F.lit("?")))


def rejected_fetches(fetch_log: DataFrame) -> DataFrame:
    """``(stage, key, reason)`` of the other ones."""
    failed = fetch_log.filter(F.col("status").isNull() | (F.col("status") != 200))
    reason = http_reason(F.col("status")).alias("reason")
    return failed.select(F.lit("download").alias("stage"), F.col("pdf_url").alias("key"), reason)
