"""The exception queue's life: refresh, transitions in batches, log and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The statuses in order and where each may lead.
STATUSES = ("New", "Under Review", "Analysis Required", "Approved", "Rejected", "Actioned Externally", "Closed")
NEXT = {
    "New": ("Under Review", "Analysis Required", "Rejected"), "Under Review": ("Analysis Required", "Approved", "Rejected"), "Analysis Required": ("Under Review", "Approved", "Rejected"),
    "Approved": ("Actioned Externally", "Closed"), "Rejected": ("Closed",), "Actioned Externally": ("Closed",), "Closed": (),
}


def refreshed(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Fresh exceptions, with the status of those that were in the queue; what is fresh no more goes."""
    known = existing.select("exception_id", F.col("status").alias("_status"))
    return fresh.join(known, "exception_id", "left").withColumn("status", F.coalesce("_status", F.lit("New"))).drop("_status")


def transitions(queue: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queue after, log) of requests (exception_id, new_status, reviewer_persona, reason, at), one for each exception.

    The log has a row for each request; those that can't be followed say why in `error` and change nothing.
    """
    allowed = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)).cast("array<string>") for kv in NEXT.items() for x in kv])
    log = requests.join(queue.select("exception_id", F.col("status").alias("previous_status")), "exception_id", "left")
    error = (
        F.when(~F.col("new_status").isin(*STATUSES), "unknown status").when(F.col("previous_status").isNull(), "unknown exception")
        .when(~F.array_contains(F.element_at(allowed, F.col("previous_status")), F.col("new_status")), "transition not allowed")
    )
    log = log.withColumn("error", error)
    action = F.replace(F.concat_ws("-", F.lit("ACT"), "exception_id", "previous_status", "new_status", F.date_format("at", "yyyyMMdd'T'HHmmss")), F.lit(" "), F.lit("_"))
    log = log.select(F.when(F.col("error").isNull(), action).alias("action_id"), "exception_id", "previous_status", "new_status", "reviewer_persona", "reason", "at", "error")
    done = log.where("error is null").select("exception_id", F.col("new_status").alias("_new"))
    after = queue.join(done, "exception_id", "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")
    return after, log


def append_log(log: DataFrame, path: str) -> None:
    """Q22: only adds."""
    log.where("error is null").drop("error").write.mode("append").parquet(path)


def status_counts(queue: DataFrame) -> DataFrame:
    """every status, also those without an exception, and the total."""
    all_ = queue.sparkSession.createDataFrame([(k, s) for k, s in enumerate(STATUSES)], "place int, status string")
    by = all_.join(queue.groupBy("status").agg(F.count("*").alias("n")), "status", "left").select("place", "status", F.coalesce("n", F.lit(0)).alias("exceptions"))
    total = queue.agg(F.count("*").alias("exceptions")).select(F.lit(len(STATUSES)).alias("place"), F.lit("total").alias("status"), "exceptions")
    return by.unionByName(total)
