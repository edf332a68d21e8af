"""Transitions of a durable queue as expressions over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions.values import name_uuid
from lodeweave.operators.merge import insert_ignore


def claim(jobs: DataFrame, now: Column, until: Column, owner: str, limit: int) -> DataFrame:
    """jobs after the first ``limit`` claimable ones are leased: pending, or leased and expired, and due; by priority, then age.

    Only the claimed keys, at most ``limit``, are brought together.
    """
    due = ((F.col("status") == "pending") | (F.col("status") == "leased") & (F.col("leased_until") < now)) & (F.col("available_at") <= now)
    taken = jobs.where(due).orderBy(F.desc("priority"), "available_at", "created_at", "job_id").limit(limit).select("job_id", F.lit(True).alias("__taken"))
    mine = F.coalesce("__taken", F.lit(False))
    return jobs.join(F.broadcast(taken), "job_id", "left").select(*[
        F.when(mine, v).otherwise(F.col(c)).alias(c) if (v := {"status": F.lit("leased"), "leased_until": until, "owner": F.lit(owner), "attempts": F.col("attempts") + 1}.get(c)) is not None else F.col(c) for c in jobs.columns
    ])


def fail(jobs: DataFrame, failed: Column, now: Column) -> DataFrame:
    """jobs after the failed ones go back with a delay that doubles with each attempt, up to 300 seconds, or are dead after their last."""
    dead = F.col("attempts") >= F.col("max_attempts")
    delay = F.least(F.pow(F.lit(2.0), F.col("attempts") - 1), F.lit(300.0)).cast("int")
    return jobs.withColumns({
        "status": F.when(failed, F.when(dead, "dead").otherwise("pending")).otherwise(F.col("status")),
        "available_at": F.when(failed & ~dead, F.timestamp_seconds(F.unix_timestamp(now) + delay)).otherwise(F.col("available_at")),
    })


def enqueue(outbox: DataFrame, wanted: DataFrame, namespace: str, now: Column) -> DataFrame:
    """outbox with the wanted jobs (job_type, idempotency_key, payload, priority, max_attempts) that it doesn't have; a job wanted twice comes in once.

    A job's id follows from its type and key, so that replaying a batch adds nothing.
    """
    made = {"job_id": name_uuid(namespace, F.concat_ws(":", "job_type", "idempotency_key")), "status": F.lit("pending"), "attempts": F.lit(0), "available_at": now, "created_at": now}
    fresh = wanted.withColumns(made)
    absent = {c: F.lit(None).cast(outbox.schema[c].dataType) for c in outbox.columns if c not in fresh.columns}
    rows = fresh.withColumns(absent).select(*[F.col(c).cast(outbox.schema[c].dataType).alias(c) for c in outbox.columns])
    return insert_ignore(outbox, rows, ["job_id"], -F.col("priority"))


def seed(outbox: DataFrame, history: DataFrame, done: DataFrame, job_type: str, key: str, namespace: str, now: Column) -> DataFrame:
    """outbox with one job for every key of history that isn't done and was never enqueued."""
    open_ones = history.select(key).distinct().join(done.select(key), key, "left_anti")
    jobs = open_ones.select(F.lit(job_type).alias("job_type"), F.col(key).alias("idempotency_key"), F.to_json(F.struct(key)).alias("payload"), F.lit(0).alias("priority"), F.lit(5).alias("max_attempts"))
    return enqueue(outbox, jobs, namespace, now)


def cursor_choice(checkpoints: DataFrame, fingerprint: Column, now: Column, most_hours: int = 144, back_hours: int = 24) -> DataFrame:
    """checkpoints (since_id, query_fingerprint, updated_at) with where to read on from: since, or start and the reason why not since.

    A checkpoint counts if it is of the same query and not too old.
    """
    known, same = F.coalesce(F.col("since_id") != "", F.lit(False)), F.coalesce(F.col("query_fingerprint") == fingerprint, F.lit(False))
    fresh = F.coalesce(F.col("updated_at") >= now - F.make_interval(hours=F.lit(most_hours)), F.lit(False))
    good = known & same & fresh
    return checkpoints.withColumns({
        "since": F.when(good, F.col("since_id")), "start": F.when(~good, now - F.make_interval(hours=F.lit(back_hours))),
        "reason": F.when(good, F.lit(None)).when(known & ~same, "query_changed").when(known, "checkpoint_stale_or_legacy").otherwise("checkpoint_missing"),
    })
