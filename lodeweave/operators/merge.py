"""Upsert policies as pure functions of the stored and the incoming table.

Every policy is a union and an aggregate, or an anti-join, so that it works on
plain parquet tables and gives the same result when a batch is replayed. In
streams the functions are called in foreachBatch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.operators.skew import prior_values


def _ranked(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both tables, where ``__new`` orders the incoming rows behind the stored."""
    return stored.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))


def insert_ignore(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The first row of each key stays; of several new rows of a key the least by ``order`` comes in."""
    fresh = incoming.join(stored.select(*keys), list(keys), "left_anti")
    rest = [c for c in stored.columns if c not in keys]
    first = fresh.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")
    return stored.unionByName(first.select(*stored.columns))


def last_writer(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Column, fixed: Sequence[str] = ()) -> DataFrame:
    """The last row written of each key; columns in ``fixed`` keep the value first written."""
    rest = [c for c in stored.columns if c not in keys and c not in fixed]
    when = F.struct(F.col("__new"), order.alias("o"))
    both = _ranked(stored, incoming)
    kept = [F.max_by(F.struct(*rest), when).alias("__r"), *([F.min_by(F.struct(*fixed), when).alias("__f")] if fixed else [])]
    shown = [*keys, "__r.*", *(["__f.*"] if fixed else [])]
    return both.groupBy(*keys).agg(*kept).select(*shown).select(*stored.columns)


def newest_wins(rows: DataFrame, keys: Sequence[str], observed: str, first: str | None = None, ties: Sequence[Column] = ()) -> DataFrame:
    """The row of each key observed last; ``first`` becomes the earliest of all its rows. At equal times the last by ``ties``."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(observed), *[t.alias(f"x{i}") for i, t in enumerate(ties)]))
    picked = rows.groupBy(*keys).agg(newest.alias("__r"), *([F.min(first).alias("__f")] if first else []))
    shown = [F.col("__f").alias(c) if c == first else F.col(f"__r.{c}").alias(c) for c in rest]
    return picked.select(*keys, *shown).select(*rows.columns)


def append_versions(observed: DataFrame, keys: Sequence[str], at_us: str, digest: str) -> DataFrame:
    """The observations whose digest differs from the one before; a state that returns later is a version again.

    Several observations at one time count once, with the greatest digest.
    """
    once = observed.groupBy(*keys, at_us).agg(F.max(digest).alias(digest))
    prior = prior_values(once, keys, at_us, {"__b": F.struct(F.col(digest).alias("v"))})
    return prior.where(F.col("__b").isNull() | ~F.col(digest).eqNullSafe(F.col("__b.v"))).select(*keys, at_us, digest)


def guarded_upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], guard: Column) -> DataFrame:
    """Incoming rows replace stored ones for which ``guard`` holds, and come in where there are none; ``guard`` is over the stored columns."""
    rest = [c for c in stored.columns if c not in keys]
    old = stored.select(*keys, F.struct(*rest).alias("__o"), F.coalesce(guard, F.lit(False)).alias("__may"))
    new = incoming.select(*keys, F.struct(*rest).alias("__i"))
    chosen = F.when(F.col("__o").isNull(), F.col("__i")).when(F.col("__i").isNotNull() & F.col("__may"), F.col("__i")).otherwise(F.col("__o"))
    return old.join(new, list(keys), "full").select(*keys, chosen.alias("__r")).select(*keys, "__r.*").select(*stored.columns)


def close_and_reopen(stored: DataFrame, present: DataFrame, keys: Sequence[str], valid_to: str, now: Column) -> DataFrame:
    """Closes stored rows whose key is no longer present, opens those that are, and adds new ones."""
    here = present.select(*keys).distinct().withColumn("__here", F.lit(True))
    marked = stored.join(here, list(keys), "left")
    closed = F.when(F.col("__here"), F.lit(None)).otherwise(F.coalesce(F.col(valid_to), now)).cast(stored.schema[valid_to].dataType)
    kept = marked.withColumn(valid_to, closed).select(*stored.columns)
    fresh = present.join(stored.select(*keys), list(keys), "left_anti").withColumn(valid_to, F.lit(None).cast(stored.schema[valid_to].dataType))
    return kept.unionByName(fresh.select(*stored.columns))


def refresh(stored: DataFrame, computed: DataFrame, keys: Sequence[str], kept: str) -> DataFrame:
    """The computed table; ``kept`` stays as stored where the key was there, and keys not computed again are gone."""
    before = stored.select(*keys, F.col(kept).alias("__k"))
    return computed.join(before, list(keys), "left").withColumn(kept, F.coalesce("__k", kept)).select(*computed.columns)


def replace_children(stored: DataFrame, incoming: DataFrame, parent: Sequence[str]) -> DataFrame:
    """All children of an incoming parent are replaced by the incoming ones."""
    return stored.join(incoming.select(*parent).distinct(), list(parent), "left_anti").unionByName(incoming.select(*stored.columns))


def advance(cursors: DataFrame, polled: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Checkpoints that only move forward; at equal times the incoming one counts."""
    return newest_wins(_ranked(cursors, polled), keys, at, ties=[F.col("__new")]).select(*cursors.columns)


def last_poll(cursors: DataFrame, polled: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Checkpoints as polled, also where they move back; of several polls of a key the last by ``at``. See advance() for those that may not."""
    newest = newest_wins(polled, keys, at)
    return cursors.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest.select(*cursors.columns))


def checkpoint(cursors: DataFrame, **key: object) -> dict | None:
    """The one checkpoint of a key; None where there is none."""
    found = reduce(lambda df, item: df.where(F.col(item[0]).eqNullSafe(F.lit(item[1]))), key.items(), cursors).limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"several checkpoints of {key}")
    return found[0].asDict() if found else None


def keyed_update(stored: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with the non-null values of the updates' other columns; keys not stored are ignored."""
    changed = [c for c in updates.columns if c not in keys]
    new = updates.select(*keys, *[F.col(c).alias(f"__u_{c}") for c in changed])
    return stored.join(new, list(keys), "left").select(*[F.coalesce(f"__u_{c}", c).alias(c) if c in changed else F.col(c) for c in stored.columns])


def missing_since(seen: DataFrame, cycles: DataFrame, keys: Sequence[str], cycle: str) -> DataFrame:
    """keys, missing_since: the first complete cycle after a key was last seen; null while it is there.

    ``seen``: keys and cycle in which they were seen. ``cycles``: the complete cycles.
    """
    last = seen.groupBy(*keys).agg(F.max(cycle).alias("__last"))
    spans = cycles.select(F.col(cycle).alias("__c")).distinct()
    ordered = prior_values(spans.withColumn("__all", F.lit(1)).withColumn("__u", F.unix_micros(F.col("__c").cast("timestamp"))), ["__all"], "__u", {"__p": F.col("__c")})
    return last.join(ordered.select(F.col("__p"), F.col("__c").alias("missing_since")), F.col("__last") == F.col("__p"), "left").select(*keys, "missing_since")
