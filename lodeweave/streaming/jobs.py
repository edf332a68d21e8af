"""Structured Streaming jobs over landed files.

Every job takes a streaming DataFrame and gives the rows of its batch operator
once all input is read. Sinks write with foreachBatch under the batch's
number, so that a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodeweave.operators.late import Lateness, Ledger
from lodeweave.operators.merge import insert_ignore, newest_wins
from lodeweave.session import SharedPath, discard, materialize


def file_stream(spark: SparkSession, path: str, like: DataFrame, files_per_batch: int = 1) -> DataFrame:
    """Parquet files under a path as a stream, with the columns of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(path)


def distinct_records(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; rows of one key may be apart by at most ``delay`` in ``time``, after which the key is forgotten."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def after_floor(stream: DataFrame, time: Column, last_cycle: Column, overlap: str) -> DataFrame:
    """Rows from the last cycle's start less an overlap on: reading a little twice rather than missing what came late."""
    return stream.where(time >= last_cycle - F.expr(f"interval {overlap}"))


def run_all(stream: DataFrame, folder: str, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> DataFrame | None:
    """Runs the stream over all that is there and returns its output; with ``each`` that writes the batches itself, nothing."""
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/checkpoint")
    if each is not None:
        writer.foreachBatch(each).start().awaitTermination()
        return None
    writer.format("parquet").option("path", f"{folder}/rows").start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


class KeyedState:
    """A table by key that a stream keeps up in the shared folder, whoever writes it and however often it is restarted.

    Keys are hashed to buckets, and a batch writes only the buckets that it
    touches, under its number: ``batch=N/bucket=B``. A batch counts once Spark
    has marked it as complete, and reads only batches before its own number,
    so that a batch which is repeated after a failure gives the same table.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], buckets: int = 16):
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, f"{folder}/state", schema, list(keys), buckets

    def batches(self, before: int | None = None) -> list[int]:
        """The complete batches, the newest first."""
        numbers = [int(n[6:]) for n in SharedPath(self.spark, self.folder).names() if n.startswith("batch=")]
        return sorted((n for n in numbers if (before is None or n < before) and SharedPath(self.spark, f"{self.folder}/batch={n}/_SUCCESS").exists()), reverse=True)

    def parts(self, before: int | None = None) -> dict[int, list[str]]:
        """The folders of each bucket, the newest first."""
        found: dict[int, list[str]] = {}
        for n in self.batches(before):
            for name in SharedPath(self.spark, f"{self.folder}/batch={n}").names():
                if name.startswith("bucket="):
                    found.setdefault(int(name[7:]), []).append(f"{self.folder}/batch={n}/{name}")
        return found

    def chosen(self, folders: list[str]) -> list[str]:
        """Which of a bucket's folders make up its rows: here the newest, which holds them all."""
        return folders[:1]

    def read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def table(self, before: int | None = None) -> DataFrame:
        """All rows, as of the newest batch or of the one before a number."""
        return self.read([p for folders in self.parts(before).values() for p in self.chosen(folders)])

    def merged(self, held: DataFrame, batch: DataFrame) -> DataFrame:
        """What is written of the buckets touched, from their rows and the batch's."""
        raise NotImplementedError

    def merge(self, batch: DataFrame, number: int) -> None:
        """Merges a batch; repeating one gives the same table."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        # the batch is read twice, and may be a stateful operator's output: it is computed once
        rows = materialize(batch.select(*self.schema.names))
        touched = [r[0] for r in rows.select(bucket.alias("b")).distinct().collect()]
        parts = self.parts(number)
        held = self.read([p for b in touched for p in self.chosen(parts.get(b, []))])
        out = self.merged(held, rows).withColumn("bucket", bucket)
        out.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/batch={number}")
        discard(rows)
        self.tidy(number)

    def tidy(self, number: int) -> None:
        """Deletes what no batch from this one on reads: all but the newest two folders of each bucket."""
        for folders in self.parts().values():
            for path in folders[2:]:
                if int(path.split("batch=")[1].split("/")[0]) < number:
                    SharedPath(self.spark, path).delete(True)


class CurrentState(KeyedState):
    """The newest row of each key."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], observed: str, first: str | None = None, ties: Sequence[str] = (), buckets: int = 16):
        super().__init__(spark, folder, schema, keys, buckets)
        self.observed, self.first, self.ties = observed, first, list(ties)

    def merged(self, held: DataFrame, batch: DataFrame) -> DataFrame:
        return newest_wins(held.unionByName(batch), self.keys, self.observed, first=self.first, ties=[F.col(t) for t in self.ties])


class FirstRecords(KeyedState):
    """The first row of each key, however far apart its rows are: each batch adds the keys that no batch before it has."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], order: Column, buckets: int = 16):
        super().__init__(spark, folder, schema, keys, buckets)
        self.order = order

    def chosen(self, folders: list[str]) -> list[str]:
        return folders

    def merged(self, held: DataFrame, batch: DataFrame) -> DataFrame:
        fresh = batch.join(held.select(*self.keys), self.keys, "left_anti")
        return insert_ignore(self.spark.createDataFrame([], self.schema), fresh, self.keys, self.order)

    def tidy(self, number: int) -> None:
        """Every folder has rows of its own."""


class OnlyChanges:
    """Calls ``each`` for the batches whose digest differs from the one before; a batch without change only moves the poll time.

    Digests are kept in the shared folder under their batch's number, so that
    a restarted or repeated batch is held against the right one.
    """

    def __init__(self, spark: SparkSession, folder: str, digest: Column, each: Callable[[DataFrame, int], None]):
        self.spark, self.folder, self.digest, self.each, self.skipped = spark, f"{folder}/digests", digest, each, 0

    def last(self, before: int) -> str | None:
        """The digest of the newest batch before this number; null digests are told from none."""
        numbers = [int(n) for n in SharedPath(self.spark, self.folder).names() if n.isdigit() and int(n) < before]
        return SharedPath(self.spark, f"{self.folder}/{max(numbers)}").read() if numbers else None

    def __call__(self, batch: DataFrame, number: int) -> None:
        now = json.dumps(batch.agg(self.digest.alias("d")).first()["d"], default=str)
        if now == self.last(number):
            self.skipped += 1
        else:
            self.each(batch, number)
        SharedPath(self.spark, f"{self.folder}/{number}").write(now)
        for name in SharedPath(self.spark, self.folder).names():
            if name.isdigit() and int(name) < number - 1:
                SharedPath(self.spark, f"{self.folder}/{name}").delete()


def late_totals(stream: DataFrame, keys: Sequence[str], event: str, arrival: str, size: str, worth: str, rule: Lateness = Lateness()) -> DataFrame:
    """period_totals() as a stream in update mode: each output row replaces the one before of its keys and period.

    ``event`` and ``arrival`` are timestamps; the stream needs a watermark on
    ``arrival``. A period's ordered state is its log of slots with their
    checkpoints: the late records of a micro-batch are put into the log, the
    checkpoint before the first of them is restored, and the suffix replayed
    once (n_replayed counts the slots). Once the watermark is past the
    cut-off, only the period's total is kept, since later records can only be
    counted. That total of one row per keys and period stays, so that a record
    of any lateness is counted beside it. Spark itself drops records that are
    read later than the watermark's delay behind others' arrival.
    """
    start = (F.floor(F.unix_micros(event) / F.lit(rule.period)) * rule.period).cast("long")
    rows = stream.where(F.col(event).isNotNull() & F.col(arrival).isNotNull()).select(*keys, start.alias("period_us"), F.unix_micros(event).alias("e"), F.col(arrival).alias("a"), F.unix_micros(arrival).alias("a_us"), F.col(size).cast("string").alias("s"), F.col(worth).cast("string").alias("w"))
    out = T.StructType([*[stream.schema[k] for k in keys], T.StructField("period_us", T.LongType()), T.StructField("revision", T.LongType()), T.StructField("n", T.LongType()), T.StructField("size", T.StringType()), T.StructField("worth", T.StringType()), T.StructField("n_cut_off", T.LongType()), T.StructField("n_replayed", T.LongType())])
    slots, names = -(-rule.period // rule.slot), [*keys, "period_us"]

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[str, Any] = json.loads(state.get[0]) if state.exists else {"ledger": Ledger(slots, rule.stride).dump(), "revision": 0, "tick": 0, "cut": 0, "final": None}
        if state.hasTimedOut:
            n, s, w = Ledger.load(held["ledger"], slots, rule.stride).total
            state.update((json.dumps(held | {"ledger": None, "final": (n, str(s), str(w))}),))
            return
        end, replayed = int(key[-1]) + rule.period, 0
        batch = pd.concat(list(batches)).sort_values("a_us")
        late = batch["a_us"] > end + rule.cut_off
        held["cut"] += int(late.sum())
        if not held["final"]:
            ledger, first = Ledger.load(held["ledger"], slots, rule.stride), slots
            for row in batch[~late].itertuples():
                slot = int((row.e - key[-1]) // rule.slot)
                ledger.put(slot, 1, Decimal(row.s or 0), Decimal(row.w or 0))
                first = min(first, slot)
                tick = 0 if row.a_us <= end + rule.grace else int((row.a_us - end) // rule.tick) + 1
                if tick > held["tick"]:
                    held["revision"], held["tick"] = held["revision"] + 1, tick
            if first < slots:
                ledger.replay(first)
            replayed, held["ledger"] = ledger.replayed, ledger.dump()
            total = ledger.total
        n, s, w = held["final"] or total
        state.update((json.dumps(held),))
        if not held["final"]:
            state.setTimeoutTimestamp(max((end + rule.cut_off) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([[*key, held["revision"], n, str(s), str(w), held["cut"], replayed]], columns=out.names)

    return rows.groupBy(*names).applyInPandasWithState(fold, out, "held string", "update", GroupStateTimeout.EventTimeTimeout)
