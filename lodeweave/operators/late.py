"""Totals per period of event time, corrected as late records arrive, up to a cut-off.

The state of a key's period is ordered by event time: short slots, and after
every few slots a checkpoint of the running state. What arrives in time is
laid down first and gives the first result. Each later arrival restores the
checkpoint before its slot, is put into the sorted log, and the suffix is
replayed from there; the outputs after it are replaced. What arrives after
the cut-off is only counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE = 60_000_000


@dataclass(frozen=True)
class Lateness:
    """Times in microseconds. A period's first result is due ``grace`` after its end; corrections are taken until ``cut_off`` after it."""

    period: int = 60 * MINUTE
    grace: int = 10 * MINUTE
    cut_off: int = 24 * 60 * MINUTE
    slot: int = MINUTE
    #: Slots between two checkpoints.
    stride: int = 8
    #: Arrivals within one tick are one correction.
    tick: int = MINUTE


class Ledger:
    """The ordered state of one period: a sorted log of slots, and the running state after every ``stride`` slots."""

    def __init__(self, slots: int, stride: int):
        self.stride = stride
        self.log: list[tuple | None] = [None] * slots
        self.marks: list[tuple] = [(0, Decimal(0), Decimal(0))]
        self.replayed = 0

    def put(self, slot: int, n: int, size: Decimal, worth: Decimal) -> None:
        """Put a record into the sorted log."""
        had = self.log[slot]
        self.log[slot] = (n, size, worth) if had is None else (had[0] + n, had[1] + size, had[2] + worth)

    def replay(self, slot: int) -> None:
        """Restore the last checkpoint before the slot and run the suffix again, with a new checkpoint after every stride."""
        first = min(slot // self.stride, len(self.marks) - 1)
        del self.marks[first + 1 :]
        state = self.marks[first]
        for start in range(first * self.stride, len(self.log), self.stride):
            for held in self.log[start : start + self.stride]:
                if held is not None:
                    state = (state[0] + held[0], state[1] + held[1], state[2] + held[2])
                    self.replayed += 1
            self.marks.append(state)

    def dump(self) -> dict:
        """The log and the checkpoints, as plain values."""
        return {"log": {i: (x[0], str(x[1]), str(x[2])) for i, x in enumerate(self.log) if x}, "marks": [(n, str(s), str(w)) for n, s, w in self.marks]}

    @classmethod
    def load(cls, held: dict, slots: int, stride: int) -> Ledger:
        """The ledger as it was dumped; nothing is replayed."""
        out, exact = cls(slots, stride), lambda x: (x[0], Decimal(x[1]), Decimal(x[2]))
        for slot, x in held["log"].items():
            out.log[int(slot)] = exact(x)
        out.marks = [exact(x) for x in held["marks"]]
        return out

    @property
    def total(self) -> tuple:
        return self.marks[-1]

    def half(self) -> int | None:
        """The first slot by whose end at least half of the size is reached; None without size."""
        whole = self.total[1]
        if whole <= 0:
            return None
        after = next(i for i, m in enumerate(self.marks) if 2 * m[1] >= whole)
        state = self.marks[after - 1][1]
        for slot in range((after - 1) * self.stride, min(after * self.stride, len(self.log))):
            held = self.log[slot]
            state += held[1] if held else 0
            if 2 * state >= whole:
                return slot
        return None


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """The rows of each group, which come one after another; a group may go on in the next batch."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if rows and row[:width] != rows[-1][:width]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _settle(rows: list[tuple], width: int, slots: int, stride: int, every: bool) -> Iterator[tuple]:
    """Rows of one period, in order of arrival: (*keys, period, tick, slot, cut, n, size, worth)."""
    ledger, revision, tick, cut, laid = Ledger(slots, stride), 0, None, 0, False
    for row in rows:
        now, slot, late, n, size, worth = row[width:]
        if late:
            cut += n
            continue
        if now != tick and now > 0:  # the correction before this one is complete
            if not laid:
                ledger.replay(0)
                laid = True
            elif every:
                yield (*rows[0][:width], revision, *ledger.total, ledger.half(), 0, ledger.replayed)
            if not revision and every:
                yield (*rows[0][:width], 0, *ledger.total, ledger.half(), 0, ledger.replayed)
            revision += 1
        tick = now
        ledger.put(slot, n, size, worth)
        if now > 0:
            ledger.replay(slot)
    if not laid:
        ledger.replay(0)
    yield (*rows[0][:width], revision, *ledger.total, ledger.half(), cut, ledger.replayed)


def period_totals(df: DataFrame, keys: Sequence[str], event_us: str, arrival_us: str, size: Column, worth: Column, rule: Lateness = Lateness(), every: bool = False) -> DataFrame:
    """keys, period_us (its start), revision, n, size, worth, half_slot, n_cut_off, n_replayed.

    One row per key and period: the totals after the last correction, how many
    corrections there were, and how many records came after the cut-off and
    are not in the totals. With ``every``, one row for each result in turn,
    n_cut_off being on the last. half_slot is the slot of the period by which
    half of the size was reached.

    Rows without key, event time or arrival are left out; a null size or worth
    counts as 0. One record may have only one row; df's other columns are
    ignored. A busy period is bounded before it reaches a task: equal slots and
    arrivals are summed up on the map side, so that a period has at most
    slots * ticks rows, however many records it has.
    """
    event, arrival = F.col(event_us), F.col(arrival_us)
    start = (F.floor(event / F.lit(rule.period)) * rule.period).cast("long")
    end = F.col("period_us") + rule.period
    known = event.isNotNull() & arrival.isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    placed = df.where(known).select(*keys, start.alias("period_us"), event.alias("__e"), arrival.alias("__a"), F.coalesce(size, F.lit(0)).cast("decimal(18,8)").alias("__s"), F.coalesce(worth, F.lit(0)).cast("decimal(37,16)").alias("__w"))
    late = F.col("__a") > end + rule.cut_off
    tick = F.when(late | (F.col("__a") <= end + rule.grace), F.lit(0)).otherwise(F.floor((F.col("__a") - end) / F.lit(rule.tick)) + 1).cast("long")
    slot = F.when(late, F.lit(0)).otherwise(F.floor((F.col("__e") - F.col("period_us")) / F.lit(rule.slot))).cast("int")
    summed = (
        placed.groupBy(*keys, "period_us", tick.alias("__tick"), slot.alias("__slot"), late.cast("int").alias("__late"))
        .agg(F.count(F.lit(1)).alias("__n"), F.sum("__s").cast("decimal(38,8)").alias("__size"), F.sum("__w").cast("decimal(38,16)").alias("__worth"))
    )
    width, slots, stride = len(keys) + 1, -(-rule.period // rule.slot), rule.stride
    fields = [summed.schema[k] for k in [*keys, "period_us"]]
    out = T.StructType([*fields, T.StructField("revision", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("size", T.DecimalType(38, 8)), T.StructField("worth", T.DecimalType(38, 16)), T.StructField("half_slot", T.IntegerType()), T.StructField("n_cut_off", T.LongType()), T.StructField("n_replayed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, done = to_arrow_schema(out), []
        for rows in _runs(batches, width):
            done.extend(_settle(rows, width, slots, stride, every))
            if len(done) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    ordered = summed.repartition(*keys, "period_us").sortWithinPartitions(*keys, "period_us", "__late", "__tick", "__slot")
    return ordered.select(*keys, "period_us", "__tick", "__slot", "__late", "__n", "__size", "__worth").mapInArrow(run, out)


def first_arrivals(records: DataFrame, record: str, run: str, runs: DataFrame, run_key: str, arrived_us: str, carried: Sequence[str]) -> DataFrame:
    """One row per record: the earliest arrival of its rows in ``arrived_us``, and the carried columns.

    ``runs`` tells when each run arrived; repeated rows of a run count once,
    with the earliest time. Rows of a run that never arrived don't count. A
    record's rows are the same but for their run, so its carried columns are
    part of the grouping.
    """
    times = runs.groupBy(F.col(run_key).alias("__run")).agg(F.min(arrived_us).alias(arrived_us))
    joined = records.join(times, records[run] == F.col("__run")).where(F.col(arrived_us).isNotNull())
    return joined.groupBy(record, *carried).agg(F.min(arrived_us).alias(arrived_us))
