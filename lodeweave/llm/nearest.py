"""Pairing records of two tables with the nearest in time of the same entity, within a tolerance.

Rows are hash-partitioned by entity and time block into Arrow groups. In each
group DuckDB runs an ASOF join backward and one forward, and the nearer of the
two candidates is kept if it is within the tolerance.

A block that is too large for one group, by whichever side, is cut into slots
of time. A slot needs of the others only the last time before it and the first
after it, so every slot gets these two times as further rows, and is a group
of its own: no row of either side is copied, however hot an entity is.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave.operators.skew import SMALL

#: Width of a block; a busy entity is spread over its blocks. At least twice the tolerance is used.
BLOCK_US = 3_600_000_000
#: Rows of both sides that one group should have; an absolute bound, which holds at any size.
GROUP_ROWS = 250_000
#: Slots that a block is cut into for each GROUP_ROWS of it, so that a burst within it still fits.
FINE = 4
#: Rows of the left that one DuckDB join takes at a time.
SLICE = 100_000

_connection = None


def _duck():
    """One connection per Python worker, with one thread, bounded memory and no folder to spill to."""
    global _connection
    if _connection is None:
        import duckdb

        _connection = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "512MB", "temp_directory": ""})
    return _connection


def asof_both_ways(left: pa.Table, right: pa.Table, keys: Sequence[str], left_us: str, right_us: str, tolerance_us: int) -> pa.Table:
    """left's rows with nearest_us and away_us, where there is a right row within the tolerance; of two equally near the earlier."""
    duck = _duck()
    same = lambda b: " and ".join(f'l."{k}" = {b}."{k}"' for k in keys)
    back, ahead = f'l."{left_us}" - b."{right_us}"', f'f."{right_us}" - l."{left_us}"'
    duck.register("l_side", left)
    duck.register("r_side", right)
    try:
        return duck.sql(
            f"""
            with near as (
              select l.*, b."{right_us}" as back_us, f."{right_us}" as ahead_us, {back} as back_by, {ahead} as ahead_by
              from l_side l
              asof left join r_side b on {same("b")} and l."{left_us}" >= b."{right_us}"
              asof left join r_side f on {same("f")} and l."{left_us}" <= f."{right_us}"),
            picked as (
              select *, case when back_by is not null and (ahead_by is null or back_by <= ahead_by) then back_us else ahead_us end as nearest_us,
                     least(back_by, ahead_by) as away_us
              from near)
            select * exclude (back_us, ahead_us, back_by, ahead_by) from picked where away_us <= {tolerance_us}
            """
        ).to_arrow_table()
    finally:
        duck.unregister("l_side")
        duck.unregister("r_side")


def _slotted(held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct times of cut blocks, each in its slot, and for every slot the last time before it and the first after it.

    ``held``: keys, __block, __slots, __slot, __at. What goes to other slots
    is at most two rows for each slot.
    """
    times = held.select(*keys, "__block", "__slots", "__slot", "__at").distinct()
    of_block = [*keys, "__block"]
    ends = times.groupBy(*of_block, "__slots", "__slot").agg(F.min("__at").alias("__first"), F.max("__at").alias("__last"))
    order = Window.partitionBy(*of_block).orderBy("__slot")
    near = ends.withColumn("__before", F.coalesce(F.lag("__slot").over(order), F.lit(0))).withColumn("__after", F.coalesce(F.lead("__slot").over(order), F.col("__slots") - 1))
    none = F.array().cast("array<int>")
    up = F.when(F.col("__after") > F.col("__slot"), F.sequence(F.col("__slot") + 1, F.col("__after"))).otherwise(none)
    down = F.when(F.col("__before") < F.col("__slot"), F.sequence(F.col("__before"), F.col("__slot") - 1)).otherwise(none)
    sent = near.select(*of_block, F.explode(F.concat(F.transform(up, lambda s: F.struct(s.alias("s"), F.col("__last").alias("at"))), F.transform(down, lambda s: F.struct(s.alias("s"), F.col("__first").alias("at"))))).alias("x"))
    return times.select(*keys, "__at", "__block", "__slot").unionByName(sent.select(*keys, F.col("x.at").alias("__at"), "__block", F.col("x.s").alias("__slot")))


def nearest_in_time(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: str, right_us: str, tolerance_us: int, block_us: int = BLOCK_US, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The distinct rows of left with ``nearest_us``, the nearest time in right of the same keys.

    Times are microseconds. At most ``tolerance_us`` away, inclusive; of two
    equally near the earlier. Rows without partner, and rows with a null key
    or time on either side, don't come out. Of right only keys and time are
    read, so clashing names of other columns don't matter; columns of left
    that are named nearest_us or away_us are left out.

    A row of left goes to every block that its tolerance reaches (one or two),
    so every partner is seen; the candidates of both blocks are compared. The
    number of groups follows the rows counted on both sides.
    """
    left = left.drop("nearest_us", "away_us")
    width = max(block_us, 2 * tolerance_us, 1)
    reach = F.explode(F.array_distinct(F.array(F.floor((F.col(left_us) - tolerance_us) / width), F.floor((F.col(left_us) + tolerance_us) / width))))
    asked = left.where(" and ".join(f"`{c}` is not null" for c in [*keys, left_us])).withColumn("__block", reach)
    held = right.select(*keys, F.col(right_us).alias("__at")).where(" and ".join(f"`{c}` is not null" for c in [*keys, "__at"])).withColumn("__block", F.floor(F.col("__at") / width))

    of_block = [*keys, "__block"]
    counted = asked.select(*of_block, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(held.select(*of_block, F.lit(0).alias("l"), F.lit(1).alias("r"))).groupBy(*of_block).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    # a block with rows on one side only pairs nothing, and isn't cut
    large = (F.col("l") > 0) & (F.col("r") > 0) & (F.col("l") + F.col("r") > group_rows)
    rows, n_large = counted.agg(F.sum(F.col("l") + F.col("r")), F.count_if(large)).first()
    groups = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * -(-(rows or 0) // group_rows))
    if n_large:
        slots = (FINE * F.ceil((F.col("l") + F.col("r")) / F.lit(group_rows))).cast("int")
        cut = counted.where(large).select(*of_block, slots.alias("__slots"))
        cut = F.broadcast(cut) if n_large <= SMALL else cut
        slot_of = lambda at: F.floor(F.pmod(at, F.lit(width)) * F.col("__slots") / F.lit(width)).cast("int")
        # a time of the block beside lies before the first or behind the last slot
        side = F.floor(F.col(left_us) / width)
        own = F.when(side < F.col("__block"), 0).when(side > F.col("__block"), F.col("__slots") - 1).otherwise(slot_of(F.col(left_us)))
        asked = asked.join(cut, of_block, "left").withColumn("__slot", F.when(F.col("__slots").isNotNull(), own).otherwise(0)).drop("__slots")
        placed = held.join(cut, of_block, "left").withColumn("__slot", F.when(F.col("__slots").isNotNull(), slot_of(F.col("__at"))).otherwise(0))
        whole = placed.where("__slots is null").select(*keys, "__at", "__block", "__slot")
        held = whole.unionByName(_slotted(placed.where("__slots is not null"), keys).select(*whole.columns))
    else:
        asked, held = asked.withColumn("__slot", F.lit(0)), held.withColumn("__slot", F.lit(0))
    place = F.pmod(F.xxhash64(*keys, "__block", "__slot"), F.lit(groups)).cast("int")
    asked, held = (side.withColumn("__group", place) for side in (asked, held))
    names = left.columns
    out = T.StructType([*[left.schema[c] for c in names], T.StructField("nearest_us", T.LongType()), T.StructField("away_us", T.LongType())])
    keyed = list(keys)

    def match(asked_group: pa.Table, held_group: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(out)
        if not asked_group.num_rows or not held_group.num_rows:
            return shape.empty_table()
        asked_group = asked_group.drop_columns(["__group"])
        parts = [asof_both_ways(asked_group.slice(at, SLICE), held_group, keyed, left_us, "__at", tolerance_us).select(shape.names).cast(shape) for at in range(0, asked_group.num_rows, SLICE)]
        return pa.concat_tables(parts)

    asked, held = asked.select(*names, "__group"), held.select(*keys, "__at", "__group")
    found = asked.groupBy("__group").cogroup(held.groupBy("__group")).applyInArrow(match, out)
    return found.groupBy(*names).agg(F.min(F.struct("away_us", "nearest_us")).alias("__best")).select(*names, F.col("__best.nearest_us").alias("nearest_us"))
