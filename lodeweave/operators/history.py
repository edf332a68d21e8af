"""History of changing attributes from observations.

Each attribute has its own change log with its own intervals. A state of the
entity is the combination: the time line is split at the union of all
attributes' boundaries, each split gets every attribute's value then, and
equal neighbours are joined again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.operators.skew import ROWS, next_value, pieces_needed, prior_values


@dataclass(frozen=True)
class Attribute:
    """An attribute, read from ``value``; where ``keeps_last`` holds a null means not reported."""

    name: str
    value: Column
    keeps_last: bool = False


def observations(df: DataFrame, keys: Sequence[str], time_us: Column, attributes: Sequence[Attribute], pieces: int = 2) -> DataFrame:
    """One row per key and time. Rows without time are left out.

    Of several rows of a key at one time one whole row counts, so that no
    state is made of values that never held together: the last by the
    attributes' values in their order, where null is first. Only an attribute
    that keeps its last value takes it from another of these rows if the one
    chosen doesn't report it. With ``pieces`` of 1 (no key is too large for a
    task) rows meet under their key alone, so that later scans by key need no
    further shuffle.
    """
    picked = df.select(*keys, time_us.alias("at_us"), *[a.value.alias(a.name) for a in attributes]).where("at_us is not null")
    if pieces == 1:
        picked = picked.repartition(*keys)
    row = F.max(F.struct(*[a.name for a in attributes])).alias("__row")
    held = picked.groupBy(*keys, "at_us").agg(row, *[F.max(a.name).alias(f"__m_{a.name}") for a in attributes if a.keeps_last])
    return held.select(*keys, "at_us", *[(F.coalesce(f"__row.{a.name}", f"__m_{a.name}") if a.keeps_last else F.col(f"__row.{a.name}")).alias(a.name) for a in attributes])


def change_log(observed: DataFrame, keys: Sequence[str], attributes: Sequence[Attribute], rows: int = ROWS, pieces: int | None = None) -> DataFrame:
    """keys, at_us, attribute, value: each attribute's first value and every value that differs from the one before it.

    ``observed`` is as observations() gives it. Values are strings. The first
    observation of a key is logged for every attribute that doesn't keep its
    last value, also where its value is null.
    """
    seen = {a.name: F.when(F.col(a.name).isNotNull(), F.struct(F.col(a.name).alias("v"))) if a.keeps_last else F.struct(F.col(a.name).alias("v")) for a in attributes}
    prior = prior_values(observed, keys, "at_us", {f"__b_{n}": c for n, c in seen.items()}, rows, pieces=pieces)
    entries = []
    for a in attributes:
        before, now = F.col(f"__b_{a.name}"), F.col(a.name).cast("string")
        changed = before.isNull() | ~F.col(a.name).eqNullSafe(before["v"])
        if a.keeps_last:
            changed = changed & F.col(a.name).isNotNull()
        entries.append(F.when(changed, F.struct(F.lit(a.name).alias("attribute"), now.alias("value"))))
    kept = prior.select(*keys, "at_us", F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("__log"))
    return kept.select(*keys, "at_us", F.explode("__log").alias("__e")).select(*keys, "at_us", "__e.attribute", "__e.value")


def attribute_intervals(log: DataFrame, keys: Sequence[str], rows: int = ROWS, pieces: int | None = None) -> DataFrame:
    """Each logged value with its own half-open interval; valid_to_us is null while current."""
    return next_value(log, [*keys, "attribute"], "at_us", "valid_to_us", rows, pieces).withColumnRenamed("at_us", "valid_from_us")


def combine(log: DataFrame, keys: Sequence[str], names: Sequence[str], rows: int = ROWS, pieces: int | None = None) -> DataFrame:
    """keys, valid_from_us, valid_to_us, one column per attribute: the states in which no attribute changes.

    Splits at the union of the attributes' boundaries and joins equal
    neighbours; valid_to_us is null while current.
    """
    split = log.groupBy(*keys, "at_us").agg(*[F.max(F.when(F.col("attribute") == n, F.struct(F.col("value").alias("v")))).alias(f"__s_{n}") for n in names])
    held = prior_values(split, keys, "at_us", {f"__h_{n}": F.col(f"__s_{n}") for n in names}, rows, pieces=pieces)
    now = {n: F.coalesce(F.col(f"__s_{n}"), F.col(f"__h_{n}"))["v"] for n in names}
    was = {n: F.col(f"__h_{n}")["v"] for n in names}
    opened = F.coalesce(*[F.col(f"__h_{n}") for n in names]).isNull()
    differs = opened
    for n in names:
        differs = differs | ~now[n].eqNullSafe(was[n])
    states = held.where(differs).select(*keys, F.col("at_us").alias("valid_from_us"), *[now[n].alias(n) for n in names])
    return next_value(states, keys, "valid_from_us", "valid_to_us", rows, pieces).select(*keys, "valid_from_us", "valid_to_us", *names)


def attribute_history(df: DataFrame, keys: Sequence[str], time_us: Column, attributes: Sequence[Attribute], rows: int = ROWS) -> DataFrame:
    """The full history of df's keys from its observations, in any order and however often repeated.

    Null keys are a key like any other, an empty table gives an empty history,
    further columns of df are ignored. Rows per key are counted once, on df:
    every later table has at most as many.
    """
    pieces = pieces_needed(df, keys, rows)
    log = change_log(observations(df, keys, time_us, attributes, pieces), keys, attributes, rows, pieces)
    return combine(log, keys, [a.name for a in attributes], rows, pieces)
