"""Numbers, times, hashes and JSON as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(text: Column, kind: str = "decimal(18,8)") -> Column:
    """A finite decimal of a text; null where it is none."""
    return F.trim(text).try_cast(kind)


def plain(number: Column) -> Column:
    """A decimal in plain digits; its scale is kept."""
    return number.cast("string")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def iso_time(text: Column) -> Column:
    """A time of ISO 8601, without zone in UTC; null where it is none."""
    return blank_to_null(text).try_cast("timestamp")


def epoch_time(text: Column, fallback: Column) -> Column:
    """A time from a number of milliseconds (from 1e11 on) or seconds, or in ISO 8601; the fallback where it is blank."""
    number = text.try_cast("decimal(20,3)")
    millis = F.timestamp_millis(number.try_cast("long"))
    seconds = F.timestamp_micros((number * 1_000_000).try_cast("long"))
    return F.when(blank_to_null(text).isNull(), fallback).when(number >= 100_000_000_000, millis).when(number.isNotNull(), seconds).otherwise(iso_time(text))


def season(date: Column) -> Column:
    """The season that a day belongs to, which begins in March."""
    return F.year(date) - (F.month(date) < 3).cast("int")


def canonical_json(**fields: Column) -> Column:
    """JSON of the fields in order of their names, nulls included."""
    return F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]), {"ignoreNullFields": "false"})


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def name_uuid(namespace: str, name: Column) -> Column:
    """The UUID of version 5 of a name in a namespace."""
    raw = F.sha1(F.concat(F.lit(uuid.UUID(namespace).bytes), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), (F.conv(F.substring(raw, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat(F.substring(raw, 1, 8), F.lit("-"), F.substring(raw, 9, 4), F.lit("-5"), F.substring(raw, 14, 3), F.lit("-"), variant, F.substring(raw, 18, 3), F.lit("-"), F.substring(raw, 21, 12))


def set_digest(member: Column) -> Column:
    """An aggregate: a digest of the group's members that doesn't depend on their order, repetition included.

    The members' hashes are summed in four parts of 60 bits, so that a group
    of any size is one row of partial sums and never gathered.
    """
    hashed = F.sha2(member, 256)
    parts = [F.sum(F.conv(F.substring(hashed, at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16, 31, 46)]
    return F.sha2(F.concat_ws(":", F.count(member).cast("string"), *[p.cast("string") for p in parts]), 256)


def json_list(text: Column) -> Column:
    """A list of strings written as JSON; an empty one where it is none."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def sole_winner(status: Column, prices: Column) -> Column:
    """The index of the only price that is 1, once resolved; null if any price is unreadable."""
    read = F.transform(prices, lambda p: p.try_cast("decimal(18,8)"))
    ones = F.size(F.filter(read, lambda p: p == 1))
    ok = (status == "resolved") & ~F.exists(read, lambda p: p.isNull()) & (ones == 1)
    return F.when(ok, F.array_position(read, F.lit(1).cast("decimal(18,8)")) - 1).cast("int")


def host(url: Column) -> Column:
    """The host of an address in lower case; null where it is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))
