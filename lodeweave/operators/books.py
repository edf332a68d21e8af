"""Order-book ladders: best prices, bounded depth, and the complement of a side.

A ladder is an array of (price, size) per row; everything is done within the
row by array expressions, so that no ladder is shuffled or exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = "struct<price:decimal(18,8),size:decimal(18,8)>"


def levels(ladder: Column, best_high: bool, below_one: bool = False) -> Column:
    """A side's levels, best first: prices in (0, 1] (or (0, 1)), sizes above 0. Unreadable levels are left out; ties keep their order."""
    read = F.transform(F.coalesce(ladder, F.array().cast("array<struct<price:string,size:string>>")), lambda x, i: F.struct(x["price"].try_cast("decimal(18,8)").alias("price"), x["size"].try_cast("decimal(18,8)").alias("size"), i.alias("i")))
    top = (lambda p: p < 1) if below_one else (lambda p: p <= 1)
    good = F.filter(read, lambda x: x["price"].isNotNull() & x["size"].isNotNull() & (x["price"] > 0) & top(x["price"]) & (x["size"] > 0))
    keyed = F.transform(good, lambda x: F.struct((-x["price"] if best_high else x["price"]).cast("decimal(19,8)").alias("k"), x["i"].alias("i"), x["price"].alias("price"), x["size"].alias("size")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["price"].alias("price"), x["size"].alias("size")))


def readable(ladder: Column) -> Column:
    """Whether every level of a side can be read: a price in (0, 1] and a size above 0; null and empty sides are readable."""
    bad = lambda x: F.coalesce(~((x["price"].try_cast("decimal(18,8)") > 0) & (x["price"].try_cast("decimal(18,8)") <= 1) & (x["size"].try_cast("decimal(18,8)") > 0)), F.lit(True))
    return ~F.coalesce(F.exists(ladder, bad), F.lit(False))


def worth(level: Column) -> Column:
    return (level["price"] * level["size"]).cast("decimal(28,8)")


def total(side: Column) -> Column:
    """The side's price times size, summed."""
    return F.aggregate(side, F.lit(0).cast("decimal(28,8)"), lambda a, x: (a + worth(x)).cast("decimal(28,8)"))


def bounded(side: Column, depth: Column) -> Column:
    """The best levels until their worth reaches ``depth``; the level that crosses it is kept whole."""
    start = F.struct(F.lit(0).cast("decimal(28,8)").alias("sum"), F.array().cast(f"array<{LEVEL}>").alias("kept"))

    def step(a: Column, x: Column) -> Column:
        level = F.struct(x["price"].alias("price"), x["size"].alias("size"))
        return F.when(a["sum"] < depth, F.struct((a["sum"] + worth(x)).cast("decimal(28,8)").alias("sum"), F.concat(a["kept"], F.array(level)).alias("kept"))).otherwise(a)

    return F.aggregate(side, start, step, lambda a: a["kept"])


def complement(side: Column) -> Column:
    """The other outcome's side: the same sizes at one minus the price."""
    return F.transform(side, lambda x: F.struct((F.lit(1) - x["price"].try_cast("decimal(18,8)")).cast("decimal(18,8)").cast("string").alias("price"), x["size"].alias("size")))


def normalize_books(books: DataFrame, bids: str, asks: str, depth: Column, strict: bool = False) -> DataFrame:
    """books with best_bid, best_ask, midpoint, spread, each side's totals, bounded ladders and whether they were cut; null where a side is empty.

    Levels that can't be read are left out; with ``strict`` a book that has one is left out as a whole.
    """
    books = books.where(readable(F.col(bids)) & readable(F.col(asks))) if strict else books
    side = books.withColumn("__b", levels(F.col(bids), True)).withColumn("__a", levels(F.col(asks), False))
    b, a = F.get(F.col("__b"), F.lit(0))["price"], F.get(F.col("__a"), F.lit(0))["price"]
    out = side.withColumns({
        "best_bid": b, "best_ask": a, "midpoint": ((a + b) / 2).cast("decimal(18,8)"), "spread": (a - b).cast("decimal(18,8)"),
        "bid_total": total(F.col("__b")), "ask_total": total(F.col("__a")), "bid_levels": bounded(F.col("__b"), depth), "ask_levels": bounded(F.col("__a"), depth),
    })
    return out.withColumns({"bid_cut": F.size("bid_levels") < F.size("__b"), "ask_cut": F.size("ask_levels") < F.size("__a")}).drop("__b", "__a")


def depth_sweep(books: DataFrame, side: Column, depths: list[float]) -> DataFrame:
    """One row per book and depth: how many levels and how much worth are within it, over one reading of the ladder."""
    read = books.withColumn("__s", side).withColumn("depth", F.explode(F.array(*[F.lit(d).cast("decimal(18,2)") for d in depths])))
    kept = bounded(F.col("__s"), F.col("depth"))
    return read.withColumn("__k", kept).withColumns({"n_levels": F.size("__k"), "captured": total(F.col("__k"))}).drop("__s", "__k")
