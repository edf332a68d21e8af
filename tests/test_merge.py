from pyspark.sql import functions as F

from lodeweave.operators import merge as M


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_insert_ignore_and_last_writer(spark):
    old = spark.createDataFrame([("a", 1, "x"), (None, 5, "n")], "k string, n int, f string")
    new = spark.createDataFrame([("a", 2, "y"), ("b", 4, "z"), ("b", 3, "w")], "k string, n int, f string")
    assert _rows(M.insert_ignore(old, new, ["k"], F.col("n"))) == _rows(spark.createDataFrame([("a", 1, "x"), ("b", 3, "w"), (None, 5, "n")], old.schema))
    assert _rows(M.last_writer(old, new, ["k"], F.col("n"), fixed=["f"])) == _rows(spark.createDataFrame([("a", 2, "x"), ("b", 4, "w"), (None, 5, "n")], old.schema))
    assert _rows(M.insert_ignore(old, new.limit(0), ["k"], F.col("n"))) == _rows(old)


def test_replaying_a_batch_changes_nothing(spark):
    old = spark.createDataFrame([("a", 1, 1)], "k string, seen int, first int")
    new = spark.createDataFrame([("a", 3, 3), ("a", 2, 0)], "k string, seen int, first int")
    once = M.newest_wins(old.unionByName(new), ["k"], "seen", first="first")
    assert _rows(once) == [("a", 3, 0)] and _rows(M.newest_wins(once.unionByName(new), ["k"], "seen", first="first")) == [("a", 3, 0)]


def test_guard_closing_refresh_children_and_update(spark):
    old = spark.createDataFrame([("a", "open"), ("b", "final"), ("c", None)], "k string, s string")
    new = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "x")], "k string, s string")
    assert _rows(M.guarded_upsert(old, new, ["k"], F.col("s") != "final")) == [("a", "x"), ("b", "final"), ("c", None), ("d", "x")]
    edges = spark.createDataFrame([("a", None), ("b", 3), ("c", None)], "k string, valid_to int")
    here = spark.createDataFrame([("b",), ("c",), ("d",)], "k string")
    assert _rows(M.close_and_reopen(edges, here, ["k"], "valid_to", F.lit(9))) == [("a", 9), ("b", None), ("c", None), ("d", None)]
    assert _rows(M.refresh(old, new, ["k"], "s")) == [("a", "open"), ("b", "final"), ("c", "x"), ("d", "x")]
    assert _rows(M.replace_children(old, spark.createDataFrame([("a", "1"), ("a", "2")], "k string, s string"), ["k"])) == [("a", "1"), ("a", "2"), ("b", "final"), ("c", None)]
    assert _rows(M.keyed_update(old, spark.createDataFrame([("a", None), ("c", "y"), ("z", "y")], "k string, s string"), ["k"])) == [("a", "open"), ("b", "final"), ("c", "y")]


def test_cursors_only_advance(spark):
    at = spark.createDataFrame([("s", 5)], "k string, t int")
    assert _rows(M.advance(at, spark.createDataFrame([("s", 4), ("u", 1)], "k string, t int"), ["k"], "t")) == [("s", 5), ("u", 1)]


def test_missing_since_the_cycle_after(spark):
    days = spark.createDataFrame([(d,) for d in ("2024-01-01", "2024-01-02", "2024-01-03")], "c string").select(F.col("c").cast("timestamp").alias("c"))
    seen = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-01")], "k string, c string").select("k", F.col("c").cast("timestamp").alias("c"))
    assert [(r.k, r.missing_since and r.missing_since.day) for r in M.missing_since(seen, days, ["k"], "c").orderBy("k").collect()] == [("a", None), ("b", 2)]
