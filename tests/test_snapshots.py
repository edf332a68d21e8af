from pyspark.sql import functions as F

from lodeweave.operators.snapshots import consecutive, except_all_both_ways, plain_name, plain_set, snapshot_changes


def test_pairs_follow_time_within_a_feed(spark):
    v = spark.createDataFrame([("c", "f", 3), ("a", "f", 1), ("b", "f", 1), ("z", None, 1), ("y", None, 2), ("x", "f", None)], "v string, feed string, t long")
    for limit in (10**6, 1):
        got = {(r.v, r.previous) for r in consecutive(v, ["feed"], "v", "t", rows=limit).collect()}
        assert got == {("a", None), ("b", "a"), ("c", "b"), ("z", None), ("y", "z")}


def test_changes_by_key(spark):
    rows = spark.createDataFrame([("1", "same", "x"), ("1", "gone", "x"), ("1", "edit", "x"), ("2", "same", "x"), ("2", "same", "x"), ("2", "edit", "y"), ("2", "new", "x"), ("1", "two", "p"), ("2", "two", "p"), ("2", "two", "q")], "v string, k string, c string")
    pairs = spark.createDataFrame([("1", None), ("2", "1")], "v string, previous string")
    got = {tuple(r) for r in snapshot_changes(rows, pairs, "v", ["k"], "c").collect()}
    assert got == {("2", "gone", "removed"), ("2", "edit", "changed"), ("2", "new", "added"), ("2", "two", "changed")}


def test_except_all_both_ways_against_except_all(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), ("z", 3)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", None), ("w", 4), ("w", 4)], "k string, v int")
    both = a.selectExpr("k", "v", "1 as s").unionByName(b.selectExpr("k", "v", "-1 as s"))
    got = {(r.k, r.v): r.left for r in except_all_both_ways(both, ["k", "v"], "s").collect()}
    count = lambda df: {(r.k, r.v): r["count"] for r in df.groupBy("k", "v").count().collect()}
    assert got == {**count(a.exceptAll(b)), **{k: -n for k, n in count(b.exceptAll(a)).items()}}


def test_one_snapshot_empty(spark):
    rows = spark.createDataFrame([("1", "a", "x")], "v string, k string, c string")
    pairs = spark.createDataFrame([("1", None), ("2", "1")], "v string, previous string")
    assert [tuple(r) for r in snapshot_changes(rows, pairs, "v", ["k"], "c").collect()] == [("2", "a", "removed")]
    assert snapshot_changes(rows.limit(0), pairs, "v", ["k"], "c").count() == 0


def test_what_is_no_change(spark):
    df = spark.createDataFrame([("  A  b ", ["x", None, "x  y", "x"]), ("A b", None)], "n string, a array<string>")
    got = df.select(plain_name(F.col("n")).alias("n"), plain_set(F.col("a")).alias("a")).collect()
    assert [r.n for r in got] == ["A b", "A b"] and [r.a for r in got] == [["x", "x y"], []]
