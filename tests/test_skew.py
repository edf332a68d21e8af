import random

from pyspark.sql import functions as F

from lodeweave.operators.skew import PIECE, hot_keys, in_ranges, next_value, pieces_needed, prior_values


def _rows(seed=3, n=600):
    """Two thirds of the rows in one key, the rest in others and in the null key; times unique within a key."""
    rng = random.Random(seed)
    at = list(range(n))
    rng.shuffle(at)
    return [("hot" if i % 3 else rng.choice(["a", "b", None]), t, rng.choice([None, 1, 2])) for i, t in enumerate(at)]


def _expected(rows):
    out, last = set(), {}
    for k, t, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.add((k, t, last.get(k)))
        last[k] = v if v is not None else last.get(k)
    return out


def test_prior_values_alike_whether_cut_or_not(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, t long, v int")
    for limit in (10**6, 20):
        got = prior_values(df, ["k"], "t", {"p": F.col("v")}, rows=limit).select("k", "t", "p")
        assert {tuple(r) for r in got.collect()} == _expected(rows)


def test_ranges_bound_the_rows_of_a_task(spark):
    df = spark.createDataFrame(_rows(), "k string, t long, v int")
    assert pieces_needed(df, ["k"]) == 1 and hot_keys(df, ["k"]) is None
    assert pieces_needed(df, ["k"], 20) == 31 and pieces_needed(df.limit(0), ["k"], 20) == 1
    sizes = [r["count"] for r in in_ranges(df, ["k"], "t", 31).groupBy(PIECE).count().collect()]
    assert sum(sizes) == 600 and max(sizes) < 60
    hot, parts = hot_keys(df, ["k"], 100)
    assert [(r["k"], r["__parts"]) for r in hot.collect()] == [("hot", 4)] and parts == 4


def test_next_value_and_empty_table(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 2)], "k string, t long")
    assert {tuple(r) for r in next_value(df, ["k"], "t", "n").collect()} == {("a", 1, 5), ("a", 5, None), (None, 2, None)}
    assert next_value(df.limit(0), ["k"], "t", "n").count() == 0


def test_a_column_of_the_wanted_name_is_replaced(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 8)], "k string, t long, p int")
    assert {tuple(r) for r in prior_values(df, ["k"], "t", {"p": F.col("p")}).select("t", "p").collect()} == {(1, None), (2, 9)}
