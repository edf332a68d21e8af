import random

from pyspark.sql import functions as F

from lodeweave.operators.asof import asof, asof_horizons, coverage, interval_totals


def _tables(spark):
    left = spark.createDataFrame([(1, "a", 1000, "x"), (2, "a", None, "x"), (3, None, 1000, None), (4, "b", 1000, "x")], "id int, k string, at long, v string")
    right = spark.createDataFrame([("a", 400, 1, "y"), ("a", 985, 2, "y"), ("a", 985, 3, "y"), ("a", 1070, 4, "y"), ("a", 1302, 5, "y"), (None, 1000, 6, "y"), ("a", None, 7, "y")], "k string, t long, w int, v string")
    return left, right


def test_backward_and_forward_with_tolerance(spark):
    left, right = _tables(spark)
    back = {r.id: r.r and r.r.w for r in asof(left, right, ["k"], F.col("at"), "t", 600, ties=[F.col("r.w")]).collect()}
    assert back == {1: 3, 2: None, 3: None, 4: None}
    ahead = {r.id: r.r and r.r.w for r in asof(left, right, ["k"], F.col("at"), "t", 70, forward=True).collect()}
    assert ahead[1] == 4
    assert {r.id: r.r for r in asof(left, right, ["k"], F.col("at"), "t", 14).collect()}[1] is None
    assert asof(left, right.limit(0), ["k"], F.col("at"), "t", 9).where("r is null").count() == 4


def test_horizons_may_share_a_row(spark):
    left, right = _tables(spark)
    got = {r.id: (r.h0, r.h1, r.h2) for r in asof_horizons(left, right, ["k"], "at", "t", {"h0": 0, "h1": 60, "h2": 400}, 120, "w").collect()}
    assert got[1] == (4, 4, None) and got[3] == (None, None, None)


def test_coverage_counts_the_edges(spark):
    left, right = _tables(spark)
    got = {r.id: (r.n_seen, r.max_gap_us) for r in coverage(left, right, ["k"], "at", "t", 1000).collect()}
    assert got == {1: (2, 698), 2: (0, None), 3: (0, None), 4: (0, None)}


def test_interval_totals_against_brute_force(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("ab"), rng.randrange(-500, 5000)) for i in range(80)]
    right = [(rng.choice("ab"), rng.randrange(-500, 5000), rng.randrange(9)) for _ in range(300)]
    got = interval_totals(spark.createDataFrame(left, "id int, k string, at long"), spark.createDataFrame(right, "k string, t long, w int"), ["k"], "at", "t", 97, {"n": F.count(F.lit(1)), "s": F.sum("r.w")})
    for r in got.collect():
        hits = [w for k, t, w in right if k == r.k and r["at"] <= t <= r["at"] + 97]
        assert (r.n, r.s) == ((len(hits), sum(hits)) if hits else (None, None))
