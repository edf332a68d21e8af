import random

from pyspark.sql import functions as F

from lodeweave.operators.dyadic import covering_nodes, enclosing_nodes, join_valid_at, latest_valid


def test_cover_is_exact_and_small(spark):
    levels = 6
    pairs = [(a, b) for a in range(0, 64, 3) for b in range(a, 64, 5)] + [(5, 4), (0, 63)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", covering_nodes(F.col("a"), F.col("b"), levels).alias("n"))
    for a, b, nodes in df.collect():
        leaves = [leaf for n in nodes for leaf in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(leaves) == list(range(a, b + 1)) and len(nodes) <= 2 * levels


def test_an_interval_and_an_event_share_one_node_or_none(spark):
    up = spark.range(64).select("id", enclosing_nodes(F.col("id"), 6).alias("n")).collect()
    cover = {tuple(n) for n in spark.range(1).select(covering_nodes(F.lit(9), F.lit(50), 6).alias("n")).first().n}
    for row in up:
        assert len(cover & {tuple(n) for n in row.n}) == int(9 <= row.id <= 50)


def test_join_against_brute_force(spark):
    rng = random.Random(1)
    span = 10**15
    events = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([rng.randrange(-span, 4 * span), None, 0, 10**18])) for i in range(150)]
    facts = []
    for i in range(150):
        lo, hi = rng.randrange(-span, 4 * span), rng.randrange(-span, 4 * span)
        facts.append((f"f{i}", rng.choice(["hot", "a", None]), rng.choice([lo, None, 0]), rng.choice([hi, None, 10**15])))
    want = {(e, f) for e, k, t in events for f, g, lo, hi in facts if k is not None and k == g and t is not None and (lo is None or lo <= t) and (hi is None or hi > t)}
    left = spark.createDataFrame(events, "e int, k string, at long")
    right = spark.createDataFrame(facts, "f string, k string, lo long, hi long")
    for bits, rows in ((30, 10**6), (36, 10**6), (50, 10**6), (44, 3)):
        got = join_valid_at(left, right, ["k"], "at", "lo", "hi", bits=bits, rows=rows).select("e", "f").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert join_valid_at(left, right.limit(0), ["k"], "at", "lo", "hi").count() == 0
    assert join_valid_at(left.limit(0), right, ["k"], "at", "lo", "hi").count() == 0


def test_all_events_at_one_time(spark):
    left = spark.createDataFrame([(i, "a", 7) for i in range(5)], "e int, k string, at long")
    right = spark.createDataFrame([("f", "a", None, None), ("g", "a", 7, 8), ("h", "a", 8, 9), ("i", "a", 0, 7)], "f string, k string, lo long, hi long")
    for rows in (10, 2):
        got = {(r.e, r.f) for r in join_valid_at(left, right, ["k"], "at", "lo", "hi", rows=rows).collect()}
        assert got == {(i, f) for i in range(5) for f in "fg"}


def test_precedence_is_deterministic(spark):
    m = spark.createDataFrame([(1, None, 5, "a"), (1, 3, 4, "b"), (1, 3, 4, "c"), (2, None, 1, "d")], "e int, lo long, known long, id string")
    got = latest_valid(m, ["e"], [F.coalesce("lo", F.lit(-(1 << 62))), F.col("known"), F.col("id")], F.col("id"), "v")
    assert {tuple(r) for r in got.collect()} == {(1, "c"), (2, "d")}


def test_clashing_names_and_other_columns(spark):
    left = spark.createDataFrame([("a", 5, "L", 7)], "k string, at long, lo string, x int")
    right = spark.createDataFrame([("a", 1, 9, "R", 8)], "k string, lo long, hi long, at string, x int")
    got = join_valid_at(left, right, ["k"], "at", "lo", "hi")
    assert got.columns == ["k", "at", "lo", "x", "fact_lo", "hi", "fact_at", "fact_x"] and [tuple(r) for r in got.collect()] == [("a", 5, "L", 7, 1, 9, "R", 8)]
