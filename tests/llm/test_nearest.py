import random

from lodeweave.llm.nearest import nearest_in_time

S = 1_000_000


def _run(spark, left, right, **kw):
    a = spark.createDataFrame(left, "id int, k string, at long, value string").selectExpr("*", "1 as nearest_us")
    b = spark.createDataFrame(right, "k string, seen long, value string, id int, at string")
    return {(r.id, r.nearest_us) for r in nearest_in_time(a, b, ["k"], "at", "seen", 600 * S, **kw).collect()}


def test_tolerance_and_ties(spark):
    left = [(1, "a", 1000 * S, ""), (2, "b", 1000 * S, ""), (3, "c", 1000 * S, ""), (4, "d", 0, ""), (5, "e", -5, "")]
    right = [("a", 400 * S, "", 1, ""), ("a", 1600 * S, "", 1, ""), ("b", 1600 * S + 1, "", 1, ""), ("c", 900 * S, "", 1, ""), ("c", 950 * S, "", 1, ""), ("c", 1049 * S, "", 1, ""), ("d", 0, "", 1, ""), ("e", -600 * S - 5, "", 1, "")]
    assert _run(spark, left, right) == {(1, 400 * S), (3, 1049 * S), (4, 0), (5, -600 * S - 5)}


def test_nulls_and_empty_sides(spark):
    right = [("a", 5, "", 1, ""), (None, 5, "", 1, ""), ("a", None, "", 1, "")]
    assert _run(spark, [(1, None, 5, ""), (2, "a", None, ""), (None, "a", 5, None)], right) == {(None, 5)}
    assert _run(spark, [(1, "a", 5, "")], []) == set() and _run(spark, [], right) == set()


def test_against_brute_force_with_a_hot_key_and_repeated_rows(spark):
    rng = random.Random(2)
    left = [(i, rng.choice(["hot", "hot", "a", "b"]), rng.randrange(-10**5, 10**5) * S, "") for i in range(300)]
    right = [(rng.choice(["hot", "hot", "a"]), rng.randrange(-10**5, 10**5) * S, "", i, "") for i in range(400)]
    want = set()
    for i, k, at, _ in left:
        near = min(((abs(t - at), t) for g, t, *_ in right if g == k), default=None)
        if near and near[0] <= 600 * S:
            want.add((i, near[1]))
    assert _run(spark, left, right + right[:50]) == want
    assert _run(spark, left, right, block_us=1) == want
    for rows in (3, 20, 150):  # large blocks are cut into slots
        assert _run(spark, left, right, block_us=10**11, group_rows=rows) == want


def test_a_block_hot_on_either_side_or_both(spark):
    rng = random.Random(5)
    at = lambda n: [rng.randrange(0, 3600) * S + 7 for _ in range(n)]
    burst = [1800 * S] * 60
    for lefts, rights in ((at(300) + burst, [5 * S, 3000 * S]), ([10 * S, 1799 * S, -200 * S, 3700 * S], at(300) + burst), (at(200) + burst, at(200) + burst)):
        left = [(i, "hot", t, "") for i, t in enumerate(lefts)]
        right = [("hot", t, "", 0, "") for t in rights]
        want = {(i, min((abs(t - u), u) for u in rights)[1]) for i, t in enumerate(lefts) if min(abs(t - u) for u in rights) <= 600 * S}
        assert _run(spark, left, right, group_rows=20) == want
