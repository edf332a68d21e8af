import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lodeweave.llm.mixture import min_cost_flow, mix

SIZED = "doc_id long, unit string, source string, n_tokens int, mix_name string, pattern string"
TARGETS = "mix_name string, source string, target_weight double, max_repeats int, total_ratio double"


def _sized(spark, docs):
    return spark.createDataFrame([(*d, "clash", "clash") for d in docs], SIZED)


def _best(supply, quota, uses):
    """The largest flow and its least cost by trying every split, in whole tokens of one pattern per source."""
    import itertools

    slots = [(p, k, s) for (p, s), n in sorted(uses.items()) for k in range(1, n + 1)]
    best = (0, 0)
    for amounts in itertools.product(*[range(supply[p] + 1) for p, _, _ in slots]):
        per_use, per_source, cost = {}, {}, 0
        for (p, k, s), a in zip(slots, amounts):
            per_use[p, k] = per_use.get((p, k), 0) + a
            per_source[s] = per_source.get(s, 0) + a
            cost += a * (2 * k - 1)
        if all(v <= supply[p] for (p, _), v in per_use.items()) and all(v <= quota[s] for s, v in per_source.items()):
            best = max(best, (sum(amounts), -cost))
    return best[0], -best[1]


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 2), st.integers(0, 2), st.integers(0, 4), st.integers(0, 4), st.integers(1, 2), st.integers(0, 1))
def test_flow_is_largest_and_cheapest(a, ab, qa, qb, ra, rb):
    supply, quota = {"a": a, "ab": ab}, {"A": qa, "B": qb}
    uses = {("a", "A"): ra, ("ab", "A"): ra, ("ab", "B"): rb}
    flow = min_cost_flow(supply, quota, uses)
    assert (sum(flow.values()), sum(v * (2 * k - 1) for (_, k, _), v in flow.items())) == _best(supply, quota, uses)


def test_flow_re_routes_over_several_sources():
    supply = {"ab": 10, "bc": 10, "cd": 10, "a": 5}
    quota = {"a": 5, "b": 10, "c": 10, "d": 10}
    flow = min_cost_flow(supply, quota, {(p, s): 1 for p in supply for s in p})
    by = {s: sum(v for (_, _, t), v in flow.items() if t == s) for s in quota}
    assert by == {"a": 5, "b": 10, "c": 10, "d": 10}
    assert all(sum(v for (p, _, _), v in flow.items() if p == q) <= n for q, n in supply.items())


def test_ten_thousand_patterns_are_quick():
    rng = random.Random(4)
    sources = [f"s{i:02d}" for i in range(24)]
    patterns = {}
    while len(patterns) < 10_000:
        patterns["\x1f".join(sorted(rng.sample(sources, rng.randint(1, 7))))] = rng.randrange(1, 10**6)
    total = sum(patterns.values())
    quota = {s: total * rng.randint(1, 9) // 60 for s in sources}
    began = time.perf_counter()
    flow = min_cost_flow(patterns, quota, {(p, s): 1 + int(s[1:]) % 3 for p in patterns for s in p.split("\x1f")})
    assert time.perf_counter() - began < 10
    used = {}
    for (p, k, s), v in flow.items():
        assert v > 0 and s in p
        used[p, k] = used.get((p, k), 0) + v
    assert all(v <= patterns[p] for (p, _), v in used.items())
    assert all(k == 1 or used.get((p, k - 1)) == patterns[p] for p, k in used)  # lower uses fill first
    got = {s: sum(v for (_, _, t), v in flow.items() if t == s) for s in sources}
    assert all(got[s] <= quota[s] for s in sources)


def test_shares_repeats_and_small_sources(spark):
    docs = [(i, f"u{i}", "big", 10) for i in range(100)] + [(200 + i, f"s{i}", "small", 10) for i in range(5)] + [(300, "n", None, 10), (301, "e", "big", 0)]
    goals = [("m", "big", 1.0, 1, 0.4), ("m", "small", 1.0, 3, 0.4), ("m", "absent", 2.0, 2, 0.4), ("m", None, 1.0, 1, 0.4), ("m", "void", None, 1, 0.4)]
    chosen, shares = mix(_sized(spark, docs), spark.createDataFrame(goals, TARGETS))
    by = {r.source: r for r in shares.collect()}
    # 1060 tokens in all, 424 wanted: 106 for each of big and small, 212 for what isn't there
    assert by["small"].target_tokens == 106 and by["small"].n_documents == 5 and by["small"].actual_tokens == 110
    assert by["big"].actual_tokens == 110 and by["big"].n_copies == 11
    assert by["absent"].actual_tokens == 0 and by["absent"].target_tokens == 212
    rows = chosen.collect()
    assert max(r.copies for r in rows if r.source == "small") <= 3 and all(r.copies == 1 for r in rows if r.source == "big")
    again = {tuple(r) for r in mix(_sized(spark, docs[::-1]), spark.createDataFrame(goals, TARGETS))[0].collect()}
    assert again == {tuple(r) for r in rows}


def test_a_text_of_two_sources_serves_the_one_that_needs_it(spark):
    docs = [(1, "x", "a", 10), (2, "x", "b", 10), (3, "y", "a", 10)]
    goals = [("m", "a", 1.0, 1, 2 / 3), ("m", "b", 1.0, 1, 2 / 3)]
    chosen = {(r.source, r.doc_id, r.copies) for r in mix(_sized(spark, docs), spark.createDataFrame(goals, TARGETS))[0].collect()}
    assert chosen == {("a", 3, 1), ("b", 1, 1)}


def test_empty_tables(spark):
    none, goals = spark.createDataFrame([], SIZED), spark.createDataFrame([("m", "a", 1.0, 1, 0.5)], TARGETS)
    chosen, shares = mix(none, goals)
    assert chosen.count() == 0 and [r.actual_tokens for r in shares.collect()] == [0]
    assert mix(none, goals.limit(0))[1].count() == 0
