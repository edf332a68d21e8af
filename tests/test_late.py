import random
from decimal import Decimal

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeweave.operators.late import MINUTE, Lateness, Ledger, first_arrivals, period_totals

HOUR = 60 * MINUTE


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, e long, a long, s decimal(18,8), w decimal(18,8), n long")
    return period_totals(df, ["k"], "e", "a", F.col("s"), F.col("w"), **kw)


def test_bounds_of_lateness(spark):
    end, rows = HOUR, []
    for i, late in enumerate([0, 10 * MINUTE, 10 * MINUTE + 1, 24 * HOUR, 24 * HOUR + 1]):
        rows.append((f"k{i}", 5, end + late, Decimal(1), Decimal(2), 9))
    got = {r.k: (r.revision > 0, r.n_cut_off, r.n) for r in _run(spark, rows).collect()}
    assert got == {"k0": (False, 0, 1), "k1": (False, 0, 1), "k2": (True, 0, 1), "k3": (True, 0, 1), "k4": (False, 1, 0)}


def test_totals_against_plain_sums(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a"]), e := rng.randrange(-HOUR, 3 * HOUR), e + rng.choice([0, 90 * MINUTE, 5 * HOUR, 30 * HOUR]) + rng.randrange(MINUTE), Decimal(rng.randrange(100)), Decimal(rng.randrange(100)), 0) for _ in range(500)]
    want = {}
    for k, e, a, s, w, _ in rows:
        start = e // HOUR * HOUR
        n = want.setdefault((k, start), [0, 0, 0, 0])
        if a > start + 25 * HOUR:
            n[3] += 1
        else:
            n[0], n[1], n[2] = n[0] + 1, n[1] + s, n[2] + w
    got = {(r.k, r.period_us): [r.n, r.size, r.worth, r.n_cut_off] for r in _run(spark, rows).collect()}
    assert got == want


def test_every_revision_in_turn(spark):
    late = HOUR + 20 * MINUTE
    rows = [("k", 1, 2, Decimal(1), Decimal(1), 0), ("k", 2, late, Decimal(2), Decimal(1), 0), ("k", 3, late + 1, Decimal(4), Decimal(1), 0), ("k", 4, late + HOUR, Decimal(8), Decimal(1), 0), ("k", 4, 99 * HOUR, Decimal(8), Decimal(1), 0)]
    got = [(r.revision, int(r.size), r.n_cut_off) for r in _run(spark, rows, every=True).orderBy("revision").collect()]
    assert got == [(0, 1, 0), (1, 7, 0), (2, 15, 1)]


def test_nulls_and_empty(spark):
    rows = [(None, 1, 1, None, None, 0), ("k", None, 1, None, None, 0), ("k", 1, None, None, None, 0), ("k", 1, 1, None, None, 0)]
    assert [(r.k, r.n, r.size, r.half_slot) for r in _run(spark, rows).collect()] == [("k", 1, 0, None)]
    assert _run(spark, rows).limit(0).count() == 0


@given(st.lists(st.tuples(st.integers(0, 59), st.integers(1, 9)), min_size=1, max_size=40), st.integers(1, 13))
def test_replay_from_a_checkpoint_equals_starting_anew(records, stride):
    one, anew = Ledger(60, stride), Ledger(60, stride)
    one.replay(0)
    for slot, size in records:
        one.put(slot, 1, Decimal(size), Decimal(0))
        one.replay(slot)
        anew.put(slot, 1, Decimal(size), Decimal(0))
    anew.replay(0)
    assert one.marks == anew.marks and one.total[1] == sum(s for _, s in records)
    whole, run = one.total[1], 0
    for slot in range(60):
        run += sum(s for t, s in records if t == slot)
        if 2 * run >= whole:
            assert one.half() == slot
            break


def test_first_arrival_of_a_record(spark):
    records = spark.createDataFrame([("t", "r1", 5), ("t", "r2", 5), ("u", "none", 5), ("v", "r3", 5)], "uid string, run string, x int")
    runs = spark.createDataFrame([("r1", 9), ("r1", 7), ("r2", 8), ("r3", None)], "id string, at long")
    assert [tuple(r) for r in first_arrivals(records, "uid", "run", runs, "id", "at", ["x"]).collect()] == [("t", 5, 7)]
    assert Lateness().cut_off == 24 * HOUR
