from pyspark.sql import functions as F

from lodeweave.operators.history import Attribute, attribute_history, attribute_intervals, change_log, observations
from lodeweave.operators.merge import append_versions


def _attributes():
    return [Attribute("content", F.col("c")), Attribute("status", F.lower(F.trim("s")), keeps_last=True)]


def _history(spark, data, **kw):
    df = spark.createDataFrame(data, "k string, t long, c string, s string, value string, at_us string")
    return {tuple(r) for r in attribute_history(df, ["k"], F.col("t"), _attributes(), **kw).collect()}


def test_splits_at_the_union_of_boundaries_and_joins_equal_neighbours(spark):
    rows = [("m", t, c, s, "x", "y") for t, c, s in [(1, "A", "Open"), (2, "A", " open "), (3, "A", None), (4, "B", None), (5, "B", "closed"), (6, "A", "CLOSED")]]
    want = {("m", 1, 4, "A", "open"), ("m", 4, 5, "B", "open"), ("m", 5, 6, "B", "closed"), ("m", 6, None, "A", "closed")}
    assert _history(spark, rows) == want
    assert _history(spark, rows[::-1] + rows) == want  # order and repetition don't matter


def test_a_status_reported_later_begins_a_period(spark):
    assert _history(spark, [("m", 1, "A", None, "", ""), ("m", 2, "A", "open", "", "")]) == {("m", 1, 2, "A", None), ("m", 2, None, "A", "open")}


def test_nulls_ties_and_empty(spark):
    rows = [(None, 1, "A", None, "", ""), (None, None, "B", None, "", ""), ("t", 1, "A", None, "", ""), ("t", 1, "B", None, "", ""), ("n", 1, None, None, "", ""), ("n", 2, "A", None, "", "")]
    assert _history(spark, rows) == {(None, 1, None, "A", None), ("t", 1, None, "B", None), ("n", 1, 2, None, None), ("n", 2, None, "A", None)}
    # one whole row counts, and a status it doesn't report comes from another of the same time
    rows = [("w", 1, "A", "zzz", "", ""), ("w", 1, "B", "open", "", ""), ("r", 1, "A", "open", "", ""), ("r", 1, "B", None, "", "")]
    assert _history(spark, rows) == {("w", 1, None, "B", "open"), ("r", 1, None, "B", "open")}
    df = spark.createDataFrame([], "k string, t long, c string, s string")
    assert attribute_history(df, ["k"], F.col("t"), _attributes()).count() == 0


def test_cut_keys_give_the_same(spark):
    rows = [("hot" if i % 4 else f"k{i % 8}", i, "AB"[(i // 5) % 2], ["x", None, "y"][i % 3], "", "") for i in range(400)]
    assert _history(spark, rows, rows=25) == _history(spark, rows)


def test_every_attribute_has_its_own_intervals(spark):
    df = spark.createDataFrame([("m", 1, "A", "x"), ("m", 2, "B", "x"), ("m", 3, "B", "y")], "k string, t long, c string, s string")
    a = _attributes()
    got = {tuple(r) for r in attribute_intervals(change_log(observations(df, ["k"], F.col("t"), a), ["k"], a), ["k"]).select("attribute", "valid_from_us", "valid_to_us", "value").collect()}
    assert got == {("content", 1, 2, "A"), ("content", 2, None, "B"), ("status", 1, 3, "x"), ("status", 3, None, "y")}


def test_versions_keep_a_state_that_returns(spark):
    df = spark.createDataFrame([("k", 1, "A"), ("k", 2, "A"), ("k", 3, "B"), ("k", 4, "A")], "k string, t long, d string")
    assert sorted(tuple(r) for r in append_versions(df, ["k"], "t", "d").collect()) == [("k", 1, "A"), ("k", 3, "B"), ("k", 4, "A")]
