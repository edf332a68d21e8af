import pytest
from pyspark.sql import functions as F

from lodeweave.functions import enrich as E


def test_providers(spark):
    E.provider("topics")(E.keyword_provider({"injury": ["hurt"], "trade": ["signed", "waived"]}))
    df = spark.createDataFrame([("He signed, hurt",), ("nothing",), (None,)], "t string")
    assert [(r.enrichment.tags, r.enrichment.main) for r in E.enrich(df, "t", "topics").collect()] == [(["injury", "trade"], "injury"), ([], None), ([], None)]
    with pytest.raises(ValueError):
        E.enrich(df, "t", "unheard of")


def test_repeated_tags(spark):
    df = spark.createDataFrame([("n", 1, "a", 0.5, ["x", "y"], "A"), ("n", 0, "a", 0.2, ["y", "z"], "a"), ("n", 2, "b", None, None, "B"), (None, 1, "a", 0.1, [], "q")], "k string, i int, s string, c double, r array<string>, shown string")
    got = {(r.k, r.s): (r.shown, r.c, r.r) for r in E.merged_tags(df, ["k"], ["i"], ["s"], ["shown"], "c", "r").collect()}
    assert got == {("n", "a"): ("a", 0.5, ["y", "z", "x"]), ("n", "b"): ("B", None, []), (None, "a"): ("q", 0.1, [])}
    assert df.select(E.unknown_refs(F.col("r"), F.array(F.lit("y"))).alias("u")).collect()[0].u == ["x"]


def test_topics_by_rules(spark):
    texts = ["Official: he is questionable (injury), traded", "Subscribe now", "nothing", None, "I think the contract could be long", "traders"]
    got = [r.e for r in spark.createDataFrame([(t,) for t in texts], "t string").select(E.tagged(F.col("t")).alias("e")).collect()]
    assert [(x.tags, x.usefulness, x.information_status) for x in got] == [(["injury_availability", "roster_transaction"], "high", "official"), (["promotional_social"], "irrelevant", "reported"), (["unrelated_other"], "irrelevant", "reported"), (["unrelated_other"], "irrelevant", "reported"), (["contract"], "medium", "rumor"), (["unrelated_other"], "irrelevant", "reported")]
    assert got[3].summary == "No usable source text." and len(E.TOPICS) == 12 and set(E.HIGH) | set(E.MEDIUM) == set(E.TOPICS)


def test_contract_types_refs_and_latest(spark):
    df = spark.createDataFrame([("Moneyline", []), (None, ["Yes", "NO"]), ("x", ["a", "b", "c"]), (None, None), ("spreads", None), ("totals", None)], "k string, o array<string>")
    assert [r[0] for r in df.select(E.contract_type(F.col("k"), F.col("o"))).collect()] == ["moneyline", "binary", "multi_candidate", "other", "spread", "total"]
    refs = lambda values: spark.range(1).select(E.checked_refs(F.array(*[F.lit(v) for v in values]), F.array(F.lit("tweet"), F.lit("page")), {"post": "tweet"}))
    assert refs(["post", "page", "tweet"]).first()[0] == ["tweet", "page"]
    with pytest.raises(Exception, match="unknown references"):
        refs(["nowhere"]).collect()
    rows = spark.createDataFrame([("n", 1, "completed", "a"), ("n", 2, "completed_with_warnings", "b"), ("n", 3, "failed", "c"), ("m", 1, None, "d")], "k string, t int, status string, s string")
    assert [(r.k, r.s) for r in E.latest_completed(rows, "k", "t").collect()] == [("n", "b")]
