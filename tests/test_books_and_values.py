import datetime as dt
import uuid
from decimal import Decimal
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lodeweave.functions import text as X
from lodeweave.functions import values as V
from lodeweave.operators import books as B
from lodeweave.operators.events import Rule, bucket, labelled

LADDER = "array<struct<price:string,size:string>>"


def test_books(spark):
    bids = [("0.40", "100"), ("0.50", "200"), ("bad", "1"), ("0.30", "0"), ("1.2", "5"), (None, "3"), ("0.50", "10")]
    df = spark.createDataFrame([(1, bids, [("0.60", "100")]), (2, [], None)], f"id int, bids {LADDER}, asks {LADDER}")
    one, two = B.normalize_books(df, "bids", "asks", F.lit(100)).orderBy("id").collect()
    assert (one.best_bid, one.best_ask, one.midpoint, one.spread) == (D("0.5"), D("0.6"), D("0.55"), D("0.1"))
    assert one.bid_total == D(145) and [tuple(x) for x in one.bid_levels] == [(D("0.5"), D(200))] and one.bid_cut and not one.ask_cut
    assert two.best_bid is None and two.midpoint is None and two.bid_total == 0 and two.bid_levels == []
    swept = {r.depth: (r.n_levels, r.captured) for r in B.depth_sweep(df.where("id = 1"), B.levels(F.col("bids"), True), [100.0, 104.0, 1000.0]).collect()}
    assert swept == {D(100): (1, D(100)), D(104): (2, D(105)), D(1000): (3, D(145))}
    other = df.where("id = 1").select(B.levels(B.complement(F.col("bids")), False, below_one=True).alias("a")).first().a
    assert [x.price for x in other] == [D("0.5"), D("0.5"), D("0.6")]


def test_values(spark):
    row = spark.range(1).select(
        V.exact(F.lit(" 130.00 "), "decimal(18,2)").alias("d"), V.exact(F.lit("NaN")).alias("nan"), V.name_uuid(str(uuid.NAMESPACE_DNS), F.lit("é")).alias("u"),
        V.canonical_json(b=F.lit(None).cast("int"), a=F.lit("x")).alias("j"), V.season(F.lit("2024-02-28").cast("date")).alias("s"), V.host(F.lit("https://A.b/c")).alias("h"), V.host(F.lit("::")).alias("bad"),
        V.epoch_time(F.lit("1700000000"), F.lit(None)).alias("t1"), V.epoch_time(F.lit("1700000000000"), F.lit(None)).alias("t2"), V.epoch_time(F.lit(" "), F.lit("2020-01-01").cast("timestamp")).alias("t3"), V.iso_time(F.lit("2024-01-01T00:00:00Z")).alias("t4"), V.iso_time(F.lit("soon")).alias("t5"),
        F.array(*[V.sole_winner(F.lit(s), V.json_list(F.lit(p))) for s, p in [("resolved", '["0","1"]'), ("resolved", '["1","1"]'), ("open", '["0","1"]'), ("resolved", '["x","1"]'), ("resolved", "no list")]]).alias("w"),
    ).first()
    assert row.d == D("130.00") and row.nan is None and row.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, "é")) and row.j == '{"a":"x","b":null}' and row.s == 2023
    assert row.h == "a.b" and row.bad is None and row.t1 == row.t2 == dt.datetime(2023, 11, 14, 22, 13, 20) and row.t3.year == 2020 and row.t4.year == 2024 and row.t5 is None
    assert row.w == [1, None, None, None, None]


def test_text(spark):
    assert X.name_form("  D.J. Moore Jr. ") == "dj moore jr" and X.name_form("O’Neil  ﬁx") == "o'neil fix" and X.name_form(None) is None and X.name_form("Straße") == "strasse"
    # initials: only the dot of a pair at the end of a word is joined
    assert X.name_form("J.K.L. Dobbins") == "j kl dobbins" and X.name_form("T.J.Watt") == "t j watt" and X.name_form("A. B. Cee") == "a b cee"
    texts = ["Player AB", "NO", "no", "Someone  ELSE.", "  ", None, "Ann", "yes", "No listed player", "Field", "Player ABC"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.placeholder(F.col("t"))).collect()] == ["placeholder", None, "generic", "generic", None, None, None, "generic", "generic", None, None]
    assert [r[0] for r in spark.createDataFrame([("ann lee jr",), ("lee iii jr",), ("jr walker",), ("v",), ("ann",)], "n string").select(X.without_suffixes(F.col("n"))).collect()] == ["ann lee", "lee", "jr walker", "", "ann"]
    df = spark.createDataFrame([("Player AB", "a", "b"), ("NO", "abcd", "bcde"), ("no", None, "x"), ("Any other", "", ""), ("  ", "x", "x"), (None, "x", "y"), ("Ann", "x", "y")], "t string, a string, b string")
    assert [r[0] for r in df.select(X.ratio("a", "b")).collect()] == [0.0, 0.75, None, 1.0, 1.0, 0.0, 0.0]
    assert df.select(X.normalize_name("t")).collect()[0][0] == "player ab"
    found = spark.range(1).select(X.has_word(F.lit("The TRADE's on"), ["trade"]).alias("a"), X.has_word(F.lit("trader"), ["trade"]).alias("b"), X.excerpt(F.lit("one\nhere Ann is\nend"), F.lit("ann")).alias("c"), X.excerpt(F.lit("x"), F.lit("ann")).alias("d"),
                                  X.article_urls(F.array(F.lit("https://t.co/1"), F.lit("https://a.b/1"), F.lit("https://a.b/1"), F.lit("bad")), ["t.co"]).alias("u"), X.names_agree(F.lit("al roe jr"), F.lit("ann roe"), F.lit(0.0)).alias("n"), X.names_agree(F.lit("al roe"), F.lit("al row"), F.lit(0.5)).alias("m")).first()
    assert (found.a, found.b, found.c, found.d, found.u, found.n, found.m) == (True, False, "here Ann is", None, ["https://a.b/1"], True, False)


def test_articles():
    page = "<html><head><title>T</title><script>x</script></head><body><nav><p>menu</p></nav><article><h1>Head</h1><p>One <b>two</b><br>three</p><ul><li>four</ul></article><p>after</p></body></html>"
    assert X.article(page) == "Head\nOne twothree\nfour" and X.article("<p>a</p><p> b  c</p>") == "a\nb c" and X.article("plain  text") == "plain text"
    assert X.article(None) is None and X.article("") == "" and len(X.article("<p>" + "x" * 99_999)) == 12_000


def _bucket(delta, count, worth, spread, bid, ask, rule):
    """The rule by its description, with Python's decimals."""
    dec = lambda x: None if x is None else Decimal(str(x))
    delta, worth, spread, bid, ask = map(dec, (delta, worth, spread, bid, ask))
    least = rule.cents / 100
    if rule.book_quality:
        if spread is None or spread > rule.most_spread_cents / 100 or bid is None or ask is None or min(bid, ask) < rule.least_depth:
            return None
        least = max(least, spread / 2)
    if delta is None:
        return None
    if abs(delta) < least:
        return "flat"
    if rule.trade_confirmed:
        if count is None:
            return None
        if count < rule.min_trades or (worth or 0) < rule.min_worth:
            return "flat"
    return "up" if delta > 0 else "down"


def test_buckets_in_all_cases(spark):
    import itertools

    cases = list(itertools.product([None, 0.05, -0.05, 0.02, 0.019, 0.0], [None, 1, 2], [None, 49.99, 50.0], [None, 0.0, 0.05, 0.06], [None, 100.0, 99.0], [100.0, None]))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, d double, n int, w double, s double, b double, a double")
    cast = [F.col(c).cast("decimal(18,8)") for c in ("d", "s", "b", "a")]
    rules = [Rule(trade_confirmed=t, book_quality=q) for t in (True, False) for q in (True, False)]
    for rule in rules:
        got = dict(df.select("i", bucket(rule, *cast, F.col("n"), F.col("w").cast("decimal(18,8)"))).collect())
        assert got == {i: _bucket(*c, rule) for i, c in enumerate(cases)}, rule
    assert [r.column for r in rules] == ["target_plus_30m_2c_tc", "target_plus_30m_2c_tc_nobook", "target_plus_30m_2c_raw", "target_plus_30m_2c_raw_nobook"] and Rule("plus_2h", Decimal("0.5")).column == "target_plus_2h_0p5c_tc"
    rows = df.withColumn("delta_plus_30m", cast[0])
    assert labelled(rows, rules[3:]).where("target_plus_30m_2c_raw_nobook = 'up'").count() > 0
    with pytest.raises(ValueError, match="spread"):
        labelled(rows, rules[:1])


def test_unreadable_levels_reject_a_book_only_where_asked(spark):
    ladder = "array<struct<price:string,size:string>>"
    rows = [("ok", [("0.5", "1")], []), ("bad", [("0.5", "1"), ("x", "1")], None), ("out", [("1.5", "1")], []), ("none", None, None)]
    df = spark.createDataFrame(rows, f"k string, b {ladder}, a {ladder}")
    assert {r.k for r in B.normalize_books(df, "b", "a", F.lit(10), strict=True).collect()} == {"ok", "none"} and B.normalize_books(df, "b", "a", F.lit(10)).count() == 4


def test_article_query_keeps_long_pages_and_plain_texts(spark, tmp_path):
    from lodeweave.plans import reference

    texts = ["<p>" + "x" * 20_000 + "</p><p>end</p>", " a  <b\nc ", None, "z " * 9_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.article for r in reference.article_text_extract(spark, str(tmp_path)).collect()}
    assert got == {0: "x" * 20_000 + "\nend", 1: "a <b c", 3: ("z " * 9_000).strip()}
