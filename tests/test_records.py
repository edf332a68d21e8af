import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from lodeweave.operators import registry as R
from lodeweave.operators.registry import build_registry
from lodeweave.sources import records as S


def test_posts_edges_and_assets(spark):
    one = {"data": [{"id": "1", "text": "a", "author_id": "u", "created_at": "2024-01-01T00:00:00Z", "attachments": {"media_keys": ["m"]}, "referenced_tweets": [{"type": "reposted", "id": "2"}, {"type": "quoted", "id": "9"}]}], "includes": {"users": [{"id": "u", "username": "old"}], "tweets": [{"id": "2", "text": "referred"}]}}
    two = {"data": [{"id": "2", "text": "found"}, {"id": "1", "text": "again"}, {"text": "no id"}], "includes": {"users": [{"id": "u", "username": "new"}], "media": [{"media_key": "m", "type": "video", "preview_image_url": "p", "variants": [{"bit_rate": 1, "content_type": "video/mp4", "url": "low"}, {"bit_rate": 5, "content_type": "video/mp4", "url": "high"}, {"content_type": "x", "url": "n"}]}]}}
    pages = spark.createDataFrame([(0, json.dumps(one)), (1, json.dumps(two)), (2, "not json"), (3, None)], "seq int, page string")
    posts, edges = S.posts_from_pages(pages)
    got = {r.post_id: r for r in posts.collect()}
    assert {k: (r.text, r.author_username, r.matched) for k, r in got.items()} == {"1": ("a", "new", True), "2": ("found", None, True)}
    assert got["1"].published_at == dt.datetime(2024, 1, 1) and got["1"].media[0].asset.url == "high" and got["2"].published_at is None
    assert {tuple(r) for r in edges.collect()} == {("1", "2", "reposted", True), ("1", "9", "quoted", False)}


def test_markets_and_present_fields(spark):
    raw = [json.dumps({"id": "1", "question": "q", "closed": True, "outcomes": '["Yes","No"]', "outcomePrices": '["0","1"]', "clobTokenIds": '["t1","t2"]', "status": "resolved"}), json.dumps({"id": "2", "question": "q", "outcomes": "bad", "clobTokenIds": '["t3"]'}), json.dumps({"id": "3"}), "bad", None]
    df = spark.createDataFrame([(r,) for r in raw], "j string")
    markets, tokens = S.markets_from_json(df, "j")
    assert {(r.market_id, r.winner) for r in markets.collect()} == {("1", 1), ("2", None)}
    assert {tuple(r) for r in tokens.collect()} == {("1", 0, "t1", "Yes"), ("1", 1, "t2", "No"), ("2", 0, "t3", None)}
    kept = spark.createDataFrame([('{"b":null,"a":1,"z":2}',), ('{"a":1}',)], "j string").select(S.present_fields(F.col("j"), ["a", "b", "c"])).collect()
    assert [r[0] for r in kept] == ['{"a":1,"b":null}', '{"a":1}']


def test_trades_are_read_or_rejected_with_a_reason(spark):
    rows = [("u", "BUY", "1700000000", "0.014165", "5"), ("", "BUY", "1", "1", "1"), ("u", "buy", "1", "1", "1"), ("u", "SELL", "soon", "1", "1"), ("u", "SELL", "1", "NaN", "1"), ("u", "SELL", "1", "1", "-1"), (None, None, None, None, None)]
    good, bad = S.readable_trades(spark.createDataFrame(rows, "uid string, side string, seconds string, price string, size string"))
    assert [(r.side, str(r.price)) for r in good.collect()] == [("BUY", "0.01416500")] and sorted(r.reason for r in bad.collect()) == ["price", "side", "size", "time", "uid", "uid"]


def test_samples_and_evidence(spark):
    df = spark.createDataFrame([(100.0, "text", " "), (None, None, "page"), (9999.0, "", "")], "s double, a string, b string")
    text, names = S.evidence([("post", F.col("a")), ("article", F.col("b"))])
    rows = df.select(S.sample_times(F.col("s")).alias("t"), text.alias("e"), names.alias("n")).collect()
    assert rows[0].t == [12.5, 37.5, 62.5, 87.5] and rows[1].t == [] and len(rows[2].t) == 8 and max(rows[2].t) < 300
    assert [r.e for r in rows] == ["[post]\ntext", "[article]\npage", ""] and rows[2].n == []


def test_registry(spark):
    rows = [
        ("r1", "ann lee", "2000-01-01", "x1", "y1"), ("r2", "ann lee jr", None, "x1", None), ("r3", "bob ray", None, "x1", "y3"),  # r3 shares x1 but is someone else
        ("r4", "bob ray", None, None, "y3"), ("r5", "cy", None, "x5", None), ("r6", "dee", None, "x5", None), ("r7", "eve", None, None, " "), ("r8", "ann lee", "1990-01-01", "x1", None),
    ]
    out = build_registry(spark.createDataFrame(rows, "r string, n string, b string, x string, y string"), "r", "n", "b", ["x", "y"])
    members = {}
    for m in out["members"].collect():
        members.setdefault(m.entity_id, set()).add(m.r)
    assert sorted(map(sorted, members.values())) == [["r1", "r2", "r8"], ["r3", "r4"]]  # r2 goes with both r1 and r8
    assert {(r.kind, r.identifier) for r in out["identifiers"].collect()} == {("y", "y1"), ("y", "y3")}
    assert sorted(r.reason for r in out["quarantine"].where("record in ('r5', 'r6', 'r7')").collect()) == ["identifiers shared with another entity"] * 2 + ["no identifier"]


def test_teams_and_players(spark):
    rows = [(1, "9", "OLD", "Old Bay Owls", "Owls"), (2, "9", "NBO", "North Bay Owls", "Owls"), (3, "9", "NBX", "North Bay Owls ", "Owls"), (4, " ", "X", "X", "X"), (5, "7", "SBC", "Crows", "Crows")]
    teams, aliases = R.team_entities(spark.createDataFrame(rows, "i int, team_id string, team_abbr string, team_name string, team_nick string"), spark.createDataFrame([("NBO",), ("SBC",)], "team_abbr string"), "i")
    assert {(r.team_id, r.canonical_name) for r in teams.collect()} == {("9", "North Bay Owls"), ("7", "Crows")}
    nine = teams.where("team_id = '9'").first().entity_id
    assert {(r.normalized_alias, r.alias_type) for r in aliases.where(F.col("entity_id") == nine).collect()} == {("old bay owls", "full_name"), ("north bay owls", "full_name"), ("owls", "nickname"), ("old", "abbreviation"), ("nbo", "abbreviation"), ("nbx", "abbreviation"), ("old bay", "location"), ("north bay", "location")}
    people = spark.createDataFrame([("a", "Ann Old", "1990-01-01", "2020", "XX1", "p1"), ("b", "Ann New", "", "2010", "00-2", "p1"), ("c", "Ann Mid", None, "2022", "00-1", None), ("d", "Bob", None, None, None, "p9")], "r string, n string, b string, s string, gsis_id string, pfr string")
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 2)], "r string, component int")
    got = {r.component: r for r in R.player_entities(people, groups, R.identifiers(people, "r", ["gsis_id", "pfr"]), "r", "n", "b", "s").collect()}
    # of the rows with a modern identifier none has a date of birth; the one of the last season is shown
    assert got[1].canonical_name == "Ann Mid" and got[1].n_rows == 3 and got[1].s == "2022" and got[2].canonical_name == "Bob"
    assert got[1].entity_id == str(uuid.uuid5(uuid.UUID(R.NAMESPACE), "person:00-1")) and got[2].entity_id == str(uuid.uuid5(uuid.UUID(R.NAMESPACE), "person:pfr:p9"))


def test_roster_rows_are_matched_by_any_identifier(spark):
    rows = [("1", "Ann Lee Jr.", "OWL", "x1", None), ("2", "Ann Lee", "OWL", "x1", "y2"), ("3", "Zed Other", "OWL", None, "y2"), ("4", "New One", "OWL", "x9", None), ("5", "Ann Lee", "???", "x1", None), ("6", "Ann Lee", "OWL", " ", None), ("7", "", "OWL", "x1", None)]
    rosters = spark.createDataFrame(rows, "r string, n string, t string, x string, y string")
    owners = spark.createDataFrame([("x", "x1", "ann"), ("y", "y2", "bob")], "kind string, identifier string, entity_id string")
    names = spark.createDataFrame([("ann", "ann lee"), ("bob", "bob ray")], "entity_id string, name string")
    teams = spark.createDataFrame([("OWL", "owls")], "abbreviation string, entity_id string")
    out = R.roster_match(rosters, "r", "n", "t", ["x", "y"], owners, names, teams)
    assert {r.r: (r.outcome, r.person_id) for r in out.collect()} == {"1": ("matched", "ann"), "2": ("several people", None), "3": ("other name", None), "4": ("new person", None), "5": ("unknown team", None), "6": ("no identifier", None), "7": ("other name", None)}
    players = spark.createDataFrame([("ann", 3), ("bob", 1)], "entity_id string, n_rows int")
    aliases = spark.createDataFrame([("ann", "lee"), ("bob", "lee"), ("bob", "ray")], "entity_id string, normalized_alias string")
    report = {r.metric: r.value for r in R.quality(rosters, players, rosters, out, aliases, rosters.limit(2), owners.limit(1)).collect()}
    assert len(report) == 13 and report == {
        "source_player_rows": 7, "merged_player_rows": 2, "complete_player_history": 2, "source_roster_rows": 7, "current_rostered_people": 1, "roster_only_people": 1, "roster_missing_person_source_id": 1, "roster_unknown_person_mapping": 1,
        "roster_unknown_team_mapping": 1, "source_mapping_conflicts": 3, "quarantined_records": 7, "unsafe_source_mapping_collisions": 1, "ambiguous_normalized_aliases": 1,
    }


def test_a_junk_identifier_makes_few_edges(spark):
    rows = [(f"r{i:03d}", f"{chr(97 + i % 26)}{chr(97 + i // 26)} smith", None if i == 7 else f"19{i % 50:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, "r string, n string, b string")
    owned = df.selectExpr("r", "'k' as kind", "'0' as identifier", "0 as priority")
    assert R.compatible_edges(df, owned, "r", "n", "b").count() <= 300


def test_second_platform_rows(spark):
    markets = ['{"ticker":"KXA-1-X","event_ticker":"KXA-1","title":"","status":"","floor_strike":"3.50","can_close_early":false,"volume_fp":"NaN","custom_strike":{"a":1},"close_time":"2024-01-02T03:04:05Z","close":1}', '{"ticker":"","event_ticker":"e"}', "no json", None]
    got = S.second_markets(spark.createDataFrame([(m,) for m in markets], "j string"), "j", spark.createDataFrame([("KXA",), ("KXA-1",)], "series_ticker string")).collect()
    assert len(got) == 1 and len(got[0].asDict()) >= 41
    m = got[0]
    assert (m.title, m.status, m.market_type, str(m.floor_strike), m.can_close_early, m.is_provisional, m.volume, m.series_ticker, m.custom_strike) == (None, "unknown", "binary", "3.50000000", False, None, None, "KXA-1", '{"a":1}')
    trades = ['{"trade_id":"t","ticker":"k","created_time":"2024-01-01T00:00:00Z","count_fp":"1","yes_price_dollars":"0.5","taker_outcome_side":"","taker_side":"no"}', '{"trade_id":"t","ticker":"k","created_time":"soon"}', '{"ticker":"k"}', '{"trade_id":"u","ticker":"k","created_time":"2024-01-01T00:00:00Z","count_fp":"x"}']
    good, bad = S.second_trades(spark.createDataFrame([(t,) for t in trades], "j string"), "j")
    assert [(r.taker_outcome_side, r.is_block_trade, r.no_price) for r in good.collect()] == [("no", False, None)] and sorted(r.reason for r in bad.collect()) == ["count", "id", "time"]
    both = S.new_trades(good.unionByName(good), spark.createDataFrame([("k",)], "ticker string"), F.lit("2023-01-01").cast("timestamp"))
    assert both.count() == 1 and S.new_trades(good, spark.createDataFrame([("z",)], "ticker string"), F.lit("2023-01-01").cast("timestamp")).count() == 0
    a, b = spark.createDataFrame([("x", 1), ("x", 2)], "k string, v int"), spark.createDataFrame([("x", 9), ("y", 3), ("y", 4)], "k string, v int")
    assert {tuple(r) for r in S.open_over_settled(a, b, "k", F.col("v")).collect()} == {("x", 2), ("y", 4)}
    t = spark.createDataFrame([(None, "1", "2"), ("f", "1", None), ("", None, None), (None, "1", None)], "f string, a string, b string")
    assert [r[0] for r in t.select(S.threshold(F.col("f"), F.col("a"), F.col("b"))).collect()] == ["1-2", "f", None, "1"]


def test_envelopes_books_and_index_rows(spark):
    record = "struct<token_id:string,ticker:string,midpoint:string,spread:string,bid_captured_notional:string,ask_captured_notional:string>"
    rows = [("r1", None, [("t", None, "0.5", None, "1", "2"), ("", "k", None, "0.1", None, None), ("t", None, "0.6", None, None, None)]), ("r2", None, [])]
    env = spark.createDataFrame(rows, f"ingest_run_id string, ingested_at timestamp, records array<{record}>")
    books = S.books_by_token(env)
    assert {(r.token, r.midpoint and str(r.midpoint)) for r in books.collect()} == {("t", "0.60000000"), ("k", None)}
    asked = spark.createDataFrame([("r1", "t"), ("r1", "z"), ("r2", "t"), ("r9", "t")], "ingest_run_id string, token string")
    assert {(r.ingest_run_id, r.token): r.found for r in S.looked_up(asked, books.drop("ingested_at"), env).collect()} == {("r1", "t"): "book", ("r1", "z"): "no token", ("r2", "t"): "no token", ("r9", "t"): "no envelope"}
    head = spark.createDataFrame([("a", None, "x", "news_posts"), ("b", "p", "x", "news_posts"), ("c", None, "y", "t")], "ingest_run_id string, provider string, source string, object_type string")
    assert {tuple(r) for r in S.index_row(head).collect()} == {("a", "x", "recent-search", "posts"), ("b", "p", "x", "news_posts"), ("c", "y", "y", "t")}
    kept = spark.createDataFrame([('{"b":1,"a":null,"c":{"z":1.5},"d":"s"}',), ("{}",)], "j string").select(S.present_fields(F.col("j"), ["a", "b", "c", "q"])).collect()
    assert [r[0] for r in kept] == ['{"a":null,"b":1,"c":{"z":1.5}}', "{}"]


def test_events_context_and_series(spark):
    raw = [json.dumps({"id": "1", "title": "t", "tags": [{"id": "b"}, {"id": "a"}], "markets": [{"id": "m", "question": "q"}, {"id": "x"}], "startDate": "2024-01-01T00:00:00Z"}), json.dumps({"id": "2"}), "bad", None]
    (e,) = S.events_from_json(spark.createDataFrame([(r,) for r in raw], "j string"), "j").collect()
    assert [t.id for t in e.tags] == ["a", "b"] and [m.id for m in e.markets] == ["m"] and e.closed is False and e.start_at == dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(" a ", "a", "", None, "b")], "a string, b string, c string, d string, e string")
    whole, short = (S.joined_context(*[F.col(c) for c in "abcde"], most=n) for n in (None, 3))
    assert tuple(df.select(whole, short).first()) == ("a\n\nb", "a\n\n")
    assert [r.ticker for r in S.wanted_series(spark.createDataFrame([("KXA",), ("KXA",), ("B",), (None,)], "ticker string"), ["^KXA", "^Z"]).collect()] == ["KXA"]
