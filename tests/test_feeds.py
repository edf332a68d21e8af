import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lodeweave.operators import merge as M
from lodeweave.operators import queue as Q
from lodeweave.sources import feeds as S


def _rows(spark, name="s", version=1):
    at = dt.datetime(2024, 1, 2, 3, 4)
    return spark.createDataFrame([(name, version, "p", "src", "kind", f"r{i}", at + dt.timedelta(days=i), [(str(i), None)], "derived") for i in range(3)], S.HEADER + ", records array<struct<id:string,v:string>>, _derived string")


def test_envelopes_round_trip_and_prune(spark, tmp_path):
    S.write_envelopes(_rows(spark), str(tmp_path / "raw"))
    kept = S.read_envelopes(spark, str(tmp_path / "raw"), "array<struct<id:string,v:string>>", "s", 1, start="2024-01-03")
    assert sorted((r.ingest_run_id, r.records[0].id, r.header_provider) for r in kept.collect()) == [("r1", "1", "p"), ("r2", "2", "p")]
    assert "PartitionFilters: [isnotnull(date" in kept._jdf.queryExecution().toString() and (tmp_path / "raw/provider=p/source=src/object=kind/schema=v1/date=2024-01-02/hour=03").exists()
    with pytest.raises(Exception, match="unexpected envelope"):
        S.read_envelopes(spark, str(tmp_path / "raw"), "array<struct<id:string,v:string>>", "s", 2).collect()


def test_envelope_bytes():
    data = S.encode_envelope({"schema_name": "s", "schema_version": 1}, [{"b": 1, "a": "é"}])
    assert data == S.encode_envelope({"schema_version": 1, "schema_name": "s"}, [{"a": "é", "b": 1}])
    assert S.decode_envelope(data, "s", 1)["record_count"] == 1
    with pytest.raises(ValueError):
        S.decode_envelope(json.dumps({"schema_name": "t", "schema_version": 1}).encode(), "s", 1)


def test_registry_lines_and_newest(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("id,name\n01,Ann\n", encoding="utf-8-sig")
    assert [tuple(r) for r in S.read_registry(spark, str(path)).collect()] == [("01", "Ann")]
    with pytest.raises(ValueError):
        S.read_registry(spark, str(path), "0" * 64)
    S.write_lines(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "l"))
    assert "".join(p.read_text() for p in (tmp_path / "l").glob("part*")).strip() == '{"a":null,"b":1}'
    (tmp_path / "bad.json").write_text('{"b": "x"}\n')
    with pytest.raises(Exception):
        S.read_lines(spark, str(tmp_path / "bad.json"), "b int").collect()
    for day in (1, 2):
        spark.range(day).write.parquet(str(tmp_path / f"export_{day}.parquet"))
    assert S.newest(spark, str(tmp_path / "export_*.parquet")).count() == 2


def test_paged_feed(spark, tmp_path):
    for name, cursor, page in [("a", "first", {"records": [{"i": 1}], "next": "x"}), ("a", "x", {"records": [{"i": 2}]}), ("b", "first", {"records": []}), ("c", "first", {"records": [], "next": "y"}), ("c", "y", {"records": [], "next": "y"})]:
        (tmp_path / f"{name}-{cursor}.json").write_text(json.dumps(page))
    spark.dataSource.register(S.PagedFeed)
    read = lambda **kw: [tuple(r) for r in spark.read.format("paged_feed").options(path=str(tmp_path), **kw).load().collect()]
    assert read(listings="a,b") == [("a", '{"i": 1}'), ("a", '{"i": 2}')]
    with pytest.raises(Exception, match="came again"):
        read(listings="c")
    with pytest.raises(Exception, match="more than 1 pages"):
        read(listings="a", most="1")


def test_packing_and_retries():
    assert S.pack_terms(["aa", "bb", "cc"], 9, tail="!") == ["aa OR bb!", "cc!"] and S.retry_delay(2, None, 0.5) == 4.5 and S.retry_delay(9, 40, 0.5) == 40
    with pytest.raises(ValueError):
        S.pack_terms(["x" * 9], 5)


def test_queue(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    jobs = spark.createDataFrame([(1, "pending", 1, 0, None, 0), (2, "leased", 5, 0, -1, 1), (3, "leased", 9, 0, 60, 1), (4, "pending", 9, 60, None, 0), (5, "done", 9, 0, None, 0), (6, "pending", 1, -60, None, 3)], "job_id int, status string, priority int, due int, lease int, attempts int")
    at = lambda c: F.timestamp_seconds(F.unix_timestamp(now) + F.col(c))
    jobs = jobs.select("job_id", "status", "priority", at("due").alias("available_at"), now.alias("created_at"), at("lease").alias("leased_until"), F.lit(None).cast("string").alias("owner"), "attempts", F.lit(3).alias("max_attempts"))
    taken = {r.job_id: (r.status, r.attempts, r.owner) for r in Q.claim(jobs, now, now, "w", 2).collect()}
    assert taken[2] == ("leased", 2, "w") and taken[6] == ("leased", 4, "w") and taken[1] == ("pending", 0, None) and taken[3] == ("leased", 1, None)
    failed = {r.job_id: (r.status, r.available_at.second) for r in Q.fail(jobs, F.col("job_id").isin(2, 6), now).collect()}
    assert failed[2] == ("pending", 1) and failed[6][0] == "dead" and failed[5][0] == "done"


def test_retries_chunks_and_reports(spark, tmp_path):
    answers, slept = [{"status": 429, "retry_after": 5}, {"status": 503}, {"status": 200, "body": "x"}], []
    assert S.fetched(lambda: answers.pop(0), 3, slept.append, lambda: 0.0)["body"] == "x" and slept == [5, 2.0]
    with pytest.raises(RuntimeError, match="404 after 1"):
        S.fetched(lambda: {"status": 404}, 3, slept.append, lambda: 0.0)
    with pytest.raises(RuntimeError, match="500 after 2"):
        S.fetched(lambda: {"status": 500}, 2, slept.append, lambda: 0.0)
    assert S.chunks([1, 2, 3, 4, 5], 2) == [[1, 2], [3, 4], [5]] and S.chunks([], 2) == []
    assert S.query_fingerprint(a=1, b=["x"]) == S.query_fingerprint(b=["x"], a=1) != S.query_fingerprint(a=2, b=["x"])
    S.write_report(spark, f"file://{tmp_path}/r.json", {"b": 1, "a": "é"})
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": "é", "b": 1}


def test_outbox_and_cursors(spark):
    space, now = "6ba7b814-9dad-11d1-80b4-00c04fd430c8", F.lit("2024-01-10").cast("timestamp")
    shape = "job_id string, job_type string, idempotency_key string, payload string, status string, priority int, attempts int, max_attempts int, available_at timestamp, created_at timestamp, owner string"
    wanted = spark.createDataFrame([("t", "k1", "{}", 0, 5), ("t", "k1", "{}", 9, 5), ("t", "k2", "{}", 0, 5)], "job_type string, idempotency_key string, payload string, priority int, max_attempts int")
    once = Q.enqueue(spark.createDataFrame([], shape), wanted, space, now)
    assert {(r.idempotency_key, r.priority, r.status, r.owner) for r in once.collect()} == {("k1", 9, "pending", None), ("k2", 0, "pending", None)}
    assert Q.enqueue(once, wanted, space, now).count() == 2
    seeded = Q.seed(once, spark.createDataFrame([("k2",), ("k3",), ("k3",), ("k4",)], "k string"), spark.createDataFrame([("k4",)], "k string"), "t", "k", space, now)
    assert sorted(r.idempotency_key for r in seeded.collect()) == ["k1", "k2", "k3"]
    at = dt.datetime(2024, 1, 9)
    rows = [("a", "1", "q", at), ("b", "1", "other", at), ("c", "1", "q", dt.datetime(2023, 1, 1)), ("d", None, "q", at), ("e", "1", "q", None)]
    got = {r.n: (r.since, r.reason) for r in Q.cursor_choice(spark.createDataFrame(rows, "n string, since_id string, query_fingerprint string, updated_at timestamp"), F.lit("q"), now).collect()}
    assert got == {"a": ("1", None), "b": (None, "query_changed"), "c": (None, "checkpoint_stale_or_legacy"), "d": (None, "checkpoint_missing"), "e": (None, "checkpoint_stale_or_legacy")}
    cursors = spark.createDataFrame([("s", 5), (None, 1)], "k string, t int")
    assert M.checkpoint(cursors, k="s") == {"k": "s", "t": 5} and M.checkpoint(cursors, k=None)["t"] == 1 and M.checkpoint(cursors, k="z") is None
    moved = {(r.k, r.t) for r in M.last_poll(cursors, spark.createDataFrame([("s", 2), ("s", 1), ("n", 3)], "k string, t int"), ["k"], "t").collect()}
    assert moved == {("s", 2), (None, 1), ("n", 3)}


def test_scans_of_posts_ids_and_trades():
    posts = {None: {"data": [2], "next_token": "a"}, "a": {"data": [1]}}
    assert [p["data"] for p in S.found_posts(posts.get, 5)] == [[2], [1]]
    with pytest.raises(ValueError, match="more than 1"):
        list(S.found_posts(posts.get, 1))
    asked = []
    found, gone = S.looked_up_by_id(lambda ids: asked.append(ids) or [{"id": i} for i in reversed(ids) if i != "c"], ["b", "c", "a", "b"], 2)
    assert [f["id"] for f in found] == ["b", "a"] and gone == ["c"] and asked == [["b", "c"], ["a"]]
    with pytest.raises(ValueError):
        S.looked_up_by_id(lambda ids: [], ["x"], 2)
    trades = {("m",): [{"uid": f"t{i}", "timestamp": 100 - i} for i in range(10)], ("n",): [{"uid": f"u{i}", "timestamp": 200 - i} for i in range(10)]}
    calls = []
    rows, cut = S.recent_trades(lambda some, offset: calls.append((some[0], offset)) or trades[tuple(some)][offset : offset + 3], ["m", "n"], 95, 1, 3, 3)
    assert [r["uid"] for r in rows] == ["t5", "t4", "t3", "t2", "t1", "t0"] + [f"u{i}" for i in range(8, -1, -1)] and cut == [["n"]]
    assert calls == [("m", 0), ("m", 3), ("m", 6), ("n", 0), ("n", 3), ("n", 6)]
