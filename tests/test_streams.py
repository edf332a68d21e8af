import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave.operators.late import MINUTE, Ledger, period_totals
from lodeweave.session import SharedPath
from lodeweave.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)


def _files(spark, folder, parts, schema):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i:03d}")
    return spark.createDataFrame([], schema)


def test_records_once_across_overlapping_reads(spark, tmp_path):
    at = [T0 + dt.timedelta(seconds=i) for i in range(6)]
    like = _files(spark, tmp_path / "in", [[("a", at[0]), ("b", at[1])], [("b", at[1]), ("c", at[2])], [("c", at[2]), ("d", at[3])]], "uid string, t timestamp")
    stream = J.file_stream(spark, str(tmp_path / "in"), like)
    got = J.run_all(J.distinct_records(stream, ["uid"], "t", "1 hour"), str(tmp_path / "out"))
    assert sorted(r.uid for r in got.collect()) == ["a", "b", "c", "d"]
    assert J.after_floor(spark.createDataFrame([(at[0],), (at[5],)], "t timestamp"), F.col("t"), F.lit(at[5]), "2 seconds").count() == 1


def test_current_state_equals_batch_and_repeats_harmlessly(spark, tmp_path):
    rng = random.Random(2)
    parts = [[(rng.choice("abc"), rng.randrange(100), i, rng.randrange(9)) for i in range(n * 10, n * 10 + 10)] for n in range(4)]
    like = _files(spark, tmp_path / "in", parts, "k string, seen int, first int, v int")
    state = J.CurrentState(spark, str(tmp_path / "out"), like.schema, ["k"], "seen", first="first", ties=["v"])
    J.run_all(J.file_stream(spark, str(tmp_path / "in"), like), str(tmp_path / "out"), each=state.merge)
    want = {}
    for k, seen, first, v in (r for p in parts for r in p):
        old = want.get(k)
        want[k] = (seen, first, v) if old is None else (*max((old[0], old[2]), (seen, v))[:1], min(old[1], first), max((old[0], old[2]), (seen, v))[1])
    shown = lambda: {r.k: (r.seen, r["first"], r.v) for r in state.table().collect()}
    assert shown() == want
    state.merge(spark.createDataFrame(parts[-1], like.schema), 3)
    assert shown() == want


def test_current_state_goes_on_after_a_restart(spark, tmp_path):
    out = str(tmp_path / "out")
    make = lambda: J.CurrentState(spark, out, like.schema, ["k"], "seen", buckets=4)
    like = _files(spark, tmp_path / "in", [[("a", 1), ("b", 1)], [("c", 2)]], "k string, seen int")
    J.run_all(J.file_stream(spark, str(tmp_path / "in"), like), out, each=make().merge)
    spark.createDataFrame([("a", 9), (None, 3)], like.schema).coalesce(1).write.parquet(str(tmp_path / "in" / "009"))
    J.run_all(J.file_stream(spark, str(tmp_path / "in"), like), out, each=make().merge)
    want = {("a", 9), ("b", 1), ("c", 2), (None, 3)}
    assert {tuple(r) for r in make().table().collect()} == want
    # a batch that ended half-written doesn't count, and is repeated
    SharedPath(spark, f"{out}/state/batch=2/_SUCCESS").delete()
    assert {tuple(r) for r in make().table().collect()} == {("a", 1), ("b", 1), ("c", 2)}
    make().merge(spark.createDataFrame([("a", 9), (None, 3)], like.schema), 2)
    assert {tuple(r) for r in make().table().collect()} == want


def test_first_records_go_on_after_a_restart(spark, tmp_path):
    make = lambda: J.FirstRecords(spark, str(tmp_path), T.StructType.fromDDL("k string, v int"), ["k"], F.col("v"))
    for n, rows in enumerate([[("a", 1), ("b", 2)], [("a", 0), ("c", 3), ("c", 4)], [("b", 0)]]):
        make().merge(spark.createDataFrame(rows, "k string, v int"), n)
    assert {tuple(r) for r in make().table().collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_only_changes_also_after_a_restart(spark, tmp_path):
    seen, skipped = [], 0
    for n, v in enumerate([1, 1, 2, 2, 1, None, None]):
        only = J.OnlyChanges(spark, str(tmp_path), F.max("v"), lambda b, n: seen.append(n))
        only(spark.createDataFrame([(v,)], "v int"), n)
        skipped += only.skipped
    assert seen == [0, 2, 4, 5] and skipped == 3
    J.OnlyChanges(spark, str(tmp_path), F.max("v"), lambda b, n: seen.append(n))(spark.createDataFrame([(None,)], "v int"), 6)
    assert seen == [0, 2, 4, 5]  # the repeated batch is held against the one before it


def test_late_totals_equal_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for _ in range(150):
        event = T0 + dt.timedelta(minutes=rng.randrange(180))
        rows.append((rng.choice("ab"), event, event + dt.timedelta(minutes=rng.choice([0, 5, 90, 300, 1700])), Decimal(rng.randrange(9)), Decimal(rng.randrange(9))))
    rows.sort(key=lambda r: r[2])
    like = _files(spark, tmp_path / "in", [rows[i : i + 50] for i in range(0, 150, 50)], "k string, e timestamp, a timestamp, s decimal(18,8), w decimal(18,8)")
    stream = J.late_totals(J.file_stream(spark, str(tmp_path / "in"), like).withWatermark("a", "2 days"), ["k"], "e", "a", "s", "w")
    last = {}

    def keep(batch, number):
        for r in batch.collect():
            last[r.k, r.period_us] = (r.n, Decimal(r["size"]), Decimal(r.worth), r.n_cut_off)

    J.run_all(stream, str(tmp_path / "out"), each=keep, mode="update")
    df = spark.createDataFrame(rows, like.schema).withColumns({"e": F.unix_micros("e"), "a": F.unix_micros("a")})
    batch = {(r.k, r.period_us): (r.n, r["size"], r.worth, r.n_cut_off) for r in period_totals(df, ["k"], "e", "a", F.col("s"), F.col("w")).collect()}
    assert last == batch and MINUTE == 60_000_000


def test_a_dumped_ledger_replays_only_the_suffix():
    ledger = Ledger(60, 8)
    for slot in range(60):
        ledger.put(slot, 1, Decimal(slot), Decimal(1))
    ledger.replay(0)
    back = Ledger.load(json.loads(json.dumps(ledger.dump())), 60, 8)
    assert back.total == ledger.total and back.replayed == 0
    back.put(50, 1, Decimal(7), Decimal(1))
    back.replay(50)
    assert back.total == (61, Decimal(sum(range(60)) + 7), Decimal(61)) and back.replayed == 12


def test_late_totals_stay_when_records_come_after_the_state_is_settled(spark, tmp_path):
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    rows = [("a", at(5), at(6), Decimal(3), Decimal(4)), ("a", at(7), at(200), Decimal(1), Decimal(1))]
    rows += [("b", at(60 * h), at(60 * h), Decimal(1), Decimal(1)) for h in (40, 45)]  # the watermark passes the first hour's cut-off
    rows += [("a", at(9), at(60 * 46), Decimal(8), Decimal(8)), ("b", at(60 * 50), at(60 * 50), Decimal(1), Decimal(1)), ("a", at(11), at(60 * 51), Decimal(8), Decimal(8)), ("c", at(11), at(60 * 52), Decimal(8), Decimal(8))]
    like = _files(spark, tmp_path / "in", [[r] for r in rows], "k string, e timestamp, a timestamp, s decimal(18,8), w decimal(18,8)")
    stream = J.late_totals(J.file_stream(spark, str(tmp_path / "in"), like).withWatermark("a", "1 hour"), ["k"], "e", "a", "s", "w")
    last = {}

    def keep(batch, number):
        for r in batch.collect():
            last[r.k, r.period_us] = (r.revision, r.n, Decimal(r["size"]), Decimal(r.worth), r.n_cut_off)

    J.run_all(stream, str(tmp_path / "out"), each=keep, mode="update")
    df = spark.createDataFrame(rows, like.schema).withColumns({"e": F.unix_micros("e"), "a": F.unix_micros("a")})
    batch = {(r.k, r.period_us): (r.revision, r.n, r["size"], r.worth, r.n_cut_off) for r in period_totals(df, ["k"], "e", "a", F.col("s"), F.col("w")).collect()}
    assert last == batch and (1, 2, 4, 5, 2) in last.values()


def test_trades_of_any_span_are_kept_over_batches(spark, tmp_path, monkeypatch):
    from lodeweave.plans import reference

    at = lambda days: T0 + dt.timedelta(days=days)
    parts = [[("new", "m", at(200))], [("old", "m", at(1)), ("new", "m", at(200))], [("older", "m", at(0)), ("old", "m", at(1)), ("old", "m", at(1))]]
    for rows in parts:
        spark.createDataFrame(rows, "trade_uid string, market_id string, traded_at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/polymarket_trades.parquet")
    monkeypatch.setattr(J.FirstRecords, "__init__", lambda self, *a, kept=J.FirstRecords.__init__: kept(self, *a, buckets=2))
    assert sorted(r.trade_uid for r in reference.stream_trades_dedupe(spark, str(tmp_path)).collect()) == ["new", "old", "older"]
