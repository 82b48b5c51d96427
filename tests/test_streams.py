"""Streams over several files per trigger against the same rows in a batch."""

import datetime as dt
import glob
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import lifecycle
from millrace.operators.feature_store import FeatureGroup
from millrace.plans import ORACLES, QUERIES
from millrace.streaming import jobs
from tests.conftest import rows

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


@pytest.fixture(scope="module")
def events():
    kinds = ["view", "click", "purchase", "error"]
    # Two thirds of the rows belong to user 1.
    return [(i, START + dt.timedelta(seconds=97 * i), 1 if i % 3 else i % 9, kinds[i * i % 4], float(i % 13)) for i in range(600)]


@pytest.fixture(scope="module")
def folder(spark, events, tmp_path_factory):
    """Six files in time order."""
    path = str(tmp_path_factory.mktemp("events"))
    for k in range(6):
        spark.createDataFrame(events[100 * k : 100 * k + 100], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    return jobs.arriving(spark, folder, spark.read.parquet(folder).schema, "*.parquet", files_per_trigger=1, time="ts")


def five_minutes(df):
    return jobs.windowed(df, "ts", "15 minutes", "5 minutes", ["event_type"], "value")


def counted(events):
    want = Counter()
    for _, ts, _, kind, _ in events:
        start = START + (ts - START) // dt.timedelta(minutes=5) * dt.timedelta(minutes=5)
        want[(start.replace(tzinfo=None), kind)] += 1
    return want


def test_all_windows_come_out(spark, folder, events):
    table = spark.read.parquet(folder)
    got = jobs.finished(stream(spark, folder), table, five_minutes, "ts", "5 minutes", "w")
    assert {(r.window_start, r.event_type): r.n for r in got.collect()} == counted(events)
    closed, mark = jobs.drained(five_minutes(stream(spark, folder)), "w")
    assert mark is not None and 0 < closed.count() < got.count()
    assert jobs.dropped(got, table, "ts", "5 minutes", ["event_type"]).count() == 0


def test_files_out_of_time_order(spark, events, tmp_path):
    """Closed windows, open ones and rows that came too late are all rows."""
    path = str(tmp_path / "mixed")
    for k in (1, 4, 0, 5, 2, 3):
        spark.createDataFrame(events[100 * k : 100 * k + 100], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order of their times, which have whole seconds
    table = spark.read.parquet(path)
    got = jobs.finished(stream(spark, path), table, five_minutes, "ts", "5 minutes", "w")
    late = jobs.dropped(got, table, "ts", "5 minutes", ["event_type"])
    seen = {(r.window_start, r.event_type): r.n for r in got.collect()}
    missed = {(r.window_start, r.event_type): r.late for r in late.collect()}
    assert missed and Counter(seen) + Counter(missed) == counted(events)


def test_monitor_flags_windows(spark, folder):
    base = spark.createDataFrame([("view", 3.0), ("click", 1000.0)], "event_type string, mean double")
    got = jobs.drain(jobs.monitored(stream(spark, folder), base, "ts", "15 minutes", "1 hour", "event_type", "value"), "m").collect()
    assert got and all(r.alert == (abs((r["mean"] - r.baseline) * 100 / r.baseline) > 20) for r in got if r.baseline is not None)
    assert all(r.alert is None for r in got if r.event_type == "error") and any(r.alert for r in got)


def test_replays_fold_to_one_row(spark, folder, events):
    live = stream(spark, folder)
    copies = live.withColumn("k", F.explode(F.when(F.col("user_id") == 1, F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1))))).drop("k")
    repeat = F.explode(F.when(F.col("user_id") == 1, F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1))))
    table = spark.read.parquet(folder).withColumn("k", repeat).drop("k")
    got = jobs.finished(copies, table, lambda df: jobs.deduplicated(df, "event_id", "ts", "15 minutes", "1 hour", ["user_id"]), "ts", "1 hour", "d").collect()
    assert sorted(r.event_id for r in got) == [e[0] for e in events]
    assert all(r.copies == (3 if r.user_id == 1 else 1) for r in got)


def test_late_rows(spark, events):
    delays = {e[0]: (e[0] * 37 % 80) for e in events}
    arrived = [(i, ts, ts + dt.timedelta(minutes=delays[i])) for i, ts, *_ in events]
    df = spark.createDataFrame(arrived, "event_id bigint, ts timestamp, arrival timestamp").repartition(4)
    got = {r.event_id: r.late for r in jobs.late_rows(df, "ts", "arrival", "5 minutes", "15 minutes").collect()}
    batch = lambda a: (a - START) // dt.timedelta(minutes=5)
    for i, ts, a in arrived:
        earlier = [t for _, t, b in arrived if batch(b) < batch(a)]
        assert got[i] == bool(earlier and ts < max(earlier) - dt.timedelta(minutes=15))


def walked(table):
    """Moves of each model from all its raw events, in order of time."""
    want = set()
    for m in {r[1] for r in table}:
        current, since = "", None
        for ts, _, status in sorted(r for r in table if r[1] == m):
            event, following = jobs.LIFECYCLE.get(current, (None, None))
            if status == event and (since is None or ts > since):
                want.add((m, current, following, ts.replace(tzinfo=None)))
                current, since = following, ts
    return want


@pytest.mark.parametrize("files", [1, 4])
def test_state_machine(spark, events, tmp_path, files):
    """Statuses repeat within minutes; two thirds of the events belong to model 1."""
    status = ["Approved", "Completed", "Failed", "Approved", "Deployed", "Completed", "Approved", "Deployed", "Rejected"]
    table = [(ts, uid, status[(i * 7 + uid) % 9]) for i, ts, uid, *_ in events]
    table += [(START + dt.timedelta(hours=h), 50, s) for h, s in ((9, "Approved"), (10, "Completed"), (11, "Approved"), (11, "Deployed"), (12, "Deployed"))]
    table.sort()
    path, step = str(tmp_path / "s"), -(-len(table) // files)
    for k in range(files):
        spark.createDataFrame(table[step * k : step * k + step], "ts timestamp, model bigint, status string").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    live = jobs.arriving(spark, path, spark.read.parquet(path).schema, "*.parquet", files_per_trigger=1, time="ts")
    moving, schema = jobs.moving_events(live, "model", "status", "ts")
    moves = jobs.drain(jobs.transitions(jobs.arriving(spark, f"{moving}/*", schema), "model", "status", "ts"), "moves")
    assert {(r.model, r.from_status, r.to_status, r.moved_at) for r in moves.collect()} == walked(table)
    mine = {r.to_status: r.moved_at.hour for r in moves.where("model = 50").collect()}
    assert mine == {"PendingManualApproval": 10, "Approved": 11, "Deployed": 12}
    messages = {r.message for r in jobs.notifications(moves, "model").collect()}
    assert "Model 1: new -> PendingManualApproval" in messages and len(messages) == moves.count()


def test_late_rows_come_out_on_the_side(spark, tmp_path):
    """Files out of the order of time: kept and late rows are all rows, late by the mark of the batches before."""
    path, table, mark, want = str(tmp_path / "s"), [], None, set()
    for k, start in enumerate([0, 90, 30, 200, 10, 195, 300]):
        rows = [(START + dt.timedelta(minutes=start + m), k * 100 + m) for m in range(0, 30, 3)] + [(None, k * 100 + 99)]
        spark.createDataFrame(rows, "ts timestamp, id bigint").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
        table += rows
        want |= {i for at, i in rows if at and mark and at < mark}
        mark = max(at for at, _ in rows if at) - dt.timedelta(minutes=15) if mark is None else max(mark, max(at for at, _ in rows if at) - dt.timedelta(minutes=15))
    live = jobs.arriving(spark, path, spark.read.parquet(path).schema, "*.parquet", files_per_trigger=1, time="ts")
    kept, late = jobs.split_late(live, "ts", "15 minutes")
    assert {r.id for r in late.collect()} == want and len(want) > 20
    assert sorted(r.id for r in kept.unionByName(late).collect()) == sorted(i for _, i in table)


def test_distribution_bounds(spark):
    """Summaries of windows stay within their stated errors."""
    rows = [(START + dt.timedelta(minutes=m % 120), float((m * 37) % 101) + (30 if m % 120 >= 60 else 0)) for m in range(2400)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    edges, base = [10.0 * i for i in range(1, 14)], [v for at, v in rows if at < START + dt.timedelta(hours=1)]
    bins = [sum(1 for v in base if sum(v > e for e in edges) == i) for i in range(14)]
    windows = jobs.distribution(df, edges, "ts", "1 minute", "1 hour", [], "v")
    got = {r.window_start: r for r in jobs.distribution_drift(windows, bins, edges, (0.0, 140.0)).collect()}
    assert len(got) == 2
    for at, r in got.items():
        own = sorted(v for t, v in rows if t.replace(tzinfo=None) >= at and t.replace(tzinfo=None) < at + dt.timedelta(hours=1))
        assert r.n == len(own)
        for q, name in ((0.5, "p50"), (0.95, "p95")):
            exact = own[-(-int(len(own) * q * 100) // 100) - 1]
            assert exact <= r[name] <= exact + 10
        points = sorted(set(own) | set(base))
        ks = max(abs(sum(v <= p for v in own) / len(own) - sum(v <= p for v in base) / len(base)) for p in points)
        assert r.ks <= ks + 1e-9 <= r.ks + max(max(r.counts) / r.n, max(bins) / len(base)) + 1e-9
    first, second = (got[k] for k in sorted(got))
    assert first.psi < 1e-9 < 0.1 < second.psi


def test_a_batch_reads_its_own_models_only(spark, tmp_path, monkeypatch):
    """The same number of files in the twelfth batch as in the third; a batch that comes twice changes nothing."""
    reads, merges, path = [], [], str(tmp_path / "s")
    for k in range(12):
        status = ("Completed", "Approved", "Deployed")[k // 4]
        rows = [(START + dt.timedelta(hours=k), m, status) for m in range(k % 4 * 10, k % 4 * 10 + 10)]
        spark.createDataFrame(rows, "ts timestamp, model bigint, status string").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    real_rows, real_merge, real_lookup = jobs.LatestView._rows, jobs.LatestView.merge, jobs.LatestView.lookup
    monkeypatch.setattr(jobs.LatestView, "_rows", lambda self, folders: reads.append(len(folders)) or real_rows(self, folders))
    monkeypatch.setattr(jobs.LatestView, "lookup", lambda self, ids: reads.append(None) or real_lookup(self, ids))
    monkeypatch.setattr(jobs.LatestView, "merge", lambda self, delta, note: merges.append(note) or real_merge(self, delta, note))

    def twice(stream, write, label, checkpoint=None):
        def both(batch, number):
            write(batch, number)
            write(batch, number)

        _each(stream, both, label, checkpoint)

    _each = jobs._each_batch
    monkeypatch.setattr(jobs, "_each_batch", twice)
    live = jobs.arriving(spark, path, spark.read.parquet(path).schema, "*.parquet", files_per_trigger=1, time="ts")
    moving, schema = jobs.moving_events(live, "model", "status", "ts", buckets=4)
    assert spark.read.schema(schema).parquet(f"{moving}/*").count() == 120
    assert merges == [str(k) for k in range(12)]
    looked = [reads[i + 1] for i, r in enumerate(reads) if r is None]
    assert len(looked) == 12 and max(looked) <= 4 and looked[-1] == looked[3]


def test_rejected_records_are_kept(spark, folder, tmp_path):
    group = FeatureGroup("g", "user_id", "event_time", {"user_id": "Integral", "event_time": "Fractional", "value": "Fractional"})
    raw = stream(spark, folder).select(
        F.when(F.col("event_id") % 5 == 0, "x1").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.unix_timestamp("ts").cast("double").alias("event_time"), "value", "event_id")
    accepted, rejected = jobs.ingest_stream(raw, group, str(tmp_path / "h"))
    assert accepted.count() == 480 and sorted(r.event_id for r in rejected.collect()) == list(range(0, 600, 5))


@pytest.mark.parametrize("salted", [False, True])
def test_outcomes_join(spark, tmp_path, salted):
    predictions = [(i, START + dt.timedelta(hours=i), i / 10) for i in range(40)]
    outcomes = [(n, 7 if n % 3 == 0 else n % 40, START + dt.timedelta(hours=n % 40 + n % 5), n % 2) for n in range(300)]
    spark.createDataFrame(predictions, "request bigint, at timestamp, p double").repartition(3).write.parquet(str(tmp_path / "p"))
    spark.createDataFrame(outcomes, "oid bigint, request bigint, seen timestamp, y int").repartition(3).write.parquet(str(tmp_path / "o"))

    salts = jobs.outcome_salts(spark.read.parquet(str(tmp_path / "o")), "request", 12) if salted else None

    def live(name, time):
        return jobs.arriving(spark, str(tmp_path / name), spark.read.parquet(str(tmp_path / name)).schema, files_per_trigger=1, time=time)

    got = jobs.drain(
        jobs.joined_outcomes(live("p", "at"), live("o", "seen"), "request", "at", "seen", F.col("oid"), "3 HOURS", "10 days", salts), "j"
    )
    at = {i: t for i, t, _ in predictions}
    want = sorted((o, r) for o, r, seen, _ in outcomes if r in at and at[r] <= seen <= at[r] + dt.timedelta(hours=3))
    assert sorted((r.oid, r.request) for r in got.collect()) == want and want
    assert sorted(got.columns) == ["at", "oid", "p", "request", "seen", "y"]


def test_rules_fan_out(spark):
    df = spark.createDataFrame(
        [(1, "storage", "created", ("training-data/a.csv", None)), (2, "storage", "created", ("other/a.csv", None)),
         (3, "training", "state", (None, "Completed")), (4, "training", "state", (None, "Failed"))],
        "event_id int, source string, detail_type string, detail struct<object_key:string,status:string>",
    )
    rules = [
        {"rule": "train", "source": "storage", "detail": {"object_key": {"prefix": "training-data/"}}},
        {"rule": "register", "source": "training", "detail": {"status": ["Completed"]}},
        {"rule": "log", "source": "training"},
    ]
    got = {(r.event_id, r.rule) for r in lifecycle.match_rules(df, rules).collect()}
    assert got == {(1, "train"), (3, "register"), (3, "log"), (4, "log")}


def test_registry(spark):
    registry = spark.createDataFrame(
        [("m1", 1, "PendingManualApproval", 1), ("m2", 2, "PendingManualApproval", 2), ("m3", 3, "Rejected", 3)],
        "model string, created int, status string, status_time int",
    )
    pick = lifecycle.latest_pending(registry, "created", "model")
    assert [r.model for r in pick.collect()] == ["m2"]
    after = lifecycle.approve(registry, pick, "model", F.lit(9))
    assert after.count() == 4
    assert rows(lifecycle.current_status(after, "model").select("model", "status")) == [
        ("m1", "PendingManualApproval"), ("m2", "Approved"), ("m3", "Rejected")
    ]
    steps = spark.createDataFrame([("a", 0, 60), ("b", 10, None)], "s string, x int, y int").select(
        "s", F.timestamp_seconds("x").alias("start_time"), F.timestamp_seconds("y").alias("end_time")
    )
    assert {r.s: r.duration_s for r in lifecycle.step_durations(steps).collect()} == {"a": 60.0, "b": None}


def test_late_parts_round_seconds_as_sql_does(spark, tmp_path):
    """The last half second before a part belongs to the part after it."""
    part, day = dt.timedelta(seconds=691_200), dt.timedelta(days=2)
    start = dt.datetime(2024, 1, 1)
    times = [(0, start + dt.timedelta(hours=1)), (1, start + part - day - dt.timedelta(seconds=0.3)), (2, start + part - 2 * day - dt.timedelta(seconds=0.5)), (0, start + part - dt.timedelta(seconds=0.7)), (0, start + 1.5 * part)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, user_id BIGINT, ts TIMESTAMP)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?)", [(i, u, at) for i, (u, at) in enumerate(times)])
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    got = sorted((r.event_id, r.late) for r in QUERIES["late_side_output"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(ORACLES["late_side_output"]).fetchall()) and sum(late for _, late in got) == 2


def test_outcomes_wait_in_tables(spark, tmp_path):
    """Rows meet those of earlier batches, late ones are left out, and no state is kept in the memory of tasks."""
    hour = lambda h: START + dt.timedelta(hours=h)
    p = [[(1, hour(0)), (9, hour(3))], [(2, hour(100))], [(3, hour(200))], [(4, hour(1)), (5, hour(250))]]
    o = [[(10, 1, hour(1))], [(11, 2, hour(101)), (12, 1, hour(2)), (13, 1, hour(9))], [(14, 3, hour(201)), (15, 9, hour(4))], [(16, 4, hour(2)), (17, 5, hour(251)), (18, 3, hour(203)), (19, 9, hour(5))]]
    for k in range(4):
        for name, rows, schema in (("p", p, "request bigint, at timestamp"), ("o", o, "oid bigint, request bigint, seen timestamp")):
            spark.createDataFrame(rows[k], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        time.sleep(1.1)  # files come in the order of their times

    def live(name, at):
        return jobs.arriving(spark, str(tmp_path / name), spark.read.parquet(str(tmp_path / name)).schema, files_per_trigger=1, time=at)

    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/state"))
    got = jobs.drain(jobs.joined_outcomes(live("p", "at"), live("o", "seen"), "request", "at", "seen", F.col("oid"), "3 HOURS", "1 hour"), "late")
    # Batch 2 goes by the first batch, whose mark is the least newest time, 1 h, less 1 h; batch 3 by the first two, 100 h less 1 h.
    assert sorted((r.oid, r.request) for r in got.collect()) == [(10, 1), (11, 2), (12, 1), (14, 3), (15, 9), (17, 5), (18, 3)]
    assert got.columns == ["request", "at", "oid", "seen"]
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/state")) == before
