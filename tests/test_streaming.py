"""Hand-made stream F3: a burst, a quiet user, a late row, a replayed id."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cardwatch.operators import velocity
from cardwatch.streaming import jobs, progress
from cardwatch.streaming import sources as ss

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = ("transaction_id string, user_id string, amount double, currency string, merchant_id string, "
          "merchant_name string, merchant_category string, merchant_country string, card_type string, "
          "card_last4 string, is_international boolean, timestamp string, event_time timestamp_ntz")


def _row(tid, user, sec):
    t = T0 + dt.timedelta(seconds=sec)
    return (tid, user, 50.0, "USD", "MCH_001", "Whole Foods", "grocery", "US", "credit", "1234", False,
            t.strftime("%Y-%m-%dT%H:%M:%S+00:00"), t)


def _events():
    a = [_row(f"A{i}", "A", 5 * i) for i in range(9)]
    b = [_row(f"B{i}", "B", 30 * i) for i in range(6)]
    c = [_row("C0", "C", 300), _row("C1", "C", 4000)]
    return sorted(a + b + c, key=lambda r: r[-1])


def _write_files(spark, folder, late=True, dup=True):
    """Five rows per file in event-time order; the late row after the 300 s row; one replayed id."""
    ev = _events()
    files = [ev[i:i + 5] for i in range(0, len(ev), 5)]
    if dup:
        files[1] = files[1] + [_row("A4", "A", 20)]      # same id again, while its windows are open
    if late:
        # After the file holding 300 s and 4000 s.  Spark drops input older than
        # the previous batch's watermark, so the row must come a batch after
        # the watermark has passed it.
        files.append([_row("LATE", "A", 10)])
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, f"f={i:03d}"))
    return os.path.join(folder, "f=*")


def _stream(spark, folder, **kw):
    glob = _write_files(spark, folder, **kw)
    src = ss.file_stream(spark, glob, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    return jobs.watermarked(src, "30 seconds")


def _drain(df, base, foreach_batch=None):
    q = jobs.start(df, os.path.join(base, "ck"), path=None if foreach_batch else os.path.join(base, "out"),
                   foreach_batch=foreach_batch, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_velocity_windows_stream(spark, scratch):
    w = jobs.velocity_windows(_stream(spark, os.path.join(scratch, "in"), dup=False), "60 seconds", "10 seconds", 6)
    watched = progress.watch(spark)
    q = _drain(w, os.path.join(scratch, "q"))
    got = spark.read.parquet(os.path.join(scratch, "q", "out"))
    counts = sorted((r["window_start"].second + 60 * r["window_start"].minute, r["txn_count"])
                    for r in got.where(F.col("user_id") == "A").collect())
    assert max(c for _, c in counts) == 9
    assert got.where(F.col("user_id") != "A").count() == 0
    totals = progress.totals(spark, watched, q).first()
    spark.streams.removeListener(watched)
    assert totals["input_rows"] == 18 and watched.of(q)["late_state_rows_dropped"] >= 1


def test_velocity_alerts_stream_dedups_and_drops_late(spark, scratch):
    a = jobs.velocity_alerts(_stream(spark, os.path.join(scratch, "in")), "60 seconds", "10 seconds", 6)
    from cardwatch.sources import sinks
    target = os.path.join(scratch, "alerts")
    _drain(a, os.path.join(scratch, "q"), foreach_batch=lambda df, bid: sinks.insert_if_absent(df, target))
    got = spark.read.parquet(target)
    ids = sorted(r["transaction_id"] for r in got.collect())
    assert ids == [f"A{i}" for i in range(9)]               # 9 alerts, one per transaction, no LATE
    assert set(r["final_rule"] for r in got.collect()) == {"VELOCITY_BURST"}


def test_stream_equals_batch_fanout(spark, scratch):
    """33 joined rows for A's burst in batch (the original's left join fan-out)."""
    df = spark.createDataFrame(_events(), SCHEMA)
    j = velocity.join_windows(df, window="60 seconds", slide="10 seconds", threshold=6, how="inner")
    assert j.count() == 33
    f = velocity.flag(df, window="60 seconds", slide="10 seconds", threshold=6)
    assert f.where("velocity_fraud").count() == 9 and f.count() == 17


def test_pipeline_dual_sink_and_replay(spark, scratch):
    v = jobs.verdicts(_stream(spark, os.path.join(scratch, "in")), "60 seconds", "10 seconds", 6)
    txn_path, alerts_path = os.path.join(scratch, "transactions"), os.path.join(scratch, "alerts")
    writer = jobs.pipeline_writer(txn_path, alerts_path, created_at=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    _drain(v, os.path.join(scratch, "q"), foreach_batch=writer)
    t = spark.read.parquet(txn_path)
    a = spark.read.parquet(alerts_path)
    # 16 closed transactions (C1 at 4000 s is still open); the replayed A4 and the late row add nothing.
    assert t.count() == 16 and t.select("transaction_id").distinct().count() == 16
    assert a.count() == 9 and set(r["final_rule"] for r in a.collect()) == {"VELOCITY_BURST"}
    # Replaying a batch (same rows again) changes nothing: idempotent sinks.
    again = spark.read.parquet(txn_path).limit(3)
    from cardwatch.sources import sinks
    sinks.insert_if_absent(again, txn_path, partition_by=["event_date"], prune_by="event_date")
    sinks.insert_if_absent(again, txn_path, partition_by=["event_date"])
    assert spark.read.parquet(txn_path).count() == 16


def test_stateless_stream_is_immediate(spark, scratch):
    s = jobs.score(_stream(spark, os.path.join(scratch, "in"), late=False, dup=False))
    _drain(s.select("transaction_id", "fraud_rule"), os.path.join(scratch, "q"))
    assert spark.read.parquet(os.path.join(scratch, "q", "out")).count() == 17


def test_run_from_json_records(spark, scratch):
    """Raw JSON records (as from Kafka) through the whole pipeline; bad records are quarantined."""
    import json
    good = [r for r in _events()]
    folder = os.path.join(scratch, "raw")
    names = ["transaction_id", "user_id", "amount", "currency", "merchant_id", "merchant_name",
             "merchant_category", "merchant_country", "card_type", "card_last4", "is_international", "timestamp"]
    recs = []
    for r in good:
        d = dict(zip(names, r[:-1]))
        d["transaction_id"] = "00000000-0000-4000-8000-%012d" % int.from_bytes(d["transaction_id"].encode(), "big")
        recs.append((d["user_id"], json.dumps(d)))
    big = dict(zip(names, _row("BIG", "D", 100)[:-1]))
    big.update(transaction_id="00000000-0000-4000-8000-000000000999", amount=9999.0)
    recs.append(("D", json.dumps(big)))
    recs.append(("X", "not json"))
    spark.createDataFrame(recs, "key string, value string").coalesce(1).write.parquet(os.path.join(folder, "f=0"))
    raw = ss.file_stream(spark, os.path.join(folder, "f=*"),
                         spark.createDataFrame([], "key string, value string").schema)
    qs = jobs.run(raw, os.path.join(scratch, "t"), os.path.join(scratch, "a"), os.path.join(scratch, "ck"),
                  quarantine_path=os.path.join(scratch, "bad"), window="60 seconds", slide="10 seconds",
                  delay="30 seconds", available_now=True, early_alerts_path=os.path.join(scratch, "early"))
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    assert spark.read.parquet(os.path.join(scratch, "bad")).count() == 1
    final = jobs.committed(spark, os.path.join(scratch, "a"), os.path.join(scratch, "t_commits"))
    early = spark.read.parquet(os.path.join(scratch, "early"))
    assert final.count() == 10                                  # A's burst + the large purchase
    assert [r["final_rule"] for r in early.collect()] == ["HIGH_AMOUNT"]
    from cardwatch.operators import verdict
    assert verdict.current_alerts(final, early.select(*final.columns)).count() == 10


def test_await_all_stops_the_others_on_failure(spark, scratch):
    import pytest
    src = _stream(spark, os.path.join(scratch, "in"), late=False, dup=False)

    def boom(df, batch_id):
        raise ValueError("sink down")

    ok = jobs.start(jobs.score(src).select("transaction_id"), os.path.join(scratch, "ck1"),
                    path=os.path.join(scratch, "out1"), processing_time="1 second")
    bad = jobs.start(src.select("transaction_id"), os.path.join(scratch, "ck2"), foreach_batch=boom,
                     processing_time="1 second")
    with pytest.raises(RuntimeError):
        jobs.await_all([ok, bad], timeout_s=120)
    assert not ok.isActive and not bad.isActive


def test_live_counters(spark, scratch):
    """observe(): per-batch events and alerts reported with the query's progress."""
    src = _stream(spark, os.path.join(scratch, "in"), late=False, dup=False)
    scored = jobs.score(src).withColumn("final_is_fraud", F.col("stateless_fraud"))
    q = _drain(progress.observe(scored).select("transaction_id"), os.path.join(scratch, "q"))
    rows = [r for r in progress.progress_rows(q) if r["events"] is not None]
    assert sum(int(r["events"]) for r in rows) == 17
    assert sum(int(r["alerts"]) for r in rows) == 0
    assert progress.progress_frame(spark, q).count() == len(progress.progress_rows(q))


NAMES = ["transaction_id", "user_id", "amount", "currency", "merchant_id", "merchant_name", "merchant_category",
         "merchant_country", "card_type", "card_last4", "is_international", "timestamp"]


def _record(number, **changes):
    r = dict(zip(NAMES, _row("x", f"U{number}", number)[:-1]))
    r["transaction_id"] = "00000000-0000-4000-8000-%012d" % number
    return r | changes


def _run(spark, scratch, files, name="", **options):
    """The whole pipeline over JSON records, one file per micro-batch; the folders it wrote to.

    ``name`` is that of a source and its checkpoints, writing to the same tables.
    """
    import json
    for k, records in enumerate(files):
        rows = [("k", r if isinstance(r, str) else json.dumps(r)) for r in records]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(os.path.join(scratch, f"raw{name}", f"f={k}"))
    raw = ss.file_stream(spark, os.path.join(scratch, f"raw{name}", "f=*"), spark.createDataFrame([], "key string, value string").schema,
                         max_files_per_trigger=1)
    paths = {k: os.path.join(scratch, k) for k in ("txn", "alerts", "early")}
    for q in jobs.run(raw, paths["txn"], paths["alerts"], os.path.join(scratch, f"ck{name}"), window="60 seconds", slide="10 seconds",
                      delay="1 second", available_now=True, early_alerts_path=paths["early"], state_partitions=2, **options):
        q.awaitTermination()
        assert q.exception() is None
    return paths | {k: f"{paths['txn']}_{k}" for k in ("quarantine", "late", "commits")}


def test_pipeline_loses_no_record(spark, scratch):
    """First batch without alerts, then every kind of bad record; the quarantine is written without being asked for."""
    bad = [_record(1001, amount=1e12), _record(1002, timestamp="2024-02-30T10:00:00Z"), "not json {", _record(1003, user_id=None)]
    fine = [_record(1004, timestamp="2024-01-01t00:01:30z"), _record(1005, merchant_category="casino", amount=6000.0)]
    far = [_record(9_000, amount=9999.0)]  # its watermark closes all before it
    p = _run(spark, scratch, [[_record(1), _record(2)], [_record(200), *bad, *fine], [_record(300, amount=9999.0)], far])
    kept = spark.read.parquet(p["txn"]).collect()
    assert sorted(r["transaction_id"][-4:] for r in kept) == ["0001", "0002", "0200", "0300", "1004", "1005"]
    assert {r["transaction_id"][-4:]: r["final_rule"] for r in kept}["1005"] == "HIGH_AMOUNT"  # default threshold
    out = spark.read.parquet(p["quarantine"]).collect()
    assert len(out) == 4 and all(r["raw_value"] for r in out) and "not json {" in {r["raw_value"] for r in out}
    assert sorted(r["violations"].split(",")[0] for r in out) == ["format:timestamp", "maximum:amount", "missing:transaction_id",
                                                                    "missing:user_id"]


def test_quarantine_batch_is_written_once(spark, scratch):
    write = jobs.quarantine_writer(os.path.join(scratch, "q"))
    batch = spark.createDataFrame([("x", "missing:amount")], "raw_value string, violations string")
    for _ in range(2):
        write(batch, 7)
    write(batch, 8)
    assert spark.read.parquet(os.path.join(scratch, "q")).count() == 2


def test_an_id_sent_again_on_another_date_is_not_new(spark, scratch):
    from cardwatch.sources import sinks
    schema = "transaction_id string, event_time timestamp_ntz, event_date date, v int"
    day = lambda d: (dt.datetime(2024, 1, d), dt.date(2024, 1, d))
    path = os.path.join(scratch, "t")
    first = spark.createDataFrame([("a", *day(1), 2), ("a", *day(2), 1), ("b", *day(1), 5)], schema)
    sinks.insert_if_absent(first, path, partition_by=["event_date"], order_by=["event_time"])
    again = spark.createDataFrame([("a", *day(9), 3), ("c", *day(9), 4), (None, *day(9), 6)], schema)
    sinks.insert_if_absent(again, path, partition_by=["event_date"], order_by=["event_time"])
    got = {r["transaction_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": 2, "b": 5, "c": 4, None: 6}


def test_empty_first_write_leaves_a_readable_table(spark, scratch):
    from cardwatch.sources import sinks
    path = os.path.join(scratch, "t")
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "transaction_id string, event_date date")
    sinks.insert_if_absent(rows.limit(0), path, partition_by=["event_date"])
    sinks.insert_if_absent(rows, path, partition_by=["event_date"], prune_by="event_date")
    sinks.insert_if_absent(rows, path, partition_by=["event_date"])
    assert spark.read.parquet(path).count() == 1


def test_totals_cover_forgotten_batches(spark, scratch):
    """With two kept progress reports, the totals of eight batches are still complete."""
    for k in range(8):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.parquet(os.path.join(scratch, "in", f"f={k}"))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    watched = progress.watch(spark)
    try:
        src = ss.file_stream(spark, os.path.join(scratch, "in", "f=*"), spark.range(0).schema, max_files_per_trigger=1)
        q = _drain(src, os.path.join(scratch, "q"))
        assert watched.of(q)["input_rows"] == 80 and watched.of(q)["batches"] >= 8 and len(q.recentProgress) <= 2
    finally:
        spark.conf.set(key, before)
        spark.streams.removeListener(watched)


def test_staged_slices_have_several_files_and_close(spark, scratch):
    rows = [(f"i{k}", T0 + dt.timedelta(seconds=k)) for k in range(1200)]
    df = spark.createDataFrame(rows, "transaction_id string, event_time timestamp_ntz")
    glob, files = ss.stage_in_time_order(df, "event_time", os.path.join(scratch, "s"), 3, close_after="1 hour")
    assert files > 1
    counts = [len([f for f in os.listdir(os.path.join(scratch, "s", d)) if f.endswith(".parquet")])
              for d in sorted(os.listdir(os.path.join(scratch, "s"))) if d.startswith("slice=")]
    assert counts == [files, files, files, 1] and spark.read.parquet(glob).count() == 1201


def _numbers(rows):
    return sorted(int(r["transaction_id"][-4:]) for r in rows.collect())


def _burst(first, user="B1", start=100):
    out = []
    for k in range(9):
        r = _record(first + k)
        t = T0 + dt.timedelta(seconds=start + 2 * k)
        out.append(r | {"user_id": user, "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S+00:00")})
    return out


def test_counters_count_rows_of_the_tables_once(spark, scratch):
    """Nine transactions of one burst lie in several windows each; every record is read by both sides of a join."""
    p = _run(spark, scratch, [[*_burst(1), "not json"], [_record(9000)]])
    done = jobs.committed(spark, p["txn"], p["commits"])
    assert done.count() == 9 and jobs.committed(spark, p["alerts"], p["commits"]).count() == 9
    c = progress.counters(spark, p["commits"]).first()
    assert (c["records"], c["quarantined"], c["events"], c["alerts"], c["late"], c["alert_rate_pct"]) == (11, 1, 9, 9, 0, 100.0)


def test_console_shows_bursts(spark, scratch, capfd):
    _run(spark, scratch, [_burst(1), [_record(9000)]], console_debug=True)
    assert "VELOCITY_BURST" in capfd.readouterr().out


def test_late_transactions_are_kept(spark, scratch):
    """Rows behind the watermark are late, whatever their verdict; together with the table that is every record."""
    files = [[_record(1), _record(2)], [_record(500)], [_record(501), _record(3)], [_record(502), _record(4, amount=9999.0), _record(499)],
             [_record(9000)], [_record(5)], [_record(9999)]]
    p = _run(spark, scratch, files)
    late = jobs.committed(spark, p["late"], p["commits"])
    # 3 came while the watermark that drops rows was still the first file's; 499 is just on the line
    assert _numbers(late) == [4, 5, 499]
    assert {r["final_rule"] for r in late.where("transaction_id like '%0004'").collect()} == {"HIGH_AMOUNT"}
    kept = _numbers(jobs.committed(spark, p["txn"], p["commits"]))
    assert kept == [1, 2, 3, 500, 501, 502, 9000]  # 9999 is still open
    c = progress.counters(spark, p["commits"]).first()
    assert (c["events"], c["late"]) == (len(kept), late.count())


def test_late_rows_keep_all_fields_apart(spark, scratch):
    """Fields that no table holds stay out of the verdicts, but two late records that differ in one only are two."""
    twin = [_record(5, device_id="x", latitude=1.0), _record(5, device_id="y", latitude=1.0)]
    p = _run(spark, scratch, [[_record(1, device_id="x")], [_record(500)], [_record(9000)], [*twin, _record(6)], [_record(9999)]])
    assert _numbers(jobs.committed(spark, p["late"], p["commits"])) == [5, 5, 6]
    assert _numbers(jobs.committed(spark, p["txn"], p["commits"])) == [1, 500, 9000]
    v = jobs.verdicts(jobs.for_tables(_stream(spark, os.path.join(scratch, "in")).withColumns({c: F.lit("x") for c in jobs.UNREAD})))
    assert not set(jobs.UNREAD) & set(v.columns) and "timestamp" in v.columns


def test_a_replayed_batch_runs_its_joins_once(spark, scratch):
    """State operators count their rows once although every other batch is written twice."""
    from cardwatch.plans import streams
    from cardwatch.sources import commits
    held, seen = [], []
    for name in ("plain", "twice"):
        log = commits.Commits(spark, os.path.join(scratch, name, "commits"))

        def write(batch, batch_id):
            query = commits.stream_id(batch.sparkSession)
            if log.begin(query, batch_id) != "done":
                seen.append((name, batch_id, batch.count()))
                log.commit(query, batch_id, {})

        stream = jobs.verdicts(_stream(spark, os.path.join(scratch, name, "in")))
        q = _drain(stream, os.path.join(scratch, name, "q"), streams._odd_batches_twice(write, log) if name == "twice" else write)
        held.append({p["batch_id"]: p["state_rows"] for p in progress.progress_rows(q)})
    assert held[0] == held[1] and max(held[0]) >= 3
    assert sorted(set(s[1:] for s in seen)) == [s[1:] for s in seen if s[0] == "plain"]
    assert [s[1] for s in seen if s[0] == "twice"] == [k for k in sorted(held[0]) for _ in range(1 + k % 2)]


def test_a_new_checkpoint_adds_to_the_quarantine(spark, scratch):
    first = _run(spark, scratch, [["not json 1", _record(1)], [_record(9000)]], name="1")
    again = _run(spark, scratch, [["not json 2", _record(1), _record(2)], [_record(9001)]], name="2")
    assert first == again
    kept = jobs.committed(spark, first["quarantine"], first["commits"]).collect()
    assert sorted(r["raw_value"] for r in kept) == ["not json 1", "not json 2"]
    assert _numbers(jobs.committed(spark, first["txn"], first["commits"])) == [1, 2]
    c = progress.counters(spark, first["commits"]).first()
    assert (c["records"], c["quarantined"], c["events"]) == (7, 2, 2)


def test_a_crash_between_the_tables_is_invisible(spark, scratch, monkeypatch):
    """The alerts' write fails after the transactions': readers see neither; the restarted batch completes both, counted once."""
    from cardwatch.sources import sinks
    real, calls = sinks.insert_if_absent, []

    def failing(batch, path, **kw):
        calls.append(path)
        if path.endswith("alerts") and batch.count() and not any(c == "crashed" for c in calls):
            calls.append("crashed")
            raise RuntimeError("lost")
        return real(batch, path, **kw)

    monkeypatch.setattr(sinks, "insert_if_absent", failing)
    files = [[*_burst(1), "not json"], [_record(9000)], [_record(9999)]]
    try:
        _run(spark, scratch, files)
        raise AssertionError("the crash did not stop the stream")
    except Exception as e:
        assert "lost" in str(e)
    txn, log = os.path.join(scratch, "txn"), os.path.join(scratch, "txn_commits")
    assert spark.read.parquet(txn).count() == 9 and jobs.committed(spark, txn, log).count() == 0
    raw = ss.file_stream(spark, os.path.join(scratch, "raw", "f=*"), spark.createDataFrame([], "key string, value string").schema,
                         max_files_per_trigger=1)
    for q in jobs.run(raw, txn, os.path.join(scratch, "alerts"), os.path.join(scratch, "ck"), window="60 seconds", slide="10 seconds",
                      delay="1 second", available_now=True, early_alerts_path=os.path.join(scratch, "early"), state_partitions=2):
        q.awaitTermination()
        assert q.exception() is None
    assert _numbers(jobs.committed(spark, txn, log)) == [*range(1, 10), 9000]
    assert _numbers(jobs.committed(spark, os.path.join(scratch, "alerts"), log)) == list(range(1, 10))
    c = progress.counters(spark, log).first()
    assert (c["records"], c["quarantined"], c["events"], c["alerts"]) == (12, 1, 10, 9)


def test_a_batch_is_decoded_once(spark, scratch, monkeypatch):
    """The counts, the join and the arrivals of the verdicts' query share one exchange, and so one decoding."""
    real, queries = jobs.start, []
    monkeypatch.setattr(jobs, "start", lambda *a, **k: queries.append(real(*a, **k)) or queries[-1])
    p = _run(spark, scratch, [[_record(1), _record(2, device_id="x"), "not json"], [_record(500)], [_record(3), _record(9000)]])
    plan = next(q for q in queries if q.name == "verdicts")._jsq.explainInternal(False)
    assert plan.count("Generate inline") == 1 and plan.count("ReusedExchange") == 2
    assert _numbers(jobs.committed(spark, p["txn"], p["commits"])) == [1, 2, 3, 500]
    c = progress.counters(spark, p["commits"]).first()
    assert (c["records"], c["quarantined"], c["events"], c["late"]) == (6, 1, 4, 0)



def test_records_meet_their_times_without_a_join(spark, scratch):
    """Without repeated ids a record's time is its row's own; with them all pairs come out, as of the join; a null id meets none."""
    from cardwatch.plans import catalog, streams
    from cardwatch.sources import fixtures
    at = lambda k: T0 + dt.timedelta(seconds=k)
    once = [(k, at(k), k % 7, "x", 10.0 * k, "{}") for k in range(60)] + [(None, at(99), 1, "x", 1.0, "{}")]
    for name, rows in (("once", once), ("twice", [*once, (5, at(500), 3, "x", 2.0, "{}"), (5, at(5), 5, "x", 50.0, "{}")])):
        d = os.path.join(scratch, name)
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
            os.path.join(d, "events.parquet"))
        got = streams._timed_records(spark, d)
        t = fixtures.transactions(spark, d, keep_event_id=True).select("event_id", "event_time")
        want = catalog.defective_records(spark, d, keep_event_id=True).join(t, "event_id")
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert (plan.count("Join") > plan.count("Join LeftOuter")) == (name == "twice"), plan
