from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import cdc, guards, scd2
from tidemark.plans import runner
from tidemark.plans.storage import CommitConflict, TableLock, VersionedTable
from tidemark.sources.registry import ColumnConfig, Source, TableConfig, get_source, is_permanent, register_source, with_retries
from tidemark.streaming import changes


def config(name="t", large=False):
    cols = tuple(ColumnConfig("src", name, c, i, is_primary_key=c == "k") for i, c in enumerate(("k", "v", "d")))
    return TableConfig("src", name, source_aggregate_column_name="d" if large else None, first_load_date="2024-01-01" if large else None, columns=cols)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, d timestamp_ntz")


def test_small_table_twice(spark, tmp_path):
    d = __import__("datetime").datetime(2024, 1, 1)
    data = {"now": [(k, "a", d) for k in range(20)]}
    run = runner.Run(spark, str(tmp_path), extract=lambda s, c, a, b: frame(s, data["now"]))
    c = config()
    assert runner.small_table(run, c, run.ops.next_batch(), run_ts="2024-01-01 00:00:00") == "SUCCESS"
    data["now"] = [(k, "b" if k < 5 else "a", d) for k in range(1, 21)]
    assert runner.small_table(run, c, run.ops.next_batch(), run_ts="2024-02-01 00:00:00") == "SUCCESS"
    stage = run.stage(c).read()
    assert cdc.current(stage).count() == 20
    assert stage.where("_cdc_is_current = 0").count() == 5  # four updates, one delete
    history = run.bronze(c).read()
    assert scd2.active_versions(history).count() == 20
    assert scd2.point_in_time(history, "2024-01-15 00:00:00").where("v = 'a'").count() == 20
    assert scd2.duplicate_active(history, ["k"]).count() == 0
    # too few rows are held back by the guard
    data["now"] = data["now"][:1]
    assert runner.small_table(run, c, run.ops.next_batch()) == "SKIPPED"
    events = {(r["EventType"], r["Status"]) for r in run.ops.read("event").collect()}
    assert {("EXTRACT", "SKIPPED"), ("CDC_PROMOTION", "SUCCESS"), ("SCD2_PROMOTION", "SUCCESS")} <= events


def test_schema_evolves_between_runs(spark, tmp_path):
    c = config()
    frames = iter([spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([(1, "a", 5)], "k long, v string, extra int")])
    run = runner.Run(spark, str(tmp_path), extract=lambda s, c, a, b: next(frames))
    assert runner.small_table(run, c, 1, run_ts="2024-01-01 00:00:00") == "SUCCESS"
    assert runner.small_table(run, c, 2, run_ts="2024-01-02 00:00:00") == "SUCCESS"
    assert "extra" in run.bronze(c).read().columns
    assert run.bronze(c).read().count() == 2


def test_large_table_by_day(spark, tmp_path):
    from datetime import datetime

    rows = [(k, "a", datetime(2024, 1, 1 + k % 3, 5)) for k in range(9)]
    all_rows = {"rows": rows}
    run = runner.Run(spark, str(tmp_path), extract=lambda s, c, a, b: frame(s, [r for r in all_rows["rows"] if a <= r[2].date() < b]))
    c = config("big", large=True)
    out = runner.large_table(run, c, 1, date(2024, 1, 4))
    assert out == {date(2024, 1, d): "SUCCESS" for d in (1, 2, 3)}
    assert cdc.current(run.stage(c).read()).count() == 9
    all_rows["rows"] = [r for r in rows if r[0] != 4]
    assert runner.large_table(run, c, 2, date(2024, 1, 4))[date(2024, 1, 2)] == "SUCCESS"
    assert scd2.active_versions(run.bronze(c).read()).count() == 8
    assert runner.large_table(run, c, 3, date(2024, 1, 4), reprocess_lookback=False) == {}
    assert run.ops.states().where("Status = 'SUCCESS'").count() == 3


def test_storage_conflict_and_vacuum(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    t.commit(spark.range(3).toDF("x"))
    t.commit(spark.range(4).toDF("x"), after=1)
    try:
        t.commit(spark.range(5).toDF("x"), after=1)
    except CommitConflict:
        pass
    else:
        raise AssertionError("two writers committed one version")
    assert t.read().count() == 4 and t.read(1).count() == 3
    t.commit(spark.range(6).toDF("x"))
    assert len(t.vacuum(keep=1)) == 2 and t.read().count() == 6


def test_lock(spark, tmp_path):
    a, b = (TableLock(spark, str(tmp_path), "s", "t") for _ in range(2))
    assert a.acquire() and not b.acquire()
    assert a.heartbeat() and not b.heartbeat()
    a.release()
    assert b.acquire()
    stale = TableLock(spark, str(tmp_path), "s", "t", stale_s=-1)
    assert stale.acquire()


def test_retries_and_registry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("connection reset by peer")
        return 7

    assert with_retries(flaky, sleep=lambda s: None) == 7
    assert is_permanent("Incorrect syntax near") and not is_permanent("syntax timeout") and not is_permanent("odd")
    register_source(Source("Main", "parquet", "/x"))
    assert get_source("MAIN").root == "/x"


def test_guard_decisions():
    assert guards.decide(5, 100).kind == "drop" and guards.decide(10, 100).kind == "warn" and guards.decide(60, 100).kind == "ok"
    assert guards.decide(501, 100).kind == "growth" and guards.decide(500, 100).proceed
    assert guards.decide(10, None).proceed and not guards.decide(10**9, 0).proceed
    assert guards.decide_daily(0, 100).proceed
    d = date
    assert guards.dates_to_process(d(2024, 1, 5), None, set(), first_load=d(2024, 1, 3)) == [d(2024, 1, 3), d(2024, 1, 4)]
    assert guards.dates_to_process(d(2024, 1, 5), d(2024, 1, 3), {d(2024, 1, 3)}, first_load=d(2024, 1, 3), reprocess_lookback=False) == [d(2024, 1, 4)]
    assert guards.gap_alarm(d(2024, 3, 1), d(2024, 1, 1)) and not guards.gap_alarm(d(2024, 1, 5), d(2024, 1, 3))


def test_stream_into_history(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").coalesce(1).write.parquet(src)
    table = VersionedTable(spark, str(tmp_path / "h"))
    read = lambda: spark.readStream.schema("k long, v string").parquet(src)
    stamp = lambda n: f"2024-01-{n + 1:02d} 00:00:00"
    changes.into_history(read(), table, ["k"], str(tmp_path / "cp"), run_ts=stamp).awaitTermination()
    spark.createDataFrame([(1, "c")], "k long, v string").coalesce(1).write.mode("append").parquet(src)
    changes.into_history(read(), table, ["k"], str(tmp_path / "cp"), run_ts=stamp).awaitTermination()
    now = {r["k"]: r["v"] for r in scd2.active_versions(table.read()).collect()}
    assert now == {1: "c", 2: "b"} and table.read().count() == 3
    assert not changes.apply_upserts(table, spark.createDataFrame([(9, "x")], "k long, v string"), ["k"], stamp(1), 1)


def test_stream_windows(spark, tmp_path, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(schema.simpleString().replace("struct<", "").rstrip(">").replace(":", " ").replace("timestamp_ntz", "timestamp")).parquet(str(tmp_path / "e"))
    q = changes.daily_counts(stream, "ts").writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("days").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf}/events.parquet").count()


def test_stale_lock_is_taken_by_one(spark, tmp_path):
    """Two that see the same stale lock: the one that comes later doesn't delete the lock of the first."""
    held = TableLock(spark, str(tmp_path), "s", "u")
    assert held.acquire()
    first, second = (TableLock(spark, str(tmp_path), "s", "u", stale_s=-1) for _ in range(2))
    seen = second.files.text

    def late(name):
        text = seen(name)
        if name == second.name and text == held.token:
            second.files.text = seen
            assert first.acquire()  # between the look and the takeover
        return text

    second.files.text = late
    assert not second.acquire()
    assert first.heartbeat() and not held.heartbeat() and not second.heartbeat()
