"""Operators on small frames: the hash's properties, key hygiene, invariants of changes and history."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import hashing, sanitize
from tidemark.operators import cdc, evolve, guards, keys, profile, reconcile, scd2
from tidemark.plans import ops
from tidemark.sources import sinks

SCHEMA = "s string, u string, i long, f double, d date, t timestamp, b boolean"


def hashes(spark, rows, schema=SCHEMA, **options):
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "_n int, " + schema)
    return [r["_row_hash"] for r in hashing.add_row_hash(df, **options).orderBy("_n").collect()]


def test_hash_properties(spark):
    one = lambda **k: tuple({"s": None, "u": None, "i": None, "f": None, "d": None, "t": None, "b": None} | k for _ in "x")[0]
    row = lambda **k: tuple(one(**k).values())
    same = [
        (row(u="é ñ Å"), row(u="é ñ Å")), (row(s="trailing   "), row(s="trailing")), (row(f=-0.0), row(f=0.0)), (row(f=float("nan")), row(f=float("nan"))), (row(f=0.1 + 0.2), row(f=0.3)),
    ]
    for a, b in same:
        x, y = hashes(spark, [a, b])
        assert x == y
    different = [row(), row(s=""), row(f=float("nan")), row(f=float("inf")), row(f=float("-inf")), row(s="NULL"), row(s="AB", u="C"), row(s="A", u="BC"), row(s="a\t"), row(s="a"), row(i=0), row(f=0.0), row(b=False), row(b=True), row(f=1e300)]
    found = hashes(spark, different)
    assert len(set(found)) == len(different) and all(len(h) == 64 for h in found)
    empty = hashes(spark, [row(s=""), row(), row(s="  ")], empty_is_null=True)
    assert empty[0] == empty[1] != empty[2]


def test_hash_two_ways_and_any_partitioning(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    a = {r["event_id"]: r["_row_hash"] for r in hashing.add_row_hash(df).collect()}
    b = {r["event_id"]: r["_row_hash"] for r in hashing.add_row_hash_in_python(df.repartition(7)).collect()}
    assert a == b
    nested = spark.createDataFrame([(1, [1, 2], {"a": 1}, bytearray(b"x"))], "k int, l array<int>, m map<string,int>, z binary")
    assert len(hashing.add_row_hash(nested).first()["_row_hash"]) == 64


def test_hash_scans_only_its_columns(spark, sf):
    plan = hashing.add_row_hash(spark.read.parquet(f"{sf}/orders.parquet"), ["o_custkey"], normalize=False).select("o_orderkey", "_row_hash")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0] and "ArrowEvalPython" not in plan


def test_diff_is_one_shuffle_a_side(spark, sf):
    from tidemark import catalogue

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = catalogue.QUERIES["cdc_diff_part"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_window_reaches_the_scan(spark, sf):
    df = cdc.in_window(spark.read.parquet(f"{sf}/events.parquet"), "ts", "2024-01-10", "2024-01-11")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_instants(spark):
    good = ["2025-01-15 10:30:00", "2025-01-15T10:30:00", "2025-01-15 10:30:00.123", "2025-01-15T10:30:00.123456", "15-JAN-2025 10:30:00", "15-jan-25 10:30:00"]
    bad = ["2025-01-15", "15/01/2025 10:30:00", "", None, "2025-13-15 10:30:00"]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string").select(sanitize.parse_instant(F.col("v")).alias("t"))
    got = [r["t"] for r in df.collect()]
    assert all(t and t.replace(microsecond=0) == datetime(2025, 1, 15, 10, 30) for t in got[:6]) and got[6:] == [None] * 5
    for n, expected in ((18, True), (17, False)):
        df = spark.createDataFrame([("2025-01-15 10:30:%02d" % i if i < n else "x%d" % i,) for i in range(20)], "v string")
        assert sanitize.sniff_instants(df).first()["is_instant"] is expected


def test_dates_bits_and_text(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29).date(), "x", "a\tb c\x85", True)], "d date, DATE_X string, s string, b boolean")
    out = sanitize.prepare(df, "2024-03-01 00:00:00", fix=True).first()
    assert out["d"] == datetime(2024, 2, 29) and out["DATE_X"] is None and out["s"] == "abc" and out["b"] == 1
    with pytest.raises(sanitize.ColumnOrderError):
        sanitize.reorder(df, ["nope"])
    assert sanitize.quote_table("a.b`c") == "`a`.`b``c`"
    with pytest.raises(ValueError):
        sanitize.quote_identifier("x" * 129)


def test_wider_and_aligned_keys(spark):
    assert keys.wider(T.IntegerType(), T.LongType()) == T.LongType() and keys.wider(T.LongType(), T.FloatType()) == T.FloatType() and keys.wider(T.StringType(), T.LongType()) == T.StringType()
    a, b = spark.createDataFrame([("1",), ("x",)], "k string"), spark.createDataFrame([(1,)], "k int")
    x, y = keys.align_keys(a, b, ["k"])
    assert x.join(y, "k").count() == 1


def snapshot(rng, n=40):
    return [(k, rng.choice("abc")) for k in range(n) if rng.random() < 0.8]


@pytest.mark.parametrize("seed", range(4))
def test_invariants_over_random_snapshots(spark, seed):
    rng = random.Random(seed)
    stage = history = None
    seen = []
    for n in range(1, 5):
        rows = snapshot(rng)
        seen.append((f"2024-01-{n:02d} 00:00:00", dict(rows)))
        fresh = sanitize.prepare(spark.createDataFrame(rows, "k long, v string"), seen[-1][0])
        if stage is not None:
            counts = cdc.summary(cdc.diff(fresh, cdc.current(stage), ["k"])).first().asDict()
            cdc.check_counts(counts, len(rows))
        stage = spark.createDataFrame(cdc.merge(stage, fresh, ["k"], seen[-1][0], n).stage.collect(), sinks.stage_schema(T._parse_datatype_string("k long, v string")))
        history = spark.createDataFrame(scd2.apply(history, cdc.current(stage), ["k"], seen[-1][0]).history.collect(), T.StructType(sinks.history_schema(T._parse_datatype_string("k long, v string")).fields[1:]))
    assert {r["k"]: r["v"] for r in cdc.current(stage).collect()} == seen[-1][1]
    assert scd2.duplicate_active(history, ["k"]).count() == 0
    assert reconcile.overlaps(history, ["k"]).count() == 0 and reconcile.inverted(history).count() == 0
    for at, rows in seen:  # the history answers for every instant
        assert {r["k"]: r["v"] for r in scd2.point_in_time(history, at).collect()} == rows
    again = cdc.diff(sanitize.prepare(spark.createDataFrame(list(seen[-1][1].items()), "k long, v string"), "2024-02-01 00:00:00"), cdc.current(stage), ["k"])
    assert {r["op"] for r in again.collect()} == {"N"}


def test_diff_of_empty_frames(spark):
    some = hashing.add_row_hash(spark.createDataFrame([(1, "a")], "k long, v string"))
    none = some.where("false")
    assert [r["op"] for r in cdc.diff(some, none, ["k"]).collect()] == ["I"]
    assert [r["op"] for r in cdc.diff(none, some, ["k"]).collect()] == ["D"]
    assert cdc.diff(none, none, ["k"]).count() == 0
    assert cdc.summary(cdc.diff(none, none, ["k"])).first()["update_ratio"] == 0


def test_overlap_without_self_join(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, 40)
            rows.append((k, f"h{len(rows)}", datetime(2024, 1, 1 + a // 24, a % 24), None if rng.random() < 0.2 else datetime(2024, 1, 1 + (a + rng.randint(1, 9)) // 24, (a + 3) % 24), 1, "I"))
    rows = [r for r in rows if r[3] is None or r[3] >= r[2]]
    h = spark.createDataFrame(rows, f"k long, {scd2.VERSION_HASH} string, {scd2.START} timestamp_ntz, {scd2.END} timestamp_ntz, {scd2.ACTIVE} int, {scd2.OPERATION} string")
    far = datetime(9999, 12, 31)
    hit = {r["k"] for r in reconcile.overlaps(h, ["k"]).collect()}
    pairs = {a[0] for a in rows for b in rows if a is not b and a[0] == b[0] and a[2] < (b[3] or far) and b[2] < (a[3] or far) and a[2] < (a[3] or far) and b[2] < (b[3] or far)}
    assert hit == pairs


def test_latest_is_deterministic(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "x")]
    for p in (1, 3):
        df = spark.createDataFrame(rows, "k int, t int, v string").repartition(p)
        assert sorted(map(tuple, keys.latest(df, ["k"], ["t"]).collect())) == [(1, 5, "b"), (2, None, "x")]
    numbered = keys.numbered(spark.range(500).toDF("k"), ["k"], 10, "n").agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(numbered) == (11, 510, 500)


def test_evolution(spark):
    old, new = T._parse_datatype_string("a int, gone string, name string"), T._parse_datatype_string("a bigint, name string, extra double, gene string")
    e = evolve.evolution(old, new)
    assert e.added == ("extra", "gene") and e.removed == ("gone",) and ("gone", "gene") in e.renamed
    with pytest.raises(evolve.SchemaError):
        evolve.evolution(old, T._parse_datatype_string("a string"))
    with pytest.raises(evolve.SchemaError):
        evolve.contract(spark.range(1), ["nope"], strict=True)
    c = evolve.contract(spark.range(1).withColumn("_x", F.lit(1)), ["id"])
    assert c.holds and c.unexpected == ()
    with pytest.raises(evolve.SchemaError):
        evolve.concat_strict([spark.range(1), spark.range(1).toDF("x")])
    wide = evolve.concat_aligned([spark.range(1), spark.createDataFrame([(1.5,)], "id double")], widen=True)
    assert wide.schema["id"].dataType == T.DoubleType()
    assert evolve.levenshtein("kitten", "sitting") == 3


def test_profile_recommends(spark, sf):
    r = profile.recommend(spark.read.parquet(f"{sf}/events.parquet"), ["event_type", "event_id", "user_id"])
    assert r.columns == ("event_id",)
    pair = spark.createDataFrame([(a, b, 1) for a in range(4) for b in range(4)], "x_id int, y_id int, z int")
    assert set(profile.recommend(pair).columns) == {"x_id", "y_id"}
    assert profile.recommend(spark.createDataFrame([(1,), (1,)], "v int")).columns == ()
    assert profile.is_key_name("cust_id") and profile.is_key_name("ID") and not profile.is_key_name("idle")


def test_sinks(spark, tmp_path, sf):
    df = spark.createDataFrame([(1, "a", True, datetime(2024, 1, 1, 2, 3, 4, 567000)), (2, None, None, None)], "k int, s string, b boolean, t timestamp_ntz").coalesce(1)
    sinks.export_text(df, str(tmp_path / "x"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "x")).collect()] == ["1\ta\t1\t2024-01-01 02:03:04.567", "2\t\t\t"]
    with pytest.raises(sinks.LoadError):
        sinks.export_text(spark.createDataFrame([("a\tb",)], "s string"), str(tmp_path / "y"))
    assert sinks.load(df, str(tmp_path / "z"), expected=2) == 2
    with pytest.raises(sinks.LoadError):
        sinks.load(df, str(tmp_path / "w"), expected=3)
    assert '"name": "k"' in sinks.format_description(df.schema)
    sinks.create(spark, str(tmp_path / "stage"), sinks.stage_schema(df.schema))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 0
    assert sinks.clustered(spark.read.parquet(f"{sf}/orders.parquet"), ["o_custkey"], "o_orderdate").count() > 0


def test_ops_tables(spark, tmp_path):
    import logging

    o = ops.Ops(spark, str(tmp_path))
    assert o.next_batch() == 1 and o.next_batch() == 2
    with pytest.raises(RuntimeError), o.track(1, "TABLE_TOTAL", "t", "s"):
        raise RuntimeError("boom")
    assert ops.failed(o.read("event"), "2020-01-01 00:00:00").first()["ErrorMessage"] == "boom"
    day = datetime(2024, 1, 1).date()
    o.checkpoint("t", "s", day, "FAILED", 1, "CDC")
    o.checkpoint("t", "s", day, "SUCCESS", 2)
    assert [r["Status"] for r in o.states("t", "s").collect()] == ["SUCCESS"]
    handler = ops.OpsHandler(o, 1)
    log = logging.getLogger("tidemark-test")
    log.addHandler(handler)
    log.warning("careful")
    assert o.read("log").first()["Message"] == "careful"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    o.record_audit(1, "t", "s", "TABLE", reconcile.table(a, a.where("k = 1"), ["k"]))
    o.record_audit(1, "t", "s", "TABLE", reconcile.table(a, a, ["k"]))
    assert sorted(r["Status"] for r in o.read("reconciliation").collect()) == ["FAILED", "PASSED"]
    assert ops.dirty_audits(o.read("reconciliation")).first()["SourceOnlyRows"] == 1


def test_slowest_ties(spark):
    """Of equal durations the rows of the lowest batches are kept, however the rows are read; nulls are last."""
    schema = "BatchId long, TableName string, EventType string, CompletedAt timestamp_ntz, DurationMs long, RowsProcessed long, Status string"
    row = lambda batch, name, ms, n: (batch, name, "TABLE_TOTAL", datetime(2024, 1, 2), ms, n, "SUCCESS")
    data = [row(b, "t", 9, 100 - b) for b in range(20)] + [row(0, "t", 9, 200), row(1, None, 9, 7), row(1, "a", None, 8), row(2, "a", 9, 1)]
    expected = [("a", 1), ("t", 100), ("t", 200), ("t", 99), ("t", 98)]
    for rows in (data, data[::-1], random.Random(1).sample(data, len(data))):
        for parts in (1, 3):
            df = spark.createDataFrame(rows, schema).repartition(parts)
            assert [(r["TableName"], r["RowsProcessed"]) for r in ops.slowest(df, "2024-01-01 00:00:00", 5).collect()] == expected
    assert [r["RowsProcessed"] for r in ops.slowest(df, "2024-01-01 00:00:00", 99).collect()][-2:] == [7, 8]


def test_llm_is_optional():
    import subprocess
    import sys

    code = "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'cdc_summary' in q and 'pipeline' not in q and not [k for k in q if k.startswith('op1_')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_weekday_baseline_falls_back(spark):
    from datetime import date

    rows = [(datetime(2024, 1, d, 5), 10 * d) for d in range(1, 9)]
    df = spark.createDataFrame(rows, "CompletedAt timestamp_ntz, RowsProcessed long")
    got = guards.weekday_baseline(df, date(2024, 1, 9)).first()
    assert got["same_weekday"] is False and got["baseline"] == 45


def test_plans_of_latest_and_integrity(spark):
    """The newest row of a key is carried once through one exchange; the integrity checks share an exchange by key."""
    from tidemark.operators import keys, reconcile

    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (1, 3, None), (2, None, "c")], "k long, t int, v string")
    newest = keys.latest(df, ["k"], ["t"])
    assert sorted(map(tuple, newest.collect())) == [(1, 3, "b"), (2, None, "c")]
    plan = newest._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan
    history = spark.sql("select 1L k, 'h' UdmHash, timestamp_ntz'2024-01-01' UdmEffectiveDateTime, cast(null as timestamp_ntz) UdmEndDateTime, 1Y UdmActiveFlag, 'I' UdmScd2Operation")
    plan = reconcile.integrity(history, ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == 1
