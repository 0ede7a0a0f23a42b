"""Sources in several formats, configurations, hints, windows, profiling of metadata."""

from datetime import date, datetime

import pytest

from tidemark.operators import profile
from tidemark.sources import registry as r


@pytest.mark.parametrize("kind", ["parquet", "json", "orc", "csv"])
def test_formats(spark, tmp_path, kind):
    df = spark.createDataFrame([(k, datetime(2024, 1, 1 + k % 4, 23, 30), f"v{k}") for k in range(12)], "k long, d timestamp, v string")
    df.write.format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(str(tmp_path / f"t.{kind}"))
    r.register_source(r.Source("here", kind, str(tmp_path), {"header": "true", "inferSchema": "true"} if kind == "csv" else {}))
    c = r.TableConfig("HERE", "t", source_aggregate_column_name="d")
    assert r.extract_full(spark, c).count() == 12
    assert r.extract_windowed(spark, c, date(2024, 1, 2)).count() == 3
    assert r.extract_windowed(spark, c, date(2024, 1, 2), overlap_minutes=60).count() == 6
    assert r.extract_range(spark, c, date(2024, 1, 1), date(2024, 1, 3)).count() == 6


def test_sentinels_are_scrubbed(spark, tmp_path):
    spark.createDataFrame([(1, datetime(9999, 12, 31)), (2, datetime(2024, 1, 1))], "k long, d timestamp_ntz").write.parquet(str(tmp_path / "s.parquet"))
    r.register_source(r.Source("sent", "parquet", str(tmp_path)))
    c = r.TableConfig("sent", "s")
    assert sorted((x["k"], x["d"]) for x in r.extract_full(spark, c).collect())[0][1] is None
    assert r.extract_full(spark, c, scrub=False).where("d is null").count() == 0
    with pytest.raises(ValueError):
        r.extract_range(spark, c, date(2024, 1, 1), date(2024, 1, 2))


def test_catalog_tables(spark):
    spark.range(5).toDF("k").createOrReplaceTempView("some_view")
    r.register_source(r.Source("cat", "table"))
    assert r.extract_full(spark, r.TableConfig("cat", "some_view")).count() == 5
    assert r.table_exists(spark, "some_view") and not r.table_exists(spark, "no_view")
    with pytest.raises(KeyError):
        r.get_source("nowhere")


def test_hints():
    assert r.hinted("ix", "s.t", where="d >= 1") == "SELECT /*+ INDEX(t ix) */ * FROM s.t WHERE d >= 1"
    assert r.hinted(None, "s.t") == "SELECT /*+ FULL */ * FROM s.t"


def test_configurations(spark):
    tables = spark.createDataFrame([("a", "x", None, "d", "Python"), ("a", "y", "yy", None, "Python"), ("a", "z", None, None, "Other")], "source_name string, source_object_name string, stage_table_name string, source_aggregate_column_name string, stage_load_tool string")
    columns = spark.createDataFrame([("a", "x", "k", 1, "Stage", True), ("a", "yy", "b", 2, "Stage", True), ("a", "yy", "a", 1, "Stage", True), ("a", "yy", "h", 3, "Bronze", False)], "source_name string, table_name string, column_name string, ordinal_position int, layer string, is_primary_key boolean")
    every = r.table_configs(tables, columns)
    assert [(c.source_object_name, c.is_large, c.keys) for c in every] == [("x", True, ["k"]), ("y", False, ["a", "b"])]
    assert [c.source_object_name for c in r.table_configs(tables, columns, large=True)] == ["x"]
    assert every[1].stage_name == "a.yy_cdc" and every[1].expected_columns == ["a", "b"]
    assert r.known_sources(tables).count() == 1 and r.known_tables(tables).count() == 3


def test_null_partition_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "k int, p int")
    assert r.with_null_partition(df.where("p is not null"), "p", df).count() == 2


def test_metadata_checks(spark):
    tables = spark.createDataFrame([("a", "d"), ("b", "d")], "table_name string, date_column string")
    indexes = spark.createDataFrame([("a", "d", 1), ("b", "d", 2)], "table_name string, column_name string, ordinal int")
    assert {x["table_name"]: x["has_index"] for x in profile.date_index_coverage(indexes, tables).collect()} == {"a": True, "b": False}
    assert [x["table_name"] for x in profile.keyless(tables, spark.createDataFrame([("a",)], "table_name string")).collect()] == ["b"]
    recorded = spark.createDataFrame([("k", "int"), ("v", "string")], "column_name string, data_type string")
    assert profile.type_drift(spark.createDataFrame([(1, "x")], "k long, v string"), recorded) == ["k: int -> bigint"]


def test_columns_are_synced_once(spark):
    df = spark.createDataFrame([(k, 1) for k in range(9)], "x_id long, v int")
    c = r.TableConfig("a", "t")
    made = r.sync_columns(df, c)
    assert [(m.column_name, m.is_primary_key) for m in made] == [("x_id", True), ("v", False)]
    known = spark.createDataFrame([("a", "t", "v", 1, "Stage", True)], "source_name string, table_name string, column_name string, ordinal_position int, layer string, is_primary_key boolean")
    assert [m.column_name for m in r.sync_columns(df, c, known)] == ["v"]
    assert r.sync_columns(df, c, known, refresh_keys=True) == made


def test_command_line(spark, tmp_path, capsys):
    from tidemark.__main__ import main

    src, conf, root = (str(tmp_path / x) for x in ("src", "conf", "root"))
    spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string").write.parquet(f"{src}/t.parquet")
    spark.createDataFrame([("s", "parquet", src)], "name string, kind string, root string").write.parquet(f"{conf}/sources.parquet")
    spark.createDataFrame([("s", "t", None, "Python")], "source_name string, source_object_name string, source_aggregate_column_name string, stage_load_tool string").write.parquet(f"{conf}/tables.parquet")
    spark.createDataFrame([("s", "t", "k", 1, "Stage", True)], "source_name string, table_name string, column_name string, ordinal_position int, layer string, is_primary_key boolean").write.json(f"{conf}/columns.json")
    assert main(["small", "--config", conf, "--list-tables"], spark) == 0
    assert "s.t" in capsys.readouterr().out
    assert main(["small", "--config", conf, "--root", root, "--table", "T"], spark) == 0
    assert "t: SUCCESS" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["small", "--config", conf, "--table", "nope"], spark)


def test_ranges_reach_the_scan(spark, sf):
    """With sentinel dates scrubbed, as by default, the range is among the filters of the Parquet scan."""
    r.register_source(r.Source("plans", "parquet", sf))
    config = r.TableConfig("plans", "orders", source_aggregate_column_name="o_orderdate")
    for df in (r.extract_range(spark, config, date(1995, 1, 1), date(1995, 2, 1)), r.extract_windowed(spark, config, date(1995, 1, 1), overlap_minutes=30)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
        assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
