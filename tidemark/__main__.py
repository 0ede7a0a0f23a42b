"""python -m tidemark {small,large} --config FOLDER --root FOLDER: runs configured tables.

The configuration folder has `tables` and `columns` as Parquet or JSON, with the columns of TableConfig and
ColumnConfig, and `sources` with name, kind and root.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from .plans.runner import Run, run_tables
from .sources.registry import Source, TableConfig, register_source, table_configs


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("kind", choices=["small", "large"])
    p.add_argument("--config", required=True)
    p.add_argument("--root", help="where tables are kept; not needed to list")
    p.add_argument("--workers", type=int, default=4)
    p.add_argument("--table", help="only this table")
    p.add_argument("--source", help="only this source")
    p.add_argument("--list-tables", action="store_true")
    p.add_argument("--force", action="store_true", help="proceed whatever the volume guards say")
    p.add_argument("--all-dates", action="store_true", help="process dates again that have succeeded")
    p.add_argument("--today", type=date.fromisoformat, default=date.today())
    return p.parse_args(argv)


def _config(spark: SparkSession, folder: str, name: str) -> DataFrame:
    for kind in ("parquet", "json"):
        try:
            return spark.read.format(kind).load(f"{folder}/{name}.{kind}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise FileNotFoundError(f"{folder}/{name}.parquet or .json")


def chosen(configs: list[TableConfig], table: str | None, source: str | None) -> list[TableConfig]:
    out = [c for c in configs if (table is None or c.source_object_name.lower() == table.lower()) and (source is None or c.source_name.lower() == source.lower())]
    if not out and (table or source):
        raise SystemExit(f"no such table; known: {', '.join(f'{c.source_name}.{c.source_object_name}' for c in configs)}")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments(argv)
    spark = spark or SparkSession.builder.config("spark.scheduler.mode", "FAIR").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for r in _config(spark, a.config, "sources").collect():
        register_source(Source(r["name"], r["kind"], r["root"]))
    configs = chosen(table_configs(_config(spark, a.config, "tables"), _config(spark, a.config, "columns"), large=a.kind == "large"), a.table, a.source)
    if a.list_tables:
        for c in configs:
            print(f"{c.source_name}.{c.source_object_name}")
        return 0
    if not a.root:
        raise SystemExit("--root is needed")
    results = run_tables(Run(spark, a.root, force_guard=a.force, force_dates=a.all_dates), configs, a.today, workers=a.workers)
    for name, result in results.items():
        print(f"{name}: {result}")
    return int(any(isinstance(r, Exception) for r in results.values()))


if __name__ == "__main__":
    sys.exit(main())
