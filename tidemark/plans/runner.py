"""Runs of one table or many: extract, guard, evolve, track changes, keep history, checkpoint.

A source is read once for each table or day, into a landing folder: the guard's count, the merge and its counts are of
that one snapshot, and an error during the scan is retried, not only one on opening it. Tables run as independent jobs
of one driver, in FAIR pools.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sanitize import prepare
from ..operators import cdc, evolve, guards, scd2
from ..sources.registry import TableConfig, extract_full, extract_range, with_retries
from .ops import Ops, now
from .storage import TableLock, VersionedTable


@dataclass
class Run:
    """Where a run keeps its tables. extract: (spark, config, start, end) to a frame; both are None for a full one."""

    spark: SparkSession
    root: str
    force_guard: bool = False
    force_dates: bool = False
    extract: Callable[[SparkSession, TableConfig, date | None, date | None], DataFrame] | None = None

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.ops = Ops(self.spark, f"{self.root}/ops")

    def stage(self, c: TableConfig) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/stage/{c.stage_name}")

    def bronze(self, c: TableConfig) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/bronze/{c.bronze_name}")

    def fresh(self, c: TableConfig, start: date | None, end: date | None) -> DataFrame:
        if self.extract:
            return self.extract(self.spark, c, start, end)
        return extract_range(self.spark, c, start, end) if start else extract_full(self.spark, c)

    @contextmanager
    def landed(self, c: TableConfig, start: date | None, end: date | None) -> Iterator[DataFrame]:
        """The fresh rows, written once and read from there; gone when the table or day is done."""
        files = VersionedTable(self.spark, f"{self.root}/landing").files
        path = f"{self.root}/landing/{c.source_name}.{c.source_object_name}-{uuid.uuid4().hex}"

        def write():
            own = self.fresh(c, start, end)
            own.write.mode("overwrite").parquet(path)
            return own.schema

        try:
            yield self.spark.read.schema(with_retries(write)).parquet(path)
        finally:
            files.delete(path)


def _evolved(stage: DataFrame | None, fresh: DataFrame, config: TableConfig) -> tuple[DataFrame | None, DataFrame, bool]:
    """Both frames in one schema; a column that a source lost stays, as null."""
    evolve.contract(fresh, config.keys, strict=True)
    if stage is None:
        return None, fresh, False
    own = stage.select(*(c for c in stage.columns if not c.startswith("_")))
    found = evolve.evolution(own.schema, fresh.schema)
    internal = [f for f in stage.schema.fields if f.name.startswith("_")]
    return evolve.conform(stage, evolve.T.StructType([*found.schema.fields, *internal])), evolve.conform(fresh, found.schema), found.changed


def promote(run: Run, config: TableConfig, batch_id: int, fresh: DataFrame, run_ts: str, window: tuple[str, str, str] | None = None) -> dict:
    """Fresh rows into the change-tracking table and the history; the counts of both."""
    stage, bronze = run.stage(config), run.bronze(config)
    before, past = stage.version(), bronze.version()
    old, fresh, schema_changed = _evolved(stage.read(), fresh, config)
    prepared = prepare(fresh, run_ts)
    merged = cdc.merge(old, prepared, config.keys, run_ts, batch_id, window=window)
    with run.ops.track(batch_id, "CDC_PROMOTION", config.source_object_name, config.source_name) as event:
        counts = cdc.summary(merged.ops).first().asDict()
        version = stage.commit(merged.stage, after=before.number if before else 0, batch_id=batch_id)
        level = guards.phantom_updates(counts["update_ratio"], counts["updates"], schema_changed=schema_changed)
        event |= {"RowsInserted": counts["inserts"], "RowsUpdated": counts["updates"], "RowsDeleted": counts["deletes"], "RowsUnchanged": counts["unchanged"], "RowsProcessed": counts["n_fresh"], "RowsBefore": before.rows if before else 0, "RowsAfter": version.rows, "Metadata": {"update_ratio": counts["update_ratio"], "level": level}}
    # deletions are known from the version that was committed, not computed again from the source
    written = stage.read(version.number)
    gone = written.where((F.col("_cdc_is_current") == 0) & (F.col("_cdc_valid_to") == F.lit(run_ts).cast("timestamp_ntz"))).select(*config.keys).join(cdc.current(written).select(*config.keys), config.keys, "left_anti")
    current = cdc.in_window(cdc.current(written), *window) if window else cdc.current(written)
    history = bronze.read()
    if history is not None:
        history = evolve.conform(history, evolve.T.StructType([*history.schema.fields, *(f for f in current.schema.fields if f.name not in history.columns and f.name not in cdc.INTERNAL)]))
    applied = scd2.apply(history, current, config.keys, run_ts, targeted=window is not None, deleted_keys=gone)
    with run.ops.track(batch_id, "SCD2_PROMOTION", config.source_object_name, config.source_name) as event:
        made = applied.counts().first().asDict()
        done = bronze.commit(applied.history, after=past.number if past else 0, batch_id=batch_id)
        ratio = guards.active_ratio(bronze.read(done.number)).first().asDict()
        event |= {"RowsInserted": made["inserts"] + made["new_versions"], "RowsUpdated": made["closes"], "RowsUnchanged": made["unchanged"], "RowsAfter": done.rows, "Metadata": {"active_ratio": ratio["active_ratio"]}}
    scd2.assert_unique_active(bronze.read(done.number), config.keys)
    return counts | {f"history_{k}": v for k, v in made.items()}


def small_table(run: Run, config: TableConfig, batch_id: int, *, run_ts: str | None = None) -> str:
    """A full refresh: SUCCESS, or SKIPPED by the lock, an empty extract or the volume guard."""
    run_ts, c = run_ts or str(now()), config
    lock = TableLock(run.spark, f"{run.root}/locks", c.source_name, c.source_object_name)
    with run.ops.track(batch_id, "TABLE_TOTAL", c.source_object_name, c.source_name) as total:
        if not lock.acquire():
            total |= {"Status": "SKIPPED", "EventDetail": "lock"}
            return "SKIPPED"
        try:
            with run.landed(c, None, None) as fresh:
                return _refreshed(run, c, batch_id, run_ts, fresh, total)
        finally:
            lock.release()


def _refreshed(run: Run, c: TableConfig, batch_id: int, run_ts: str, fresh: DataFrame, total: dict) -> str:
    with run.ops.track(batch_id, "EXTRACT", c.source_object_name, c.source_name) as event:
        n = fresh.count()  # from footers
        own = run.ops.read("event").where((F.col("EventType") == "EXTRACT") & (F.col("Status") == "SUCCESS") & (F.col("TableName") == c.source_object_name) & (F.col("SourceName") == c.source_name) & (F.col("BatchId") != batch_id))
        decision = guards.decide(n, guards.median_baseline(own).first()["baseline"])
        event |= {"RowsProcessed": n, "EventDetail": decision.kind}
        if n == 0 or not (decision.proceed or run.force_guard):
            event["Status"] = total["Status"] = "SKIPPED"
            return "SKIPPED"
    total |= {"RowsProcessed": n}
    promote(run, c, batch_id, fresh, run_ts)
    return "SUCCESS"


def large_table(run: Run, config: TableConfig, batch_id: int, today: date, *, reprocess_lookback: bool = True) -> dict[date, str]:
    """Day by day up to yesterday: the status of each. A schema error ends the table, another error only its day."""
    c, out = config, {}
    lock = TableLock(run.spark, f"{run.root}/locks", c.source_name, c.source_object_name)
    if not lock.acquire():
        return out
    try:
        done = run.ops.states(c.source_object_name, c.source_name)
        succeeded = {r["DateValue"] for r in done.where("Status = 'SUCCESS'").select("DateValue").collect()}  # a row for each day
        first = guards.parse_date(c.first_load_date) if c.first_load_date else None
        days = guards.dates_to_process(today, max(succeeded, default=None), set() if run.force_dates else succeeded, first_load=first, lookback=c.lookback_days or guards.LOOKBACK, reprocess_lookback=reprocess_lookback)
        for day in days:
            lock.heartbeat()
            try:
                out[day] = _one_day(run, c, batch_id, day)
            except evolve.SchemaError as e:
                out[day] = "FAILED"
                run.ops.checkpoint(c.source_object_name, c.source_name, day, "FAILED", batch_id, "SCHEMA")
                raise e
            except Exception:
                out[day] = "FAILED"
                run.ops.checkpoint(c.source_object_name, c.source_name, day, "FAILED", batch_id, "DAY")
        return out
    finally:
        lock.release()


def _one_day(run: Run, c: TableConfig, batch_id: int, day: date) -> str:
    with run.landed(c, day, day + timedelta(days=1)) as fresh:
        return _promoted(run, c, batch_id, day, fresh)


def _promoted(run: Run, c: TableConfig, batch_id: int, day: date, fresh: DataFrame) -> str:
    start, end, n = day, day + timedelta(days=1), fresh.count()  # from footers
    with run.ops.track(batch_id, "EXTRACT", c.source_object_name, c.source_name) as event:
        own = run.ops.read("event").where((F.col("EventType") == "EXTRACT") & (F.col("Status") == "SUCCESS") & (F.col("TableName") == c.source_object_name) & (F.col("SourceName") == c.source_name) & (F.col("RowsProcessed") > 0))
        decision = guards.decide_daily(n, guards.weekday_baseline(own, day + timedelta(days=1)).first()["baseline"])
        event |= {"RowsProcessed": n, "EventDetail": f"{day} {decision.kind}"}
        if not (decision.proceed or run.force_guard):
            event["Status"] = "SKIPPED"
            run.ops.checkpoint(c.source_object_name, c.source_name, day, "SKIPPED", batch_id)
            return "SKIPPED"
    if n:
        run.ops.checkpoint(c.source_object_name, c.source_name, day, "EXTRACTED", batch_id)
        promote(run, c, batch_id, fresh, str(now()), (c.source_aggregate_column_name, str(start), str(end)))
    run.ops.checkpoint(c.source_object_name, c.source_name, day, "SUCCESS", batch_id)
    return "SUCCESS"


def run_tables(run: Run, configs: Sequence[TableConfig], today: date, *, workers: int = 4) -> dict[str, object]:
    """All tables, some at a time, each in a scheduler pool of its own; an error is that table's result."""
    batch_id = run.ops.next_batch()

    def one(c: TableConfig):
        run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", c.source_object_name)
        try:
            return large_table(run, c, batch_id, today) if c.is_large else small_table(run, c, batch_id)
        except Exception as e:
            return e

    with ThreadPoolExecutor(workers) as pool:
        return dict(zip((c.source_object_name for c in configs), pool.map(inheritable_thread_target(run.spark)(one), configs)))


