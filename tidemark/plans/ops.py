"""Operational tables as appended Parquet, and the questions asked of them."""

from __future__ import annotations

import json
import logging
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import latest


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


TABLES = {
    "batch": "BatchId long, CreatedAt timestamp_ntz",
    "event": "BatchId long, TableName string, SourceName string, EventType string, EventDetail string, StartedAt timestamp_ntz, CompletedAt timestamp_ntz, DurationMs long, Status string, ErrorMessage string, RowsProcessed long, RowsInserted long, RowsUpdated long, RowsDeleted long, RowsUnchanged long, RowsBefore long, RowsAfter long, TableCreated boolean, Metadata string, RowsPerSecond double",
    "log": "BatchId long, TableName string, SourceName string, LogLevel string, Module string, FunctionName string, Message string, ErrorType string, StackTrace string, Metadata string, CreatedAt timestamp_ntz",
    "state": "TableName string, SourceName string, DateValue date, Status string, BatchId long, ProcessedAt timestamp_ntz",
    "quarantine": "TableName string, SourceName string, RejectionReason string, RecordData string, BatchId long, QuarantinedAt timestamp_ntz",
    "reconciliation": "BatchId long, TableName string, SourceName string, CheckType string, RunAt timestamp_ntz, Status string, IsClean boolean, SourceRows long, TargetRows long, MatchedRows long, MismatchedRows long, SourceOnlyRows long, TargetOnlyRows long, Errors string, Metadata string",
}


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Ops:
    """The operational tables under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, table: str, *rows: dict) -> None:
        schema = _schema(TABLES[table])
        known = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        self.spark.createDataFrame(known, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{table}")

    def append_rows(self, table: str, df: DataFrame) -> None:
        schema = _schema(TABLES[table])
        df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields)).write.mode("append").parquet(f"{self.root}/{table}")

    def read(self, table: str) -> DataFrame:
        schema = _schema(TABLES[table])
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{table}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def next_batch(self) -> int:
        n = (self.read("batch").agg(F.max("BatchId")).first()[0] or 0) + 1
        self.append("batch", {"BatchId": n, "CreatedAt": now()})
        return n

    @contextmanager
    def track(self, batch_id: int, event: str, table: str, source: str):
        """One event row for a step, with its duration, outcome and rows per second; the caller fills in counts."""
        row = {"BatchId": batch_id, "TableName": table, "SourceName": source, "EventType": event, "StartedAt": now(), "Status": "SUCCESS"}
        try:
            yield row
        except Exception as e:
            row |= {"Status": "FAILED", "ErrorMessage": str(e)[:4000]}
            raise
        finally:
            row["CompletedAt"] = now()
            seconds = (row["CompletedAt"] - row["StartedAt"]).total_seconds()
            row["DurationMs"] = int(seconds * 1000)
            if row.get("RowsProcessed") and seconds > 0:
                row["RowsPerSecond"] = round(row["RowsProcessed"] / seconds, 2)
            if isinstance(row.get("Metadata"), dict):
                row["Metadata"] = json.dumps(row["Metadata"])
            self.append("event", row)

    def checkpoint(self, table: str, source: str, day, status: str, batch_id: int, step: str | None = None) -> None:
        """The status of a day; FAILED carries its step. The last one written counts."""
        self.append("state", {"TableName": table, "SourceName": source, "DateValue": day, "Status": f"FAILED_{step}" if status == "FAILED" and step else status, "BatchId": batch_id, "ProcessedAt": now()})

    def states(self, table: str | None = None, source: str | None = None) -> DataFrame:
        """The last status of each (table, source, day)."""
        own = self.read("state")
        if table:
            own = own.where((F.col("TableName") == table) & (F.col("SourceName") == source))
        return latest(own, ["TableName", "SourceName", "DateValue"], ["ProcessedAt"])

    def record_audit(self, batch_id: int, table: str, source: str, check: str, result: DataFrame, errors: list[str] | None = None) -> dict:
        """Keeps an audit's one row, whatever its outcome; ERROR only if there are errors and it isn't clean."""
        r = result.first().asDict() if errors is None or not errors else {}
        clean = bool(r.get("is_clean", False))
        status = "PASSED" if clean else "ERROR" if errors else "FAILED"
        pick = lambda *names: next((r[n] for n in names if n in r), None)
        self.append("reconciliation", {
            "BatchId": batch_id, "TableName": table, "SourceName": source, "CheckType": check, "RunAt": now(), "Status": status, "IsClean": clean,
            "SourceRows": pick("source_rows", "source_count", "stage_current_rows", "source_pk_count"), "TargetRows": pick("stage_rows", "target_count", "bronze_active_rows", "bronze_active_pk_count", "stage_count"),
            "MatchedRows": pick("matched_rows"), "MismatchedRows": pick("mismatched_rows", "hash_mismatches"), "SourceOnlyRows": pick("source_only_rows", "missing_bronze_rows", "missing_count"),
            "TargetOnlyRows": pick("stage_only_rows", "orphaned_bronze_rows", "ghost_count"), "Errors": json.dumps(errors or []), "Metadata": json.dumps(r, default=str),
        })
        return r


class OpsHandler(logging.Handler):
    """Keeps log records in the log table: ten at a time, or at once from a warning on."""

    def __init__(self, ops: Ops, batch_id: int, size: int = 10):
        super().__init__()
        self.ops, self.batch_id, self.size, self.held = ops, batch_id, size, []

    def emit(self, record: logging.LogRecord) -> None:
        trace = logging.Formatter().formatException(record.exc_info) if record.exc_info else None
        self.held.append({"BatchId": self.batch_id, "TableName": getattr(record, "table", None), "SourceName": getattr(record, "source", None), "LogLevel": record.levelname, "Module": record.module, "FunctionName": record.funcName, "Message": record.getMessage(), "ErrorType": record.exc_info[0].__name__ if record.exc_info and record.exc_info[0] else None, "StackTrace": trace, "CreatedAt": now()})
        if len(self.held) >= self.size or record.levelno >= logging.WARNING:
            self.flush()

    def flush(self) -> None:
        if held := self.held:
            self.held = []
            self.ops.append("log", *held)


def slowest(events: DataFrame, since: str, n: int = 10) -> DataFrame:
    """The n longest runs of whole tables. Equal ones go by batch, then by what is shown, so the data alone decides which are kept; nulls are last."""
    own = events.where((F.col("EventType") == "TABLE_TOTAL") & (F.col("CompletedAt") > F.lit(since).cast("timestamp_ntz")))
    order = [F.desc_nulls_last("DurationMs"), *(F.asc_nulls_last(c) for c in ("TableName", "BatchId", "RowsProcessed", "Status"))]
    return own.orderBy(*order).limit(n).select("TableName", "EventType", "DurationMs", "RowsProcessed", "Status")


def failed(events: DataFrame, since: str) -> DataFrame:
    return events.where((F.col("Status") == "FAILED") & (F.col("CompletedAt") > F.lit(since).cast("timestamp_ntz"))).select("BatchId", "TableName", "EventType", "ErrorMessage", "CompletedAt")


def skipped(events: DataFrame, event: str | None = None) -> DataFrame:
    """Steps that a guard or a lock skipped."""
    own = events.where(F.col("Status") == "SKIPPED")
    return (own.where(F.col("EventType") == event) if event else own).select("TableName", "SourceName", "EventType", "EventDetail", "RowsProcessed", "Metadata", "CompletedAt")


def ratios(events: DataFrame, event: str, name: str, since: str, above: float | None = None) -> DataFrame:
    """(TableName, <name>, CompletedAt): a ratio that steps keep in their JSON metadata."""
    value = F.get_json_object("Metadata", f"$.{name}").try_cast("double")
    own = events.where((F.col("EventType") == event) & (F.col("CompletedAt") > F.lit(since).cast("timestamp_ntz"))).select("TableName", value.alias(name), "CompletedAt")
    return own.where(F.col(name) > above) if above is not None else own


def dirty_audits(log: DataFrame) -> DataFrame:
    return log.where(~F.col("IsClean")).select("TableName", "CheckType", "MismatchedRows", "SourceOnlyRows", "TargetOnlyRows", "RunAt")


def inventory(tables: DataFrame) -> DataFrame:
    """Configured tables with their class and way of extraction."""
    size = F.when(F.col("source_aggregate_column_name").isNotNull(), "LARGE").otherwise("SMALL")
    way = F.when(F.col("source_index_hint").isNotNull(), "hinted").when(F.col("partition_on").isNotNull(), "partitioned").otherwise("bulk")
    return tables.where("stage_load_tool = 'Python'").select("source_name", "source_object_name", size.alias("size_class"), way.alias("extraction_path"))


def key_gaps(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Configured tables with the number of their key and of all columns, those without a key first in need."""
    own = columns.where("layer = 'Stage'").groupBy("source_name", F.col("table_name").alias("_t")).agg(F.sum(F.col("is_primary_key").cast("long")).alias("_k"), F.count(F.lit(1)).alias("_n"))
    t = tables.where("stage_load_tool = 'Python'").withColumn("_t", F.coalesce("stage_table_name", "source_object_name"))
    return t.join(own, ["source_name", "_t"], "left").select("source_name", "source_object_name", F.coalesce("_k", F.lit(0)).alias("n_keys"), F.coalesce("_n", F.lit(0)).alias("n_columns"), F.when(F.coalesce("_n", F.lit(0)) == 0, "NOT SYNCED").otherwise("SYNCED").alias("metadata_status"), (F.coalesce("_k", F.lit(0)) == 0).alias("lacks_key"))


def key_columns(columns: DataFrame) -> DataFrame:
    """(source_name, table_name, keys): key columns in order, joined."""
    own = columns.where("is_primary_key and layer = 'Stage'").groupBy("source_name", "table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))).alias("k"))
    return own.select("source_name", "table_name", F.array_join(F.transform("k", lambda x: x["column_name"]), ",").alias("keys"))


def hint_assessment(tables: DataFrame, indexes: DataFrame) -> DataFrame:
    """(source_name, source_object_name, hint, exists, mode) of tables with an index hint."""
    known = indexes.select("table_name", "index_name").distinct().withColumn("_there", F.lit(True))
    own = tables.where("source_index_hint is not null").join(known, (F.col("source_object_name") == F.col("table_name")) & (F.col("source_index_hint") == F.col("index_name")), "left")
    return own.select("source_name", "source_object_name", F.col("source_index_hint").alias("hint"), F.coalesce("_there", F.lit(False)).alias("exists"), F.when(F.col("source_aggregate_column_name").isNull(), "full scan").otherwise("windowed").alias("mode"))


def staleness(df: DataFrame, at: str, now_ts: str) -> DataFrame:
    """df with age_days and bucket: up to 30 days, up to 90, or older."""
    age = F.datediff(F.lit(now_ts).cast("date"), F.col(at).cast("date"))
    return df.withColumns({"age_days": age, "bucket": F.when(age.isNull(), "never").when(age <= 30, "fresh").when(age <= 90, "aging").otherwise("stale")})


def retain(df: DataFrame, at: str, now_ts: str, days: int) -> DataFrame:
    """Rows of the last `days` days."""
    return df.where(F.col(at) >= F.lit(now_ts).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))
