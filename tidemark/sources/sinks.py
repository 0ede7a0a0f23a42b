"""Writers: text export, format description, checked loads, table creation."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import column
from ..functions.sanitize import unsanitized
from ..operators.scd2 import ACTIVE, END, KEY, OPERATION, START, VERSION_HASH


class LoadError(ValueError):
    """A write that didn't take all rows, or rows that can't be written as text."""


def export_text(df: DataFrame, path: str, *, validate: bool = True, mode: str = "overwrite") -> None:
    """Tab-separated text without header or quotes; null is empty, booleans are 0 and 1, instants have milliseconds.

    validate: a value that holds a control character is an error, looked for in all rows.
    """
    if validate and not unsanitized(df).isEmpty():
        raise LoadError("a string holds a control character; sanitize first")
    shown = []
    for f in df.schema.fields:
        c = column(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("tinyint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        shown.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    # one column of text: the CSV writer would quote or escape
    df.select(F.concat_ws("\t", *shown).alias("value")).write.mode(mode).text(path)


def format_description(schema: T.StructType) -> str:
    """The columns of an export in order, as JSON."""
    return json.dumps([{"ordinal": i, "name": f.name, "type": f.dataType.simpleString(), "terminator": "\n" if i == len(schema.fields) else "\t"} for i, f in enumerate(schema.fields, 1)], indent=1)


def load(df: DataFrame, path: str, *, expected: int | None = None, mode: str = "errorifexists", target_rows: int = 5_000_000) -> int:
    """Writes Parquet and counts what was written from the files' footers; another count than expected is an error.

    Small known counts go to one file, others to a file for each `target_rows` rows or less.
    """
    if expected is not None and expected < 1000:
        df = df.coalesce(1)
    df.write.mode(mode).option("maxRecordsPerFile", target_rows).parquet(path)
    n = df.sparkSession.read.parquet(path).count()
    if expected is not None and mode != "append" and n != expected:
        raise LoadError(f"{n} rows written, {expected} expected")
    return n


def stage_schema(source: T.StructType) -> T.StructType:
    """Source columns and the change-tracking columns."""
    own = [T.StructField(f.name, f.dataType) for f in source.fields if not f.name.startswith("_")]
    ts = T.TimestampNTZType()
    return T.StructType([*own, T.StructField("_row_hash", T.StringType()), T.StructField("_extracted_at", ts), T.StructField("_cdc_operation", T.StringType()), T.StructField("_cdc_valid_from", ts), T.StructField("_cdc_valid_to", ts), T.StructField("_cdc_is_current", T.ByteType()), T.StructField("_cdc_batch_id", T.LongType())])


def history_schema(source: T.StructType) -> T.StructType:
    """Surrogate key, source columns and the version columns."""
    own = [T.StructField(f.name, f.dataType) for f in source.fields if not f.name.startswith("_")]
    ts = T.TimestampNTZType()
    return T.StructType([T.StructField(KEY, T.LongType()), *own, T.StructField(VERSION_HASH, T.StringType()), T.StructField(START, ts), T.StructField(END, ts), T.StructField(ACTIVE, T.ByteType()), T.StructField(OPERATION, T.StringType())])


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def clustered(df: DataFrame, keys: Sequence[str], newest_first: str | None = None) -> DataFrame:
    """Rows of near keys in the same files, in order: readers of a key, or of a key at a time, skip most row groups."""
    order = [column(k) for k in keys] + ([column(newest_first).desc()] if newest_first else [])
    return df.repartitionByRange(*(column(k) for k in keys)).sortWithinPartitions(*order)
