"""Key hygiene: null keys, duplicates, types, the change mask and stable row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import column

NULL_KEY_ALARM = 0.01


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (column(k).isNull() for k in keys))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all there."""
    return df.where(~any_null(keys))


def null_key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a null key, nulls per key column (null_<key>), share, whether it is an alarm."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(any_null(keys).cast("long")), F.lit(0)).alias("n_null_rows"), *(F.coalesce(F.sum(column(k).isNull().cast("long")), F.lit(0)).alias(f"null_{k}") for k in keys))
    share = F.when(F.col("n_rows") > 0, F.col("n_null_rows") / F.col("n_rows")).otherwise(F.lit(0.0))
    return counted.withColumns({"share": share, "alarm": share > NULL_KEY_ALARM})


def null_key_sample(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """A few rows with a null key, the first by all their columns."""
    return df.where(any_null(keys)).orderBy(*(column(c).asc_nulls_first() for c in df.columns)).limit(n)


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the last by `by`, ties by all columns in descending order.

    The row itself, in the order of comparison, is the aggregate's value, so it is carried once, rows of a key are
    combined before the shuffle, and no key's rows are gathered in a window.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    orderable = [c for c in rest if not isinstance(df.schema[c].dataType, (T.MapType,))]
    first = [c for c in (by or ())]
    rank = F.struct(*(column(c) for c in (*first, *(c for c in orderable if c not in first))))
    if not rest:
        return df.dropDuplicates(list(keys))
    # a map can't be compared, so such a row goes beside its rank
    whole = F.max(rank) if len(orderable) == len(rest) else F.max_by(F.struct(*(column(c) for c in rest)), rank)
    best = df.groupBy(*(column(k) for k in keys)).agg(whole.alias("_best"))
    return best.select(*(column(c) if c in set(keys) else F.col("_best")[c].alias(c) for c in df.columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """(*keys, n) of keys that several rows have."""
    return df.groupBy(*(column(k) for k in keys)).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def changed(new_hash: Column, old_hash: Column) -> Column:
    """Whether a row counts as changed: hashes differ, or one or both are null."""
    return (new_hash != old_hash) | new_hash.isNull() | old_hash.isNull()


#: Fixed order of numeric types, narrow to wide.
WIDTHS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that keys of two types are compared in: the wider number, else text."""
    if a == b:
        return a
    ranks = [next((i for i, w in enumerate(WIDTHS) if isinstance(x, w)), None) for x in (a, b)]
    return T.StringType() if None in ranks else (a, b)[ranks.index(max(ranks))]


def align_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their keys cast to a common type."""
    for k in keys:
        kind = wider(left.schema[k].dataType, right.schema[k].dataType)
        left, right = (df if df.schema[k].dataType == kind else df.withColumn(k, column(k).cast(kind)) for df in (left, right))
    return left, right


def numbered(df: DataFrame, order: Sequence[str], start: Column | int = 0, name: str = "_scd2_key", buckets: int | None = None) -> DataFrame:
    """df with dense numbers from start + 1, reproducible and without gathering all rows in one task.

    Rows are numbered inside hash buckets of their order columns; a bucket starts where the one before it ends. The
    sums over buckets are `buckets` rows: sixteen for each shuffle partition, which is sized with the data, and 1,024
    at least. The same number of buckets gives the same numbers.
    """
    buckets = buckets or max(1024, 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = F.pmod(F.xxhash64(*(column(c) for c in order)), F.lit(buckets)).cast("int")
    own = df.withColumn("_bucket", at)
    counts = own.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_bucket", (F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*(column(c) for c in order)))
    first = F.lit(start) if isinstance(start, int) else start
    return own.withColumn("_place", place).join(F.broadcast(before), "_bucket").withColumn(name, (first + F.col("_before") + F.col("_place")).cast("long")).drop("_bucket", "_place", "_before")


def rename_by_case(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Columns that match a wanted name in any case get exactly that name."""
    by = {w.lower(): w for w in wanted}
    return df.select(*(column(c).alias(by.get(c.lower(), c)) for c in df.columns))


def sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows by a seeded hash of the key: the same rows whatever the partitions."""
    return df.orderBy(F.xxhash64(*(column(k) for k in keys), F.lit(seed)), *(column(k) for k in keys)).limit(n)
