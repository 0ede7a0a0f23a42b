"""Audits of a source, its change-tracking table and its history.

Each audit is a plan that gives one row of counts with `is_clean`, or the rows in question. Columns are compared in
one pass, whatever their number. Overlapping intervals are found by a running maximum instead of a self-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import HASH, column
from .cdc import in_window
from .keys import align_keys, duplicate_keys
from .scd2 import ACTIVE, END, FAR, KEY, START, VERSION_HASH

GHOST_ALERT, SUM_TOLERANCE, Z_LIMIT, NULL_RATE_LIMIT, NULL_RATE_COLUMNS, VELOCITY_LIMIT, GAP_SECONDS = 0.001, 0.001, 2.0, 0.10, 20, 10, 1
SIZE_LIMIT = 50_000_000


def _n(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def beside(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row: each column is null in all rows but one."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*(F.max(column(c)).alias(c) for c in rows.columns))


def compared_columns(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns to compare: in both frames, not a key, not internal."""
    return [c for c in a.columns if c in b.columns and c not in keys and not c.startswith("_")]


def table(source: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows on each side, matched, mismatched, on one side only, mismatches per column (diff_<column>).

    Two nulls are equal; a null and a value aren't. Keys are unique on each side.
    """
    own = list(columns) if columns is not None else compared_columns(source, stage, keys)
    source, stage = align_keys(source, stage, keys)
    a = source.select(*(column(k) for k in keys), F.struct(F.lit(True).alias("there"), *(column(c) for c in own)).alias("_a"))
    b = stage.select(*(column(k) for k in keys), F.struct(F.lit(True).alias("there"), *(column(c) for c in own)).alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    differs = {c: has_a & has_b & ~F.col("_a")[c].eqNullSafe(F.col("_b")[c]) for c in own}
    any_differs = reduce(lambda x, y: x | y, differs.values(), F.lit(False))
    row = both.agg(
        _n(has_a).alias("source_rows"), _n(has_b).alias("stage_rows"), _n(has_a & has_b & ~any_differs).alias("matched_rows"), _n(any_differs).alias("mismatched_rows"),
        _n(has_a & ~has_b).alias("source_only_rows"), _n(has_b & ~has_a).alias("stage_only_rows"), *(_n(d).alias(f"diff_{c}") for c, d in differs.items()),
    )
    return row.withColumn("is_clean", (F.col("mismatched_rows") == 0) & (F.col("source_only_rows") == 0) & (F.col("stage_only_rows") == 0))


def table_windowed(source: DataFrame, stage: DataFrame, keys: Sequence[str], date_col: str, start: str, end: str, columns: Sequence[str] | None = None) -> DataFrame:
    """table() within [start, end), and the number of keys that a side has twice; two empty sides are clean."""
    source, stage = in_window(source, date_col, start, end), in_window(stage, date_col, start, end)
    doubled = duplicate_keys(source, keys).select(F.lit(1).alias("x")).unionAll(duplicate_keys(stage, keys).select(F.lit(1).alias("x"))).agg(F.count("x").alias("duplicate_keys"))
    row = beside(table(source, stage, keys, columns), doubled)
    return row.withColumn("is_clean", F.col("is_clean") & (F.col("duplicate_keys") == 0))


def counts(source: DataFrame, stage: DataFrame, history: DataFrame) -> DataFrame:
    """One row: rows of the source, in force in the stage, active in the history, and the differences."""
    one = [df.agg(F.count(F.lit(1)).alias(name)) for df, name in ((source, "source_count"), (stage, "stage_count"), (history.where(F.col(ACTIVE) == 1), "bronze_active_count"))]
    row = beside(*one)
    row = row.withColumns({"count_delta_source_stage": F.col("source_count") - F.col("stage_count"), "count_delta_stage_bronze": F.col("stage_count") - F.col("bronze_active_count")})
    return row.withColumn("is_clean", (F.col("count_delta_source_stage") == 0) & (F.col("count_delta_stage_bronze") == 0))


def _sides(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, in_a, in_b) for each key of either side."""
    a, b = align_keys(a.select(*(column(k) for k in keys)), b.select(*(column(k) for k in keys)), keys)
    marked = a.withColumns({"in_a": F.lit(1), "in_b": F.lit(0)}).unionByName(b.withColumns({"in_a": F.lit(0), "in_b": F.lit(1)}))
    return marked.groupBy(*(column(k) for k in keys)).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))


def active_keys(source: DataFrame, history: DataFrame, keys: Sequence[str], alert: float = GHOST_ALERT) -> DataFrame:
    """One row: distinct keys of the source and active in the history, ghosts (active only), missing (source only)."""
    both = _sides(source, history.where(F.col(ACTIVE) == 1), keys)
    row = both.agg(_n(F.col("in_a") == 1).alias("source_pk_count"), _n(F.col("in_b") == 1).alias("bronze_active_pk_count"), _n(F.col("in_a") == 0).alias("ghost_count"), _n(F.col("in_b") == 0).alias("missing_count"))
    share = F.when(F.col("bronze_active_pk_count") > 0, F.col("ghost_count") / F.col("bronze_active_pk_count")).otherwise(F.lit(0.0))
    return row.withColumns({"ghost_ratio": share, "ghost_alert": share > alert, "is_clean": (F.col("ghost_count") == 0) & (F.col("missing_count") == 0)})


def bronze(stage_current: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in force against active versions by key and hash. Two null hashes are equal here."""
    a, b = align_keys(stage_current.select(*(column(k) for k in keys), column(HASH).alias("_h")), history.where(F.col(ACTIVE) == 1).select(*(column(k) for k in keys), column(VERSION_HASH).alias("_v")), keys)
    versions = b.groupBy(*(column(k) for k in keys)).agg(F.count(F.lit(1)).alias("_n"), F.max_by(F.struct("_v"), F.struct("_v")).alias("_b"))
    both = a.withColumn("_a", F.struct("_h")).drop("_h").join(versions, list(keys), "full_outer")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    same = F.col("_a._h").eqNullSafe(F.col("_b._v"))
    row = both.agg(
        _n(has_a).alias("stage_current_rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("bronze_active_rows"), _n(has_a & has_b & same).alias("matched_rows"), _n(has_a & has_b & ~same).alias("hash_mismatches"),
        _n(has_b & ~has_a).alias("orphaned_bronze_rows"), _n(has_a & ~has_b).alias("missing_bronze_rows"), _n(F.col("_n") > 1).alias("duplicate_active_pks"),
    )
    bad = F.col("hash_mismatches") + F.col("orphaned_bronze_rows") + F.col("missing_bronze_rows") + F.col("duplicate_active_pks")
    return row.withColumn("is_clean", bad == 0)


def _by_time(keys: Sequence[str], history: DataFrame):
    tie = [column(KEY)] if KEY in history.columns else [column(VERSION_HASH)]
    return Window.partitionBy(*(column(k) for k in keys)).orderBy(column(START), F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz")), *tie)


def overlaps(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that begin before an earlier one of their key has ended, with that end (previous_end).

    In order of begin, an overlap with any earlier version is one with the latest end so far.
    """
    end = F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz"))
    before = F.max(end).over(_by_time(keys, history).rowsBetween(Window.unboundedPreceding, -1))
    return history.withColumn("previous_end", before).where((F.col("previous_end") > column(START)) & (column(START) < end))


def inverted(history: DataFrame) -> DataFrame:
    """Versions that end before they begin."""
    return history.where(column(END) < column(START))


def zero_active(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, n_versions) of keys without an active version: deleted keys, or a fault."""
    own = history.groupBy(*(column(k) for k in keys)).agg(F.count(F.lit(1)).alias("n_versions"), _n(column(ACTIVE) == 1).alias("_active"))
    return own.where("_active = 0").drop("_active")


def gaps(history: DataFrame, keys: Sequence[str], seconds: int = GAP_SECONDS) -> DataFrame:
    """(*keys, previous_end, next_start, gap_seconds) where a version begins more than `seconds` after the one before."""
    end = F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz"))
    previous = F.lag(end).over(_by_time(keys, history))
    whole = lambda c: F.unix_timestamp(c.cast("timestamp"))  # noqa: E731  second boundaries, not fractions
    own = history.withColumn("previous_end", previous).withColumn("gap_seconds", whole(column(START)) - whole(F.col("previous_end")))
    return own.where(F.col("gap_seconds") > seconds).select(*(column(k) for k in keys), "previous_end", column(START).alias("next_start"), "gap_seconds")


def integrity(history: DataFrame, keys: Sequence[str], *, deletions_are_faults: bool = False) -> DataFrame:
    """One row: overlapping versions, keys without an active version, gaps, inverted intervals."""
    end, by_time = F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz")), _by_time(keys, history)
    tie = KEY if KEY in history.columns else VERSION_HASH
    whole = lambda c: F.unix_timestamp(c.cast("timestamp"))
    own = history.select(*(column(k) for k in keys), column(START), column(END), column(ACTIVE), *([] if tie in keys else [column(tie)]))
    # one window for what the four checks look back at, and one aggregate by the same keys: a single exchange
    own = own.withColumns({"_reached": F.max(end).over(by_time.rowsBetween(Window.unboundedPreceding, -1)), "_before": F.lag(end).over(by_time)})
    total = own.groupBy(*(column(k) for k in keys)).agg(
        _n((F.col("_reached") > column(START)) & (column(START) < end)).alias("_overlapping"), _n(column(ACTIVE) == 1).alias("_active"),
        _n(whole(column(START)) - whole(F.col("_before")) > GAP_SECONDS).alias("_gaps"), _n(column(END) < column(START)).alias("_inverted"),
    )
    summed = lambda name: F.coalesce(F.sum(name), F.lit(0).cast("long"))
    row = total.agg(summed("_overlapping").alias("overlapping_intervals"), _n(F.col("_active") == 0).alias("zero_active_pks"), summed("_gaps").alias("version_gaps"), summed("_inverted").alias("inverted_intervals"))
    bad = F.col("overlapping_intervals") + F.col("version_gaps") + F.col("inverted_intervals") + (F.col("zero_active_pks") if deletions_are_faults else F.lit(0))
    return row.withColumn("is_clean", bad == 0)


def samples(rows: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first n keys of rows in question."""
    return rows.select(*(column(k) for k in keys)).distinct().orderBy(*(column(k) for k in keys)).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and not f.name.startswith("_") and f.name not in (VERSION_HASH, ACTIVE)]


def _long_form(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """(column, *measures): one aggregate over df, turned into a row for each column."""
    row = df.agg(*(m(column(c)).alias(f"{name}|{c}") for c in columns for name, m in measures.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), *(column(f"{name}|{c}").alias(name) for name in measures)) for c in columns))).alias("r")).select("r.*")


def aggregates(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None, tolerance: float = SUM_TOLERANCE) -> DataFrame:
    """(column, count, sum, min, max of both sides, count_mismatch, sum_mismatch) for each numeric column."""
    own = [c for c in (columns or numeric_columns(source)) if c in target.columns]
    m = {"count": lambda c: F.count(c), "sum": lambda c: F.sum(c.cast("double")), "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")}
    a, b = _long_form(source, own, {f"source_{k}": f for k, f in m.items()}), _long_form(target, own, {f"target_{k}": f for k, f in m.items()})
    both = a.join(b, "column")
    x, y = F.col("source_sum"), F.col("target_sum")
    differs = F.when(x.isNull() | y.isNull(), ~x.eqNullSafe(y)).when(x != 0, F.abs(x - y) / F.abs(x) > tolerance).otherwise(y != 0)
    return both.withColumns({"count_mismatch": F.col("source_count") != F.col("target_count"), "sum_mismatch": differs})


def distribution(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, mean, sd, n): what is kept as a baseline."""
    return _long_form(df, list(columns or numeric_columns(df)), {"mean": lambda c: F.avg(c.cast("double")), "sd": lambda c: F.stddev_samp(c.cast("double")), "n": lambda c: F.count(c)})


def distribution_shift(df: DataFrame, baseline: DataFrame, columns: Sequence[str] | None = None, limit: float = Z_LIMIT) -> DataFrame:
    """(column, mean, sd, baseline_mean, baseline_sd, z, shifted): means in standard deviations of the baseline."""
    now = distribution(df, columns)
    both = now.join(baseline.select("column", F.col("mean").alias("baseline_mean"), F.col("sd").alias("baseline_sd")), "column")
    z = F.when(F.col("baseline_sd") > 0, F.abs(F.col("mean") - F.col("baseline_mean")) / F.col("baseline_sd"))
    return both.select("column", "mean", "sd", "baseline_mean", "baseline_sd", z.alias("z"), F.coalesce(z > limit, F.lit(False)).alias("shifted"))


def boundary(source: DataFrame, target: DataFrame, keys: Sequence[str], source_filter: str | None = f"{ACTIVE} = 1", limit: float = NULL_RATE_LIMIT) -> DataFrame:
    """One row: rows on both sides of a transformation, their difference, target keys without a source row, columns
    (among the first 20) whose share of nulls differs by more than the limit."""
    active = source.where(source_filter) if source_filter else source
    own = [c for c in target.columns if not c.startswith("_") and c in source.columns][:NULL_RATE_COLUMNS]
    rate = {"rate": lambda c: F.coalesce(F.avg(c.isNull().cast("double")), F.lit(0.0))}
    a, b = _long_form(active, own, rate).withColumnRenamed("rate", "a"), _long_form(target, own, rate).withColumnRenamed("rate", "b")
    odd = a.join(b, "column").where(F.abs(F.col("a") - F.col("b")) > limit).agg(F.array_sort(F.collect_list("column")).alias("null_rate_anomalies"))
    left, right = align_keys(target, active, keys)
    orphans = left.join(right.select(*(column(k) for k in keys)), list(keys), "left_anti").agg(F.count(F.lit(1)).alias("orphaned_keys"))
    row = beside(active.agg(F.count(F.lit(1)).alias("source_count")), target.agg(F.count(F.lit(1)).alias("target_count")), orphans, odd)
    row = row.withColumn("count_delta", F.col("source_count") - F.col("target_count"))
    return row.withColumn("is_clean", (F.col("count_delta") == 0) & (F.col("orphaned_keys") == 0) & (F.size("null_rate_anomalies") == 0))


def orphaned_references(fact: DataFrame, dimension: DataFrame, fk: str, pk: str, *, at: str | None = None) -> DataFrame:
    """Rows of fact whose reference (not null) has no row; at: the fact's instant, at which a version must be in force."""
    dim = dimension.select(column(pk).alias("_pk"), *((column(START).alias("_start"), F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz")).alias("_end")) if at else ()))
    if not at and ACTIVE in dimension.columns:
        dim = dimension.where(column(ACTIVE) == 1).select(column(pk).alias("_pk"))
    on = column(fk) == F.col("_pk")
    if at:
        on = on & (F.col("_start") <= column(at)) & (column(at) < F.col("_end"))
    return fact.where(column(fk).isNotNull()).join(dim, on, "left_anti")


def ambiguous_references(fact: DataFrame, dimension: DataFrame, fk: str, pk: str, *, at: str | None = None, fact_keys: Sequence[str] = ()) -> DataFrame:
    """(fk[, fact keys], n) where a reference has several rows in force."""
    if at:
        dim = dimension.select(column(pk).alias("_pk"), column(START).alias("_start"), F.coalesce(column(END), F.lit(FAR).cast("timestamp_ntz")).alias("_end"))
        on = (column(fk) == F.col("_pk")) & (F.col("_start") <= column(at)) & (column(at) < F.col("_end"))
        return fact.join(dim, on).groupBy(*(column(c) for c in (*fact_keys, fk, at))).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    active = dimension.where(column(ACTIVE) == 1) if ACTIVE in dimension.columns else dimension
    several = duplicate_keys(active, [pk]).withColumnRenamed(pk, fk)
    return several.join(fact.select(column(fk)).distinct(), fk, "left_semi")


def references(fact: DataFrame, dimension: DataFrame, fk: str, pk: str, *, at: str | None = None, fact_keys: Sequence[str] = ()) -> DataFrame:
    """One row: rows of fact, orphaned and ambiguous references."""
    one = [df.agg(F.count(F.lit(1)).alias(name)) for df, name in ((fact, "total_fact_rows"), (orphaned_references(fact, dimension, fk, pk, at=at), "orphaned_fks"), (ambiguous_references(fact, dimension, fk, pk, at=at, fact_keys=fact_keys), "ambiguous_fks"))]
    row = beside(*one)
    return row.withColumn("is_clean", (F.col("orphaned_fks") == 0) & (F.col("ambiguous_fks") == 0))


def velocity(history: DataFrame, keys: Sequence[str], limit: int = VELOCITY_LIMIT) -> DataFrame:
    """One row: versions per key on average and at most, and keys with more than `limit`."""
    per_key = history.groupBy(*(column(k) for k in keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_versions"), F.coalesce(F.max("n"), F.lit(0)).alias("max_versions"), _n(F.col("n") > limit).alias("high_velocity_pks"))
