"""Change data: two snapshots of a keyed table to inserts, updates, deletes and unchanged rows.

One full outer join on the key classifies all rows, so each side is shuffled once; the older side brings only its key
and hash unless its rows are to be rewritten. Change-tracking tables are rewritten as pure functions of their
versions, so that a commit is one step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import HASH, column
from .keys import align_keys, changed, drop_null_keys, latest

INTERNAL = (HASH, "_extracted_at", "_cdc_operation", "_cdc_valid_from", "_cdc_valid_to", "_cdc_is_current", "_cdc_batch_id")
TRACKING = ("_cdc_operation", "_cdc_valid_from", "_cdc_valid_to", "_cdc_is_current", "_cdc_batch_id")
UPDATE_RATIO_ALARM, UPDATES_ALARM = 0.5, 1000


def _matched(fresh: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, _f, _e): rows of both sides side by side; the struct of a side that has no row is null."""
    fresh, existing = align_keys(drop_null_keys(fresh, keys), drop_null_keys(existing, keys), keys)
    f = fresh.select(*(column(k) for k in keys), F.struct(*(column(c) for c in fresh.columns)).alias("_f"))
    e = existing.select(*(column(k) for k in keys), F.struct(*(column(c) for c in existing.columns)).alias("_e"))
    return f.join(e, list(keys), "full_outer")


def operation(new_hash: Column, old_hash: Column, has_new: Column, has_old: Column) -> Column:
    """I, U, D or N."""
    return F.when(~has_old, "I").when(~has_new, "D").when(changed(new_hash, old_hash), "U").otherwise("N")


def diff(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """(*keys, op): I, U, D or N for every key of either side; keys are unique on each side."""
    both = _matched(fresh.select(*(column(c) for c in (*keys, hash_col))), existing.select(*(column(c) for c in (*keys, hash_col))), keys)
    return both.select(*(column(k) for k in keys), operation(F.col("_f")[hash_col], F.col("_e")[hash_col], F.col("_f").isNotNull(), F.col("_e").isNotNull()).alias("op"))


def change_feed(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """(*columns of fresh, op) of what changed: the new row for I and U, keys only for D."""
    slim = existing.select(*(column(c) for c in (*keys, hash_col)))
    both = _matched(fresh, slim, keys)
    op = operation(F.col("_f")[hash_col], F.col("_e")[hash_col], F.col("_f").isNotNull(), F.col("_e").isNotNull())
    rest = [c for c in fresh.columns if c not in set(keys)]
    return both.withColumn("op", op).where("op != 'N'").select(*(column(k) for k in keys), *(F.col("_f")[c].alias(c) for c in rest), "op")


def inserts(fresh: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of fresh whose key is new."""
    return drop_null_keys(fresh, keys).join(existing.select(*(column(k) for k in keys)), list(keys), "left_anti")


def deletes(fresh: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of existing whose key is gone."""
    return drop_null_keys(existing, keys).join(fresh.select(*(column(k) for k in keys)), list(keys), "left_anti")


def _hash_join(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    old = existing.select(*(column(k) for k in keys), column(hash_col).alias("_old_hash"))
    return fresh.join(old, list(keys), "inner")


def updates(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """Rows of fresh whose key is there with another hash."""
    return _hash_join(fresh, existing, keys, hash_col).where(changed(column(hash_col), F.col("_old_hash"))).drop("_old_hash").select(*(column(c) for c in fresh.columns))


def unchanged(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """Rows of existing that fresh repeats: a semi join on key and hash, as a null hash equals none."""
    return existing.join(fresh.select(*(column(c) for c in (*keys, hash_col))), [*keys, hash_col], "left_semi")


def summary(ops: DataFrame) -> DataFrame:
    """One row of counts of diff(): inserts, updates, deletes, unchanged, n_fresh, update_ratio, alarm.

    n_fresh is inserts + updates + unchanged; the ratio is updates over all operations, at least one.
    """
    n = {name: F.coalesce(F.sum((F.col("op") == op).cast("long")), F.lit(0)).alias(name) for op, name in (("I", "inserts"), ("U", "updates"), ("D", "deletes"), ("N", "unchanged"))}
    row = ops.agg(*n.values())
    total = F.greatest(F.col("inserts") + F.col("updates") + F.col("deletes") + F.col("unchanged"), F.lit(1))
    ratio = F.col("updates") / total
    return row.withColumns({"n_fresh": F.col("inserts") + F.col("updates") + F.col("unchanged"), "update_ratio": ratio, "alarm": (ratio > UPDATE_RATIO_ALARM) & (F.col("updates") > UPDATES_ALARM)})


class CountMismatch(ValueError):
    """Inserts, updates and unchanged rows that don't add up to the fresh rows."""


def check_counts(counts: dict, n_fresh: int) -> None:
    if counts["inserts"] + counts["updates"] + counts["unchanged"] != n_fresh:
        raise CountMismatch(f"{counts} do not add up to {n_fresh} fresh rows")


def in_window(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Rows of [start, end); the column itself is compared, so that files can be skipped."""
    kind = df.schema[date_col].dataType
    return df.where((column(date_col) >= F.lit(start).cast(kind)) & (column(date_col) < F.lit(end).cast(kind)))


def windowed_diff(fresh: DataFrame, existing: DataFrame, keys: Sequence[str], date_col: str, start: str, end: str, hash_col: str = HASH) -> DataFrame:
    """diff() with both sides limited to one window; nothing outside it is ever deleted."""
    return diff(in_window(fresh, date_col, start, end), in_window(existing, date_col, start, end), keys, hash_col)


def new_rows(df: DataFrame, op: Column | str, run_ts: str, batch_id: int) -> DataFrame:
    """df with the tracking columns of rows that this run writes."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumns({"_cdc_operation": F.lit(op) if isinstance(op, str) else op, "_cdc_valid_from": ts, "_cdc_valid_to": F.lit(None).cast("timestamp_ntz"), "_cdc_is_current": F.lit(1).cast("tinyint"), "_cdc_batch_id": F.lit(batch_id).cast("long")})


@dataclass(frozen=True)
class Merged:
    """The next version of a change-tracking table, lazily, and what led to it."""

    stage: DataFrame
    ops: DataFrame
    keys: tuple[str, ...]

    @property
    def current(self) -> DataFrame:
        """Rows in force."""
        return self.stage.where("_cdc_is_current = 1")

    @property
    def deleted_keys(self) -> DataFrame:
        return self.ops.where("op = 'D'").select(*(column(k) for k in self.keys))


def merge(stage: DataFrame | None, fresh: DataFrame, keys: Sequence[str], run_ts: str, batch_id: int, *, window: tuple[str, str, str] | None = None) -> Merged:
    """The change-tracking table after a fresh snapshot (with its hash).

    New and changed rows are written with op I or U; versions that are replaced or deleted end at run_ts. Only
    versions from before this run are ended. window: (date column, start, end), which limits both sides; other
    current rows stay. Keys that are null are left out, and of several rows of a key the last counts.
    """
    keys = tuple(keys)
    fresh = latest(drop_null_keys(fresh, keys), keys)
    if window:
        fresh = in_window(fresh, *window)
    if stage is None:
        first = new_rows(fresh, "I", run_ts, batch_id)
        return Merged(first, first.select(*(column(k) for k in keys), F.lit("I").alias("op")), keys)
    inside = F.col("_cdc_is_current") == 1
    if window:
        kind = stage.schema[window[0]].dataType
        inside = inside & (column(window[0]) >= F.lit(window[1]).cast(kind)) & (column(window[0]) < F.lit(window[2]).cast(kind))
    inside = F.coalesce(inside, F.lit(False))
    compared, rest = latest(stage.where(inside), keys, ["_cdc_valid_from"]), stage.where(~inside)
    ts = F.lit(run_ts).cast("timestamp_ntz")
    both = _matched(fresh, compared, keys)
    op = operation(F.col("_f")[HASH], F.col("_e")[HASH], F.col("_f").isNotNull(), F.col("_e").isNotNull())
    both = both.withColumn("_op", op)

    def row(side: str, kind: str) -> Column:
        tracking = {
            "new": {"_cdc_operation": F.col("_op"), "_cdc_valid_from": ts, "_cdc_valid_to": F.lit(None).cast("timestamp_ntz"), "_cdc_is_current": F.lit(1).cast("tinyint"), "_cdc_batch_id": F.lit(batch_id).cast("long")},
            "ended": {"_cdc_valid_to": ts, "_cdc_is_current": F.lit(0).cast("tinyint")},
            "kept": {},
        }[kind]
        have = set(fresh.columns if side == "_f" else compared.columns)
        fields = []
        for c in stage.columns:
            kind_of = stage.schema[c].dataType
            value = tracking[c] if c in tracking else F.col(side)[c] if c in have else F.lit(None)
            fields.append(value.cast(kind_of).alias(c))
        return F.struct(*fields)

    out = F.when(F.col("_op") == "I", F.array(row("_f", "new"))).when(F.col("_op") == "U", F.array(row("_e", "ended"), row("_f", "new"))).when(F.col("_op") == "D", F.array(row("_e", "ended"))).otherwise(F.array(row("_e", "kept")))
    rewritten = both.select(F.explode(out).alias("r")).select("r.*")
    return Merged(rest.unionByName(rewritten), both.select(*(column(k) for k in keys), F.col("_op").alias("op")), keys)


def current(stage: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in force, with the named columns and the internal ones."""
    own = stage.where("_cdc_is_current = 1")
    return own if columns is None else own.select(*(column(c) for c in (*columns, *(i for i in INTERNAL if i not in columns))))


def purge_expired(stage: DataFrame, run_ts: str, days: int = 30) -> DataFrame:
    """Without versions that ended more than `days` days before run_ts."""
    old = (F.col("_cdc_is_current") == 0) & (F.col("_cdc_valid_to") < F.lit(run_ts).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))
    return stage.where(~F.coalesce(old, F.lit(False)))
