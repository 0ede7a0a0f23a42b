"""Type-2 history: versions of a key with validity [effective, end), an active flag and the operation that made them.

The next history is a pure function of the history and the current rows: one full outer join on the key, each matched
row giving the versions it becomes. Insertion, closing and activation are one commit, so no reader ever meets a key
with two active versions or none in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH, column
from .cdc import INTERNAL
from .keys import align_keys, changed, drop_null_keys, duplicate_keys, latest, numbered

KEY, VERSION_HASH, START, END, ACTIVE, OPERATION = "_scd2_key", "UdmHash", "UdmEffectiveDateTime", "UdmEndDateTime", "UdmActiveFlag", "UdmScd2Operation"
HISTORY = (KEY, VERSION_HASH, START, END, ACTIVE, OPERATION)
FAR = "9999-12-31 00:00:00"


def source_columns(current: DataFrame) -> list[str]:
    """Columns that a version keeps: all but the internal ones of either layer."""
    return [c for c in current.columns if c not in INTERNAL and c not in HISTORY]


def as_versions(current: DataFrame, run_ts: str, op: Column | str = "I", active: Column | int = 1) -> DataFrame:
    """Current rows (with their hash) as versions that begin at run_ts."""
    return current.select(
        *(column(c) for c in source_columns(current)),
        column(HASH).alias(VERSION_HASH),
        F.lit(run_ts).cast("timestamp_ntz").alias(START),
        F.lit(None).cast("timestamp_ntz").alias(END),
        F.lit(active).cast("tinyint").alias(ACTIVE) if isinstance(active, int) else active.cast("tinyint").alias(ACTIVE),
        (F.lit(op) if isinstance(op, str) else op).alias(OPERATION),
    )


def is_orphan() -> Column:
    """A version that a run wrote and never activated."""
    return (F.col(ACTIVE) == 0) & F.col(END).isNull() & F.col(OPERATION).isin("U", "R")


def drop_orphans(history: DataFrame) -> DataFrame:
    return history.where(~F.coalesce(is_orphan(), F.lit(False)))


@dataclass(frozen=True)
class Applied:
    """The next history, lazily, and (*keys, op): I new, U changed, R back again, C closed, N unchanged."""

    history: DataFrame
    ops: DataFrame

    def counts(self) -> DataFrame:
        """One row: inserts, new_versions, closes, unchanged, resurrections."""
        n = lambda *ops: F.coalesce(F.sum(F.col("op").isin(*ops).cast("long")), F.lit(0))
        return self.ops.agg(n("I").alias("inserts"), n("U", "R").alias("new_versions"), n("U", "C").alias("closes"), n("N").alias("unchanged"), n("R").alias("resurrections"))


def apply(history: DataFrame | None, current: DataFrame, keys: Sequence[str], run_ts: str, *, targeted: bool = False, deleted_keys: DataFrame | None = None, detect_resurrection: bool = False) -> Applied:
    """The history after the current rows (with their hash) were seen at run_ts; without surrogate keys.

    targeted: current is a part of the table, so keys that it lacks stay open, but for deleted_keys, which are always
    closed. detect_resurrection: a key with closed versions only gets operation R instead of I.
    """
    keys = list(keys)
    current = latest(drop_null_keys(current, keys), keys)
    if history is None:
        first = as_versions(current, run_ts)
        return Applied(first, first.select(*(column(k) for k in keys), F.lit("I").alias("op")))
    history = drop_orphans(history)
    if KEY in history.columns:
        history = history.drop(KEY)
    active = history.where(F.col(ACTIVE) == 1)
    closed = history.where(~F.coalesce(F.col(ACTIVE) == 1, F.lit(False)))
    # an earlier run may have left several active versions of a key: the latest counts, the others are closed
    newest = latest(active, keys, [START])
    extra = _extra_active(active, keys, run_ts)
    fresh, newest = align_keys(as_versions(current, run_ts), newest, keys)
    f = fresh.select(*(column(k) for k in keys), F.struct(*(column(c) for c in fresh.columns)).alias("_f"))
    e = newest.select(*(column(k) for k in keys), F.struct(*(column(c) for c in newest.columns)).alias("_e"))
    both = f.join(e, keys, "full_outer")
    has_f, has_e = F.col("_f").isNotNull(), F.col("_e").isNotNull()
    if deleted_keys is not None:
        both = both.join(deleted_keys.select(*(column(k) for k in keys)).distinct().withColumn("_gone", F.lit(True)), keys, "left")
    gone = F.coalesce(F.col("_gone"), F.lit(False)) if deleted_keys is not None else F.lit(False)
    lost = (F.lit(not targeted) | gone) & ~has_f & has_e
    fresh_op = F.lit("I")
    if detect_resurrection:
        ended = closed.select(*(column(k) for k in keys)).distinct().withColumn("_ended", F.lit(True))
        both = both.join(ended, keys, "left")
        fresh_op = F.when(F.col("_ended"), F.lit("R")).otherwise(F.lit("I"))
    op = F.when(lost, "C").when(has_f & ~has_e, fresh_op).when(has_f & changed(F.col("_f")[VERSION_HASH], F.col("_e")[VERSION_HASH]), "U").otherwise("N")
    both = both.withColumn("_op", op)
    ts = F.lit(run_ts).cast("timestamp_ntz")

    def version(side: str, **new: Column) -> Column:
        have = set((fresh if side == "_f" else newest).columns)
        return F.struct(*((new[c] if c in new else F.col(side)[c] if c in have else F.lit(None)).cast(history.schema[c].dataType).alias(c) for c in history.columns))

    added = version("_f", **{OPERATION: F.col("_op"), ACTIVE: F.lit(1)})
    ended = version("_e", **{END: ts, ACTIVE: F.lit(0)})
    out = F.when(F.col("_op").isin("I", "R"), F.array(added)).when(F.col("_op") == "U", F.array(ended, added)).when(F.col("_op") == "C", F.array(ended)).otherwise(F.array(version("_e")))
    rewritten = both.select(F.explode(out).alias("v")).select("v.*")
    return Applied(closed.unionByName(extra).unionByName(rewritten), both.select(*(column(k) for k in keys), F.col("_op").alias("op")))


def _extra_active(active: DataFrame, keys: Sequence[str], run_ts: str) -> DataFrame:
    """Active versions beside the latest one of their key, closed at run_ts.

    Only keys that have several are read again; usually there are none.
    """
    rest = [c for c in active.columns if c not in (*keys, START)]
    several = duplicate_keys(active, keys, "_n").select(*(column(k) for k in keys))
    w = Window.partitionBy(*(column(k) for k in keys)).orderBy(column(START).desc(), *(column(c).desc() for c in rest))
    ranked = active.join(several, list(keys), "left_semi").withColumn("_rank", F.row_number().over(w)).where("_rank > 1")
    return ranked.drop("_rank").withColumns({END: F.lit(run_ts).cast("timestamp_ntz"), ACTIVE: F.lit(0).cast("tinyint")}).select(*(column(c) for c in active.columns))


def with_keys(history: DataFrame, keys: Sequence[str], start: Column | int = 0) -> DataFrame:
    """The history with a surrogate key: numbers from start + 1."""
    return numbered(history, [*keys, START], start, KEY)


def point_in_time(history: DataFrame, instant: str) -> DataFrame:
    """The version of each key that was in force at an instant."""
    at = F.lit(instant).cast("timestamp_ntz")
    return history.where((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))


def active_versions(history: DataFrame) -> DataFrame:
    """Active versions, without their surrogate key."""
    return history.where(F.col(ACTIVE) == 1).drop(KEY)


def for_keys(history: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Active versions of the wanted keys."""
    left, right = align_keys(active_versions(history), wanted.select(*(column(k) for k in keys)), keys)
    return left.join(right, list(keys), "left_semi")


def safe_current(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One active version for each key even if an interrupted run left several: the latest."""
    return latest(active_versions(history), keys, [START])


def duplicate_active(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, n) of keys with several active versions."""
    return duplicate_keys(history.where(F.col(ACTIVE) == 1), keys)


class DuplicateActive(ValueError):
    """Keys with several active versions."""


def assert_unique_active(history: DataFrame, keys: Sequence[str]) -> None:
    found = duplicate_active(history, keys).limit(5).collect()
    if found:
        raise DuplicateActive(f"several active versions, such as of {[tuple(r[k] for k in keys) for r in found]}")
