"""Guards around a run: volumes, dates to process, freshness, ratios. Decisions are plain functions of counts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import column

DROP, WARN, GROWTH = 0.10, 0.50, 5.0
CEILING, DAILY_CEILING = 100_000_000, 10_000_000
RUNS, DAYS, LOOKBACK = 14, 30, 30
ACTIVE_ALARM, STALE_HOURS, DEAD_HOURS = 0.01, 36, 48


@dataclass(frozen=True)
class Decision:
    proceed: bool
    kind: str = "ok"


def decide(fresh: int, baseline: int | None, *, drop: float = DROP, warn: float = WARN, growth: float = GROWTH, ceiling: int = CEILING) -> Decision:
    """Whether a count of fresh rows is plausible against a baseline; without one only the ceiling counts."""
    if not baseline:
        return Decision(fresh <= ceiling, "ok" if fresh <= ceiling else "ceiling")
    if drop > 0 and fresh < int(baseline * drop):
        return Decision(False, "drop")
    if fresh > int(baseline * growth):
        return Decision(False, "growth")
    return Decision(True, "warn" if warn > 0 and 0 < int(baseline * warn) and fresh < int(baseline * warn) else "ok")


def decide_daily(fresh: int, baseline: int | None, **limits) -> Decision:
    """decide() for one day: days may be empty, and the first may be large up to a lower ceiling."""
    return decide(fresh, baseline, **({"drop": 0, "ceiling": DAILY_CEILING} | limits))


def decisions(counts: DataFrame, *, drop: float = DROP, warn: float = WARN, growth: float = GROWTH, ceiling: int = CEILING) -> DataFrame:
    """counts (…, fresh_count, baseline_count) with guard: ok, warn, drop, growth or ceiling."""
    fresh, b = F.col("fresh_count"), F.col("baseline_count")
    floor = lambda share: F.floor(b * F.lit(share))
    none = b.isNull() | (b == 0)
    guard = F.when(none & (fresh > ceiling), "ceiling").when(none, "ok").when((F.lit(drop) > 0) & (fresh < floor(drop)), "drop").when(fresh > floor(growth), "growth").when((F.lit(warn) > 0) & (floor(warn) > 0) & (fresh < floor(warn)), "warn").otherwise("ok")
    return counts.withColumn("guard", guard)


def median_baseline(events: DataFrame, *, count: str = "RowsProcessed", at: str = "CompletedAt", runs: int = RUNS) -> DataFrame:
    """One row: the median of the last `runs` counts, floored for an even number of them."""
    last = events.where(column(count).isNotNull()).orderBy(column(at).desc(), column(count).desc()).limit(runs)
    return last.agg(F.floor(F.median(column(count))).cast("long").alias("baseline"), F.count(F.lit(1)).alias("n_runs"))


def weekday_baseline(events: DataFrame, day: date, *, count: str = "RowsProcessed", at: str = "CompletedAt", runs: int = RUNS, days: int = DAYS) -> DataFrame:
    """One row: the median over the same weekday of the last 30 days, or over any day if that has fewer than two runs."""
    start = F.lit(str(day - timedelta(days=days))).cast("timestamp_ntz")
    own = events.where((column(at) >= start) & (column(at) < F.lit(str(day)).cast("timestamp_ntz")) & column(count).isNotNull())
    same = own.where(F.dayofweek(column(at)) == (day.isoweekday() % 7) + 1)
    a, b = median_baseline(same, count=count, at=at, runs=runs), median_baseline(own, count=count, at=at, runs=runs)
    both = a.withColumn("_rank", F.when(F.col("n_runs") >= 2, 0).otherwise(2)).unionByName(b.withColumn("_rank", F.lit(1)))
    return both.orderBy("_rank").limit(1).select("baseline", "n_runs", (F.col("_rank") == 0).alias("same_weekday"))


def gaps(done: DataFrame, start: Column | str, end: Column | str, *, day: str = "DateValue", status: str = "Status") -> DataFrame:
    """(date) of [start, end], both ends included, without a SUCCESS."""
    to = lambda x: F.lit(x).cast("date") if isinstance(x, str) else x
    wanted = done.sparkSession.range(1).select(F.explode(F.sequence(to(start), to(end))).alias("date"))
    had = done.where(column(status) == "SUCCESS").select(column(day).cast("date").alias("date")).distinct()
    return wanted.join(had, "date", "left_anti")


def last_success(done: DataFrame, *, day: str = "DateValue", status: str = "Status") -> DataFrame:
    return done.where(column(status) == "SUCCESS").agg(F.max(column(day)).alias("last_success"))


def failed_dates(done: DataFrame, start: str, end: str, *, day: str = "DateValue", status: str = "Status") -> DataFrame:
    """Days whose status is FAILED or FAILED_<step>."""
    d = column(day).cast("date")
    return done.where(F.startswith(column(status), F.lit("FAILED")) & d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(d.alias("date"), column(status).alias("status"))


def parse_date(text: str) -> date:
    """A day written as YYYY-MM-DD, YYYYMMDD or MM/DD/YYYY."""
    from datetime import datetime

    for form in ("%Y-%m-%d", "%Y%m%d", "%m/%d/%Y"):
        try:
            return datetime.strptime(text.strip()[:10], form).date()
        except ValueError:
            continue
    raise ValueError(f"not a date: {text}")


def dates_to_process(today: date, last: date | None, succeeded: set[date], *, first_load: date | None = None, lookback: int = LOOKBACK, reprocess_lookback: bool = True) -> list[date]:
    """Days up to yesterday: those without success since the last one, and the lookback again unless that is off.

    Without history it begins at the first load, or else at the lookback. Nothing is before the first load.
    """
    yesterday = today - timedelta(days=1)
    back = yesterday - timedelta(days=lookback)
    start = last + timedelta(days=1) if last else first_load or back
    begin = min(start, back)
    if first_load:
        begin = max(begin, first_load)
    days = [begin + timedelta(days=i) for i in range((yesterday - begin).days + 1)]
    return [d for d in days if d not in succeeded or (reprocess_lookback and d >= back)]


def gap_alarm(today: date, last: date | None, lookback: int = LOOKBACK) -> bool:
    """Whether days older than the lookback may have been missed."""
    return last is not None and (today - timedelta(days=1) - last).days > lookback


def active_ratio(history: DataFrame, flag: str = "UdmActiveFlag") -> DataFrame:
    """One row: share of active versions; a warning below 1 %."""
    row = history.agg(F.coalesce(F.sum((column(flag) == 1).cast("long")), F.lit(0)).alias("active"), F.count(F.lit(1)).alias("total"))
    ratio = F.when(F.col("total") > 0, F.col("active") / F.col("total"))
    return row.withColumns({"active_ratio": ratio, "warning": F.coalesce(ratio < ACTIVE_ALARM, F.lit(False))})


def freshness(df: DataFrame, at: str, now: str) -> DataFrame:
    """One row: the newest instant, hours since, and ok, warning (over 36 h) or error (over 48 h)."""
    row = df.agg(F.max(column(at)).alias("newest"))
    hours = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("newest").cast("timestamp"))) / 3600.0
    level = F.when(hours > DEAD_HOURS, "error").when(hours > STALE_HOURS, "warning").when(hours.isNull(), "empty").otherwise("ok")
    return row.withColumns({"age_hours": hours, "level": level})


def phantom_updates(update_ratio: float, n_updates: int, *, schema_changed: bool = False) -> str:
    """ok, or the level at which a suspicious share of updates is reported."""
    if update_ratio > 0.5 and n_updates > 1000:
        return "info" if schema_changed else "warning"
    return "ok"


def row_bytes(df: DataFrame, n: int = 1000) -> DataFrame:
    """One row: the mean size of a row as JSON over n rows: an estimate to size partitions by."""
    return df.limit(n).agg(F.avg(F.octet_length(F.to_json(F.struct(*(column(c) for c in df.columns))))).alias("bytes_per_row"))
