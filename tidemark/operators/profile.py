"""Profiling of columns as keys and as partition columns: one pass over the data for any number of columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import column
from .cdc import in_window

#: What names of key columns begin or end with, and names that are one.
KEY_AFFIXES = ("_ID", "_KEY", "_CODE", "_NUM", "_NO", "_NBR", "_SEQ", "_NUMBER", "ID_")
KEY_NAMES = ("ID", "ROWID", "KEY", "CODE")
#: Scores, best first.
SCORES = ("CONFIRMED UNIQUE", "UNIQUE (but nullable)", "HIGH (>99% unique, not null)", "MEDIUM (PK name pattern, not null)", "MEDIUM (not null)", "LOW")
#: Distinct counts over many columns in one aggregate multiply its rows, so wide frames go in groups of this many.
GROUP = 8
MAX_SINGLES, MAX_PAIRS = 5, 10


def is_key_name(name: str) -> bool:
    upper = name.upper()
    return upper in KEY_NAMES or any(upper.startswith(a) or upper.endswith(a) for a in KEY_AFFIXES)


def columns(df: DataFrame, names: Sequence[str] | None = None, *, limit: int | None = None, approximate: bool = False) -> DataFrame:
    """(column, n_rows, n_distinct, n_null, uniqueness, is_unique, name_match, score) of each column.

    limit: profile the first rows only, as the caller wishes. approximate: distinct counts by sketch, as a first look.
    """
    names = list(names or df.columns)
    df = df.limit(limit) if limit else df
    out = None
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    for at in range(0, len(names), GROUP):
        own = names[at : at + GROUP]
        row = df.agg(F.count(F.lit(1)).alias("n"), *(distinct(column(c)).alias(f"d|{c}") for c in own), *(F.count(column(c)).alias(f"c|{c}") for c in own))
        entries = F.array(*(F.struct(F.lit(at + i).alias("position"), F.lit(c).alias("column"), F.col("n").alias("n_rows"), column(f"d|{c}").alias("n_distinct"), (F.col("n") - column(f"c|{c}")).alias("n_null"), F.lit(is_key_name(c)).alias("name_match")) for i, c in enumerate(own)))
        part = row.select(F.explode(entries).alias("e")).select("e.*")
        out = part if out is None else out.unionByName(part)
    uniqueness = F.when(F.col("n_rows") > 0, F.col("n_distinct") / F.col("n_rows")).otherwise(F.lit(0.0))
    unique, whole = (F.col("n_distinct") == F.col("n_rows")) & (F.col("n_null") == 0), F.col("n_null") == 0
    score = F.when(unique & whole, SCORES[0]).when(unique, SCORES[1]).when((uniqueness > 0.99) & whole, SCORES[2]).when(F.col("name_match") & whole, SCORES[3]).when(whole, SCORES[4]).otherwise(SCORES[5])
    return out.withColumns({"uniqueness": uniqueness, "is_unique": unique, "score": score})


def composites(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(columns, n_rows, n_distinct, is_unique) of each pair of columns; a pair with a null part counts."""
    out = None
    for at in range(0, len(pairs), GROUP):
        own = list(pairs[at : at + GROUP])
        row = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_distinct(F.struct(column(a), column(b))).alias(f"d{i}") for i, (a, b) in enumerate(own)))
        entries = F.array(*(F.struct(F.lit(f"{a},{b}").alias("columns"), F.col("n").alias("n_rows"), F.col(f"d{i}").alias("n_distinct")) for i, (a, b) in enumerate(own)))
        part = row.select(F.explode(entries).alias("e")).select("e.*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no pairs")
    return out.withColumn("is_unique", F.col("n_distinct") == F.col("n_rows"))


@dataclass(frozen=True)
class Recommendation:
    columns: tuple[str, ...]
    reason: str


def recommend(df: DataFrame, names: Sequence[str] | None = None) -> Recommendation:
    """A key: a unique column with a key's name, a unique column, a unique pair, the nearest to unique, or none."""
    found = sorted(columns(df, names).collect(), key=lambda r: r["position"])  # a row for each column
    unique = [r for r in found if r["score"] == SCORES[0]]
    if unique:
        best = next((r for r in unique if r["name_match"]), unique[0])
        named = " with a key's name" if best["name_match"] else ""
        return Recommendation((best["column"],), f"single unique column{named}: {best['column']} ({best['n_distinct']} distinct values)")
    whole = sorted((r for r in found if r["n_null"] == 0), key=lambda r: (not r["name_match"], -r["uniqueness"], r["position"]))[:MAX_SINGLES]
    pairs = [(a["column"], b["column"]) for a, b in combinations(whole, 2)][:MAX_PAIRS]
    if pairs:
        order = [f"{a},{b}" for a, b in pairs]
        for r in sorted((r for r in composites(df, pairs).collect() if r["is_unique"]), key=lambda r: order.index(r["columns"])):
            return Recommendation(tuple(r["columns"].split(",")), f"composite key: {r['n_distinct']} distinct = {r['n_rows']} rows")
    high = [r for r in found if r["score"] == SCORES[2]]
    if high:
        return Recommendation((high[0]["column"],), f"best guess, not unique: {high[0]['uniqueness']:.4%} unique")
    return Recommendation((), "no candidate")


def partition_stats(df: DataFrame, name: str) -> DataFrame:
    """One row: min, max, rows, nulls and share of nulls of a column to partition reads by; a warning above 10 %."""
    c = column(name)
    row = df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"), F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.count(c)).alias("n_null"))
    share = F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(F.lit(0.0))
    return row.withColumns({"null_share": share, "warning": share > 0.10})


def distinct_dates(df: DataFrame, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(date) of the days that occur in [start, end)."""
    own = in_window(df, name, start, end) if start and end else df
    return own.select(F.to_date(column(name)).alias("date")).where("date is not null").distinct()


def null_dates(df: DataFrame, name: str) -> DataFrame:
    """One row: rows without a date, which no window ever sees."""
    return df.agg(F.coalesce(F.sum(column(name).isNull().cast("long")), F.lit(0)).alias("n_null_dates"), F.count(F.lit(1)).alias("n_rows"))


def type_drift(df: DataFrame, recorded: DataFrame) -> list[str]:
    """Columns whose type differs from the recorded (column_name, data_type) rows."""
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{r['column_name']}: {r['data_type']} -> {now[r['column_name']]}" for r in recorded.collect() if r["column_name"] in now and now[r["column_name"]] != r["data_type"]]


def date_index_coverage(indexes: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, date_column, has_index): tables whose date column leads no index."""
    leading = indexes.where("ordinal = 1").select("table_name", F.col("column_name").alias("date_column")).distinct().withColumn("has_index", F.lit(True))
    return tables.join(leading, ["table_name", "date_column"], "left").select("table_name", "date_column", F.coalesce("has_index", F.lit(False)).alias("has_index"))


def keyless(tables: DataFrame, constraints: DataFrame) -> DataFrame:
    """Tables without a key constraint."""
    return tables.join(constraints.select("table_name").distinct(), "table_name", "left_anti")

