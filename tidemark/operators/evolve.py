"""Schema contracts, evolution, strict and aligned concatenation, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import column
from .keys import wider

RENAME_DISTANCE, QUARANTINE_LIMIT = 3, 100
#: Pairs of types (recorded, new) that count as one column's type.
COMPATIBLE = {
    ("int", "bigint"), ("bigint", "int"), ("smallint", "int"), ("smallint", "bigint"), ("int", "smallint"), ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
    ("float", "double"), ("double", "float"), ("date", "timestamp_ntz"), ("date", "timestamp"), ("timestamp", "timestamp_ntz"), ("timestamp_ntz", "timestamp"),
}


class SchemaError(ValueError):
    """A schema that can't be taken over."""


@dataclass(frozen=True)
class Contract:
    missing: tuple[str, ...]
    unexpected: tuple[str, ...]

    @property
    def holds(self) -> bool:
        return not self.missing


def own_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def contract(df: DataFrame, expected: Sequence[str], *, strict: bool = False) -> Contract:
    """What a frame lacks and has beyond the expected columns; strict: a lack is an error."""
    have, want = set(own_columns(df)), {c for c in expected if not c.startswith("_")}
    found = Contract(tuple(sorted(want - have)), tuple(sorted(have - want)))
    if strict and not found.holds:
        raise SchemaError(f"missing columns: {', '.join(found.missing)}")
    return found


def base_type(kind: T.DataType) -> str:
    return kind.simpleString().partition("(")[0]


def compatible(recorded: T.DataType, new: T.DataType) -> bool:
    """Whether a column may come with the new type: the same base type or a known pair."""
    a, b = base_type(recorded), base_type(new)
    return a == b or (a, b) in COMPATIBLE


@dataclass(frozen=True)
class Evolution:
    added: tuple[str, ...]
    removed: tuple[str, ...]
    retyped: tuple[str, ...]
    renamed: tuple[tuple[str, str], ...]
    schema: T.StructType

    @property
    def changed(self) -> bool:
        return bool(self.added or self.removed)


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def evolution(recorded: T.StructType, new: T.StructType) -> Evolution:
    """Added and removed columns and likely renames; a column of another type is an error before anything is added."""
    a, b = ({f.name: f.dataType for f in s.fields if not f.name.startswith("_")} for s in (recorded, new))
    retyped = tuple(c for c in b if c in a and not compatible(a[c], b[c]))
    if retyped:
        raise SchemaError("; ".join(f"{c}: {a[c].simpleString()} -> {b[c].simpleString()}" for c in retyped))
    added, removed = tuple(c for c in b if c not in a), tuple(c for c in a if c not in b)
    renamed = tuple((x, y) for x in removed for y in added if base_type(a[x]) == base_type(b[y]) and levenshtein(x.lower(), y.lower()) <= RENAME_DISTANCE)
    return Evolution(added, removed, retyped, renamed, T.StructType([*recorded.fields, *(T.StructField(c, b[c]) for c in added)]))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns and types: what it lacks is null, what can't be cast is null."""
    return df.select(*((column(f.name) if df.schema[f.name].dataType == f.dataType else column(f.name).try_cast(f.dataType)).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def rename_candidates(removed: DataFrame, added: DataFrame) -> DataFrame:
    """(old_name, new_name, distance) from (column_name, data_type) rows of one base type, at distance 3 or less."""
    a = removed.select(F.col("column_name").alias("old_name"), F.col("data_type").alias("t"))
    b = added.select(F.col("column_name").alias("new_name"), F.col("data_type").alias("t"))
    return a.join(b, "t").withColumn("distance", F.levenshtein(F.lower("old_name"), F.lower("new_name"))).where(F.col("distance") <= RENAME_DISTANCE).select("old_name", "new_name", "distance")


def concat_strict(frames: Sequence[DataFrame], context: str = "") -> DataFrame:
    """Frames of one schema, one after the other; another column or type is an error."""
    first = frames[0]
    kinds = {f.name: f.dataType for f in first.schema.fields}
    out = first
    for df in frames[1:]:
        other = {f.name: f.dataType for f in df.schema.fields}
        if other != kinds:
            raise SchemaError(f"{context}: schemas differ in {sorted(set(kinds.items() ) ^ set(other.items()), key=str)}")
        out = out.unionByName(df)
    return out


def concat_aligned(frames: Sequence[DataFrame], *, widen: bool = False) -> DataFrame:
    """Frames with any columns: what one lacks is null there. A type is that first seen, or the widest."""
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds[f.name] = f.dataType if f.name not in kinds else wider(kinds[f.name], f.dataType) if widen else kinds[f.name]
    schema = T.StructType([T.StructField(c, k) for c, k in kinds.items()])
    out = conform(frames[0], schema)
    for df in frames[1:]:
        out = out.unionByName(conform(df, schema))
    return out


def null_inflation(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, nulls_before, nulls_after) of columns that have more nulls after a step than before it."""
    own = [c for c in before.columns if c in after.columns]
    sides = []
    for df, name in ((before, "nulls_before"), (after, "nulls_after")):
        row = df.agg(*(F.coalesce(F.sum(column(c).isNull().cast("long")), F.lit(0)).alias(c) for c in own))
        sides.append(row.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), column(c).alias(name)) for c in own))).alias("e")).select("e.*"))
    return sides[0].join(sides[1], "column").where("nulls_after > nulls_before")


def quarantine(rows: DataFrame, table: str, source: str, reason: str | Column, batch_id: int, run_ts: str, *, order: Sequence[str] | None = None, limit: int = QUARANTINE_LIMIT) -> DataFrame:
    """Rejected rows as JSON with their reason; a batch records the first `limit`, as its purpose is a report."""
    record = F.to_json(F.struct(*(column(c) for c in rows.columns)))
    taken = rows.orderBy(*(column(c) for c in order)).limit(limit) if order else rows.limit(limit)
    return taken.select(F.lit(table).alias("TableName"), F.lit(source).alias("SourceName"), (F.lit(reason) if isinstance(reason, str) else reason).alias("RejectionReason"), record.alias("RecordData"), F.lit(batch_id).cast("long").alias("BatchId"), F.lit(run_ts).cast("timestamp_ntz").alias("QuarantinedAt"))
