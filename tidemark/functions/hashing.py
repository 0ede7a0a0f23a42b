"""Canonical text of values and the row hash.

The hash is SHA-256 over the canonical texts of all columns that don't start with `_`, in frame order, joined by
\\x1F. Equal rows hash equally whatever partitions, engine run or float formatting they come from; any change of a
value changes the hash. All of it is built-in expressions in one projection; only strings that might not be in Unicode
normal form go to a Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH = "_row_hash"
SEPARATOR = "\x1f"
#: What stands for values that have no text of their own.
NULL, NAN, INF, MINUS_INF = "\x1fNULL\x1f", "\x1fNAN\x1f", "\x1fINF\x1f", "\x1f-INF\x1f"
FLOAT_TYPE = "decimal(38,10)"


def column(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def nfc(value: Column) -> Column:
    """Unicode normal form C. Strings of characters below U+0300 are in it and aren't sent to Python."""
    @F.pandas_udf(T.StringType())
    def normal(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")

    return F.coalesce(normal(F.when(F.rlike(value, F.lit("[^\\x00-\\u02FF]")), value)), value)


def normal_string(value: Column, *, empty_is_null: bool = False, normalize: bool = True) -> Column:
    """A string as stored: the empty one null where sources can't hold it, normal form, no trailing spaces.

    The empty string is tested before spaces are cut, so blanks become the empty string and not null.
    """
    if empty_is_null:
        value = F.when(value != "", value)
    return F.rtrim(nfc(value) if normalize else value)


def canonical(value: Column, kind: T.DataType, *, empty_is_null: bool = False, normalize: bool = True) -> Column:
    """The text of a value that enters the hash; never null."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        wide = value.cast("double")
        fixed = F.coalesce(wide.try_cast(FLOAT_TYPE).cast("string"), wide.cast("string"))
        text = F.when(F.isnan(wide), NAN).when(wide == float("inf"), INF).when(wide == float("-inf"), MINUS_INF).otherwise(F.when(wide == 0.0, F.lit(0.0).cast(FLOAT_TYPE).cast("string")).otherwise(fixed))
        text = F.when(value.isNotNull(), text)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.StringType):
        text = normal_string(value, empty_is_null=empty_is_null, normalize=normalize)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(value)
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL))


def hash_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The columns that enter the hash: all that don't start with `_`, in frame order."""
    return [c for c in (columns or df.columns) if not c.startswith("_")]


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, *, empty_is_null: bool = False, normalize: bool = True) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.sha2(F.concat_ws(SEPARATOR, *(canonical(column(c), kinds[c], empty_is_null=empty_is_null, normalize=normalize) for c in hash_columns(df, columns))), 256)


def add_row_hash(df: DataFrame, columns: Sequence[str] | None = None, *, empty_is_null: bool = False, normalize: bool = True, name: str = HASH) -> DataFrame:
    """df with strings as stored and the row hash as a 64-digit column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    strings = {c: normal_string(column(c), empty_is_null=empty_is_null, normalize=normalize) for c in hash_columns(df, columns) if isinstance(kinds[c], T.StringType)}
    stored = df.withColumns(strings) if strings else df
    # what is stored is normal already: hashing it again would only repeat the work
    return stored.withColumn(name, row_hash(stored, columns, normalize=False))


def add_row_hash_in_python(df: DataFrame, columns: Sequence[str] | None = None, *, empty_is_null: bool = False, normalize: bool = True, name: str = HASH) -> DataFrame:
    """The same hash with hashlib in Arrow batches: an independent check of add_row_hash, and slower."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    used = hash_columns(df, columns)
    strings = {c: normal_string(column(c), empty_is_null=empty_is_null, normalize=normalize) for c in used if isinstance(kinds[c], T.StringType)}
    stored = df.withColumns(strings) if strings else df

    @F.pandas_udf(T.StringType())
    def digest(parts: pd.Series) -> pd.Series:
        import hashlib

        return parts.map(lambda p: hashlib.sha256("\x1f".join(p).encode()).hexdigest())

    return stored.withColumn(name, digest(F.array(*(canonical(column(c), kinds[c], normalize=False) for c in used))))
