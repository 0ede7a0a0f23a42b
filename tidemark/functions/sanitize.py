"""Cleaning of columns before they are stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import add_row_hash, column

#: Characters that are taken out of strings.
CONTROL = "[\\t\\n\\r\\x00\\x0B\\x0C\\x85\\u2028\\u2029]"
#: Text forms of instants that are recognised, in Spark's notation.
INSTANTS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.[SSSSSSSSS][SSSSSS][SSS][SS][S]",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSSSSS][SSSSSS][SSS][SS][S]",
    "dd-MMM-yyyy HH:mm:ss",
    "dd-MMM-yy HH:mm:ss",
)
SENTINEL = "9999-01-01 00:00:00"


def strings_of(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip_control(value: Column) -> Column:
    return F.regexp_replace(value, CONTROL, "")


def sanitize_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strings without control characters and line separators."""
    own = strings_of(df) if columns is None else list(columns)
    return df.withColumns({c: strip_control(column(c)) for c in own}) if own else df


def unsanitized(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows that still hold a control character, of all rows; an empty result is a clean frame."""
    own = strings_of(df) if columns is None else list(columns)
    found = F.lit(False)
    for c in own:
        found = found | F.coalesce(F.rlike(column(c), F.lit(CONTROL)), F.lit(False))
    return df.where(found)


def cast_bits(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The named columns, or all booleans, as 0 and 1."""
    own = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)] if columns is None else list(columns)
    return df.withColumns({c: column(c).cast("tinyint") for c in own}) if own else df


def parse_instant(value: Column) -> Column:
    """An instant from any of the recognised text forms, else null; month names in any case."""
    shaped = F.initcap(F.lower(value))
    tried = []
    for form in INSTANTS:
        source = shaped if "MMM" in form else value
        # the pattern is matched first: a parser alone would take shorter or longer fields, too
        shape = {"yyyy-MM-dd HH": r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", "yyyy-MM-dd'T'HH": r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", "dd-MMM-yyyy HH": r"^\d\d-[A-Za-z]{3}-\d{4} \d\d:\d\d:\d\d", "dd-MMM-yy HH": r"^\d\d-[A-Za-z]{3}-\d\d \d\d:\d\d:\d\d"}[form.split(":")[0]]
        shape += r"\.\d{1,9}$" if "S" in form else "$"
        tried.append(F.when(F.rlike(value, F.lit(shape)), F.try_to_timestamp(source, F.lit(form)).cast("timestamp_ntz")))
    return F.coalesce(*tried)


def sniff_instants(df: DataFrame, columns: Sequence[str] | None = None, *, sample: int = 20, share: float = 0.9) -> DataFrame:
    """(column, sampled, parsed, is_instant): whether a string column looks like instants.

    Looks at up to `sample` values that aren't null, the smallest ones, so that the answer doesn't depend on order.
    """
    own = strings_of(df) if columns is None else list(columns)
    out = None
    for c in own:
        some = df.where(column(c).isNotNull()).select(column(c).alias("v")).orderBy("v").limit(sample)
        one = some.agg(F.count("v").alias("sampled"), F.count(parse_instant(F.col("v"))).alias("parsed"))
        one = one.select(F.lit(c).alias("column"), "sampled", "parsed", ((F.col("sampled") > 0) & (F.col("parsed") >= share * F.col("sampled"))).alias("is_instant"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no string column")
    return out


def fix_dates(df: DataFrame, parse: Sequence[str] = ()) -> DataFrame:
    """Dates as instants at midnight; string columns with DATE in their name, or named, parsed, null where they fail."""
    new = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            new[f.name] = column(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.StringType) and ("DATE" in f.name.upper() or f.name in parse):
            new[f.name] = parse_instant(column(f.name))
    return df.withColumns(new) if new else df


def unsigned_to_signed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """64-bit unsigned values (decimal(20,0)) as the signed long of the same bits."""
    half, whole = F.lit("9223372036854775808").cast("decimal(20,0)"), F.lit("18446744073709551616").cast("decimal(20,0)")
    return df.withColumns({c: F.when(column(c) >= half, column(c).cast("decimal(21,0)") - whole).otherwise(column(c)).cast("long") for c in columns})


def scrub_sentinels(df: DataFrame, columns: Sequence[str] | None = None, sentinel: str = SENTINEL) -> DataFrame:
    """Dates and instants at or beyond the sentinel as null."""
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    new = {}
    for c in kinds if columns is None else columns:
        new[c] = F.when(column(c) < F.lit(sentinel).cast(kinds[c]), column(c))
    return df.withColumns(new) if new else df


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


class ColumnOrderError(ValueError):
    """A target column that the frame doesn't have."""


def reorder(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """The target's columns in the target's order; further ones are dropped, a missing one is an error."""
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ColumnOrderError(f"missing columns: {', '.join(missing)}")
    return df.select(*(column(c) for c in target))


def add_extracted_at(df: DataFrame, run_ts: str, name: str = "_extracted_at") -> DataFrame:
    """One instant for all rows, given by the caller."""
    return df.withColumn(name, F.lit(run_ts).cast("timestamp_ntz"))


def prepare(df: DataFrame, run_ts: str, *, bits: Sequence[str] | None = None, unsigned: Sequence[str] = (), fix: bool = False, empty_is_null: bool = False, normalize: bool = True, sanitize_first: bool = False) -> DataFrame:
    """Dates, hash, extraction instant, control characters, booleans, unsigned values, in this order.

    The hash covers the strings before control characters are taken out; sanitize_first turns that round.
    """
    if fix:
        df = fix_dates(df)
    if sanitize_first:
        df = sanitize_strings(df)
    df = add_extracted_at(add_row_hash(df, empty_is_null=empty_is_null, normalize=normalize), run_ts)
    own = [c for c in strings_of(df) if not c.startswith("_")]
    return unsigned_to_signed(cast_bits(sanitize_strings(df, own), bits), unsigned) if unsigned else cast_bits(sanitize_strings(df, own), bits)


def quote_identifier(name: str) -> str:
    """A quoted identifier; at most 128 characters."""
    if not name or len(name) > 128:
        raise ValueError("an identifier has 1 to 128 characters")
    return "`" + name.replace("`", "``") + "`"


def quote_table(name: str) -> str:
    """A quoted name of one to three parts."""
    parts = name.split(".")
    if not 1 <= len(parts) <= 3:
        raise ValueError("a table name has one to three parts")
    return ".".join(map(quote_identifier, parts))
