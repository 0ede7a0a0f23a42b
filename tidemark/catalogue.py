"""The queries of the engine's own operators over the driver's tables, each with its SQL for DuckDB.

Snapshots of a table with an integer key k and a value v: `existing` is the rows with k % 10 <> 0; `fresh` is those
with k % 11 <> 0, v + 1 where k % 7 = 0; `third` is `existing` again plus what it lacked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import hashing, sanitize
from .operators import cdc, evolve, guards, keys, profile, reconcile, scd2
from .plans import ops
from .sources import registry

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: key, value and canonical text of each column for DuckDB, by table
TABLES = {
    "customer": ("c_custkey", "c_acctbal", {"c_custkey": "i", "c_name": "s", "c_nationkey": "i", "c_acctbal": "f", "c_mktsegment": "s"}),
    "orders": ("o_orderkey", "o_totalprice", {"o_orderkey": "i", "o_custkey": "i", "o_orderstatus": "s", "o_totalprice": "f", "o_orderdate": "t", "o_orderpriority": "s"}),
    "part": ("p_partkey", "p_retailprice", {"p_partkey": "i", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "i", "p_retailprice": "f"}),
    "supplier": ("s_suppkey", "s_acctbal", {"s_suppkey": "i", "s_name": "s", "s_nationkey": "i", "s_acctbal": "f"}),
    "events": ("event_id", "value", {"event_id": "i", "ts": "t", "user_id": "i", "event_type": "s", "value": "f", "props": "s"}),
    "documents": ("doc_id", "n_chars", {"doc_id": "i", "text": "s", "lang": "s", "source": "s", "n_chars": "i"}),
    "lineitem": ("l_orderkey", "l_quantity", {"l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i", "l_quantity": "f", "l_extendedprice": "f", "l_discount": "f", "l_tax": "f", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"}),
}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _snapshots(spark: SparkSession, d: str, table: str) -> tuple[DataFrame, DataFrame]:
    k, v, _ = TABLES[table]
    df = _table(spark, d, table)
    existing = df.where(F.col(k) % 10 != 0)
    fresh = df.where(F.col(k) % 11 != 0).withColumn(v, F.when(F.col(k) % 7 == 0, F.col(v) + 1).otherwise(F.col(v)))
    return existing, fresh


def _hashed(spark: SparkSession, d: str, table: str) -> tuple[DataFrame, DataFrame]:
    return tuple(hashing.add_row_hash(df) for df in _snapshots(spark, d, table))


def _sql_text(c: str, kind: str) -> str:
    null = "chr(31) || 'NULL' || chr(31)"
    if kind == "f":
        fixed = f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR)"
        return f"coalesce(CASE WHEN {c} = 0 THEN '0.0000000000' ELSE {fixed} END, {null})"
    if kind == "t":
        return f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), {null})"
    if kind == "s":
        return f"coalesce(rtrim(nfc_normalize({c}), ' '), {null})"
    return f"coalesce(CAST({c} AS VARCHAR), {null})"


def _sql_hash(table: str) -> str:
    return "sha256(" + " || chr(31) || ".join(_sql_text(c, k) for c, k in TABLES[table][2].items()) + ")"


def _sql_snapshots(table: str) -> str:
    """WITH e (existing) and f (fresh), each with its hash h."""
    k, v, cols = TABLES[table]
    new = f"CASE WHEN {k} % 7 = 0 THEN {v} + 1 ELSE {v} END AS {v}"
    listed = ", ".join(new if c == v else c for c in cols)
    return f"WITH e AS (SELECT *, {_sql_hash(table)} AS h FROM {table} WHERE {k} % 10 <> 0), f AS (SELECT *, {_sql_hash(table)} AS h FROM (SELECT {listed} FROM {table} WHERE {k} % 11 <> 0))"


def _sql_ops(table: str) -> str:
    """_sql_snapshots and o (k, op)."""
    k = TABLES[table][0]
    case = f"CASE WHEN e.{k} IS NULL THEN 'I' WHEN f.{k} IS NULL THEN 'D' WHEN e.h IS DISTINCT FROM f.h THEN 'U' ELSE 'N' END"
    return f"{_sql_snapshots(table)}, o AS (SELECT coalesce(f.{k}, e.{k}) AS {k}, {case} AS op FROM f FULL OUTER JOIN e ON f.{k} = e.{k})"


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE[name or f.__name__] = sql
        return f

    return add


# hashing and sanitizing

for _t in ("customer", "orders", "events", "documents"):

    @query(f"SELECT {TABLES[_t][0]}, {_sql_hash(_t)} AS row_hash FROM {_t}", f"row_hash_{_t}")
    def _row_hash(spark, d, t=_t):
        return hashing.add_row_hash(_table(spark, d, t)).select(TABLES[t][0], F.col("_row_hash").alias("row_hash"))


@query(f"SELECT c_custkey, {_sql_hash('customer')} AS row_hash FROM customer")
def row_hash_in_python(spark, d):
    return hashing.add_row_hash_in_python(_table(spark, d, "customer")).select("c_custkey", F.col("_row_hash").alias("row_hash"))


@query(r"SELECT doc_id, regexp_replace(text, '[\t\n\r\x00\x0B\x0C\x{85}\x{2028}\x{2029}]', '', 'g') AS text FROM documents")
def sanitize_documents(spark, d):
    return sanitize.sanitize_strings(_table(spark, d, "documents")).select("doc_id", "text")


@query(r"SELECT count(*) AS n_dirty FROM documents WHERE regexp_matches(text, '[\t\n\r\x00\x0B\x0C\x{85}\x{2028}\x{2029}]')")
def unsanitized_documents(spark, d):
    return sanitize.unsanitized(_table(spark, d, "documents")).agg(F.count(F.lit(1)).alias("n_dirty"))


@query("SELECT event_id, CAST(event_id % 2 = 0 AS TINYINT) AS is_even FROM events")
def cast_bits(spark, d):
    return sanitize.cast_bits(_table(spark, d, "events").select("event_id", (F.col("event_id") % 2 == 0).alias("is_even")))


@query("SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN event_id - 1 - event_id ELSE event_id END AS BIGINT) AS u FROM events")
def unsigned_to_signed(spark, d):
    whole = F.lit("18446744073709551615").cast("decimal(20,0)")
    df = _table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, whole).otherwise(F.col("event_id").cast("decimal(20,0)")).alias("u"))
    return sanitize.unsigned_to_signed(df, ["u"])


@query("SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts FROM events")
def scrub_sentinels(spark, d):
    df = _table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 13 == 0, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"))
    return sanitize.scrub_sentinels(df)


def _instants(spark, d):
    forms = F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.upper(F.date_format("ts", "dd-MMM-yyyy HH:mm:ss")), F.upper(F.date_format("ts", "dd-MMM-yy HH:mm:ss")), F.lit("soon"))
    return _table(spark, d, "events").select("event_id", F.get(forms, (F.col("event_id") % 6).cast("int")).alias("d"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("clean"), "ts", "event_type")


@query("SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 6 = 2 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS UPDATE_DATE FROM events")
def fix_dates(spark, d):
    return sanitize.fix_dates(_instants(spark, d).select("event_id", F.col("d").alias("UPDATE_DATE")))


@query("SELECT 'clean' AS \"column\", CAST(20 AS BIGINT) AS sampled, CAST(20 AS BIGINT) AS parsed, true AS is_instant UNION ALL SELECT 'event_type', 20, 0, false")
def sniff_instants(spark, d):
    return sanitize.sniff_instants(_instants(spark, d), ["clean", "event_type"])


@query("SELECT c_mktsegment, c_custkey FROM customer")
def reorder_columns(spark, d):
    return sanitize.reorder(_table(spark, d, "customer"), ["c_mktsegment", "c_custkey"])


@query(f"SELECT doc_id, {_sql_hash('documents')} AS row_hash, regexp_replace(rtrim(nfc_normalize(text), ' '), '[\\t\\n\\r\\x00\\x0B\\x0C\\x{{85}}\\x{{2028}}\\x{{2029}}]', '', 'g') AS text, TIMESTAMP '{T1}' AS extracted_at FROM documents")
def prepare_documents(spark, d):
    return sanitize.prepare(_table(spark, d, "documents"), T1).select("doc_id", F.col("_row_hash").alias("row_hash"), "text", F.col("_extracted_at").alias("extracted_at"))


# keys

_NULLED = "(SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS c_custkey, CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_name FROM customer)"


def _nulled(spark, d):
    return _table(spark, d, "customer").select(F.when(F.col("c_custkey") % 97 != 0, F.col("c_custkey")).alias("c_custkey"), F.when(F.col("c_custkey") % 89 != 0, F.col("c_nationkey")).alias("c_nationkey"), "c_name")


@query(f"SELECT * FROM {_NULLED} WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL")
def null_key_filter(spark, d):
    return keys.drop_null_keys(_nulled(spark, d), ["c_custkey", "c_nationkey"])


@query(f"SELECT count(*) AS n_rows, CAST(count(*) FILTER (WHERE c_custkey IS NULL OR c_nationkey IS NULL) AS BIGINT) AS n_null_rows, CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT) AS null_c_custkey, CAST(count(*) FILTER (WHERE c_nationkey IS NULL) AS BIGINT) AS null_c_nationkey, count(*) FILTER (WHERE c_custkey IS NULL OR c_nationkey IS NULL) / count(*) AS share, count(*) FILTER (WHERE c_custkey IS NULL OR c_nationkey IS NULL) / count(*) > 0.01 AS alarm FROM {_NULLED}")
def null_key_breakdown(spark, d):
    return keys.null_key_summary(_nulled(spark, d), ["c_custkey", "c_nationkey"])


@query(f"SELECT * FROM {_NULLED} WHERE c_custkey IS NULL OR c_nationkey IS NULL ORDER BY c_custkey NULLS FIRST, c_nationkey NULLS FIRST, c_name LIMIT 5")
def null_key_sample(spark, d):
    return keys.null_key_sample(_nulled(spark, d), ["c_custkey", "c_nationkey"])


_LINE_ORDER = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"


@query(f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1")
def dedup_source_keys(spark, d):
    return keys.latest(_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_groups(spark, d):
    return keys.duplicate_keys(_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def align_key_types(spark, d):
    o = _table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("k"))
    a, b = keys.align_keys(o, _table(spark, d, "customer").select(F.col("c_custkey").cast("int").alias("k"), "c_name"), ["k"])
    return a.join(b, "k").select("o_orderkey", "c_name")


@query("SELECT count(*) AS n, count(*) AS n_distinct, CAST(1 AS BIGINT) AS least, count(*) AS most FROM customer")
def surrogate_keys(spark, d):
    numbered = keys.numbered(_table(spark, d, "customer"), ["c_custkey"], 0, "sk")
    return numbered.agg(F.count("sk").alias("n"), F.count_distinct("sk").alias("n_distinct"), F.min("sk").alias("least"), F.max("sk").alias("most"))


@query("SELECT 10 AS n")
def seeded_sample(spark, d):
    return keys.sample(_table(spark, d, "customer"), ["c_custkey"], 10).agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("SELECT c_custkey AS Cust_Key, c_name AS C_NAME FROM customer")
def rename_by_case(spark, d):
    return keys.rename_by_case(_table(spark, d, "customer").select(F.col("c_custkey").alias("CUST_KEY"), "c_name"), ["Cust_Key", "C_NAME"])


# change data

for _t in ("customer", "orders", "part", "events"):

    @query(f"{_sql_ops(_t)} SELECT * FROM o", f"cdc_diff_{_t}")
    def _diff(spark, d, t=_t):
        e, f = _hashed(spark, d, t)
        return cdc.diff(f, e, [TABLES[t][0]])


_COUNTS = "SELECT count(*) FILTER (WHERE op = 'I') AS inserts, count(*) FILTER (WHERE op = 'U') AS updates, count(*) FILTER (WHERE op = 'D') AS deletes, count(*) FILTER (WHERE op = 'N') AS unchanged, count(*) FILTER (WHERE op <> 'D') AS n_fresh, count(*) FILTER (WHERE op = 'U') / greatest(count(*), 1) AS update_ratio, count(*) FILTER (WHERE op = 'U') / greatest(count(*), 1) > 0.5 AND count(*) FILTER (WHERE op = 'U') > 1000 AS alarm FROM o"


@query(f"{_sql_ops('customer')} {_COUNTS}")
def cdc_summary(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.summary(cdc.diff(f, e, ["c_custkey"]))


_FCOLS = "f.c_custkey, f.c_name, f.c_nationkey, f.c_acctbal, f.c_mktsegment"


@query(f"{_sql_snapshots('customer')} SELECT {_FCOLS} FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.c_custkey = f.c_custkey)")
def cdc_inserts(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.inserts(f, e, ["c_custkey"]).drop("_row_hash")


@query(f"{_sql_snapshots('customer')} SELECT c_custkey FROM e WHERE NOT EXISTS (SELECT 1 FROM f WHERE e.c_custkey = f.c_custkey)")
def cdc_deletes(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.deletes(f, e, ["c_custkey"]).select("c_custkey")


@query(f"{_sql_snapshots('customer')} SELECT {_FCOLS} FROM f JOIN e ON e.c_custkey = f.c_custkey WHERE e.h <> f.h")
def cdc_updates(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.updates(f, e, ["c_custkey"]).drop("_row_hash")


@query(f"{_sql_snapshots('customer')} SELECT e.c_custkey FROM f JOIN e ON e.c_custkey = f.c_custkey WHERE e.h = f.h")
def cdc_unchanged(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.unchanged(f, e, ["c_custkey"]).select("c_custkey")


@query(f"{_sql_ops('customer')} SELECT o.c_custkey, f.c_name, f.c_nationkey, f.c_acctbal, f.c_mktsegment, o.op FROM o LEFT JOIN f ON f.c_custkey = o.c_custkey WHERE o.op <> 'N'")
def cdc_change_feed(spark, d):
    e, f = _hashed(spark, d, "customer")
    return cdc.change_feed(f, e, ["c_custkey"]).drop("_row_hash")


@query("WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS h FROM customer), f AS (SELECT c_custkey, CASE WHEN c_custkey % 26 = 0 THEN NULL ELSE c_name END AS h FROM customer) SELECT f.c_custkey, CASE WHEN f.h <> e.h OR f.h IS NULL OR e.h IS NULL THEN 'U' ELSE 'N' END AS op FROM f JOIN e USING (c_custkey)")
def cdc_null_hashes(spark, d):
    c = _table(spark, d, "customer")
    e, f = (c.select("c_custkey", F.when(F.col("c_custkey") % n != 0, F.col("c_name")).alias("_row_hash")) for n in (13, 26))
    return cdc.diff(f, e, ["c_custkey"])


_DAY = ("2024-01-10", "2024-01-11")
_IN_DAY = f"ts >= TIMESTAMP '{_DAY[0]}' AND ts < TIMESTAMP '{_DAY[1]}'"


@query(f"{_sql_snapshots('events')}, e1 AS (SELECT * FROM e WHERE {_IN_DAY}), f1 AS (SELECT * FROM f WHERE {_IN_DAY}) SELECT coalesce(f1.event_id, e1.event_id) AS event_id, CASE WHEN e1.event_id IS NULL THEN 'I' WHEN f1.event_id IS NULL THEN 'D' WHEN e1.h <> f1.h THEN 'U' ELSE 'N' END AS op FROM f1 FULL OUTER JOIN e1 ON f1.event_id = e1.event_id")
def cdc_windowed_diff(spark, d):
    e, f = _hashed(spark, d, "events")
    return cdc.windowed_diff(f, e, ["event_id"], "ts", *_DAY)


def _stage(spark, d, table="customer"):
    e, f = _snapshots(spark, d, table)
    k = [TABLES[table][0]]
    first = cdc.merge(None, sanitize.prepare(e, T1), k, T1, 1).stage
    return cdc.merge(first, sanitize.prepare(f, T2), k, T2, 2)


_STAGE_COLS = "c_custkey, c_acctbal, op, valid_from, valid_to, is_current, batch_id"
_STAGE_SQL = f"{_sql_ops('customer')}, s AS (SELECT e.c_custkey, e.c_acctbal, 'I' AS op, TIMESTAMP '{T1}' AS valid_from, CASE WHEN o.op IN ('U', 'D') THEN TIMESTAMP '{T2}' END AS valid_to, CAST(o.op = 'N' AS TINYINT) AS is_current, CAST(1 AS BIGINT) AS batch_id FROM e JOIN o USING (c_custkey) UNION ALL SELECT f.c_custkey, f.c_acctbal, o.op, TIMESTAMP '{T2}', NULL, CAST(1 AS TINYINT), CAST(2 AS BIGINT) FROM f JOIN o USING (c_custkey) WHERE o.op IN ('I', 'U'))"


def _shown_stage(df):
    return df.select("c_custkey", "c_acctbal", F.col("_cdc_operation").alias("op"), F.col("_cdc_valid_from").alias("valid_from"), F.col("_cdc_valid_to").alias("valid_to"), F.col("_cdc_is_current").alias("is_current"), F.col("_cdc_batch_id").alias("batch_id"))


@query(f"{_STAGE_SQL} SELECT {_STAGE_COLS} FROM s")
def cdc_stage_after_merge(spark, d):
    return _shown_stage(_stage(spark, d).stage)


@query(f"{_STAGE_SQL} SELECT {_STAGE_COLS} FROM s WHERE is_current = 1")
def cdc_current(spark, d):
    return _shown_stage(cdc.current(_stage(spark, d).stage))


@query(f"{_STAGE_SQL} SELECT {_STAGE_COLS} FROM s WHERE NOT (is_current = 0 AND valid_to < TIMESTAMP '2024-04-01')")
def cdc_purge_expired(spark, d):
    return _shown_stage(cdc.purge_expired(_stage(spark, d).stage, "2024-05-01 00:00:00", 30))


@query(f"{_STAGE_SQL}, t AS (SELECT * FROM s UNION ALL SELECT c_custkey, c_acctbal, 'I', TIMESTAMP '2023-12-01', NULL, CAST(1 AS TINYINT), CAST(0 AS BIGINT) FROM s WHERE is_current = 1 AND c_custkey % 5 = 0) SELECT {_STAGE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY valid_from DESC) AS rn FROM t WHERE is_current = 1) WHERE rn = 1")
def cdc_dedup_current(spark, d):
    now = cdc.current(_stage(spark, d).stage)
    older = now.where("c_custkey % 5 = 0").withColumns({"_cdc_valid_from": F.lit("2023-12-01").cast("timestamp_ntz"), "_cdc_operation": F.lit("I"), "_cdc_batch_id": F.lit(0).cast("long")})
    return _shown_stage(keys.latest(now.unionByName(older), ["c_custkey"], ["_cdc_valid_from"]))


# history

_H = "c_custkey, c_acctbal, effective, ended, active, op"


def _shown(df):
    return df.select("c_custkey", "c_acctbal", F.col(scd2.START).alias("effective"), F.col(scd2.END).alias("ended"), F.col(scd2.ACTIVE).cast("int").alias("active"), F.col(scd2.OPERATION).alias("op"))


def _history(spark, d, table="customer", **options):
    """After existing (T1) and fresh (T2)."""
    e, f = _hashed(spark, d, table)
    k = [TABLES[table][0]]
    return scd2.apply(scd2.apply(None, e, k, T1).history, f, k, T2, **options)


def _third(spark, d, **options):
    """After existing, fresh and all rows of the table (T3)."""
    all_rows = hashing.add_row_hash(_table(spark, d, "customer"))
    return scd2.apply(_history(spark, d).history, all_rows, ["c_custkey"], T3, **options)


_HISTORY_SQL = f"{_sql_ops('customer')}, h2 AS (SELECT e.c_custkey, e.c_acctbal, e.h, TIMESTAMP '{T1}' AS effective, CASE WHEN o.op IN ('U', 'D') THEN TIMESTAMP '{T2}' END AS ended, CAST(o.op = 'N' AS INTEGER) AS active, 'I' AS op FROM e JOIN o USING (c_custkey) UNION ALL SELECT f.c_custkey, f.c_acctbal, f.h, TIMESTAMP '{T2}', NULL, 1, o.op FROM f JOIN o USING (c_custkey) WHERE o.op IN ('I', 'U'))"
_THIRD_SQL = f"{_HISTORY_SQL}, g AS (SELECT *, {_sql_hash('customer')} AS h FROM customer), p AS (SELECT g.*, a.h AS ah, a.c_custkey AS ak, EXISTS (SELECT 1 FROM h2 z WHERE z.c_custkey = g.c_custkey) AS known FROM g LEFT JOIN (SELECT * FROM h2 WHERE active = 1) a USING (c_custkey)), h3 AS (SELECT h2.c_custkey, h2.c_acctbal, h2.effective, CASE WHEN h2.active = 1 AND p.h <> h2.h THEN TIMESTAMP '{T3}' ELSE h2.ended END AS ended, CASE WHEN h2.active = 1 AND p.h <> h2.h THEN 0 ELSE h2.active END AS active, h2.op FROM h2 JOIN p USING (c_custkey) UNION ALL SELECT c_custkey, c_acctbal, TIMESTAMP '{T3}', NULL, 1, CASE WHEN ak IS NOT NULL THEN 'U' WHEN known THEN '@BACK@' ELSE 'I' END FROM p WHERE ak IS NULL OR ah <> h)"


@query(f"{_sql_snapshots('customer')} SELECT c_custkey, c_acctbal, TIMESTAMP '{T1}' AS effective, CAST(NULL AS TIMESTAMP) AS ended, 1 AS active, 'I' AS op FROM e")
def scd2_first_load(spark, d):
    e, _ = _hashed(spark, d, "customer")
    return _shown(scd2.apply(None, e, ["c_custkey"], T1).history)


@query(f"{_HISTORY_SQL} SELECT {_H} FROM h2")
def scd2_apply(spark, d):
    return _shown(_history(spark, d).history)


@query(f"{_HISTORY_SQL} SELECT count(*) FILTER (WHERE op = 'I') AS inserts, count(*) FILTER (WHERE op = 'U') AS new_versions, count(*) FILTER (WHERE op IN ('U', 'D')) AS closes, count(*) FILTER (WHERE op = 'N') AS unchanged, CAST(0 AS BIGINT) AS resurrections FROM o")
def scd2_counts(spark, d):
    return _history(spark, d).counts()


_SUPPLIER_TARGETED = f"{_sql_ops('supplier')}, h2 AS (SELECT e.s_suppkey, TIMESTAMP '{T1}' AS effective, CASE WHEN o.op = 'U' OR (o.op = 'D' AND e.s_suppkey % 2 = 0) THEN TIMESTAMP '{T2}' END AS ended, CASE WHEN o.op = 'U' OR (o.op = 'D' AND e.s_suppkey % 2 = 0) THEN 0 ELSE 1 END AS active, 'I' AS op FROM e JOIN o USING (s_suppkey) UNION ALL SELECT f.s_suppkey, TIMESTAMP '{T2}', NULL, 1, o.op FROM f JOIN o USING (s_suppkey) WHERE o.op IN ('I', 'U')) SELECT * FROM h2"


@query(_SUPPLIER_TARGETED)
def scd2_targeted(spark, d):
    e, f = _hashed(spark, d, "supplier")
    gone = e.where("s_suppkey % 11 = 0 and s_suppkey % 2 = 0").select("s_suppkey")
    h = scd2.apply(scd2.apply(None, e, ["s_suppkey"], T1).history, f, ["s_suppkey"], T2, targeted=True, deleted_keys=gone).history
    return h.select("s_suppkey", F.col(scd2.START).alias("effective"), F.col(scd2.END).alias("ended"), F.col(scd2.ACTIVE).cast("int").alias("active"), F.col(scd2.OPERATION).alias("op"))


@query(f"{_THIRD_SQL.replace('@BACK@', 'I')} SELECT {_H} FROM h3")
def scd2_three_snapshots(spark, d):
    return _shown(_third(spark, d).history)


@query(f"{_THIRD_SQL.replace('@BACK@', 'R')} SELECT {_H} FROM h3")
def scd2_resurrection(spark, d):
    return _shown(_third(spark, d, detect_resurrection=True).history)


@query(f"{_THIRD_SQL.replace('@BACK@', 'I')} SELECT {_H} FROM h3 WHERE effective <= TIMESTAMP '2024-02-15' AND (ended IS NULL OR TIMESTAMP '2024-02-15' < ended)")
def scd2_point_in_time(spark, d):
    return _shown(scd2.point_in_time(_third(spark, d).history, "2024-02-15 00:00:00"))


def _doubled(spark, d):
    """A history in which a third of the keys have two active versions."""
    h = _history(spark, d).history
    again = h.where((F.col(scd2.ACTIVE) == 1) & (F.col("c_custkey") % 3 == 0)).withColumn(scd2.START, F.lit("2023-06-01").cast("timestamp_ntz"))
    return h.unionByName(again)


_DOUBLED_SQL = f"{_HISTORY_SQL}, hd AS (SELECT {_H} FROM h2 UNION ALL SELECT c_custkey, c_acctbal, TIMESTAMP '2023-06-01', ended, active, op FROM h2 WHERE active = 1 AND c_custkey % 3 = 0)"


@query(f"{_DOUBLED_SQL} SELECT {_H} FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY effective DESC) AS rn FROM hd WHERE active = 1) WHERE rn = 1")
def scd2_safe_current(spark, d):
    return _shown(scd2.safe_current(_doubled(spark, d), ["c_custkey"]))


@query(f"{_DOUBLED_SQL} SELECT c_custkey, count(*) AS n FROM hd WHERE active = 1 GROUP BY c_custkey HAVING count(*) > 1")
def duplicate_active_keys(spark, d):
    return scd2.duplicate_active(_doubled(spark, d), ["c_custkey"])


@query(f"{_DOUBLED_SQL} SELECT c_custkey, c_acctbal, effective, CASE WHEN active = 1 AND effective = TIMESTAMP '2023-06-01' THEN TIMESTAMP '{T3}' ELSE ended END AS ended, CASE WHEN effective = TIMESTAMP '2023-06-01' THEN 0 ELSE active END AS active, op FROM hd")
def scd2_heals_duplicates(spark, d):
    _, f = _hashed(spark, d, "customer")
    return _shown(scd2.apply(_doubled(spark, d), f, ["c_custkey"], T3).history)


def _orphaned(spark, d):
    h = _history(spark, d).history
    return h.withColumn(scd2.ACTIVE, F.when((F.col(scd2.OPERATION) == "U") & (F.col("c_custkey") % 2 == 0), F.lit(0)).otherwise(F.col(scd2.ACTIVE)).cast("tinyint"))


@query(f"{_HISTORY_SQL} SELECT {_H} FROM h2 WHERE NOT (op = 'U' AND ended IS NULL AND c_custkey % 2 = 0)")
def orphan_cleanup(spark, d):
    return _shown(scd2.drop_orphans(_orphaned(spark, d)))


@query(f"{_HISTORY_SQL} SELECT {_H} FROM h2 WHERE active = 1 AND c_custkey % 100 < 3")
def history_for_keys(spark, d):
    wanted = _table(spark, d, "customer").where("c_custkey % 100 < 3").select(F.col("c_custkey").cast("int").alias("c_custkey"))
    return _shown(scd2.for_keys(_history(spark, d).history, wanted, ["c_custkey"]))


@query(f"{_HISTORY_SQL} SELECT count(*) AS n, count(*) AS n_distinct, CAST(101 AS BIGINT) AS least, 100 + count(*) AS most FROM h2")
def history_surrogate_keys(spark, d):
    h = scd2.with_keys(_history(spark, d).history, ["c_custkey"], 100)
    return h.agg(F.count(scd2.KEY).alias("n"), F.count_distinct(scd2.KEY).alias("n_distinct"), F.min(scd2.KEY).alias("least"), F.max(scd2.KEY).alias("most"))


# audits


def _nulls_in(df, col, n):
    return df.withColumn(col, F.when(F.col("c_custkey") % n != 0, F.col(col)))


@query(f"{_sql_snapshots('customer')}, a AS (SELECT c_custkey, CASE WHEN c_custkey % 19 <> 0 THEN c_name END AS c_name, c_acctbal, c_mktsegment FROM e), b AS (SELECT c_custkey, CASE WHEN c_custkey % 38 <> 0 THEN c_name END AS c_name, c_acctbal, c_mktsegment FROM f), j AS (SELECT a.c_custkey AS ka, b.c_custkey AS kb, a.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL AS m, a.c_name IS DISTINCT FROM b.c_name AS d1, a.c_acctbal IS DISTINCT FROM b.c_acctbal AS d2, a.c_mktsegment IS DISTINCT FROM b.c_mktsegment AS d3 FROM a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey) SELECT count(ka) AS source_rows, count(kb) AS stage_rows, count(*) FILTER (WHERE m AND NOT (d1 OR d2 OR d3)) AS matched_rows, count(*) FILTER (WHERE m AND (d1 OR d2 OR d3)) AS mismatched_rows, count(*) FILTER (WHERE kb IS NULL) AS source_only_rows, count(*) FILTER (WHERE ka IS NULL) AS stage_only_rows, count(*) FILTER (WHERE m AND d1) AS diff_c_name, count(*) FILTER (WHERE m AND d2) AS diff_c_acctbal, count(*) FILTER (WHERE m AND d3) AS diff_c_mktsegment, false AS is_clean FROM j")
def recon_table(spark, d):
    e, f = _snapshots(spark, d, "customer")
    return reconcile.table(_nulls_in(e, "c_name", 19), _nulls_in(f, "c_name", 38), ["c_custkey"], ["c_name", "c_acctbal", "c_mktsegment"])


@query(f"{_sql_snapshots('events')}, a AS (SELECT * FROM e WHERE {_IN_DAY}), b AS (SELECT * FROM f WHERE {_IN_DAY}), j AS (SELECT a.event_id AS ka, b.event_id AS kb, a.value IS DISTINCT FROM b.value AS d1 FROM a FULL OUTER JOIN b ON a.event_id = b.event_id) SELECT count(ka) AS source_rows, count(kb) AS stage_rows, count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL AND NOT d1) AS matched_rows, count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL AND d1) AS mismatched_rows, count(*) FILTER (WHERE kb IS NULL) AS source_only_rows, count(*) FILTER (WHERE ka IS NULL) AS stage_only_rows, count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL AND d1) AS diff_value, CAST(0 AS BIGINT) AS duplicate_keys, false AS is_clean FROM j")
def recon_table_windowed(spark, d):
    e, f = _snapshots(spark, d, "events")
    return reconcile.table_windowed(e, f, ["event_id"], "ts", *_DAY, columns=["value"])


@query(f"{_STAGE_SQL} SELECT (SELECT count(*) FROM customer) AS source_count, (SELECT count(*) FROM s WHERE is_current = 1) AS stage_count, (SELECT count(*) FROM e) AS bronze_active_count, (SELECT count(*) FROM customer) - (SELECT count(*) FROM f) AS count_delta_source_stage, (SELECT count(*) FROM f) - (SELECT count(*) FROM e) AS count_delta_stage_bronze, false AS is_clean")
def recon_counts(spark, d):
    e, _ = _hashed(spark, d, "customer")
    return reconcile.counts(_table(spark, d, "customer"), cdc.current(_stage(spark, d).stage), scd2.apply(None, e, ["c_custkey"], T1).history)


@query(f"{_HISTORY_SQL}, a AS (SELECT c_custkey FROM h2 WHERE active = 1), src AS (SELECT c_custkey FROM e) SELECT (SELECT count(*) FROM src) AS source_pk_count, (SELECT count(*) FROM a) AS bronze_active_pk_count, (SELECT count(*) FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM src)) AS ghost_count, (SELECT count(*) FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM a)) AS missing_count, (SELECT count(*) FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM src)) / (SELECT count(*) FROM a) AS ghost_ratio, true AS ghost_alert, false AS is_clean")
def recon_active_keys(spark, d):
    e, _ = _snapshots(spark, d, "customer")
    return reconcile.active_keys(e, _history(spark, d).history, ["c_custkey"])


@query(f"{_DOUBLED_SQL}, v AS (SELECT c_custkey, count(*) AS n, max(h) AS h FROM (SELECT c_custkey, h FROM h2 WHERE active = 1 UNION ALL SELECT c_custkey, h FROM h2 WHERE active = 1 AND c_custkey % 3 = 0) GROUP BY 1), j AS (SELECT e.c_custkey AS ke, v.c_custkey AS kv, v.n, e.h IS NOT DISTINCT FROM v.h AS same FROM e FULL OUTER JOIN v ON e.c_custkey = v.c_custkey) SELECT count(ke) AS stage_current_rows, CAST(sum(n) AS BIGINT) AS bronze_active_rows, count(*) FILTER (WHERE ke IS NOT NULL AND kv IS NOT NULL AND same) AS matched_rows, count(*) FILTER (WHERE ke IS NOT NULL AND kv IS NOT NULL AND NOT same) AS hash_mismatches, count(*) FILTER (WHERE ke IS NULL) AS orphaned_bronze_rows, count(*) FILTER (WHERE kv IS NULL) AS missing_bronze_rows, count(*) FILTER (WHERE n > 1) AS duplicate_active_pks, false AS is_clean FROM j")
def recon_bronze(spark, d):
    e, _ = _hashed(spark, d, "customer")
    return reconcile.bronze(e, _doubled(spark, d), ["c_custkey"])


def _perturbed(spark, d):
    """History of three snapshots with ends moved by an hour and some keys closed for good."""
    h = _third(spark, d).history
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    k = F.col("c_custkey")
    end = F.when((k % 19 == 0) & (k % 2 == 0), F.col(scd2.END) + hour).when(k % 19 == 0, F.col(scd2.END) - hour).otherwise(F.col(scd2.END))
    return h.withColumns({scd2.END: end, scd2.ACTIVE: F.when(k % 23 == 0, F.lit(0)).otherwise(F.col(scd2.ACTIVE)).cast("tinyint")})


_PERTURBED_SQL = f"{_THIRD_SQL.replace('@BACK@', 'I')}, q AS (SELECT c_custkey, effective, CASE WHEN c_custkey % 19 = 0 AND c_custkey % 2 = 0 THEN ended + INTERVAL 1 HOUR WHEN c_custkey % 19 = 0 THEN ended - INTERVAL 1 HOUR ELSE ended END AS ended, CASE WHEN c_custkey % 23 = 0 THEN 0 ELSE active END AS active FROM h3)"
_FAR = f"TIMESTAMP '{scd2.FAR}'"
_OVERLAPS = f"SELECT DISTINCT b.c_custkey, b.effective FROM q a JOIN q b ON a.c_custkey = b.c_custkey AND a.effective < b.effective WHERE b.effective < coalesce(a.ended, {_FAR}) AND a.effective < coalesce(b.ended, {_FAR})"
_GAPS = f"SELECT c_custkey, pe AS previous_end, effective AS next_start, date_diff('second', pe, effective) AS gap_seconds FROM (SELECT *, lag(coalesce(ended, {_FAR})) OVER (PARTITION BY c_custkey ORDER BY effective) AS pe FROM q) WHERE date_diff('second', pe, effective) > 1"


@query(f"{_PERTURBED_SQL} {_OVERLAPS}")
def scd2_overlaps(spark, d):
    return reconcile.overlaps(_perturbed(spark, d), ["c_custkey"]).select("c_custkey", F.col(scd2.START).alias("effective"))


@query(f"{_PERTURBED_SQL} SELECT c_custkey, count(*) AS n_versions FROM q GROUP BY 1 HAVING sum(active) = 0")
def scd2_zero_active(spark, d):
    return reconcile.zero_active(_perturbed(spark, d), ["c_custkey"])


@query(f"{_PERTURBED_SQL} {_GAPS}")
def scd2_gaps(spark, d):
    return reconcile.gaps(_perturbed(spark, d), ["c_custkey"])


@query(f"{_PERTURBED_SQL} SELECT (SELECT count(*) FROM ({_OVERLAPS})) AS overlapping_intervals, (SELECT count(*) FROM (SELECT c_custkey FROM q GROUP BY 1 HAVING sum(active) = 0)) AS zero_active_pks, (SELECT count(*) FROM ({_GAPS})) AS version_gaps, CAST(0 AS BIGINT) AS inverted_intervals, false AS is_clean")
def scd2_integrity(spark, d):
    return reconcile.integrity(_perturbed(spark, d), ["c_custkey"])


@query(f"{_PERTURBED_SQL} SELECT DISTINCT c_custkey FROM ({_GAPS}) ORDER BY 1 LIMIT 5")
def scd2_gap_samples(spark, d):
    return reconcile.samples(reconcile.gaps(_perturbed(spark, d), ["c_custkey"]), ["c_custkey"])


_AGG = "SELECT '{c}' AS \"column\", (SELECT count({c}) FROM e) AS source_count, round((SELECT sum({c}) FROM e), 2) AS source_sum, (SELECT count({c}) FROM f) AS target_count, round((SELECT sum({c}) FROM f), 2) AS target_sum, (SELECT CAST(min({c}) AS DOUBLE) FROM e) AS source_min, (SELECT CAST(max({c}) AS DOUBLE) FROM f) AS target_max, (SELECT count({c}) FROM e) <> (SELECT count({c}) FROM f) AS count_mismatch, abs((SELECT sum({c}) FROM e) - (SELECT sum({c}) FROM f)) / abs((SELECT sum({c}) FROM e)) > 0.001 AS sum_mismatch"


@query(f"{_sql_snapshots('orders')} " + " UNION ALL ".join(_AGG.format(c=c) for c in ("o_custkey", "o_totalprice")))
def recon_aggregates(spark, d):
    e, f = _snapshots(spark, d, "orders")
    out = reconcile.aggregates(e, f, ["o_custkey", "o_totalprice"])
    return out.select("column", "source_count", F.round("source_sum", 2).alias("source_sum"), "target_count", F.round("target_sum", 2).alias("target_sum"), "source_min", "target_max", "count_mismatch", "sum_mismatch")


_DIST = "SELECT '{c}' AS \"column\", round((SELECT avg({c}) FROM events), 6) AS mean, round((SELECT avg({c}) FROM b), 6) AS baseline_mean, round(abs((SELECT avg({c}) FROM events) - (SELECT avg({c}) FROM b)) / (SELECT stddev_samp({c}) FROM b), 6) AS z, abs((SELECT avg({c}) FROM events) - (SELECT avg({c}) FROM b)) / (SELECT stddev_samp({c}) FROM b) > 2 AS shifted"


@query("WITH b AS (SELECT event_id / 10.0 AS event_id, user_id, value FROM events WHERE event_id % 3 = 0) " + " UNION ALL ".join(_DIST.format(c=c) for c in ("event_id", "user_id", "value")))
def distribution_shift(spark, d):
    e = _table(spark, d, "events")
    base = e.where("event_id % 3 = 0").withColumn("event_id", F.col("event_id").cast("double") / 10)
    own = ["event_id", "user_id", "value"]
    out = reconcile.distribution_shift(e, reconcile.distribution(base, own), own)
    return out.select("column", F.round("mean", 6).alias("mean"), F.round("baseline_mean", 6).alias("baseline_mean"), F.round("z", 6).alias("z"), "shifted")


@query(f"{_HISTORY_SQL}, a AS (SELECT * FROM h2 WHERE active = 1), t AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal FROM e) SELECT (SELECT count(*) FROM a) AS source_count, (SELECT count(*) FROM t) AS target_count, (SELECT count(*) FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM a)) AS orphaned_keys, 'c_acctbal' AS anomalies, (SELECT count(*) FROM a) - (SELECT count(*) FROM t) AS count_delta, false AS is_clean")
def boundary_check(spark, d):
    e, _ = _snapshots(spark, d, "customer")
    target = e.select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    out = reconcile.boundary(_history(spark, d).history, target, ["c_custkey"])
    return out.select("source_count", "target_count", "orphaned_keys", F.array_join("null_rate_anomalies", ",").alias("anomalies"), "count_delta", "is_clean")


_FACT = "fact AS (SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS fk, TIMESTAMP '2024-01-15' + INTERVAL (o_orderkey % 60) DAY AS at FROM orders)"


def _fact(spark, d):
    o = _table(spark, d, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 29 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("fk"), (F.lit("2024-01-15").cast("timestamp_ntz") + F.make_dt_interval((F.col("o_orderkey") % 60).cast("int"))).alias("at"))


@query(f"WITH {_FACT}, dup AS (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 50 = 0) SELECT (SELECT count(*) FROM fact) AS total_fact_rows, (SELECT count(*) FROM fact WHERE fk NOT IN (SELECT c_custkey FROM customer)) AS orphaned_fks, (SELECT count(DISTINCT fk) FROM fact WHERE fk IN (SELECT c_custkey FROM dup GROUP BY 1 HAVING count(*) > 1)) AS ambiguous_fks, false AS is_clean")
def ref_integrity(spark, d):
    c = _table(spark, d, "customer")
    return reconcile.references(_fact(spark, d), c.unionByName(c.where("c_custkey % 50 = 0")), "fk", "c_custkey")


_TEMPORAL = f"(SELECT fact.*, count(h3.c_custkey) AS n FROM fact LEFT JOIN h3 ON fact.fk = h3.c_custkey AND h3.effective <= fact.at AND fact.at < coalesce(h3.ended, {_FAR}) GROUP BY ALL)"


@query(f"{_THIRD_SQL.replace('@BACK@', 'I')}, {_FACT} SELECT o_orderkey, fk FROM {_TEMPORAL} WHERE n = 0")
def ref_integrity_temporal(spark, d):
    return reconcile.orphaned_references(_fact(spark, d), _third(spark, d).history, "fk", "c_custkey", at="at").select("o_orderkey", "fk")


_AMBIGUOUS = f"{_DOUBLED_SQL}, {_FACT} SELECT o_orderkey, count(*) AS n FROM fact JOIN hd ON fact.fk = hd.c_custkey AND hd.effective <= fact.at AND fact.at < coalesce(hd.ended, {_FAR}) GROUP BY 1 HAVING count(*) > 1"


@query(_AMBIGUOUS)
def ref_ambiguity_temporal(spark, d):
    return reconcile.ambiguous_references(_fact(spark, d), _doubled(spark, d), "fk", "c_custkey", at="at", fact_keys=["o_orderkey"]).select("o_orderkey", "n")


@query("WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT avg(n) AS avg_versions, max(n) AS max_versions, count(*) FILTER (WHERE n > 5) AS high_velocity_pks FROM n")
def version_velocity(spark, d):
    return reconcile.velocity(_table(spark, d, "lineitem"), ["l_orderkey"], 5)


# guards

_DAILY = "day_counts AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)"


def _daily(spark, d):
    return _table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_DAILY}, l AS (SELECT n FROM day_counts ORDER BY day DESC LIMIT 14) SELECT CAST(floor(median(n)) AS BIGINT) AS baseline, count(*) AS n_runs FROM l")
def guard_median_baseline(spark, d):
    return guards.median_baseline(_daily(spark, d), count="n", at="day")


@query(f"WITH {_DAILY}, l AS (SELECT n FROM day_counts WHERE day < DATE '2024-01-30' AND day >= DATE '2023-12-31' AND dayofweek(day) = dayofweek(DATE '2024-01-30') ORDER BY day DESC LIMIT 14) SELECT CAST(floor(median(n)) AS BIGINT) AS baseline, count(*) AS n_runs, true AS same_weekday FROM l")
def guard_weekday_baseline(spark, d):
    from datetime import date

    return guards.weekday_baseline(_daily(spark, d), date(2024, 1, 30), count="n", at="day")


@query("WITH c AS (SELECT event_type, count(*) AS fresh_count FROM events GROUP BY 1), x AS (SELECT event_type || m AS name, fresh_count, CAST(fresh_count * f AS BIGINT) AS baseline_count FROM c, (VALUES ('a', 1), ('b', 3), ('c', 20), ('d', 0)) AS v(m, f)) SELECT *, CASE WHEN baseline_count = 0 THEN 'ok' WHEN fresh_count < floor(baseline_count * 0.1) THEN 'drop' WHEN fresh_count > floor(baseline_count * 5) THEN 'growth' WHEN fresh_count < floor(baseline_count * 0.5) THEN 'warn' ELSE 'ok' END AS guard FROM x")
def guard_decisions(spark, d):
    c = _table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("fresh_count"))
    x = c.withColumn("v", F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(f).alias("f")) for m, f in (("a", 1), ("b", 3), ("c", 20), ("d", 0))))))
    return guards.decisions(x.select(F.concat("event_type", "v.m").alias("name"), "fresh_count", (F.col("fresh_count") * F.col("v.f")).cast("long").alias("baseline_count")))


@query("WITH done AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 3 <> 0) SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT day FROM done)")
def date_gaps(spark, d):
    done = _table(spark, d, "events").select(F.to_date("ts").alias("DateValue")).distinct().withColumn("Status", F.when(F.dayofmonth("DateValue") % 3 == 0, "FAILED_CDC").otherwise("SUCCESS"))
    return guards.gaps(done, "2024-01-01", "2024-02-05")


@query("SELECT DISTINCT CAST(ts AS DATE) AS date, 'FAILED_CDC' AS status FROM events WHERE day(ts) % 3 = 0 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def failed_dates(spark, d):
    done = _table(spark, d, "events").select(F.to_date("ts").alias("DateValue")).distinct().withColumn("Status", F.when(F.dayofmonth("DateValue") % 3 == 0, "FAILED_CDC").otherwise("SUCCESS"))
    return guards.failed_dates(done, "2024-01-05", "2024-01-20")


@query("WITH done AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 3 <> 0), days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS date) SELECT date FROM days WHERE date NOT IN (SELECT day FROM done) OR date >= DATE '2024-01-31'")
def dates_to_process(spark, d):
    from datetime import date

    days = _table(spark, d, "events").select(F.to_date("ts").alias("day")).where(F.dayofmonth("day") % 3 != 0).distinct()
    done = {r["day"] for r in days.collect()}  # a row for each day of a run's log
    wanted = guards.dates_to_process(date(2024, 2, 6), date(2024, 1, 9), done, lookback=5)
    return spark.createDataFrame([(x,) for x in wanted], "date date")


@query("SELECT max(ts) AS newest, date_diff('second', max(ts), TIMESTAMP '2024-02-01 06:00:00') / 3600.0 AS age_hours, CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-01 06:00:00') / 3600.0 > 48 THEN 'error' WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-01 06:00:00') / 3600.0 > 36 THEN 'warning' ELSE 'ok' END AS level FROM events")
def freshness(spark, d):
    return guards.freshness(_table(spark, d, "events"), "ts", "2024-02-01 06:00:00")


@query(f"{_HISTORY_SQL} SELECT CAST(sum(active) AS BIGINT) AS active, count(*) AS total, sum(active) / count(*) AS active_ratio, false AS warning FROM h2")
def active_ratio(spark, d):
    return guards.active_ratio(_history(spark, d).history)


@query("SELECT max(CAST(ts AS DATE)) AS last_success FROM events WHERE day(ts) % 3 <> 0")
def last_success(spark, d):
    done = _table(spark, d, "events").select(F.to_date("ts").alias("DateValue"), F.when(F.dayofmonth("ts") % 3 == 0, "FAILED").otherwise("SUCCESS").alias("Status"))
    return guards.last_success(done)


# profiling

_SCORE = "CASE WHEN n_distinct = n_rows AND n_null = 0 THEN 'CONFIRMED UNIQUE' WHEN n_distinct / n_rows > 0.99 AND n_null = 0 THEN 'HIGH (>99% unique, not null)' WHEN name_match AND n_null = 0 THEN 'MEDIUM (PK name pattern, not null)' WHEN n_null = 0 THEN 'MEDIUM (not null)' ELSE 'LOW' END"
_PROFILE = "SELECT '{c}' AS \"column\", count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null, {m} AS name_match FROM events"


@query("WITH p AS (" + " UNION ALL ".join(_PROFILE.format(c=c, m=str(m).lower()) for c, m in (("event_id", True), ("ts", False), ("user_id", True), ("event_type", False), ("value", False))) + f") SELECT *, {_SCORE} AS score FROM p")
def pk_profile_columns(spark, d):
    return profile.columns(_table(spark, d, "events"), ["event_id", "ts", "user_id", "event_type", "value"]).select("column", "n_rows", "n_distinct", "n_null", "name_match", "score")


@query("SELECT 'l_orderkey,l_linenumber' AS columns, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct, count(DISTINCT (l_orderkey, l_linenumber)) = count(*) AS is_unique FROM lineitem UNION ALL SELECT 'l_orderkey,l_partkey', count(*), count(DISTINCT (l_orderkey, l_partkey)), count(DISTINCT (l_orderkey, l_partkey)) = count(*) FROM lineitem")
def pk_profile_composite(spark, d):
    return profile.composites(_table(spark, d, "lineitem"), [("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey")])


@query("SELECT min(CASE WHEN l_orderkey % 7 <> 0 THEN l_partkey END) AS min_value, max(CASE WHEN l_orderkey % 7 <> 0 THEN l_partkey END) AS max_value, count(*) AS n_rows, count(*) FILTER (WHERE l_orderkey % 7 = 0) AS n_null, count(*) FILTER (WHERE l_orderkey % 7 = 0) / count(*) AS null_share, count(*) FILTER (WHERE l_orderkey % 7 = 0) / count(*) > 0.1 AS warning FROM lineitem")
def partition_stats(spark, d):
    return profile.partition_stats(_table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_partkey")).alias("p")), "p")


_NAMED = " with a key''s name"
_SINGLE = "SELECT '{c}' AS columns, 'single unique column{named}: {c} (' || count(DISTINCT {c}) || ' distinct values)' AS reason FROM {t}"


@query(f"{_SINGLE.format(c='event_id', t='events', named=_NAMED)} UNION ALL {_SINGLE.format(c='o_orderkey', t='orders', named='')}")
def key_recommendations(spark, d):
    found = [profile.recommend(_table(spark, d, "events"), ["ts", "event_id", "user_id"]), profile.recommend(_table(spark, d, "orders"), ["o_custkey", "o_orderkey"])]
    return spark.createDataFrame([(",".join(r.columns), r.reason) for r in found], "columns string, reason string")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_partkey END AS part FROM lineitem")
def null_partition_supplement(spark, d):
    own = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_partkey")).alias("part"))
    return registry.with_null_partition(own.where("part is not null"), "part", own)


_BARE = "{t} AS (SELECT substr(column_name, 3) AS name FROM (DESCRIBE {t}))"


@query(f"WITH {_BARE.format(t='customer')}, {_BARE.format(t='supplier')} SELECT 'missing' AS kind, name FROM customer WHERE name NOT IN (SELECT name FROM supplier) UNION ALL SELECT 'unexpected', name FROM supplier WHERE name NOT IN (SELECT name FROM customer)")
def schema_contract(spark, d):
    supplier, customer = (_table(spark, d, t) for t in ("supplier", "customer"))
    found = evolve.contract(supplier.toDF(*(c[2:] for c in supplier.columns)), [c[2:] for c in customer.columns])
    return spark.createDataFrame([("missing", c) for c in found.missing] + [("unexpected", c) for c in found.unexpected], "kind string, name string")


@query("WITH o AS (SELECT column_name AS name FROM (DESCRIBE orders)) SELECT 'kept' AS kind, name FROM o WHERE name <> 'o_orderpriority' UNION ALL SELECT 'removed', name FROM o WHERE name = 'o_orderpriority' UNION ALL SELECT 'added', 'o_extra'")
def schema_evolution(spark, d):
    old = _table(spark, d, "orders")
    new = old.drop("o_orderpriority").withColumn("o_extra", F.lit(1.5)).schema
    found = evolve.evolution(old.schema, new)
    rows = [("added", c) for c in found.added] + [("removed", c) for c in found.removed] + [("kept", f.name) for f in found.schema.fields if f.name not in (*found.added, *found.removed)]
    return spark.createDataFrame(rows, "kind string, name string")


@query("SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15'")
def distinct_dates(spark, d):
    return profile.distinct_dates(_table(spark, d, "events"), "ts", "2024-01-05", "2024-01-15")


@query("SELECT count(*) FILTER (WHERE event_id % 31 = 0) AS n_null_dates, count(*) AS n_rows FROM events")
def null_date_probe(spark, d):
    return profile.null_dates(_table(spark, d, "events").select(F.when(F.col("event_id") % 31 != 0, F.col("ts")).alias("ts")), "ts")


# evolution


@query("SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal, 'x' AS extra FROM customer UNION ALL SELECT c_custkey, NULL, c_acctbal, NULL FROM customer")
def schema_evolve_union(spark, d):
    c = _table(spark, d, "customer")
    first = c.select("c_custkey", "c_name", F.lit(None).cast("double").alias("c_acctbal"), F.lit("x").alias("extra"))
    return evolve.concat_aligned([first, c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_acctbal")])


@query("SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def concat_strict(spark, d):
    return evolve.concat_strict([_table(spark, d, "customer").select("c_custkey", "c_acctbal"), _table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))])


@query("SELECT 'customer' AS TableName, 'src' AS SourceName, 'negative' AS RejectionReason, CAST(c_custkey AS VARCHAR) AS k, CAST(7 AS BIGINT) AS BatchId FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 100")
def quarantine_rows(spark, d):
    bad = _table(spark, d, "customer").where("c_acctbal < 0")
    return evolve.quarantine(bad, "customer", "src", "negative", 7, T1, order=["c_custkey"]).select("TableName", "SourceName", "RejectionReason", F.get_json_object("RecordData", "$.c_custkey").alias("k"), "BatchId")


@query("SELECT a.n AS old_name, b.n AS new_name, CAST(levenshtein(lower(a.n), lower(b.n)) AS INTEGER) AS distance FROM (VALUES ('cust_name', 'string'), ('balance', 'double'), ('zip', 'int')) AS a(n, t) JOIN (VALUES ('cust_nme', 'string'), ('ballance', 'double'), ('zip_code', 'int'), ('zap', 'string')) AS b(n, t) ON a.t = b.t WHERE levenshtein(lower(a.n), lower(b.n)) <= 3")
def rename_candidates(spark, d):
    rows = lambda *x: spark.createDataFrame(x, "column_name string, data_type string")
    return evolve.rename_candidates(rows(("cust_name", "string"), ("balance", "double"), ("zip", "int")), rows(("cust_nme", "string"), ("ballance", "double"), ("zip_code", "int"), ("zap", "string")))


@query("SELECT 'c_name' AS \"column\", CAST(0 AS BIGINT) AS nulls_before, count(*) FILTER (WHERE c_custkey % 19 = 0) AS nulls_after FROM customer")
def null_inflation(spark, d):
    c = _table(spark, d, "customer")
    return evolve.null_inflation(c, _nulls_in(c, "c_name", 19))


@query("SELECT c_custkey, c_name, CAST(c_acctbal AS INTEGER) AS n, CAST(NULL AS DATE) AS born FROM (SELECT c_custkey, c_name, floor(c_acctbal) AS c_acctbal FROM customer)")
def conform_schema(spark, d):
    from pyspark.sql import types as T

    c = _table(spark, d, "customer").select("c_custkey", "c_name", F.floor("c_acctbal").cast("string").alias("n"))
    return evolve.conform(c, T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("born", T.DateType())]))


# sources


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def extract_windowed(spark, d):
    from datetime import date

    registry.register_source(registry.Source("bench", "parquet", d))
    return registry.extract_windowed(spark, registry.TableConfig("BENCH", "events", source_aggregate_column_name="ts"), date(2024, 1, 10)).select("event_id", "ts")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-09 23:00:00' AND ts < TIMESTAMP '2024-01-11'")
def extract_overlapping(spark, d):
    from datetime import date

    registry.register_source(registry.Source("bench", "parquet", d))
    return registry.extract_windowed(spark, registry.TableConfig("BENCH", "events", source_aggregate_column_name="ts"), date(2024, 1, 10), overlap_minutes=60).select("event_id")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-08'")
def extract_range(spark, d):
    from datetime import date

    registry.register_source(registry.Source("bench", "parquet", d))
    return registry.extract_range(spark, registry.TableConfig("bench", "events", source_aggregate_column_name="ts"), date(2024, 1, 3), date(2024, 1, 8)).select("event_id")


@query("SELECT * FROM nation")
def extract_full(spark, d):
    registry.register_source(registry.Source("bench", "parquet", d))
    return registry.extract_full(spark, registry.TableConfig("bench", "nation"))


@query("SELECT DISTINCT o_custkey FROM orders")
def source_keys(spark, d):
    return registry.source_keys(_table(spark, d, "orders"), ["o_custkey"])


# operational tables, made from events


def _events_log(spark, d):
    e = _table(spark, d, "events")
    kind = F.get(F.lit(["TABLE_TOTAL", "EXTRACT", "CDC_PROMOTION", "SCD2_PROMOTION"]), (F.col("event_id") % 4).cast("int"))
    status = F.when(F.col("event_id") % 9 == 0, "FAILED").when(F.col("event_id") % 11 == 0, "SKIPPED").otherwise("SUCCESS")
    return e.select(F.col("event_id").alias("BatchId"), F.concat(F.lit("t"), (F.col("user_id") % 20).cast("string")).alias("TableName"), F.lit("s").alias("SourceName"), kind.alias("EventType"), F.lit(None).cast("string").alias("EventDetail"), F.col("ts").alias("CompletedAt"), (F.col("event_id") * 37 % 10007).alias("DurationMs"), status.alias("Status"), F.lit(None).cast("string").alias("ErrorMessage"), F.col("user_id").alias("RowsProcessed"), F.concat(F.lit('{"update_ratio": '), F.format_string("%d.%02d", F.lit(0), (F.col("event_id") % 100).cast("int")), F.lit("}")).alias("Metadata"))


_LOG = "ev AS (SELECT event_id AS BatchId, 't' || user_id % 20 AS TableName, ['TABLE_TOTAL', 'EXTRACT', 'CDC_PROMOTION', 'SCD2_PROMOTION'][event_id % 4 + 1] AS EventType, ts AS CompletedAt, event_id * 37 % 10007 AS DurationMs, CASE WHEN event_id % 9 = 0 THEN 'FAILED' WHEN event_id % 11 = 0 THEN 'SKIPPED' ELSE 'SUCCESS' END AS Status, user_id AS RowsProcessed, (event_id % 100) / 100 AS update_ratio FROM events)"


@query(f"WITH {_LOG} SELECT TableName, EventType, DurationMs, RowsProcessed, Status FROM ev WHERE EventType = 'TABLE_TOTAL' AND CompletedAt > TIMESTAMP '2024-01-20' ORDER BY DurationMs DESC, TableName LIMIT 10")
def ops_slowest(spark, d):
    return ops.slowest(_events_log(spark, d), "2024-01-20 00:00:00")


@query(f"WITH {_LOG} SELECT BatchId, TableName, EventType, CompletedAt FROM ev WHERE Status = 'FAILED' AND CompletedAt > TIMESTAMP '2024-01-20'")
def ops_failed(spark, d):
    return ops.failed(_events_log(spark, d), "2024-01-20 00:00:00").drop("ErrorMessage")


@query(f"WITH {_LOG} SELECT TableName, RowsProcessed, CompletedAt FROM ev WHERE Status = 'SKIPPED' AND EventType = 'EXTRACT'")
def ops_skipped(spark, d):
    return ops.skipped(_events_log(spark, d), "EXTRACT").select("TableName", "RowsProcessed", "CompletedAt")


@query(f"WITH {_LOG} SELECT TableName, update_ratio, CompletedAt FROM ev WHERE EventType = 'CDC_PROMOTION' AND CompletedAt > TIMESTAMP '2024-01-20' AND update_ratio > 0.5")
def ops_update_ratio(spark, d):
    return ops.ratios(_events_log(spark, d), "CDC_PROMOTION", "update_ratio", "2024-01-20 00:00:00", 0.5)


@query(f"WITH {_LOG} SELECT TableName, CAST(date_diff('day', CAST(max(CompletedAt) AS DATE), DATE '2024-03-15') AS INTEGER) AS age_days, CASE WHEN date_diff('day', CAST(max(CompletedAt) AS DATE), DATE '2024-03-15') <= 30 THEN 'fresh' WHEN date_diff('day', CAST(max(CompletedAt) AS DATE), DATE '2024-03-15') <= 90 THEN 'aging' ELSE 'stale' END AS bucket FROM ev GROUP BY 1")
def ops_staleness(spark, d):
    last = _events_log(spark, d).groupBy("TableName").agg(F.max("CompletedAt").alias("at"))
    return ops.staleness(last, "at", "2024-03-15 00:00:00").drop("at")


@query(f"WITH {_LOG} SELECT BatchId FROM ev WHERE CompletedAt >= TIMESTAMP '2024-01-20'")
def ops_retention(spark, d):
    return ops.retain(_events_log(spark, d), "CompletedAt", "2024-02-19 00:00:00", 30).select("BatchId")


def _config(spark):
    tables = spark.createDataFrame([("a", "orders", None, "o_orderdate", None, None, "Python"), ("a", "customer", None, None, "ix_c", None, "Python"), ("b", "part", "part2", None, None, "p_partkey", "Python"), ("b", "old", None, None, None, None, "Other")], "source_name string, source_object_name string, stage_table_name string, source_aggregate_column_name string, source_index_hint string, partition_on string, stage_load_tool string")
    columns = spark.createDataFrame([("a", "orders", "o_orderkey", 1, "Stage", True), ("a", "orders", "o_custkey", 2, "Stage", False), ("b", "part2", "p_partkey", 2, "Stage", True), ("b", "part2", "p_brand", 1, "Stage", True)], "source_name string, table_name string, column_name string, ordinal_position int, layer string, is_primary_key boolean")
    return tables, columns


@query("SELECT * FROM (VALUES ('a', 'orders', 'LARGE', 'bulk'), ('a', 'customer', 'SMALL', 'hinted'), ('b', 'part', 'SMALL', 'partitioned')) AS v(source_name, source_object_name, size_class, extraction_path)")
def metadata_inventory(spark, d):
    return ops.inventory(_config(spark)[0])


@query("SELECT source_name, source_object_name, CAST(n_keys AS BIGINT) AS n_keys, CAST(n_columns AS BIGINT) AS n_columns, metadata_status, lacks_key FROM (VALUES ('a', 'orders', 1, 2, 'SYNCED', false), ('a', 'customer', 0, 0, 'NOT SYNCED', true), ('b', 'part', 2, 2, 'SYNCED', false)) AS v(source_name, source_object_name, n_keys, n_columns, metadata_status, lacks_key)")
def metadata_gap(spark, d):
    return ops.key_gaps(*_config(spark))


@query("SELECT * FROM (VALUES ('a', 'orders', 'o_orderkey'), ('b', 'part2', 'p_brand,p_partkey')) AS v(source_name, table_name, keys)")
def metadata_keys(spark, d):
    return ops.key_columns(_config(spark)[1])


@query("SELECT 'a' AS source_name, 'customer' AS source_object_name, 'ix_c' AS hint, true AS \"exists\", 'full scan' AS mode")
def metadata_hints(spark, d):
    return ops.hint_assessment(_config(spark)[0], spark.createDataFrame([("customer", "ix_c")], "table_name string, index_name string"))


def entry(spark: SparkSession, d: str = "/root/testdata/sf0.001") -> DataFrame:
    """The flagship: operations between two snapshots of customer, counted."""
    e, f = _hashed(spark, d, "customer")
    return cdc.diff(f, e, ["c_custkey"]).groupBy("op").agg(F.count(F.lit(1)).alias("n"))
