"""Benchmark decontamination with DataFrame functions only.

A document holds an item if some window of as many words as the item has is similar to it by 0.8 or more: the
weighted Jaccard similarity of their five-word shingles, weighted by occurrences, after lower-casing. Every window of
every document is judged, at every item's size, wherever in it the shared shingles stand.

1. Windows to fingerprint: a window that similar to an item of its size has a known number of shingles of items of
   that size, at least. The places of such shingles in a text give the windows that have enough of them; no other
   window can pass, so no other is fingerprinted.
2. SimHash of these windows and of the items: each bit is the majority of that bit over the hashes of the shingles.
   Counts of several bits lie side by side in a long, and a window's counts are those of the window before it, plus
   the shingle that came, less the one that went.
3. Multi-index Hamming blocks: the fingerprint is cut into blocks of 8 bits, and each item of a size is listed under all
   values within radius // 8 bits of each of its blocks. A fingerprint within the radius agrees so with some block, so
   looking up a window's own blocks finds every item within the radius.
4. Pairs so found are verified by the exact similarity of the shingles themselves.

Of 64 bits, those of two texts of similarity 0.8 differ in 9.7 on average; more than the default radius of 23 differ
with a probability of 0.00001. `radius=64` lists an item once for its size and so verifies every window against every
item of its size, with no such loss.

The benchmark's shingles, fingerprints and texts are broadcast only within `broadcast_rows` rows and `broadcast_bytes`
bytes, which are counted first; beyond them the same joins shuffle. Only the texts that have windows to fingerprint are
shuffled. Passages that many documents share give a few rows for each, never pairs of documents.

Defined results: a null or blank text holds nothing, and a null or blank item is held by nothing; an item of fewer
than five words is one shingle; a document shorter than the item is one window; rows with a null id are never
reported; rows that repeat an id are one document; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, cut, named

SHINGLE = 5
SPACES = " \t\n\x0b\x0c\r"
BITS, BLOCK = 64, 8


def words(text: Column) -> Column:
    """The lower-cased words of a text, none for a null or blank one."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def _once(value: Column, use) -> Column:
    """use(value), with the value made once however often it is used; both are arrays."""
    return F.flatten(F.transform(F.array(value), use))


def _word_hashes(own: str | Column) -> Column:
    return F.transform(own, lambda w: F.xxhash64(w))


def shingle_hashes(own: str | Column, k: int) -> Column:
    """The hash of each run of k words of an array; equal to those of _shingle_rows."""
    return _once(_word_hashes(own), lambda h: F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - k + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, k)))).otherwise(F.array().cast("array<bigint>")))


def _shingle_rows(df: DataFrame, keep: list[str], hashes: str, k: int) -> DataFrame:
    """A row (*keep, pos, shingle) for each run of k word hashes. Only hashes move through the generator."""
    n = F.size(hashes)
    shifted = F.arrays_zip(*(F.slice(hashes, F.lit(j + 1), F.greatest(n - (k - 1), F.lit(0))).alias(f"h{j}") for j in range(k)))
    rows = df.select(*keep, F.posexplode(shifted).alias("pos", "own"))
    return rows.select(*keep, "pos", F.xxhash64(*(F.col(f"own.h{j}") for j in range(k))).alias("shingle"))


def window_fingerprints(hashes: Column, length: Column, lane: int) -> Column:
    """The 64-bit majority fingerprint of each run of `length` hashes, from counts carried from one run to the next.

    lane: bits of a count, 16 or 32; a run has fewer than 2 ** (lane - 1) hashes. Plane b counts bit b of every lane.
    """
    ones = F.lit(sum(1 << at for at in range(0, BITS, lane))).cast("long")
    planes = F.sequence(F.lit(0), F.lit(lane - 1))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def bits(h: Column, b: Column) -> Column:
        return F.call_function("shiftrightunsigned", h, b).bitwiseAND(ones)

    def majority(counts: Column, n: Column) -> Column:
        def placed(count: Column, b: Column) -> Column:
            lanes = [(at, F.call_function("shiftrightunsigned", count, F.lit(at)).bitwiseAND(F.lit((1 << lane) - 1))) for at in range(0, BITS, lane)]
            return reduce(Column.bitwiseOR, (F.when(2 * own > n, F.call_function("shiftleft", F.lit(1).cast("long"), b + at)).otherwise(zero) for at, own in lanes))

        return F.aggregate(F.transform(counts, placed), zero, lambda acc, x: acc.bitwiseOR(x))

    def rolled(pair: Column) -> Column:
        h, n = pair["h"], pair["n"]
        first = F.transform(planes, lambda b: F.aggregate(F.slice(h, F.lit(1), n), zero, lambda acc, x: acc + bits(x, b)))
        start = F.struct(first.alias("counts"), F.array(majority(first, n)).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            gone, come = F.element_at(h, i), F.element_at(h, i + n)
            counts = F.transform(acc["counts"], lambda c, b: c + bits(come, b) - bits(gone, b))
            return F.struct(counts.alias("counts"), F.array_append(acc["out"], majority(counts, n)).alias("out"))

        further = F.when(F.size(h) > n, F.sequence(F.lit(1), F.greatest(F.size(h) - n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.when((n > 0) & (F.size(h) >= n), F.aggregate(further, start, step, lambda acc: acc["out"])).otherwise(none)

    return _once(F.struct(hashes.alias("h"), length.alias("n")), rolled)


def _blocks(fp: Column) -> list[Column]:
    return [F.call_function("shiftrightunsigned", fp, F.lit(at)).bitwiseAND(F.lit((1 << BLOCK) - 1)).cast("int") for at in range(0, BITS, BLOCK)]


def _listed(items: DataFrame, radius: int) -> DataFrame:
    """(size, block, value, item_no, item_fp): each item under every value near each of its blocks; one row where all are near."""
    near = radius // (BITS // BLOCK)
    if near >= BLOCK:
        return items.select("size", F.lit(0).alias("block"), F.lit(0).alias("value"), "item_no", "item_fp")
    flips = F.lit([sum(1 << b for b in bits) for n in range(near + 1) for bits in combinations(range(BLOCK), n)])
    own = items.select("size", "item_no", "item_fp", F.posexplode(F.array(*_blocks(F.col("item_fp")))).alias("block", "own"))
    return own.select("size", "block", F.explode(F.transform(flips, lambda x: F.col("own").bitwiseXOR(x))).alias("value"), "item_no", "item_fp")


def _probed(windows: DataFrame, radius: int) -> DataFrame:
    """windows with (block, value): what _listed() is looked up by."""
    if radius // (BITS // BLOCK) >= BLOCK:
        return windows.withColumns({"block": F.lit(0), "value": F.lit(0)})
    return windows.select("*", F.posexplode(F.array(*_blocks(F.col("fp")))).alias("block", "value"))


def _within(radius: int) -> Column:
    """Whether fp and item_fp are within the radius; true for one block only of those by which a pair is found."""
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    near = radius // (BITS // BLOCK)
    if near >= BLOCK:
        return F.bit_count(apart) <= radius
    first = F.lit(len(_blocks(apart)))
    for i, block in reversed(list(enumerate(_blocks(apart)))):
        first = F.when(F.bit_count(block) <= near, i).otherwise(first)
    return (F.bit_count(apart) <= radius) & (F.col("block") == first)


def shingles(own: str | Column) -> Column:
    """The five-word shingles of an array of words, repeats included; fewer words are one shingle."""
    own = F.col(own) if isinstance(own, str) else own
    k = F.least(F.size(own), F.lit(SHINGLE))
    return F.transform(F.sequence(F.lit(1), F.size(own) - k + 1), lambda i: F.array_join(F.slice(own, i, k), " "))


def similarity(a: str, b: str) -> Column:
    """The weighted Jaccard similarity of the shingles of two columns of words, of at least one word each."""

    def compared(p: Column) -> Column:
        def marked(x: Column) -> Column:
            # what repeats is numbered, so that the elements in common are those of multisets
            return F.transform(F.array_sort(x), lambda s, i: F.concat(s, F.lit("\n"), (i - F.array_position(F.array_sort(x), s)).cast("string")))

        plain = (F.size(F.array_distinct(p["a"])) == F.size(p["a"])) | (F.size(F.array_distinct(p["b"])) == F.size(p["b"]))
        # if one side has no repeats, no shingle is in common twice
        both = F.when(plain, F.size(F.array_intersect(p["a"], p["b"]))).otherwise(F.size(F.array_intersect(marked(p["a"]), marked(p["b"]))))
        return F.array(both / (F.size(p["a"]) + F.size(p["b"]) - both))

    return F.get(_once(F.struct(shingles(a).alias("a"), shingles(b).alias("b")), compared), F.lit(0))


def _least(threshold: float, total: Column) -> Column:
    """How many shingles are in common, at least, if `total` on both sides together have this similarity."""
    return F.ceil(threshold / (1 + threshold) * total - 1e-9).cast("int")


def _candidates(hits: DataFrame, k: int, threshold: float) -> DataFrame:
    """(doc_id, text_key, spans): runs of first words of the windows with enough shingles of items of their size.

    hits: (doc_id, text_key, n, size, places). A window's first such shingle belongs to one run only, and a run is no
    longer than the shingles that a window may lack, so its words are few more than the item's.
    """
    p, m = F.col("places"), F.col("size") - (k - 1)
    need = F.greatest(_least(threshold, 2 * m), F.lit(1))
    short_need = F.greatest(_least(threshold, m + F.col("n") - (k - 1)), F.lit(1))

    def run(j: Column) -> Column:
        before = F.when(j > 0, F.get(p, j - 1) + 1).otherwise(0)
        first = F.greatest(before, F.get(p, j + need - 1) - m + 1, F.lit(0))
        return F.struct(F.col("size"), first.cast("int").alias("first"), F.least(F.get(p, j), F.col("n") - F.col("size")).cast("int").alias("last"))

    none = F.array().cast("array<struct<size:int,first:int,last:int>>")
    runs = F.when(F.size(p) >= need, F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(p) - need, F.lit(0))), run), lambda s: s["first"] <= s["last"])).otherwise(none)
    whole = F.when(F.size(p) >= short_need, F.array(F.struct(F.col("size"), F.lit(0).alias("first"), F.lit(0).alias("last")))).otherwise(none)
    spans = hits.select("doc_id", "text_key", F.when(F.col("n") >= F.col("size"), runs).otherwise(whole).alias("spans")).where(F.size("spans") > 0)
    return spans


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.8, radius: int = 23, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = 1_000_000, broadcast_bytes: int = 1 << 26,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each item that a document holds, at its best window.

    Of windows equally similar, the first counts. first_word is the window's place in the document, from 0.
    """
    items = benchmark.select(named(item_col).alias("item_id"), words(named(item_text_col)).alias("item_words")).where((F.size("item_words") > 0) & F.col("item_id").isNotNull()).distinct()
    items = items.withColumns({"size": F.size("item_words"), "k": F.least(F.size("item_words"), F.lit(SHINGLE)), "item_no": F.xxhash64("item_id", "item_words")})
    texts = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text")).where("doc_id is not null and text is not null")
    # a repeated id's texts stay apart until the end, so that their places don't mix
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    own = texts.select("doc_id", "text_key", words(F.col("text")).alias("words"))
    own = own.select("doc_id", "text_key", F.size("words").alias("n"), _word_hashes("words").alias("hashes"))

    per_k = items.groupBy("k").agg(F.sum(F.col("size") - F.col("k") + 1).alias("n"), F.count(F.lit(1)).alias("items"), F.max("size").alias("longest"), F.sum(F.aggregate("item_words", F.lit(0).cast("long"), lambda acc, w: acc + F.octet_length(w) + 16)).alias("bytes")).collect()  # five rows at most
    schema = "doc_id long, item_id {}, similarity double, first_word int, n_words int".format(dict(benchmark.dtypes)[item_col])
    if not per_k:
        return docs.sparkSession.createDataFrame([], schema)

    def bounded(df: DataFrame, fits: bool) -> DataFrame:
        return F.broadcast(df) if fits else df

    spans = []
    for r in per_k:
        k = r["k"]
        hashed = items.where(F.col("k") == k).select("size", _word_hashes("item_words").alias("hashes"))
        targets = _shingle_rows(hashed, ["size"], "hashes", k).select("size", "shingle").distinct()
        met = _shingle_rows(own, ["doc_id", "text_key", "n"], "hashes", k).join(bounded(targets, r["n"] <= broadcast_rows), "shingle")
        hits = met.groupBy("doc_id", "text_key", "n", "size").agg(F.sort_array(F.collect_set("pos")).alias("places"))
        spans.append(_candidates(hits, k, threshold))
    # read twice below, and of the texts with windows only
    by_text = cut(reduce(DataFrame.unionByName, spans).groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    ids = by_text.select("doc_id").distinct()
    few = by_text.count() <= broadcast_rows
    held = texts.join(F.broadcast(ids), "doc_id", "left_semi") if few else texts
    held = held.dropDuplicates(["doc_id", "text_key"]).join(by_text, ["doc_id", "text_key"])
    cut_out = _once(words(F.col("text")), lambda w: F.transform("spans", lambda s: F.struct(s["size"].alias("size"), s["first"].alias("first"), F.slice(w, s["first"] + 1, s["last"] - s["first"] + s["size"]).alias("words"))))
    parts = held.select("doc_id", F.explode(cut_out).alias("s")).select("doc_id", "s.size", "s.first", "s.words")

    found = []
    for r in per_k:
        k, lane = r["k"], 16 if r["longest"] < 1 << 15 else 32
        known = items.where(F.col("k") == k)
        known = known.withColumn("item_fp", F.get(window_fingerprints(shingle_hashes("item_words", k), F.col("size") - (k - 1), lane), F.lit(0)))
        n_listed = r["items"] * (_variants(radius) if radius // (BITS // BLOCK) < BLOCK else 1)
        length = F.least(F.col("size"), F.size("words"))
        part = parts.where(F.least("size", F.lit(SHINGLE)) == k).withColumn("length", length)
        rolled = part.withColumn("fps", window_fingerprints(shingle_hashes("words", k), F.col("length") - (k - 1), lane))
        one = F.transform("fps", lambda fp, i: F.struct((F.col("first") + i).alias("first"), fp.alias("fp"), F.slice("words", i + 1, F.col("length")).alias("window")))
        windows = rolled.select("doc_id", "size", F.explode(one).alias("w")).select("doc_id", "size", "w.first", "w.fp", "w.window")
        near = _probed(windows, radius).join(bounded(_listed(known, radius), n_listed <= broadcast_rows), ["size", "block", "value"]).where(_within(radius))
        pairs = near.select("doc_id", "first", "window", "item_no").join(bounded(known.select("item_no", "item_id", "item_words"), r["bytes"] <= broadcast_bytes), "item_no")
        found.append(pairs.select("doc_id", "item_id", similarity("window", "item_words").alias("similarity"), F.col("first").alias("first_word"), F.size("window").alias("n_words")))
    scored = reduce(DataFrame.unionByName, found).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("similarity", "first_word", "n_words"), F.struct("similarity", -F.col("first_word"), "n_words")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.similarity", "best.first_word", "best.n_words")


def _variants(radius: int) -> int:
    return (BITS // BLOCK) * sum(1 for n in range(radius // (BITS // BLOCK) + 1) for _ in combinations(range(BLOCK), n))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """docs without the documents that hold an item; rows with a null id stay."""
    gone = contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_tidemark_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_tidemark_gone"], "left_anti")


#: DuckDB: all windows of every document that has enough of an item's shingles anywhere, by the definition alone.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), i AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS iw FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), ik AS (SELECT item_id, iw, len(iw) AS size, least(len(iw), 5) AS k FROM i WHERE len(iw) > 0),
ish AS (
  SELECT item_id, size, k, array_to_string(iw[p + 1 : p + k], ' ') AS s, count(*) AS b
  FROM (SELECT *, unnest(range(0, size - k + 1)) AS p FROM ik) GROUP BY ALL
), dk AS (SELECT doc_id, len(ws) AS n, ws, k FROM d, (SELECT DISTINCT k FROM ik) WHERE len(ws) >= k),
dsh AS (
  SELECT doc_id, n, k, p, array_to_string(ws[p + 1 : p + k], ' ') AS s FROM (SELECT *, unnest(range(0, n - k + 1)) AS p FROM dk)
), pair AS (
  -- a window that passes has as many places of the item's shingles, at least
  SELECT dsh.doc_id, dsh.n, ish.item_id, ish.size, ish.k FROM dsh JOIN ish ON dsh.s = ish.s AND dsh.k = ish.k
  GROUP BY ALL HAVING count(*) >= 0.8 / 1.8 * (ish.size - ish.k + 1 + least(dsh.n, ish.size) - ish.k + 1) - 1e-6
), w AS (SELECT *, least(n, size) AS length, unnest(range(0, greatest(n - size, 0) + 1)) AS first FROM pair),
a AS (
  SELECT w.doc_id, w.item_id, w.size, w.k, w.first, w.length, dsh.s, count(*) AS a
  FROM w JOIN dsh ON dsh.doc_id = w.doc_id AND dsh.k = w.k AND dsh.p >= w.first AND dsh.p <= w.first + w.length - w.k GROUP BY ALL
), c AS (
  SELECT a.doc_id, a.item_id, a.size, a.k, a.first, a.length, sum(least(a.a, ish.b)) AS common FROM a JOIN ish ON ish.item_id = a.item_id AND ish.s = a.s AND ish.size = a.size GROUP BY ALL
), f AS (
  SELECT doc_id, item_id, first, length, common / (size - k + 1 + length - k + 1 - common) AS similarity FROM c
), g AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first, length DESC) AS rn FROM f WHERE similarity >= 0.8
)
SELECT doc_id, item_id, round(similarity, 9) AS similarity, CAST(first AS INTEGER) AS first_word, CAST(length AS INTEGER) AS n_words FROM g WHERE rn = 1
"""
