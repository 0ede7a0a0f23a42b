"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: each bit is the majority of that bit over the XXH64 hashes of a text's word shingles. Distinct
fingerprints are linked at `radius` or fewer differing bits, and links are closed to components.

The search splits the 64 bits into partitions, correlated bits together, and gives each partition its own
threshold t_i >= -1 with sum(t_i) = radius - partitions + 1: any two fingerprints within the radius then differ in
t_i or fewer bits of some partition i. A dynamic program picks the thresholds that cost least by the estimated
number of candidates; partitions with threshold -1 aren't probed at all. Every fingerprint is indexed by its value
in a partition and probes all values within t_i. Candidates are compared in full.

Equal fingerprints are one entry, so a group of exact copies of any size is one row. A bucket of more than
`tile` members is dealt out as pairs of chunks of `tile` members at most, so no task holds an unbounded bucket,
and a task reports the links that span its groups instead of all pairs. Components are found by alternating
large-star and small-star steps on tables in the shared folder.

Defined results: a null or blank text has fingerprint 0 and is linked like any other; a null doc_id has a
fingerprint but takes no part in links, and its component is null; rows that repeat a doc_id are one document for
links; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, partitions, texts, written
from .substring_dedup import _counted, _gathered, _parted, _split, _unzip

BITS = 64
#: A row that is shuffled and sorted takes about as long as so many comparisons of two fingerprints.
ROW_COST = 100.0


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): the SimHash of each whole text, A-Z lower-cased, over shingles of `shingle` words."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest
        weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))

        def majority(data: bytes) -> int:
            words = data.lower().split()  # bytes: A-Z only, and cut at \x20 and \x09-\x0D only
            if not words:
                return 0
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
            ends, k = (ends - 1).tolist(), min(shingle, len(words))
            n, ones = len(words) - k + 1, np.zeros(64, np.int64)
            for at in range(0, n, 100_000):
                upto = min(n, at + 100_000)
                h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[at:upto], ends[at + k - 1 : upto + k - 1])), np.uint64, upto - at)
                ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
            return int(weights[2 * ones > n].sum())

        for batch in batches:
            fp = np.array([majority((t or "").encode()) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, fp long")


@dataclass(frozen=True)
class Plan:
    """The bits of each partition and its threshold; -1: not probed."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def bit_statistics(distinct: DataFrame):
    """(n, 64 x 64 counts of bits that are set together) over all distinct fingerprints; a constant size."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both, n = both + bits.T @ bits, n + len(fp)
        yield pa.RecordBatch.from_arrays([pa.array(range(4097), pa.int32()), pa.array([float(n), *both.ravel()])], ["cell", "count"])

    rows = map_batches(distinct.select("fp"), run, "cell int, count double").groupBy("cell").agg(F.sum("count").alias("count")).collect()
    cells = np.zeros(4097)
    for r in rows:
        cells[r["cell"]] = r["count"]
    return int(cells[0]), cells[1:].reshape(64, 64)


def allocate(n: int, both, radius: int, max_variants: int = 600, rows_factor: float = 1, pairs_factor: float = 1) -> Plan:
    """Groups correlated bits and allocates thresholds by dynamic programming on estimated candidate counts.

    For each number of partitions: bits join the partition with which they correlate most. The pairs that agree
    in all but t bits of a partition are estimated from the bits' frequencies. Cost: rows probed, each as much as
    ROW_COST pairs compared, plus pairs. The factors are for keys that also hold something else.
    """
    import numpy as np

    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    best = None
    for m in range(1, radius + 2):
        left, parts = set(range(BITS)), []
        for i in range(m):
            width = BITS // m + (i < BITS % m)
            own = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
            left.discard(own[0])
            while len(own) < width:
                own.append(max(sorted(left), key=lambda b: corr[b, own].mean()))
                left.discard(own[-1])
            parts.append(tuple(sorted(own)))
        cost = []
        for part in parts:
            differ = np.array([1.0])
            for b in part:
                differ = np.convolve(differ, [p[b] ** 2 + (1 - p[b]) ** 2, 2 * p[b] * (1 - p[b])])
            within, row = np.cumsum(differ), {-1: 0.0}
            for t in range(radius + 1):
                variants = sum(comb(len(part), k) for k in range(t + 1))
                row[t] = n * variants * ROW_COST * rows_factor + float(n) * n * within[min(t, len(part))] * pairs_factor if variants <= max_variants else float("inf")
            cost.append(row)
        reach = {0: (0.0, ())}  # thresholds + 1 used so far -> cost, thresholds
        for row in cost:
            reach = {
                used: min((c + row[t], (*ts, t)) for u, (c, ts) in reach.items() for t in row if u + t + 1 == used)
                for used in {u + t + 1 for u in reach for t in row if u + t + 1 <= radius + 1}
            }
        if (found := reach.get(radius + 1)) and found[0] < float("inf") and (best is None or found[0] < best[0]):
            best = (found[0], parts, found[1])
    if best is None:
        raise ValueError(f"no allocation for radius {radius} within {max_variants} variants")
    return Plan(tuple(best[1]), tuple(best[2]))


def probes(distinct: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, probe, fp, id): each entry under its own value and, as a probe, under all values within t_i."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (part, t) in enumerate(zip(plan.parts, plan.thresholds)):
                if t < 0:
                    continue
                mask = np.uint64(sum(1 << b for b in part))
                for k in range(t + 1):
                    for flips in combinations(part, k):
                        key = (fp & mask) ^ np.uint64(sum(1 << b for b in flips))
                        key = (key + np.uint64(i + 1)) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(fp), k > 0)), batch.column(0), batch.column(1)], ["bucket", "probe", "fp", "id"])

    return map_batches(distinct.select("fp", "id"), run, "bucket long, probe boolean, fp long, id long")


def _links(radius: int, chunk: int = 2_000_000):
    """From rows sorted by bucket and tile, entries before probes: (a, b) links that span the groups found."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def merged(label, a, b):
            while True:
                la, lb = label[a], label[b]
                if (la == lb).all():
                    return label
                low = np.minimum(la, lb)
                np.minimum.at(label, la, low)
                np.minimum.at(label, lb, low)
                while (label != label[label]).any():
                    label = label[label]

        def spanning(bucket, tile, probe, fp, ids):
            n = len(bucket)
            new = np.ones(n, bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])
            first = np.flatnonzero(new)
            end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
            unique, node = np.unique(ids, return_inverse=True)
            label = np.arange(len(unique))
            own = np.flatnonzero(~probe & (end - np.arange(n) > 1))
            todo = end[own] - own - 1
            upto = np.cumsum(todo)
            at = 0
            while at < len(own):
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + chunk, side="right")))
                left = np.repeat(own[at:stop], todo[at:stop])
                base = upto[at:stop] - todo[at:stop]
                right = left + 1 + np.arange(len(left)) + (upto[at - 1] if at else 0) - np.repeat(base, todo[at:stop])
                near = np.bitwise_count(fp[left] ^ fp[right]) <= radius
                label = merged(label, node[left[near]], node[right[near]])
                at = stop
            far = np.flatnonzero(label != np.arange(len(label)))
            return unique[far], unique[label[far]]

        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols[3] = cols[3].view(np.uint64)
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            whole = int(np.argmax(last))  # rows before the last bucket, which may go on
            if whole:
                a, b = spanning(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if held is not None and len(held[0]):
            a, b = spanning(*held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _tiled(rows: DataFrame, keep: list[str], tile: int, weight: Column | None = None) -> DataFrame:
    """(bucket, tile, probe, *keep): buckets of more than `tile` rows, or a weight above it, as all pairs of chunks of that size."""
    heavy = F.count(F.lit(1)) if weight is None else F.greatest(F.count(F.lit(1)), F.ceil(F.sum(weight)))
    large = rows.groupBy("bucket").agg(heavy.alias("n_rows")).where(F.col("n_rows") > tile).select("bucket", F.ceil(F.col("n_rows") / tile).cast("int").alias("chunks"))
    split = rows.join(large, "bucket", "left").withColumn("own", F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1))).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1), lambda c: F.least(c, F.col("own")) * 1_000_000 + F.greatest(c, F.col("own")))
    tiles = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(others.cast("array<long>"))
    return split.select("bucket", F.explode(tiles).alias("tile"), "probe", *keep)


def links(distinct: DataFrame, radius: int = 3, *, tile: int = 4096) -> DataFrame:
    """(a, b): links between ids of distinct fingerprints whose closure is that of all pairs within the radius."""
    n, both = bit_statistics(distinct)
    rows = probes(distinct, allocate(n, both, radius))
    tiled = _tiled(rows, ["fp", "id"], tile)
    dealt = tiled.repartition(partitions(distinct.sparkSession), "bucket", "tile").sortWithinPartitions("bucket", "tile", "probe")
    return map_batches(dealt, _links(radius), "a long, b long").distinct()


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(id, component): the smallest id that each linked id reaches, by large-star and small-star steps."""

    def star(e: DataFrame, small: bool) -> DataFrame:
        ends = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if not small:
            ends = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ends.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        met = ends.join(low, "u")
        moved = met.where(F.col("v") != F.col("low")) if small else met.where(F.col("v") > F.col("u"))
        moved = moved.select(F.col("v").alias("a"), F.col("low").alias("b"))
        if small:
            moved = moved.unionByName(low.where("u != low").select(F.col("u").alias("a"), F.col("low").alias("b")))
        return moved.where("a != b").distinct()

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()

    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    for _ in range(max_steps):
        if not before[0]:
            break
        edges = cut(star(star(edges, small=False), small=True))
        if (now := state(edges)) == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not closed after {max_steps} steps")
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))


def near_duplicates(docs: DataFrame, *, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of each row; component_id is the smallest doc_id reachable by links."""
    own = written(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col), "simhash")
    distinct = cut(own.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")))
    closed = components(links(distinct, radius))
    by_fp = distinct.join(closed, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return own.join(by_fp, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def hexadecimal(fp: str = "fp"):
    """The 16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def without_near_duplicates(docs: DataFrame, *, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, that of the smallest id; rows with a null id stay."""
    grouped = near_duplicates(docs, radius=radius, id_col=id_col, text_col=text_col)
    gone = grouped.where("doc_id != component_id").select(F.col("doc_id").alias("_tidemark_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_tidemark_gone"], "left_anti")


# Near copies by similarity: the same search over another fingerprint, then exact verification.

SKETCH_BITS = 128
EDGE = b".,;:!?\"'()[]"


def sketches(docs: DataFrame, *, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, s1, s2, n, m) of each text, A-Z lower-cased.

    fp: SimHash over its distinct words, edge punctuation off, which few edits move little. s1, s2: a 128-bit SimHash
    over its n distinct shingles of `shingle` words (fewer words: one shingle), by which candidates are ranked. m: how
    many values the first 32 bits of their hashes have.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        def majority(h, bits: int):
            if not len(h):
                return np.zeros(bits // 64, np.uint64)
            ones = np.zeros(bits, np.int64)
            for at in range(0, len(h), 50_000):
                ones += np.unpackbits(h[at : at + 50_000].view(np.uint8).reshape(-1, bits // 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
            return np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)

        for batch in batches:
            out = np.zeros((batch.num_rows, 3), np.uint64)
            sizes = []
            for row, text in zip(out, batch.column(1).to_pylist()):
                words = (text or "").encode().lower().split()
                parts = {b" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))} if words else set()
                bare = {w.strip(EDGE) or w for w in words}
                row[0] = majority(np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in bare), np.uint64, len(bare)), 64)[0]
                h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<u8").reshape(-1, 2)
                row[1:] = majority(h, SKETCH_BITS)
                sizes.append((len(np.unique(h[:, 0])), len(np.unique(h[:, 0].astype(np.uint32)))))
            n, m = zip(*sizes) if sizes else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(out[:, i]).view(np.int64)) for i in range(3)), pa.array(n, pa.int32()), pa.array(m, pa.int32())], ["doc_id", "fp", "s1", "s2", "n", "m"])

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, fp long, s1 long, s2 long, n int, m int")


def _classed_probes(entries: DataFrame, plan: Plan, similarity: float) -> DataFrame:
    """(bucket, probe, fp, s1, s2, n, id): buckets are of a partition's value and a class of sizes.

    Sets of a similarity have sizes within that ratio, hence in one class or two adjacent ones: an entry is in its own
    class and probes that and the one below.
    """
    import math

    step = math.log(1 / similarity) * (1 + 1e-9)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fp, n = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(3).to_numpy(zero_copy_only=False)
            size = np.floor(np.log(np.maximum(n, 1)) / step).astype(np.int64).astype(np.uint64)
            for i, (part, t) in enumerate(zip(plan.parts, plan.thresholds)):
                if t < 0:
                    continue
                mask = np.uint64(sum(1 << b for b in part))
                for k in range(t + 1):
                    for flips in combinations(part, k):
                        value = (fp & mask) ^ np.uint64(sum(1 << b for b in flips))
                        for below in (0, 1):
                            key = (value + np.uint64(i + 1)) * np.uint64(0x9E3779B97F4A7C15)
                            key = (key ^ (key >> np.uint64(29))) + (size - np.uint64(below)) * np.uint64(0xD1342543DE82EF95)
                            key ^= key >> np.uint64(32)
                            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(fp), k > 0 or below > 0)), *(batch.column(c) for c in range(5))], ["bucket", "probe", "fp", "s1", "s2", "n", "id"])

    return map_batches(entries.select("fp", "s1", "s2", "n", "id"), run, "bucket long, probe boolean, fp long, s1 long, s2 long, n int, id long")


def forest(n: int, a, b, weight):
    """Indexes of a spanning forest of least weight of the edges (a, b) between n nodes; weights are small integers."""
    import numpy as np

    label, taken = np.arange(n), []
    order = np.argsort(weight, kind="stable")
    level = np.append(np.flatnonzero(np.append(True, np.diff(weight[order]) > 0)), len(order)) if len(order) else [0]
    for x, y in zip(level, level[1:]):
        left = order[x:y]
        while True:
            la, lb = label[a[left]], label[b[left]]
            cross = la != lb
            left, la, lb = left[cross], la[cross], lb[cross]
            if not len(left):
                break
            high, first = np.unique(np.maximum(la, lb), return_index=True)  # one edge for each tree that joins a lower one
            taken.append(left[first])
            root = np.arange(n)
            root[high] = np.minimum(la, lb)[first]
            while (root != root[root]).any():
                root = root[root]
            label = root[label]
    return np.concatenate(taken) if taken else np.zeros(0, np.int64)


def _candidates(radius: int, similarity: float, forests: int, chunk: int = 2_000_000):
    """From rows sorted by bucket and tile, entries before probes: the likeliest pairs that span each bucket's groups.

    A spanning forest of least sketch distance connects what all pairs connect at every distance. Several disjoint
    ones are reported, as the sketch only estimates: a pair that verification rejects has others beside it.
    """

    def run(batches: Iterator) -> Iterator:
        import math

        import numpy as np
        import pyarrow as pa

        # equal-sized sets of this similarity differ in a share of bits that is the angle between them
        share = math.acos(2 * similarity / (1 + similarity)) / math.pi
        far = SKETCH_BITS * share + 4 * math.sqrt(SKETCH_BITS * share * (1 - share))

        def likely(bucket, tile, probe, fp, s1, s2, n, ids):
            rows = len(bucket)
            new = np.ones(rows, bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])
            first = np.flatnonzero(new)
            end = np.repeat(np.append(first[1:], rows), np.diff(np.append(first, rows)))
            own = np.flatnonzero(~probe & (end - np.arange(rows) > 1))
            todo = end[own] - own - 1
            upto, at, found = np.cumsum(todo), 0, []
            while at < len(own):
                done = upto[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(upto, done + chunk, side="right")))
                left = np.repeat(own[at:stop], todo[at:stop])
                right = left + 1 + np.arange(len(left)) + done - np.repeat(upto[at:stop] - todo[at:stop], todo[at:stop])
                near = np.bitwise_count(fp[left] ^ fp[right]) <= radius
                left, right = left[near], right[near]
                apart = np.bitwise_count(s1[left] ^ s1[right]).astype(np.int64) + np.bitwise_count(s2[left] ^ s2[right])
                low, high = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
                near = (apart <= far) & (low >= similarity * high) & (ids[left] != ids[right])
                found.append((left[near], right[near], apart[near]))
                at = stop
            if not found:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            left, right, apart = (np.concatenate(x) for x in zip(*found))
            unique, node = np.unique(ids, return_inverse=True)
            a, b = node[left], node[right]
            pair, index = np.unique(np.minimum(a, b) * len(unique) + np.maximum(a, b), return_index=True)
            a, b, apart, out = a[index], b[index], apart[index], []
            for _ in range(forests):
                if not len(a):
                    break
                chosen = forest(len(unique), a, b, apart)
                out.append((a[chosen], b[chosen]))
                rest = np.ones(len(a), bool)
                rest[chosen] = False
                a, b, apart = a[rest], b[rest], apart[rest]
            if not out:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            a, b = (np.concatenate(x) for x in zip(*out))
            return np.minimum(unique[a], unique[b]), np.maximum(unique[a], unique[b])

        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            cols[3:6] = [c.view(np.uint64) for c in cols[3:6]]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            whole = int(np.argmax(last))
            if whole:
                a, b = likely(*(x[:whole] for x in held))
                held = [x[whole:] for x in held]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if held is not None and len(held[0]):
            a, b = likely(*held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _keys(data: bytes, shingle: int):
    """The hashes of a text's distinct shingles, in order; the first half of those of sketches()."""
    import numpy as np
    import xxhash

    words = data.lower().split()
    parts = (b" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))) if words else ()
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<u8")[::2])


def _shingle_sets(shingle: int):
    """(id, keys): the sorted hashes of a text's distinct shingles."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = [_keys((text or "").encode(), shingle).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "keys"])

    return run


def _verified(similarity: float):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets_of(ids: DataFrame, known: DataFrame, shingle: int) -> DataFrame:
    """(id, keys) of the ids; of rows that repeat an id, always the same text counts."""
    held = known.join(ids, known["doc_id"] == ids["id"], "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return written(map_batches(held, _shingle_sets(shingle), "id long, keys binary"), "shingle-sets")


def _verified_pairs(pairs: DataFrame, known: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The pairs (a, b) of ids whose texts have this similarity or more, each compared exactly."""
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), known, shingle)
    met = pairs.join(sets.select(F.col("id").alias("a"), F.col("keys").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("keys").alias("y")), "b").select("a", "b", "x", "y")
    return map_batches(met, _verified(similarity), "a long, b long")


def _frequent(known: DataFrame, shingle: int, sample: int = 10_000, limit: int = 100_000):
    """32-bit hashes of shingles that occur repeatedly in about `sample` texts, the rarest first; they are only put last in order."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keys = [np.unique(_keys((text or "").encode(), shingle).astype(np.uint32)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*keys, np.zeros(0, np.uint32)]).view(np.int32))], ["key"])

    share = int(min(1.0, sample / max(known.count(), 1)) * (1 << 30))
    some = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) <= share)
    rows = map_batches(some, run, "key int").groupBy("key").count().where("count > 1").orderBy(F.desc("count"), "key").limit(limit).collect()
    return np.array([r["key"] for r in reversed(rows)], np.int32).view(np.uint32)


SENT = "home int, single boolean, doc_ids binary, sizes binary, keys binary"
TOLD = "part int, doc_ids binary, sizes binary, keys binary"


def _sent(shingle: int, n_homes: int, size: int = 6_000_000):
    """From texts: for each home of hashes, those of a batch. A hash that several texts of the batch have goes to its
    home once, as not single, and each of these texts is told at once that it is shared: home -1."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for rows in _gathered(batches, size):
            sets = [np.unique(_keys(data, shingle).astype(np.uint32)) for _, data in rows]
            ids, key = np.array([i for i, _ in rows], np.int64), np.concatenate(sets)
            doc = np.repeat(ids, list(map(len, sets)))
            if not len(key):
                continue
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            edge = _split(key)
            times = np.diff(edge)
            alone, first, out = np.repeat(times == 1, times), edge[:-1], []

            def packed(single: bool, k, d):
                home = (k.astype(np.uint64) * np.uint64(n_homes)) >> np.uint64(32)
                order = np.lexsort((k, d, home))
                k, d, home = k[order], d[order], home[order]
                cut = _split(home)
                for a, b in zip(cut, cut[1:]):
                    out.append((int(home[a]), single, *_counted(d[a:b]), k[a:b].astype("<u4").tobytes()))

            packed(True, key[alone], doc[alone])
            packed(False, key[first][times > 1], doc[first][times > 1])
            for _, places in _parted(doc[~alone], n_homes):
                out.append((-1, False, *_counted(doc[~alone][places]), key[~alone][places].astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["home", "single", "doc_ids", "sizes", "keys"])

    return run


def _told(n_parts: int):
    """From rows sorted by home: which of the hashes that are single in their batch are shared after all, by document."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names, kinds = ["part", "doc_ids", "sizes", "keys"], (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        at, held, out = None, [], []

        def decided():
            key, doc, single = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key, kind="stable")
            key, doc, single = key[order], doc[order], single[order]
            times = np.diff(_split(key))
            tell = single & np.repeat(times > 1, times)
            for part, places in _parted(doc[tell], n_parts):
                out.append((part, *_counted(doc[tell][places]), key[tell][places].astype("<u4").tobytes()))

        for batch in batches:
            for home, single, ids, sizes, keys in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if home < 0:
                    out.append((int(_unzip(ids)[0] % n_parts), ids, sizes, keys))
                    continue
                if home != at and held:
                    decided()
                    held.clear()
                at = home
                doc = np.repeat(_unzip(ids), _unzip(sizes))
                held.append((np.frombuffer(keys, "<u4"), doc, np.full(len(doc), single)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out.clear()
        if held:
            decided()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def _shared_keys(batches: Iterator) -> Iterator:
    """From rows sorted by part: (id, shared), the hashes of each document that another one has."""
    import numpy as np
    import pyarrow as pa

    def rows(held):
        doc, key = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(doc, kind="stable")
        doc, key = doc[order], key[order]
        edge = _split(doc)
        for i in range(0, len(edge) - 1, 5000):
            own = edge[i : i + 5001]
            yield pa.RecordBatch.from_arrays([pa.array(doc[own[:-1]], pa.int64()), pa.array([key[a:b].tobytes() for a, b in zip(own, own[1:])], pa.binary())], ["id", "shared"])

    at, held = None, []
    for batch in batches:
        for part, ids, sizes, keys in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if part != at and held:
                yield from rows(held)
                held = []
            at = part
            held.append((np.repeat(_unzip(ids), _unzip(sizes)), np.frombuffer(keys, "<u4")))
    if held:
        yield from rows(held)


def _postings(similarity: float, frequent):
    """(bucket, id, component, n): a row for each shared hash among the first of a document in one order of all hashes.

    Sets of this similarity share so much that they share one of their first n - ceil(similarity * n) + 1 elements in
    any order. In this one, hashes that no other document has come first, and frequent ones last. Hashes are cut to
    32 bits here; n counts whole ones, so what the cut takes together is no loss.
    """
    import numpy as np

    by_key = np.argsort(frequent)
    keys_sorted = frequent[by_key]

    def run(batches: Iterator) -> Iterator:
        import math

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out, times = [], []
            for raw, n, m in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                own = np.unique(np.frombuffer(raw, "<u4"))
                first = n - math.ceil(similarity * n - 1e-9) + 1 - (m - len(own))
                rank = np.zeros(len(own), np.int64)
                if len(keys_sorted):
                    at = np.minimum(np.searchsorted(keys_sorted, own), len(keys_sorted) - 1)
                    rank = np.where(keys_sorted[at] == own, by_key[at] + 1, 0)
                # hashes are in order already, and a stable sort keeps that within a rank
                out.append(own[np.argsort(rank, kind="stable")[: max(first, 0)]])
                times.append(len(out[-1]))
            if sum(times):
                each = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False), times) for i in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int32)), *map(pa.array, each)], ["bucket", "id", "component", "n"])

    return run


def _crossing(similarity: float):
    """From rows sorted by bucket, tile and component: links between components, each pair of sets compared exactly.

    Only links that join what is still apart are reported, so a tile gives fewer rows than it has.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def linked(component, ids, raw):
            sets = [np.frombuffer(x, "<u8") for x in raw]
            n = np.array(list(map(len, sets)))
            _, keys = np.unique(np.concatenate(sets), return_inverse=True)
            begin, mark = np.append(0, np.cumsum(n)), np.zeros(keys.max() + 1 if len(keys) else 1, bool)
            _, label = np.unique(component, return_inverse=True)
            found = []
            for i in range(len(ids) - 1):
                # later rows of other components, of a size that allows it
                right = np.flatnonzero((label[i + 1 :] != label[i]) & (np.minimum(n[i + 1 :], n[i]) >= similarity * np.maximum(n[i + 1 :], n[i]))) + i + 1
                if not len(right) or not n[i]:
                    continue
                mark[keys[begin[i] : begin[i + 1]]] = True
                at = np.append(0, np.cumsum(n[right]))
                places = np.repeat(begin[right] - at[:-1], n[right]) + np.arange(at[-1])
                both = np.add.reduceat(mark[keys[places]].astype(np.int64), at[:-1])
                mark[keys[begin[i] : begin[i + 1]]] = False
                for j in right[both >= similarity * (n[i] + n[right] - both)]:
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
                        found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            return found

        at, held = None, []
        names = ["a", "b"]
        for batch in batches:
            out = []
            for bucket, tile, component, key, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (bucket, tile) != at and held:
                    out += linked(*zip(*held))
                    held = []
                at = bucket, tile
                held.append((component, key, raw))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), ()))], names)
        if held and (out := linked(*zip(*held))):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def _missed(known: DataFrame, info: DataFrame, similarity: float, shingle: int, tile: int) -> DataFrame:
    """(a, b): links between different components, by prefix filtering; info: (id, component, n, m)."""
    spark = known.sparkSession
    n_homes = min(partitions(spark), 1 << 20)
    dealt_by = F.when(F.col("home") >= 0, F.col("home").cast("long")).otherwise(F.xxhash64("doc_ids"))
    sent = map_batches(known.where("doc_id is not null"), _sent(shingle, n_homes), SENT).repartition(n_homes, dealt_by).sortWithinPartitions("home")
    told = map_batches(sent, _told(n_homes), TOLD).repartition(n_homes, "part").sortWithinPartitions("part")
    shared = map_batches(told, _shared_keys, "id long, shared binary")
    # what shares fewer than the similarity asks of it has no link
    enough = shared.join(info, "id").where(F.octet_length("shared") / 4 >= F.ceil(similarity * F.col("n") - 1e-9) - (F.col("n") - F.col("m")))
    postings = map_batches(enough.select("id", "component", "shared", "n", "m"), _postings(similarity, _frequent(known, shingle)), "bucket int, id long, component long, n int")
    postings = written(postings, "postings")
    # the documents of a bucket meet at its smallest id, once however many buckets they share: a set is sent there once
    apart = postings.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("hub")).where("low < high").select("bucket", "hub")
    met = cut(postings.join(apart, "bucket").groupBy(F.col("hub").alias("bucket"), "id", "component").agg(F.max("n").alias("n")))
    tiled = _tiled(met.withColumn("probe", F.lit(False)), ["component", "id"], tile, weight=F.col("n") / 1024).drop("probe")
    sets = _sets_of(met.select("id").distinct(), known, shingle)
    rows = tiled.join(sets, "id").select("bucket", "tile", "component", "id", "keys")
    dealt = rows.repartition(partitions(spark), "bucket", "tile").sortWithinPartitions("bucket", "tile", "component", "id")
    return map_batches(dealt, _crossing(similarity), "a long, b long").distinct()


def similar_groups(docs: DataFrame, *, similarity: float = 0.8, shingle: int = 5, radius: int = 9, forests: int = 2, tile: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id): groups of documents linked by a Jaccard similarity of `similarity` or more of their shingles.

    First come pairs of fingerprints over words within the radius, found as in links(), of which the likeliest are
    compared exactly: that closes large groups at little cost. Then prefix filtering finds what may link the groups so
    far, whatever the fingerprints: documents that share a shingle of their prefixes, which leaves out those whose
    prefixes nobody shares. Where such a bucket has several groups, their sets are compared exactly, so no link is lost.
    Sets are compared where they meet, and only links come back: never a row for each pair.
    A null doc_id has a null component; equal documents are one entry.
    """
    spark = docs.sparkSession
    known = texts(docs, id_col, text_col)
    own = written(sketches(known, shingle=shingle), "sketches")
    key = ["fp", "s1", "s2", "n", "m"]
    entries = cut(own.where("doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("id")))
    n, both = bit_statistics(entries)
    rows = _classed_probes(entries, allocate(n, both, radius, rows_factor=2, pairs_factor=0.2), similarity)
    tiled = _tiled(rows, ["fp", "s1", "s2", "n", "id"], tile)
    dealt = tiled.repartition(partitions(spark), "bucket", "tile").sortWithinPartitions("bucket", "tile", "probe")
    pairs = cut(map_batches(dealt, _candidates(radius, similarity, forests), "a long, b long").distinct())
    closed = cut(components(_verified_pairs(pairs, known, similarity, shingle)))
    info = entries.join(closed, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "n", "m")
    more = _missed(known, cut(info), similarity, shingle, tile)
    closed = components(more.unionByName(closed.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    named_entries = entries.join(closed, "id", "left").select(*key, F.coalesce("component", "id").alias("component_id"))
    return own.join(named_entries, key, "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def without_near_copies(docs: DataFrame, *, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one document of each group, that of the smallest id; rows with a null id stay."""
    grouped = similar_groups(docs, similarity=similarity, id_col=id_col, text_col=text_col, **options)
    gone = grouped.where("doc_id != component_id").select(F.col("doc_id").alias("_tidemark_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_tidemark_gone"], "left_anti")
