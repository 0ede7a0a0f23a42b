"""Exact repeats of word sequences by fixed-block anchors.

A window is `window` consecutive words of one document. Its words are removed if the same sequence also starts in
a document of a smaller id. With blocks of (window + 1) // 2 words, every window holds a whole block that starts at
a multiple of the block's length in the document that has it first. So:

1. Index the non-overlapping blocks of every document, and probe the index with every rolling block-sized window
   of every document. Hashes are dealt out by home; a batch of documents sends each home one packed row.
2. Blocks hit by another document anchor an extension to every window around them, on both sides. The owner of a
   window sequence is the smallest id that has it, and a run of windows owned by smaller ids is a maximal exact repeat.
3. Each document drops the words of its repeats.

What a batch can decide by itself, it doesn't send: a block or window that a smaller id of the same batch has needs no
other witness. So a passage that a third of all documents share is sent a few times per batch, not once per document,
and no pairs are made. A home keeps one entry per distinct block and reads the probes as a stream. The texts are
shuffled once, by id; both later steps read that one exchange.

Sequences are equal if all 128 bits of their hashes are: words by XXH3-128, sequences by mixing the two halves of
their words' hashes separately, so of 10**13 different windows fewer than one pair in 10**12 tries is taken for equal.
Both halves go with a window, so what is decided between batches is decided by the same 128 bits as within one.

Defined results: a null text has no words; rows with a null id own nothing and lose nothing; rows that repeat an id
are one document as owners, and each is judged alone; a document shorter than a window loses nothing; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, partitions, texts

#: What homes report: documents of a part of the ids, how many entries each has, and the entries.
HITS = "part int, home int, doc_ids binary, sizes binary, keys binary"
STARTS = "part int, doc_ids binary, sizes binary, starts binary"
#: Odd multipliers of the two halves of a sequence's hash.
FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _words(data):
    """(first byte, end) of every word in an array of bytes; words are cut at \x20 and \x09-\x0D."""
    import numpy as np

    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _mixed(acc):
    import numpy as np

    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        acc = (acc ^ (acc >> np.uint64(shift))) * np.uint64(by)
    return acc ^ (acc >> np.uint64(31))


def _rolling(h, k: int, which: int):
    """The hash of every k consecutive word hashes, from those of runs half as long; each step mixes all bits."""
    import numpy as np

    if len(h) < k:
        return np.zeros(0, np.uint64)

    def joined(left, n_left: int, right, n_right: int):
        n = len(h) - n_left - n_right + 1
        return _mixed(left[:n] * np.uint64(FACTORS[which]) + right[n_left : n_left + n])

    out, n_out, power, n_power = None, 0, h, 1
    while True:
        if k & n_power:
            out, n_out = (power, n_power) if out is None else (joined(out, n_out, power, n_power), n_out + n_power)
        if n_out == k:
            return _mixed(out) if k == n_power else out
        power, n_power = joined(power, n_power, power, n_power), 2 * n_power


class _Texts:
    """A batch of documents in order of their ids: bytes, words and, for each word, its document and place."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        import numpy as np

        rows = sorted(rows, key=lambda r: r[0])
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.data = np.frombuffer(b"\n".join(r[1] for r in rows), np.uint8)
        offset = np.cumsum([0, *(len(r[1]) + 1 for r in rows)])
        first, _ = _words(self.data)
        self.doc = np.searchsorted(offset, first, side="right") - 1
        self.begin = np.searchsorted(self.doc, np.arange(len(rows)))  # each document's first word
        self.place = np.arange(len(first)) - self.begin[self.doc]
        self._hashes = None

    def runs(self, k: int):
        """The words at which k words of one document start."""
        import numpy as np

        n = len(self.doc) - k + 1
        return np.flatnonzero(self.doc[:n] == self.doc[k - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def hashes(self, which: int):
        """One half of each word's 128-bit hash."""
        import numpy as np
        import xxhash

        if self._hashes is None:
            # split() of bytes cuts at \x20 and \x09-\x0D, as _words() does
            self._hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.data.tobytes().split())), "<u8").reshape(-1, 2)
        return self._hashes[:, which]


def _block_keys(texts: _Texts, at, block: int, n_homes: int):
    """(home, 32-bit key) of the blocks at some words. A false match only costs a later comparison."""
    import numpy as np

    h = _rolling(texts.hashes(0), block, 0)[at]
    return ((h >> np.uint64(32)) % np.uint64(n_homes)).astype(np.int64), h & np.uint64(0xFFFFFFFF)


def _zip(values) -> bytes:
    """Whole numbers in ascending or small steps, compressed."""
    import numpy as np
    import zstandard

    steps = np.diff(np.asarray(values, dtype="<i8"), prepend=np.int64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def _unzip(raw: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def _split(*sorted_by):
    """The places at which any of the arrays changes, and the end."""
    import numpy as np

    n = len(sorted_by[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for x in sorted_by:
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), n)


def _gathered(batches: Iterator, size: int, more: bool = False) -> Iterator:
    """Lists of (doc_id, bytes[, more]) of `size` bytes of text or more."""
    held, n = [], 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(2 + more))):
            data = (row[1] or "").encode()
            held.append((row[0], data, *row[2:]))
            n += len(data)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


PACKED = "home int, kind int, doc_ids binary, sizes binary, keys binary"


def _parted(doc, n_parts: int):
    """(part, places): the places of each part of the ids that occurs, by document; order within one is kept."""
    import numpy as np

    part = np.mod(doc, n_parts)
    order = np.lexsort((doc, part))
    edge = _split(part[order]) if len(order) else np.zeros(1, np.int64)
    for a, b in zip(edge, edge[1:]):
        yield int(part[order[a]]), order[a:b]


def _counted(doc):
    """(each document, its number of entries) of ascending documents, packed."""
    edge = _split(doc)
    return _zip(doc[edge[:-1]]), _zip(edge[1:] - edge[:-1])


def _anchors(window: int, n_homes: int, size: int):
    """Index entries (kind 0), probes (kind 1) and what is decided here (kind 2, with home -1)."""
    block = (window + 1) // 2

    def anchors(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for rows in _gathered(batches, size):
            own = _Texts(rows)
            at = own.runs(block)
            enough = np.bincount(own.doc, minlength=len(rows)) >= window
            at = at[enough[own.doc[at]]]
            if not len(at):
                continue
            home, key = _block_keys(own, at, block, n_homes)
            pair = (home.astype(np.uint64) << np.uint64(32)) | key
            doc, indexed = own.doc[at], own.place[at] % block == 0
            order = np.lexsort((doc, pair))
            pair, doc, indexed = pair[order], doc[order], indexed[order]
            # the first document of the batch that has the key as an index entry; none: after all others
            edge = _split(pair)
            least = np.minimum.reduceat(np.where(indexed, doc, len(rows)), edge[:-1])
            group = np.repeat(np.arange(len(least)), np.diff(edge))
            decided = least[group] < doc
            # its document is hit, too, if a later one has the key
            witnessed = np.maximum.reduceat(doc, edge[:-1]) > least
            out = []

            def packed(kind, p, d):
                order = np.lexsort((p, d, p >> np.uint64(32)))
                p, d = p[order], d[order]
                new = _split(p, d)[:-1]
                p, d = p[new], d[new]
                h = p >> np.uint64(32)
                edge = _split(h)
                for a, b in zip(edge, edge[1:]):
                    docs, sizes = np.unique(d[a:b], return_counts=True)
                    out.append((int(h[a]), kind, _zip(own.ids[docs]), _zip(sizes), p[a:b].astype("<u4").tobytes()))

            some = least < len(rows)
            packed(0, pair[edge[:-1]][some], least[some])
            packed(1, pair[~decided], doc[~decided])
            p, d = np.concatenate([pair[decided], pair[edge[:-1]][witnessed]]), np.concatenate([doc[decided], least[witnessed]])
            for _, places in _parted(own.ids[d], n_homes):
                out.append((-1, 2, *_counted(own.ids[d[places]]), p[places].astype("<u8").tobytes()))
            for i in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 2000]), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["home", "kind", "doc_ids", "sizes", "keys"])

    return anchors


def _anchored(n_parts: int):
    """From rows sorted by home and kind: the keys of each document that another document shares.

    A probe of a larger id than an index entry's hits it; the entry's document is hit, too.
    """

    def anchored(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names, kinds = ["part", "home", "doc_ids", "sizes", "keys"], (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

        def least(parts):
            key, doc = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = _split(key)[:-1]
            return key[new], doc[new]

        def reported():
            if index is not None and hit.any():
                found.append((index[1][hit], index[0][hit]))
            if found:
                doc, key = (np.concatenate(x) for x in zip(*found))
                for part, places in _parted(doc, n_parts):
                    out.append((part, at, *_counted(doc[places]), key[places].astype("<u4").tobytes()))

        at, entries, n_entries, index, hit, found, n_found, out = None, [], 0, None, None, [], 0, []
        for batch in batches:
            for home, kind, ids, sizes, keys in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if kind == 2:
                    out.append((int(_unzip(ids)[0] % n_parts), -1, ids, sizes, keys))
                    continue
                if home != at:
                    reported()
                    at, entries, n_entries, index, hit, found, n_found = home, [], 0, None, None, [], 0
                doc, key = np.repeat(_unzip(ids), _unzip(sizes)), np.frombuffer(keys, "<u4")
                if kind == 0:
                    entries.append((key, doc))
                    n_entries += len(key)
                    if n_entries > 4_000_000 and len(entries) > 1:
                        entries = [least(entries)]
                        n_entries = -len(entries[0][0])  # folds again after as many new ones, at least
                    continue
                if index is None:
                    index = least(entries) if entries else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
                    entries, hit = [], np.zeros(len(index[0]), bool)
                if len(index[0]):
                    place = np.minimum(np.searchsorted(index[0], key), len(index[0]) - 1)
                    smaller = (index[0][place] == key) & (index[1][place] < doc)
                    if smaller.any():
                        hit[place[smaller]] = True
                        found.append((doc[smaller], key[smaller]))
                        n_found += int(smaller.sum())
                        if n_found > 2_000_000:
                            known, hit = hit, np.zeros(len(index[0]), bool)
                            reported()
                            found, n_found, hit = [], 0, known
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        reported()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return anchored


def _per_document(batches: Iterator) -> Iterator:
    """From rows sorted by part: (doc_id, entries), one row for each document of a part.

    Hits become home and key in one number; starts stay. A part is as large as the cluster's partitions are.
    """
    import numpy as np
    import pyarrow as pa

    def rows(held):
        doc, value = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order].astype("<u8")
        edge = _split(doc)
        for i in range(0, len(edge) - 1, 5000):
            own = edge[i : i + 5001]
            yield pa.RecordBatch.from_arrays([pa.array(doc[own[:-1]], pa.int64()), pa.array([value[a:b].tobytes() for a, b in zip(own, own[1:])], pa.binary())], ["doc_id", "entries"])

    at, held = None, []
    for batch in batches:
        for part, *more, ids, sizes, raw in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            if part != at and held:
                yield from rows(held)
                held = []
            at = part
            if not more:
                value = _unzip(raw)
            elif more[0] < 0:
                value = np.frombuffer(raw, "<u8")
            else:
                value = (np.uint64(more[0]) << np.uint64(32)) | np.frombuffer(raw, "<u4").astype(np.uint64)
            held.append((np.repeat(_unzip(ids), _unzip(sizes)), value))
    if held:
        yield from rows(held)


WINDOWS = "home int, doc_ids binary, sizes binary, places binary, keys binary"


def _extended(window: int, n_homes: int, size: int):
    """From texts with their anchor hits: the windows around each hit, packed by home.

    A window that a smaller id of the batch has is decided here: home -1, without keys.
    """
    block = (window + 1) // 2

    def extended(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for rows in _gathered(((b.filter(b.column(1).is_valid())) for b in batches), size, True):
            rows = sorted(rows, key=lambda r: r[0])
            own = _Texts([r[:2] for r in rows])
            at = own.runs(window)
            if not len(at):
                continue
            blocks = own.runs(block)
            home, key = _block_keys(own, blocks, block, n_homes)
            pair = (home.astype(np.uint64) << np.uint64(32)) | key
            anchor = np.zeros(len(own.place) + 1, np.int64)
            edge = np.searchsorted(own.doc[blocks], np.arange(len(rows) + 1))
            for d, (a, b) in enumerate(zip(edge, edge[1:])):
                if b > a:
                    anchor[blocks[a:b] + 1] = np.isin(pair[a:b], np.frombuffer(rows[d][2], "<u8"))
            seen = np.cumsum(anchor)
            at = at[seen[at + window - block + 1] > seen[at]]  # the window holds an anchor
            if not len(at):
                continue
            key = _rolling(own.hashes(0), window, 0)[at]
            other = _rolling(own.hashes(1), window, 1)[at]
            doc, place = own.doc[at], own.place[at]
            order = np.lexsort((place, doc, other, key))
            key, other, doc, place = key[order], other[order], doc[order], place[order]
            edge = _split(key, other)
            decided = np.repeat(doc[edge[:-1]], np.diff(edge)) < doc
            home = np.where(decided, -1, (other % np.uint64(n_homes)).astype(np.int64))
            order = np.lexsort((place, doc, home))
            both, doc, place, home = np.stack([key, other], axis=1)[order], doc[order], place[order], home[order]
            edge, out = _split(home), []
            for a, b in zip(edge, edge[1:]):
                docs, sizes = np.unique(doc[a:b], return_counts=True)
                out.append((int(home[a]), _zip(own.ids[docs]), _zip(sizes), _zip(place[a:b]), b"" if home[a] < 0 else both[a:b].astype("<u8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 4))], ["home", "doc_ids", "sizes", "places", "keys"])

    return extended


def _repeated(n_parts: int):
    """From rows sorted by home: the window starts of each document that a smaller id owns."""

    def repeated(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def starts(doc, place):
            for part, places in _parted(doc, n_parts):
                out.append((part, *_counted(doc[places]), _zip(place[places])))

        def owned():
            key, doc, place = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((place, doc, key[:, 1], key[:, 0]))
            key, doc, place = key[order], doc[order], place[order]
            edge = _split(key[:, 0], key[:, 1])
            later = np.repeat(doc[edge[:-1]], np.diff(edge)) < doc
            doc, place = doc[later], place[later]
            order = np.lexsort((place, doc))
            starts(doc[order], place[order])

        at, held, out = None, [], []
        names, kinds = ["part", "doc_ids", "sizes", "starts"], (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            for home, ids, sizes, places, keys in zip(*(batch.column(c).to_pylist() for c in range(5))):
                doc, place = np.repeat(_unzip(ids), _unzip(sizes)), _unzip(places)
                if home < 0:
                    starts(doc, place)
                    continue
                if home != at and held:
                    owned()
                    held = []
                at = home
                held.append((np.frombuffer(keys, "<u8").reshape(-1, 2), doc, place))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if held:
            owned()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return repeated


def _removed(window: int):
    def removed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, owned in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode().split()  # of bytes: at \x20 and \x09-\x0D only
                if not owned:
                    out.append((len(words), 0, [], b" ".join(words)))
                    continue
                drop = np.zeros(len(words) + window + 1, np.int64)
                starts = np.frombuffer(owned, "<u8").astype(np.int64)
                starts = starts[starts + window <= len(words)]  # of rows that repeat an id, the longer one's are here, too
                np.add.at(drop, starts, 1)
                np.add.at(drop, starts + window, -1)
                gone = np.cumsum(drop)[: len(words)] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
                kept, last = [], 0
                for a, b in (*zip(edge[::2], edge[1::2]), (len(words), len(words))):
                    kept += words[last:a]
                    last = b
                out.append((len(words), int(gone.sum()), [{"first": a, "end": b} for a, b in zip(edge[::2], edge[1::2])], b" ".join(kept)))
            n_words, n_removed, repeats, kept = zip(*out) if out else ((), (), (), ())
            span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(repeats, span), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "repeats", "kept"])

    return removed


def without_repeats(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 6_000_000) -> DataFrame:
    """(doc_id, n_words, n_removed, repeats array<struct<first, end>> in words, kept string) of each row."""
    if window < 2:
        raise ValueError("a window has two words at least")
    n_homes = min(partitions(docs.sparkSession), 1 << 20)
    own = texts(docs, id_col, text_col)
    known = own.where("doc_id is not null")

    def per_document(reports: DataFrame) -> DataFrame:
        return map_batches(reports.repartition(n_homes, "part").sortWithinPartitions("part"), _per_document, "doc_id long, entries binary")

    # rows of what a batch decided by itself have no home: they are dealt out by their documents
    key = F.when(F.col("home") >= 0, F.col("home").cast("long")).otherwise(F.xxhash64("doc_ids"))
    dealt = map_batches(known, _anchors(window, n_homes, batch_bytes), PACKED).repartition(n_homes, key).sortWithinPartitions("home", "kind")
    anchors = per_document(map_batches(dealt, _anchored(n_homes), HITS))
    # both joins are left joins over the same rows, so that the exchange of the texts is made once
    around = known.join(anchors, "doc_id", "left").select("doc_id", F.when(F.col("entries").isNotNull(), F.col("text")).alias("text"), F.coalesce("entries", F.lit(b"")).alias("entries"))
    windows = map_batches(around, _extended(window, n_homes, batch_bytes), WINDOWS).repartition(n_homes, key).sortWithinPartitions("home")
    owned = per_document(map_batches(windows, _repeated(n_homes), STARTS))
    result = "doc_id long, n_words long, n_removed long, repeats array<struct<first:int,end:int>>, kept string"
    judged = map_batches(known.join(owned, "doc_id", "left"), _removed(window), result)
    nobody = own.where("doc_id is null").withColumn("entries", F.lit(None).cast("binary"))
    return judged.unionByName(map_batches(nobody, _removed(window), result))
