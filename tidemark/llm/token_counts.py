"""Token counts by a join of pre-token frequencies with pieces that are counted once per distinct pre-token.

1. Documents are gathered into blocks of bounded size. A block has its distinct pre-tokens and, for each
   document, how often it has which of them, as packed numbers.
2. The blocks' pre-tokens are dealt out by hash. Each distinct pre-token has one home, which counts its pieces
   once, whatever number of blocks have it.
3. Blocks are joined with the counts of their pre-tokens, and each document's counts are summed. Ids are never
   made, and no row exists for a pair of a document and a pre-token.

A block's row is bounded by `block_chars` (one longer document is a block of its own), so neither a hot source
nor a frequent pre-token gathers rows in a task.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a null or repeated doc_id is passed through,
a row for each input row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_in_worker, map_batches, partitions, safe_parts, texts, written


def _tokenizer(path: str):
    def load():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return kept_in_worker(("tokenizers", path), load)


def _splitter(path: str, pattern: str):
    """A function from text to its pre-tokens, as the tokenizer of this file splits.

    The pattern is matched here where both libraries surely agree on character classes (ASCII and Latin
    letters); other texts are split by the tokenizer itself.
    """

    def make():
        import regex

        split, other = regex.compile(pattern).findall, regex.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ƺ]").search
        by_library = _tokenizer(path).pre_tokenizer.pre_tokenize_str
        return lambda text: [text[a:b] for _, (a, b) in by_library(text)] if other(text) else split(text)

    return kept_in_worker(("pre-tokens", path, pattern), make)


def _pack(values) -> bytes:
    """Whole numbers below 2**32, small: their bytes by significance, compressed."""
    import numpy as np
    import zstandard

    return zstandard.compress(np.asarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(raw: bytes):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _pack_texts(names: list[str]) -> tuple[bytes, bytes]:
    """Strings as (their lengths in code points, their compressed concatenation)."""
    import zstandard

    return _pack([len(x) for x in names]), zstandard.compress("".join(names).encode(), 3)


def _unpack_texts(lengths: bytes, joined: bytes) -> list[str]:
    import zstandard

    text, names, at = zstandard.decompress(joined).decode(), [], 0
    for n in _unpack(lengths).tolist():
        names.append(text[at : at + n])
        at += n
    return names


def _blocks(path: str, pattern: str, special: tuple[str, ...], n_homes: int, block_chars: int):
    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        import regex
        import xxhash
        from pyspark import TaskContext

        split = _splitter(path, pattern)
        cut_special = regex.compile("|".join(regex.escape(x) for x in sorted(special, key=len, reverse=True))).split if special else lambda t: [t]
        seq = TaskContext.get().partitionId() << 32
        def flushed():
            nonlocal seq
            names = list(vocabulary)
            home = np.fromiter((xxhash.xxh32_intdigest(x) % n_homes for x in names), np.uint16, len(names))
            by_home = [[] for _ in range(n_homes)]
            for x, h in zip(names, home.tolist()):
                by_home[h].append(x)
            rows = [(seq, h, None, None, None, None, None, None, None, *_pack_texts(own)) for h, own in enumerate(by_home) if own]
            rows.append((seq, None, doc_ids, n_bytes, specials, _pack(home), _pack(sizes), _pack(np.concatenate(steps)), _pack(np.concatenate(counts)), None, None))
            seq += 1
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int64())),
                *(pa.array(c, pa.binary()) for c in cols[5:]),
            ], ["block", "home", "doc_ids", "n_bytes", "specials", "homes", "sizes", "steps", "counts", "lengths", "pre_tokens"])

        vocabulary, doc_ids, n_bytes, specials, sizes, steps, counts, held = {}, [], [], [], [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                segments, frequency = cut_special(text), Counter()
                for segment in segments:
                    for part in safe_parts(segment):
                        frequency.update(split(part))
                place = vocabulary.setdefault
                own = np.fromiter((place(x, len(vocabulary)) for x in frequency), np.uint32, len(frequency))
                order = np.argsort(own)  # a document's places in order, as steps from one to the next
                doc_ids.append(doc_id), n_bytes.append(len(text.encode())), specials.append(len(segments) - 1), sizes.append(len(own))
                steps.append(np.diff(own[order], prepend=np.uint32(0))), counts.append(np.fromiter(frequency.values(), np.uint32, len(own))[order])
                held += len(text)
                if held >= block_chars or len(doc_ids) >= 50_000:
                    yield flushed()
                    vocabulary, doc_ids, n_bytes, specials, sizes, steps, counts, held = {}, [], [], [], [], [], [], 0
        if doc_ids:
            yield flushed()

    return run


BLOCK = "block long, home int, doc_ids array<long>, n_bytes array<long>, specials array<long>, homes binary, sizes binary, steps binary, counts binary, lengths binary, pre_tokens binary"


def _pieces(path: str):
    """(block, home, n_pieces): the number of pieces of each pre-token, each distinct one counted once."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tokenizer, known = _tokenizer(path), {}
        for batch in batches:
            out = []
            for packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                names = _unpack_texts(*packed)
                fresh = [x for x in names if x not in known]
                known.update(zip(fresh, (len(e) for e in tokenizer.encode_batch_fast(fresh, add_special_tokens=False))))
                out.append(np.fromiter((known[x] for x in names), np.uint32, len(names)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["block", "home", "n_pieces"])

    return run


def _sums(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            homes = _unpack(row["homes"])
            n_pieces = np.zeros(len(homes), np.int64)
            order = np.argsort(homes, kind="stable")
            n_pieces[order] = np.frombuffer(b"".join(x["n_pieces"] for x in sorted(row["pieces"] or [], key=lambda x: x["home"])), np.uint32)
            sizes = _unpack(row["sizes"]).astype(np.int64)
            ends = np.cumsum(sizes)
            place = np.cumsum(_unpack(row["steps"]), dtype=np.int64)
            before = np.concatenate([[0], place])[ends - sizes]  # each document's steps start from 0
            total = np.concatenate([[0], np.cumsum(n_pieces[place - np.repeat(before, sizes)] * _unpack(row["counts"]))])
            n = total[ends] - total[ends - sizes] + np.array(row["specials"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(
    docs: DataFrame, tokenizer_path: str, pattern: str, special: tuple[str, ...] = (), *,
    id_col: str = "doc_id", text_col: str = "text", block_chars: int = 32_000_000,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text.

    pattern: how the tokenizer splits text into pre-tokens. special: its added tokens, which inside a text
    count one each. block_chars bounds a block's text.
    """
    spark = docs.sparkSession
    n_homes = min(partitions(spark), 65_535)
    blocks = written(map_batches(texts(docs, id_col, text_col), _blocks(tokenizer_path, pattern, special, n_homes, block_chars), BLOCK), "token-blocks")
    homes = blocks.where("home is not null").select("block", "home", "lengths", "pre_tokens").repartition(n_homes, "home")
    pieces = map_batches(homes, _pieces(tokenizer_path), "block long, home int, n_pieces binary")
    by_block = pieces.groupBy("block").agg(F.collect_list(F.struct("home", "n_pieces")).alias("pieces"))
    own = blocks.where("home is null").drop("home", "lengths", "pre_tokens")
    return map_batches(own.join(by_block, "block", "left"), _sums, "doc_id long, n_bytes long, n_tokens long")
