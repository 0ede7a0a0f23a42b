"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Each match of the split pattern is encoded on its own, without special tokens. Long texts are cut at places
that are surely between two matches, so that no call gets an unbounded text; ids are those of the whole text.
Decoding joins the raw bytes of the ids and never passes through a string, so that any ids decode.

Defined results: a null text counts as empty (no ids, no bytes); a null or repeated doc_id is passed through,
a row for each input row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_in_worker, map_batches, safe_parts, texts


def encoding(ranks_path: str, pattern: str):
    """The tiktoken Encoding of a rank file, loaded once in each worker process."""

    def load():
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}
        return tiktoken.Encoding(ranks_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return kept_in_worker(("tiktoken", ranks_path, pattern), load)


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>): the token ids of every whole text; decoded: also bytes binary, what they decode to.

    A round trip in one pass needs one worker process per task, and ids cross to it once.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc = encoding(ranks_path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                parts, back, offsets = [], [], np.zeros(batch.num_rows + 1, dtype=np.int32)
                for i, text in enumerate(batch.column(1).to_pylist()):
                    own = [enc.encode_to_numpy(part, disallowed_special=()) for part in safe_parts(text or "")]
                    offsets[i + 1] = offsets[i] + sum(map(len, own))
                    parts += own
                    if decoded:
                        back.append(b"".join(enc.decode_bytes(x.tolist()) for x in own))
                values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
                columns = {"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}
                if decoded:
                    columns["bytes"] = pa.array(back, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, ids array<int>" + ", bytes binary" * decoded)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, bytes binary): the raw bytes of the ids; null ids count as none."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoding(ranks_path, pattern)
        for batch in batches:
            out = [enc.decode_bytes(ids.values.tolist()) if ids.is_valid else b"" for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"])

    taken = encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return map_batches(taken, run, "doc_id long, ids array<int>, bytes binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """The token count and the SHA-256 of the ids and of the bytes that decode() returned, and columns named."""
    return decoded.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.coalesce("ids", F.array().cast("array<int>")).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        *more,
    )
