"""Document fingerprints: Merkle trees over sections, paragraphs and sentences.

A paragraph is a line that isn't blank. A section is a run of paragraphs: it ends at a blank line or after a paragraph
whose own digest says so, one in eight, so an inserted paragraph changes its section and shifts no other. The leaves
of a paragraph are its sentences, as a paragraph is often the whole document and an edit should be located inside it;
a sentence of more than 16 words is cut after words whose checksum says so, for the same reason. A leaf's digest covers
its text, that of a paragraph or section its kind and its children's digests, and the root's its sections' and the raw
text, so that equal roots mean equal texts, white space included, and equal texts have equal fingerprints.

A fingerprint is `root/section:paragraph=leaf,leaf;paragraph=leaf|section:...`. Two fingerprints are compared from the
top: equal roots are equal texts; equal sections, then equal paragraphs match whole; only what is left is compared by
leaves. The likeness is the Dice coefficient of the matched leaves. Edits are located by aligning the sections, and
inside of sections that differ their paragraphs.

Defined results: a null or blank text has a tree without leaves; two such fingerprints are alike by 1 if equal, else
0; the next document is that of the next id, ties by text, a null id before all; the last is followed by the first,
and a single document by itself; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, partitions, texts

#: One in so many paragraphs ends a section; one in so many words ends a leaf of a sentence with more than LONG words.
SECTION, LEAF, LONG = 8, 8, 16


def _digest(data: bytes, size: int) -> str:
    import hashlib

    return hashlib.blake2b(data, digest_size=size).hexdigest()


def leaves(paragraph: str) -> list[str]:
    """The texts of a paragraph's leaves."""
    import re
    from zlib import crc32

    out = []
    for sentence in re.split(r"(?<=[.!?;:|])\s+", paragraph.strip()):
        words = sentence.split()
        if len(words) <= LONG:
            out.append(sentence)
            continue
        at = 0
        for i, w in enumerate(words, 1):
            if crc32(w.encode()) % LEAF == 0 or i == len(words):
                out.append(" ".join(words[at:i]))
                at = i
    return out


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text; pure Python, for use in workers and tests."""
    text = text or ""
    shown, section = [], []
    for line in [*text.split("\n"), ""]:
        last = not line.strip()
        if not last:
            own = ",".join(_digest(b"leaf" + x.encode(), 4) for x in leaves(line))
            section.append((_digest(b"paragraph" + own.encode(), 4), own))
            last = int(section[-1][0], 16) % SECTION == 0
        if last and section:
            digest = _digest(b"section" + ",".join(d for d, _ in section).encode(), 8)
            shown.append(f"{digest}:" + ";".join(f"{d}={own}" for d, own in section))
            section = []
    sections = ",".join(x[:16] for x in shown)
    return f"{_digest(b'root' + _digest(text.encode(), 16).encode() + sections.encode(), 16)}/{'|'.join(shown)}"


def _tree(shown: str) -> tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]:
    """(root, [(section, [(paragraph, [leaf])])])."""
    root, _, body = shown.partition("/")
    return root, [(s[:16], [(p[:8], p[9:].split(",")) for p in s[17:].split(";")]) for s in body.split("|") if s]


def _unmatched(a: list[tuple], b: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The nodes of each side without those whose digests both have, as often as both have them."""
    from collections import Counter

    same = Counter(x[0] for x in a) & Counter(x[0] for x in b)

    def rest(own):
        left, out = Counter(same), []
        for x in own:
            if left[x[0]]:
                left[x[0]] -= 1
            else:
                out.append(x)
        return out

    return rest(a), rest(b)


def likeness(a: str, b: str) -> float:
    """The share of leaves that two fingerprints have in common, found from the top of the trees; 0 to 1."""
    from collections import Counter

    (root_a, own_a), (root_b, own_b) = _tree(a), _tree(b)
    if root_a == root_b:
        return 1.0
    total = sum(len(p[1]) for own in (own_a, own_b) for s in own for p in s[1])
    if not total:
        return 0.0
    sections = _unmatched(own_a, own_b)
    paragraphs = _unmatched(*([p for s in own for p in s[1]] for own in sections))
    left = [Counter(x for p in own for x in p[1]) for own in paragraphs]
    return (total - (left[0] - left[1]).total() - (left[1] - left[0]).total()) / total


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of a, each from 0, that b has not at the place that aligns with it."""
    from difflib import SequenceMatcher

    (root_a, own_a), (root_b, own_b) = _tree(a), _tree(b)
    if root_a == root_b:
        return []

    def changed(x: list[str], y: list[str]):
        return ((i1, i2, j1, j2) for tag, i1, i2, j1, j2 in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if tag != "equal")

    out = []
    for i1, i2, j1, j2 in changed([s[0] for s in own_a], [s[0] for s in own_b]):
        mine = [(i, j, p[0]) for i in range(i1, i2) for j, p in enumerate(own_a[i][1])]
        other = [p[0] for s in own_b[j1:j2] for p in s[1]]
        for k1, k2, _, _ in changed([d for _, _, d in mine], other):
            out += [(i, j) for i, j, _ in mine[k1:k2]]
    return out


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _dealt(cuts: list[int]):
    """Rows with the range they are in; the first row of each range goes to the range before it, too."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at = np.array(cuts, np.int64)
        for batch in batches:
            # a null id is before all others, in range 0
            ids = pc.fill_null(batch.column(0), -(1 << 63)).to_numpy(zero_copy_only=False)
            own = np.searchsorted(at, ids, side="right")
            first = np.flatnonzero((own > 0) & (ids == at[np.maximum(own - 1, 0)])) if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(np.zeros(len(ids), bool)), batch.column(0), batch.column(1)], ["range", "ahead", "doc_id", "text"])
            if len(first):
                taken = batch.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([pa.array((own[first] - 1).astype(np.int32)), pa.array(np.ones(len(first), bool)), taken.column(0), taken.column(1)], ["range", "ahead", "doc_id", "text"])

    return run


def _fingerprinted(batches: Iterator) -> Iterator:
    """From rows in order of range, ahead, doc_id and text."""
    import pyarrow as pa

    names = ["doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held, done_with, out, size = None, None, [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for at, ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text or ""
            shown = fingerprint(text)
            if held is not None and held[0] == at and done_with != at:
                _, own_id, own_text, own = held
                new = edited(own_text, text)
                other = fingerprint(new)
                out.append((own_id, own_text, new, own, other, likeness(own, other), likeness(own, shown)))
                size += len(own_text)
                if size > 4_000_000:
                    yield batch_of(out)
                    out, size = [], 0
            if ahead:
                done_with = at  # the rest of the rows ahead repeat this id and belong to the next range
            held = (at, doc_id, text, shown)
    if out:
        yield batch_of(out)


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    Ranges of ids are cut at ids that occur, so that each has a first row, which the range before it also gets;
    the last range gets the first row of all. Each range is then a run in order on one task, and the texts are
    shuffled once.
    """
    own = texts(docs, id_col, text_col)
    n = 2 * partitions(docs.sparkSession)
    found = own.select("doc_id").agg(F.min("doc_id"), F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n), F.count(F.lit(1)), F.count("doc_id")).first()
    least, cuts, n_rows, n_ids = found
    cuts = sorted({c for c in cuts or [] if n_rows > n_ids or c > least})
    first = own.where("doc_id is null") if n_rows > n_ids else own.where(F.col("doc_id") == least)
    first = first.groupBy().agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "doc_id")).alias("first")).where("first is not null")
    wrap = first.select(F.lit(len(cuts)).alias("range"), F.lit(True).alias("ahead"), F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"))
    dealt = map_batches(own.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), _dealt(cuts), "range int, ahead boolean, doc_id long, text string").unionByName(wrap)
    ordered = dealt.repartition(partitions(docs.sparkSession), "range").sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), "text")
    return map_batches(ordered, _fingerprinted, "doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
