"""Language identification by string kernels.

The kernel of two texts is the normalised number of n-grams that both have, over all lengths of a range (a
blended-spectrum presence kernel). The n-grams are those of the training texts, over UTF-8 bytes. A Nyström map over
landmark texts stands for the kernel's feature space, and one ridge regression per language is fitted on it, each
language against the rest. Batches of texts are scored by two matrix products: presence x landmarks, then kernel
values x coefficients.

The model is fitted on a bounded sample of labelled rows, `max_train` in all, spread evenly over the languages (what a
rare one can't use, others get) and chosen by a hash of the id among rows of `max_chars` characters at most; a language
without such a row is learned from its shortest ones. Of more languages than `max_train` the most frequent are learned.
Everything else reads every whole text.

Defined results: a null text or one without any letter is `und` with score 0; without any labelled row all texts
are `und`; a null or repeated doc_id is passed through, a row for each input row; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from .common import give_back, named, texts

UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)


@dataclass(frozen=True)
class Model:
    """grams: packed n-grams, in order; landmarks: their normalised presence; weights: one column per language."""

    langs: tuple[str, ...]
    grams: object
    table: object
    landmarks: object
    weights: object


def _codes(data, n: int):
    """The n-grams of a byte array as integers: the length, then the bytes."""
    import numpy as np

    if len(data) < n:
        return np.zeros(0, np.uint64)
    acc = np.full(len(data) - n + 1, n, np.uint64)
    for j in range(n):
        acc = (acc << np.uint64(8)) | data[j : len(data) - n + 1 + j]
    return acc


def _slots(codes, bits: int):
    import numpy as np

    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _bytes(text: str):
    import numpy as np

    return np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint64)


def _lookup(grams, bits: int = 18):
    """Tables of `1 << bits` places from hash to gram, as many as it takes for every gram to have a place."""
    import numpy as np

    tables, left, at = [], np.arange(len(grams)), _slots(grams, bits)
    while len(left) or not tables:
        row = np.full(1 << bits, -1, np.int32)
        row[at[left][::-1]] = left[::-1]
        tables.append(row)
        left = left[row[at[left]] != left]
    return np.stack(tables)


def presence(text: str, grams, table, out) -> None:
    """Sets out[g] for each known n-gram g of the text; long texts in pieces that overlap."""
    import numpy as np

    data, bits = _bytes(text), int(np.log2(table.shape[1]))
    for start in range(0, max(len(data), 1), 1 << 20):
        piece = data[start : start + (1 << 20) + max(GRAMS) - 1]
        for n in GRAMS:
            codes = _codes(piece, n)
            at = _slots(codes, bits)
            for row in table:
                found = row[at]
                out[found[(found >= 0) & (grams[found] == codes)]] = 1


def kernel(p, landmarks):
    """Normalised counts of shared n-grams of texts (rows of 0 and 1) and landmarks (normalised rows)."""
    import numpy as np

    return (p @ landmarks.T) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))


def fit(rows: list[tuple[str, str]], *, max_grams: int = 16_000, n_landmarks: int = 160, ridge: float = 1e-3) -> Model:
    """From (text, lang) pairs, in a stable order."""
    import numpy as np

    langs = tuple(sorted({lang for _, lang in rows}))
    # in how many texts each n-gram is; the most frequent are kept, ties by their code
    own = [np.unique(np.concatenate([_codes(data, n) for n in GRAMS])) for data in (_bytes(text) for text, _ in rows)]
    codes, texts_with = np.unique(np.concatenate(own), return_counts=True)
    del own
    kept = np.sort(codes[np.lexsort((codes, -texts_with))[:max_grams]])
    grams = kept if len(kept) else np.zeros(1, np.uint64)
    table = _lookup(grams)

    def present(chosen: list[int]):
        p = np.zeros((len(chosen), len(grams)), np.float32)
        for row, i in zip(p, chosen):
            presence(rows[i][0], grams, table, row)
        return p

    y = np.array([[float(lang == x) for x in langs] for _, lang in rows])
    by_lang = [[i for i, (_, lang) in enumerate(rows) if lang == x] for x in langs]
    chosen = sorted({i for own in by_lang for i in own[: max(1, n_landmarks // len(langs))]})
    p = present(chosen)
    landmarks = p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
    values, vectors = np.linalg.eigh(kernel(p, landmarks).astype(np.float64))
    # a few texts at a time: the presence of all of them would take many times the room of their kernel values
    k = np.concatenate([kernel(present(list(range(at, min(at + 256, len(rows))))), landmarks) for at in range(0, len(rows), 256)]).astype(np.float64)
    good = values > 1e-6 * max(values.max(), 1e-12)
    to_features = vectors[:, good] / np.sqrt(values[good])  # the Nyström map
    z = k @ to_features
    weight = np.array([len(rows) / (len(langs) * len(own)) for own in by_lang])[y.argmax(axis=1)][:, None]
    beta = np.linalg.solve(z.T @ (weight * z) + ridge * len(rows) * np.eye(z.shape[1]), z.T @ (weight * y))
    return Model(langs, grams, table, landmarks.astype(np.float32), (to_features @ beta).astype(np.float32))


def shares(counts: list[int], total: int) -> list[int]:
    """How many of `total` each of some groups gets: as evenly as their sizes allow, one at least."""
    out, left = [0] * len(counts), total
    for done, i in enumerate(sorted(range(len(counts)), key=lambda i: (counts[i], i))):
        out[i] = min(counts[i], max(1, left // (len(counts) - done)))
        left -= out[i]
    return out


def training_rows(docs: DataFrame, usable: Column, *, max_train: int = 2000, max_chars: int = 20_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(text, lang) of `max_train` usable labelled rows at most, as evenly over the languages as they go.

    Languages are thinned by a hash of the id before any row is gathered. Texts go to the driver, so rows of at most
    `max_chars` characters are sampled, or a language's shortest rows if all are longer; they are learned from whole.
    """
    own = docs.where(usable & named(lang_col).isNotNull() & named(id_col).isNotNull() & named(text_col).isNotNull())
    own = own.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"), named(lang_col).cast("string").alias("lang"))
    own = own.withColumn("length", F.char_length("text"))
    short = F.col("length") <= max_chars
    counts = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(short).alias("short"), F.min("length").alias("least")).orderBy(F.desc("n"), "lang").limit(max_train).collect()
    if not counts:
        return []
    share = dict(zip((r["lang"] for r in counts), shares([r["short"] or 1 for r in counts], max_train)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))

    def thinned(r) -> Column:
        if not r["short"]:
            return F.col("length") == r["least"]
        return short & (place < int(min(1.0, (1.3 * share[r["lang"]] + 8) / r["short"]) * (1 << 40)))

    some = F.lit(False)
    for r in counts:
        some = F.when(F.col("lang") == r["lang"], thinned(r)).otherwise(some)
    taken = own.where(some).select("lang", "text", place.alias("place"), "doc_id").orderBy("place", "doc_id", "text").limit(2 * max_train + 20 * len(counts)).collect()
    rows, held = [], dict.fromkeys(share, 0)
    for r in taken:
        if held[r["lang"]] < share[r["lang"]]:
            held[r["lang"]] += 1
            rows.append((r["text"], r["lang"]))
    return rows


def _predicted(m: Model, own: list[str | None], p) -> tuple[list[str], object]:
    """Language and score of some texts; p: an array of presence to use, a row for each text at least."""
    import numpy as np

    p[: len(own)] = 0
    known = np.array([t is not None and any(map(str.isalpha, t)) for t in own], dtype=bool)
    for row, text, k in zip(p, own, known):
        if k:
            presence(text, m.grams, m.table, row)
    f = kernel(p[: len(own)], m.landmarks) @ m.weights
    best = f.argmax(axis=1)
    score = np.where(known, np.clip(f[np.arange(len(own)), best], 0, 1), 0).astype(np.float64)
    return [m.langs[b] if k else UNKNOWN for b, k in zip(best, known)], score


def predict(docs: DataFrame, model: Model | None, *, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score", batch_rows: int = 256) -> DataFrame:
    """docs with the language and score of every whole text as two more columns."""
    if model is None:
        return docs.withColumns({lang_out: F.lit(UNKNOWN), score_out: F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by the model's parameters

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        m = sent.value
        p = np.zeros((batch_rows, len(m.grams)), np.float32)
        try:
            for batch in batches:
                langs, scores = [], []
                for start in range(0, len(batch), batch_rows):
                    own, score = _predicted(m, batch.slice(start, batch_rows).to_pylist(), p)
                    langs += own
                    scores.append(score)
                yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang", "score"])
        finally:
            del p
            give_back()

    # not to be taken apart: a filter on the result would make the scores twice
    own = F.arrow_udf(run, "lang string, score double", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    scored = docs.withColumn("_tidemark_lang", own(named(text_col).cast("string")))
    return scored.withColumns({lang_out: F.col("_tidemark_lang.lang"), score_out: F.col("_tidemark_lang.score")}).drop("_tidemark_lang")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32(doc_id as text) mod 4 is 2, or the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = 2000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): fitted on rows that aren't held out, applied to all."""
    rows = training_rows(docs, ~held_out(named(id_col).cast("long")), max_train=max_train, id_col=id_col, text_col=text_col, lang_col=lang_col)
    scored = predict(texts(docs, id_col, text_col), fit(rows) if rows else None)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def with_known_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train: int = 2000) -> DataFrame:
    """docs without those whose language can't be told; a missing label becomes the predicted one."""
    rows = training_rows(docs, ~held_out(named(id_col).cast("long")), max_train=max_train, id_col=id_col, text_col=text_col, lang_col=lang_col)
    if not rows:  # nothing to learn from: only texts without a letter are known to have no language
        return docs.where(F.coalesce(F.rlike(named(text_col), F.lit(r"\p{L}")), F.lit(False)))
    names = docs.columns
    scored = predict(docs, fit(rows), text_col=text_col, lang_out="_tidemark_pred", score_out="_tidemark_score").where(F.col("_tidemark_pred") != UNKNOWN)
    return scored.select(*(F.coalesce(named(c), F.col("_tidemark_pred")).alias(c) if c == lang_col else named(c) for c in names))
