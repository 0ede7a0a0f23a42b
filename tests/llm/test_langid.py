"""Language identification against a dense kernel and ridge regression by hand, and what is learned from."""

import numpy as np

from tidemark.llm import langid


def test_scores_by_hand(spark, sf):
    """Presence, kernel, Nyström map and ridge regression written out densely over sets of n-grams."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang is not null and char_length(text) between 20 and 2000").orderBy("doc_id").limit(60).collect()
    rows, others = [(r["text"], r["lang"]) for r in docs[:40]], [r["text"] for r in docs[40:]]
    model = langid.fit(rows, n_landmarks=16)
    kept = {int(c) for c in model.grams}

    def grams(text):
        data = text.lower().encode()
        return {int.from_bytes(bytes([n]) + data[i : i + n]) for n in langid.GRAMS for i in range(len(data) - n + 1)} & kept

    def k(a, b):
        return len(a & b) / max(len(a), 1) ** 0.5 / max(len(b), 1) ** 0.5

    langs = sorted({lang for _, lang in rows})
    chosen = sorted({i for x in langs for i in [i for i, r in enumerate(rows) if r[1] == x][: max(1, 16 // len(langs))]})
    marks, own = [grams(rows[i][0]) for i in chosen], [grams(t) for t, _ in rows]
    values, vectors = np.linalg.eigh(np.array([[k(a, b) for b in marks] for a in marks]))
    good = values > 1e-6 * values.max()
    back = vectors[:, good] / np.sqrt(values[good])
    z = np.array([[k(a, b) for b in marks] for a in own]) @ back
    y = np.array([[float(lang == x) for x in langs] for _, lang in rows])
    w = np.diag([len(rows) / (len(langs) * sum(r[1] == lang for r in rows)) for _, lang in rows])
    beta = np.linalg.solve(z.T @ w @ z + 1e-3 * len(rows) * np.eye(z.shape[1]), z.T @ w @ y)
    expected = np.array([[k(grams(t), b) for b in marks] for t in others]) @ back @ beta
    got, score = langid._predicted(model, others, np.zeros((len(others), len(model.grams)), np.float32))
    assert got == [langs[i] for i in expected.argmax(axis=1)]
    assert np.allclose(score, np.clip(expected.max(axis=1), 0, 1), atol=1e-3)


def test_every_gram_has_a_place():
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000).astype(np.uint64))
    table = langid._lookup(grams, bits=9)
    assert set(table[table >= 0]) == set(range(len(grams))) and len(table) > 8


def test_shares():
    assert langid.shares([5, 100, 100], 50) == [5, 22, 23]
    assert langid.shares([1, 1], 10) == [1, 1] and langid.shares([9, 9, 9], 2) == [1, 1, 1] and langid.shares([], 5) == []


def test_rare_and_long_languages_are_learned(spark):
    long_text = "ωψχ φυτ σρπ " * 3000
    rows = [(i, f"the house number {i} and the garden", "en") for i in range(40)] + [(100 + i, long_text + str(i % 3), "el") for i in range(4)] + [(200, "der hund und die katze", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    got = langid.training_rows(df, F.lit(True), max_train=30)
    by = {x: sum(lang == x for _, lang in got) for x in ("en", "el", "de")}
    assert by["de"] == 1 and by["el"] >= 1 and by["en"] >= 27
