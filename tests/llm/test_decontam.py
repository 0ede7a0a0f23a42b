"""Decontamination against the definition over every window."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam


def held(text, item, threshold=0.8):
    """(similarity, first, words) of the best of all windows, or None."""
    w, own = (brute.words((t or "").lower()) for t in (text, item))
    if not w or not own:
        return None

    def counted(x):
        k = min(5, len(x))
        return Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1))

    goal, best = counted(own), None
    for first in range(max(len(w) - len(own), 0) + 1):
        window = w[first : first + len(own)]
        c = counted(window)
        s = (c & goal).total() / (c | goal).total()
        if s >= threshold and (best is None or s > best[0]):
            best = (s, first, len(window))
    return best


def compared(spark, docs, items, **options):
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["first_word"], r["n_words"]) for r in decontam.contaminated(*frames, **options).collect()}
    expected = {(i, j): (round(h[0], 9), *h[1:]) for i, t in docs for j, x in items if (h := held(t, x))}
    return got, expected


def letters(rng, n=16, length=6):
    return "".join(rng.choice("abcdefghijklmnop"[:n]) for _ in range(length))


def test_halves_of_an_item_swapped(spark):
    rng = random.Random(1)
    w = [letters(rng) for _ in range(100)]
    docs = [(0, " ".join(["x", *w[50:], *w[:50], "y"])), (1, " ".join(w[25:] + w[:25])), (2, " ".join(w[:40])), (3, " ".join(w))]
    got, expected = compared(spark, docs, [(7, " ".join(w))])
    assert got == expected and set(got) == {(0, 7), (1, 7), (3, 7)} and 0.9 < got[0, 7][0] < 0.93


@pytest.mark.parametrize("options", [{}, {"radius": 64}, {"broadcast_rows": 0, "broadcast_bytes": 0}])
def test_all_windows(spark, options):
    rng = random.Random(2)
    items, docs = [], []
    for i in range(24):
        few = 3 if i % 4 == 0 else 16  # of few letters: shingles that repeat within an item
        size = rng.choice([1, 3, 4, 5, 6, 9, 13, 20, 21, 40, 75])
        w = [letters(rng, few, 1 if few == 3 else 6) for _ in range(size)]
        items.append((i, " ".join(w)))
        for _ in range(4):
            own = list(w)
            for _ in range(rng.randint(0, 2)):
                at, kind = rng.randrange(len(own) + 1), rng.random()
                if kind < 0.4:
                    own[at:at] = [letters(rng)]
                elif kind < 0.7:
                    own[at : at + 1] = []
                else:
                    own = own[at:] + own[:at]
            docs.append((len(docs), " ".join([letters(rng) for _ in range(rng.randint(0, 3))] + own * rng.randint(1, 3) + [letters(rng) for _ in range(rng.randint(0, 3))])))
    got, expected = compared(spark, docs, items, **options)
    assert got == expected and len(got) > 60


def test_recall_of_the_radius(spark):
    """Windows at the threshold itself, where the loss by the radius is largest: all are found."""
    rng = random.Random(3)
    items, docs = [], []
    for i in range(240):
        n = (13, 14, 18, 30, 49, 58, 100, 200)[i % 8]
        w, c = [letters(rng) for _ in range(n)], (n - 4) // 9
        items.append((i, " ".join(w)))
        docs.append((i, " ".join([letters(rng) for _ in range(c)] + w[c:] if i % 2 else w[:-c] + [letters(rng) for _ in range(c)])))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sum(r["doc_id"] == r["item_id"] for r in decontam.contaminated(*frames).collect()) == 240


def test_odd_rows(spark):
    rng = random.Random(4)
    w = " ".join(letters(rng) for _ in range(12))
    docs = [(1, w), (1, w), (1, "other " + w), (1, None), (2, ""), (None, w), (3, "z " * 30_000 + w), (4, (w + " ") * 500)]
    items = [(1, w), (1, w), (2, None), (3, " \n"), (None, w), (4, w)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    clash = {c: F.lit("x") for c in ("size", "words", "k", "n", "shingle", "first", "window", "fp", "block", "value", "item_no", "similarity", "places", "spans", "text_key")}
    got = sorted(tuple(r) for r in decontam.contaminated(frames[0].withColumns(clash), frames[1].withColumns(clash)).collect())
    assert got == sorted((i, j, 1.0, first, 12) for i, first in ((1, 0), (3, 30_000), (4, 0)) for j in (1, 4))
    kept = decontam.without_contaminated(frames[0].withColumns(clash), frames[1])
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == ["2", "None"]


@pytest.mark.parametrize("lane", [16, 32])
def test_rolled_fingerprints(spark, lane):
    rng = random.Random(5)
    rows = [([rng.choice("abcdefghij") for _ in range(n)], m) for n, m in ((40, 20), (5, 1), (7, 3), (9, 5), (3, 1), (30, 26))]
    df = spark.createDataFrame(rows, "w array<string>, m int").select("m", decontam.shingle_hashes("w", 5).alias("h"))
    for r in df.withColumn("fps", decontam.window_fingerprints(F.col("h"), F.col("m"), lane)).collect():
        expected = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r["h"][i : i + r["m"]]) > r["m"]) for i in range(len(r["h"]) - r["m"] + 1)]
        assert [x & (2**64 - 1) for x in r["fps"]] == expected


def test_blocks_find_all_within_the_radius(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(20)]
    rows = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 30))) for b in base for _ in range(20)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    items = spark.createDataFrame([(9, i, signed(b)) for i, b in enumerate(base)], "size int, item_no long, item_fp long")
    windows = spark.createDataFrame([(9, i, signed(b)) for i, b in enumerate(rows)], "size int, n long, fp long")
    for radius in (0, 7, 15, 23, 30, 64):
        near = decontam._probed(windows, radius).join(decontam._listed(items, radius), ["size", "block", "value"]).where(decontam._within(radius)).select("n", "item_no").collect()
        assert sorted(map(tuple, near)) == sorted((i, j) for i, x in enumerate(rows) for j, b in enumerate(base) if (x ^ b).bit_count() <= radius)
