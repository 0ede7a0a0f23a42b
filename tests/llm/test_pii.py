"""Personal data: base spans and redaction against plain versions, the selection, and what is learned."""

import os
import random
import time

import brute
import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import pii


def by_row(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return brute.table(spark).cache()


@pytest.fixture(scope="module")
def real(spark, sf):
    return spark.read.parquet(os.path.join(os.path.dirname(sf), "sf0.01", "documents.parquet"))


@pytest.fixture(scope="module")
def model(spark, real):
    return pii.fit(real)


ODD = [
    "a@b.c_d@e.f x@y a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0000000000000000255.1.1.1", "+1 (555) 010-9999 and +12 and +1+2", "4111 1111 1111 1111 4111-1111-1111-1112",
    "é€😀 x.y@z.org +49 170 1234567", "9" * 300 + ".1.2.3", "a@b." * 600, "1 " * 3000, "x" * 20000 + "@y.zz", "- 5-5-5 -", "@", "+", "a.b@c-d.e.f-g.", " ".join(f"u{i}@h{i}.org" for i in range(1500)),
]


def test_personal_data(spark, docs, model):
    rows = [(i, t) for i, t, _ in brute.TEXTS] + [(100 + i, t) for i, t in enumerate(ODD)]
    extra = spark.createDataFrame([(100 + i, t, "en") for i, t in enumerate(ODD)], "doc_id long, text string, lang string")
    found = pii.find(docs.unionByName(extra, allowMissingColumns=True), model).select("doc_id", pii.shown("_base").alias("base"), pii.shown("_spans").alias("spans")).collect()
    assert by_row(found, "doc_id", "base") == sorted(((i, brute.base_spans(t)) for i, t in rows), key=repr)
    for r in found:
        assert set(r["base"].split(",")) <= set(r["spans"].split(",")) or not r["base"]


def test_personal_data_adds_likely_spans(spark, model):
    texts = ["call me at (555) 123-4567.", "the total was 100-200-300 in all", "ann.lee (at) mail (dot) com wrote", "SSN 123-45-6789 is his", "version 2024.01.02 came"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: r["s"] for r in pii.find(df, model).select("doc_id", pii.shown("_spans").alias("s")).collect()}
    assert spans[0].startswith("phone:11:") and spans[1] == "" and spans[2].startswith("email:0:") and spans[3].startswith("ssn:4:15") and spans[4] == ""


def test_redaction(spark, docs, model):
    got = {r["doc_id"]: r for r in pii.redacted(docs, model).collect()}
    assert got[12]["text"] == "mail [EMAIL] or [PHONE], host [IP], card [CARD] <|endoftext|> ok"
    assert got[4]["text"] is None and got[0]["text"] == brute.TEXTS[0][1] and got[0]["a.b"] == "x"


def test_learned_from_documents(spark, real, model):
    """What is planted in the documents and no base pattern finds: assigned keys of 40 hexadecimal digits."""
    planted = {(r["doc_id"], m.start(1), m.end(1)) for r in real.collect() for m in regex.finditer(r'(?i)token = "([0-9a-f]{40})"', r["text"] or "")}
    rows = pii.find(real, model).select("doc_id", "_spans").collect()
    found = {(r["doc_id"], s["start"], s["end"]) for r in rows for s in r["_spans"] if pii.KINDS[s["kind"]] == "secret"}
    assert planted and found == planted
    for kind, n, right, precision, recall in model.report:
        assert n >= right and (precision is None or precision >= 0.9) and (right < 5 or recall >= 0.9), kind
    again = pii.fit(real.repartition(7))
    assert again.trees == model.trees and again.thresholds == model.thresholds


def test_nothing_to_learn_from(spark):
    model = pii.fit(brute.empty(spark))
    assert len(model.trees) > 0 and pii.find(brute.empty(spark), model).count() == 0
    assert all(n == 0 and precision is None for _, n, _, precision, _ in model.report)


def test_selection_of_overlapping_spans(spark, model):
    rng = random.Random(9)
    pieces = ["4111111111111111", "4111 1111 1111 1111", "tel 555-123-4567", "token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\"", "IBAN DE89 3704 0044 0532 0130 00", "SSN 123-45-6789", "u@v.org", "+1 555 010 9999", "10.0.0.1", "ann (at) web (dot) com", "x", "12", "-", "(", "2024-01-02"]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice([" ", " ", "", ". "]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    proposed = pii._proposals(F.col("text"))
    got = pii.find(df, model).select("doc_id", "text", "_base", "_spans", proposed.alias("proposed"), pii._selected(proposed, model).alias("chosen")).collect()
    n_dropped = 0
    for r in got:
        for g, (_, needs, pattern) in enumerate(pii.GENERATORS):
            expected = [(m.start(), m.end()) for m in regex.finditer(pattern, r["text"])] if regex.search(needs, r["text"]) else []
            assert [(x["start"], x["end"]) for x in r["proposed"] if x["generator"] == g] == expected
        spans = [(s["start"], s["kind"], s["end"]) for s in r["_base"]]
        for g in range(len(pii.GENERATORS)):
            taken = list(spans)
            for x in (x for x in r["chosen"] if x["generator"] == g):
                if all(x["end"] <= a or b <= x["start"] for a, _, b in taken):
                    spans.append((x["start"], x["kind"], x["end"]))
                else:
                    n_dropped += 1
        assert sorted(spans) == [(s["start"], s["kind"], s["end"]) for s in r["_spans"]]
    assert n_dropped > 20


def test_largest_before(spark):
    rng = random.Random(2)
    rows = [([rng.randint(0, 1000) for _ in range(n)],) for n in (0, 1, 2, 63, 64, 65, 128, 300)]
    for r in spark.createDataFrame(rows, "v array<int>").select("v", pii.largest_before(F.col("v")).alias("m")).collect():
        assert r["m"] == [max(r["v"][:i], default=-1) for i in range(len(r["v"]))]


def test_many_numbers_in_one_text(spark, model):
    def took(n):
        df = spark.createDataFrame([(1, "4111111111111111 4111111111111111 call me at (555) 123-4567. y " * n)], "doc_id long, text string")
        start = time.perf_counter()
        assert len(pii.redacted(df, model).first()["text"]) == len("[CARD] [CARD] call me at [PHONE]. y ") * n
        return time.perf_counter() - start

    took(1)
    fixed, some, many = took(1), took(1500), took(6000)  # 18,000 numbers
    assert many - fixed < 3 * 4 * max(some - fixed, 1)  # sixteen times, if it were quadratic


def test_account_check_digits(spark):
    rows = [("DE89 3704 0044 0532 0130 00", True), ("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False), ("", False)]
    assert [(r["v"], r["ok"]) for r in spark.createDataFrame(rows, "v string, ok boolean").select("v", pii.mod97(F.col("v")).alias("ok")).collect()] == rows
