"""Token counts, coding, sharding, language, fingerprints, personal data."""

import zlib

import brute
import pytest

from tidemark.llm import bpe_codec, langid, merkle, sharding, token_counts

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def docs(spark):
    return brute.table(spark).cache()


def by_row(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_codec(spark, docs):
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    got = bpe_codec.digests(bpe_codec.decode(bpe_codec.encode(docs, ranks, P.PATTERN), ranks, P.PATTERN)).collect()
    enc = bpe_codec.encoding(ranks, P.PATTERN)
    expected = []
    for i, t, _ in brute.TEXTS:
        ids = enc.encode_ordinary(t or "")
        expected.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t or "")))
    assert by_row(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert bpe_codec.encode(brute.empty(spark), ranks, P.PATTERN).count() == 0


def test_decode_takes_any_ids(spark):
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(1, [200, 3]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: bytes(r["bytes"]) for r in bpe_codec.decode(df, ranks, P.PATTERN).collect()}
    assert len(got[1]) >= 2 and got[2] == b"" and got[3] == b""


def test_safe_parts():
    from tidemark.llm.common import safe_parts

    text = "ab  cd\nef g" * 2000 + "x" * 3000 + " 12 " * 50
    enc = bpe_codec.encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    parts = list(safe_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 50
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


@pytest.mark.parametrize("block_chars", [1, 200, 10**7])
def test_token_counts(spark, docs, block_chars):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    got = token_counts.count_tokens(docs, path, P.PATTERN, ("<|endoftext|>",), block_chars=block_chars).collect()
    lib = Tokenizer.from_file(path)
    expected = [(i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in brute.TEXTS]
    assert by_row(got, "doc_id", "n_bytes", "n_tokens") == sorted(expected, key=repr)


def test_token_counts_empty(spark):
    assert token_counts.count_tokens(brute.empty(spark), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_sharding(spark, docs):
    placed, plan = sharding.assign(docs, 8)
    rows = placed.collect()
    assert len(rows) == len(brute.TEXTS) and plan.version == 2
    assert by_row(rows, "doc_id", "size", "text_crc32") == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in brute.TEXTS), key=repr)
    for shard in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))
    assert sharding.assign(brute.empty(spark), 8)[0].count() == 0


def test_slot_map_moves_little():
    sizes = {s: (s * 7919 % 1000) + 1 for s in range(4096)}
    even = sharding.SlotMap.even(8)
    now = even.rebalanced(sizes)
    load = [sum(sizes[s] for s in sizes if now.shard_of[s] == n) for n in range(8)]
    assert max(load) - min(load) <= 0.002 * sum(load) / 8 and len(now.moved) < 400
    more = now.grown(sizes)
    assert {more.shard_of[s] for s in more.moved} == {8} and more.version == 3
    own = sum(sizes[s] for s in sizes if more.shard_of[s] == 8)
    assert abs(own - sum(sizes.values()) / 9) < 0.01 * sum(sizes.values()) / 9


def test_slot_maps_are_kept(spark, docs, tmp_path):
    _, plan = sharding.assign(docs, 4, store=str(tmp_path / "maps"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps")).shard_of == plan.shard_of
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps"), 1).shard_of == sharding.SlotMap.even(4).shard_of
    _, later = sharding.assign(docs, 4, current=plan, store=str(tmp_path / "maps"))
    assert later.version == 3 and later.moved == ()


def test_sharding_near_equal(spark, sf):
    rows = sharding.assign(spark.read.parquet(f"{sf}/documents.parquet"), 8)[0].groupBy("shard").sum("size").collect()
    sizes = [r["sum(size)"] for r in rows]
    assert len(sizes) == 8 and max(sizes) < 1.25 * min(sizes)


def test_language(spark, docs, sf):
    rows = {r["doc_id"]: r for r in langid.identify(docs).where("doc_id is not null").collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (4, 5, 6, 7))
    assert rows[0]["held_out"] == (zlib.crc32(b"0") % 4 == 2)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert langid.identify(brute.empty(spark)).count() == 0
    real = spark.read.parquet(f"{sf}/documents.parquet")
    scored = langid.identify(real).join(real.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in scored) >= 0.97 * len(scored) > 20


def test_language_without_labels(spark, docs):
    from pyspark.sql import functions as F

    assert {r[0] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").collect()} == {"und"}
    assert {r["doc_id"] for r in langid.with_known_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()}.isdisjoint({4, 5, 6, 7})


def test_kernel_is_the_shared_share():
    import numpy as np

    model = langid.fit([("abcab", "x"), ("xyzxy", "y"), ("abc", "x")], n_landmarks=4)
    p = np.zeros((2, len(model.grams)), np.float32)
    for row, text in zip(p, ("abcab", "abc")):
        langid.presence(text, model.grams, model.table, row)
    grams = [{t[i : i + n] for n in langid.GRAMS for i in range(len(t) - n + 1)} for t in ("abcab", "abc")]
    normal = p[1:] / np.sqrt(p[1:].sum())
    assert abs(langid.kernel(p[:1], normal)[0, 0] - len(grams[0] & grams[1]) / (len(grams[0]) * len(grams[1])) ** 0.5) < 1e-6


@pytest.mark.parametrize("partitions", [1, 4])
def test_fingerprints(spark, docs, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = merkle.with_next(docs).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    order = sorted(((i, t or "") for i, t, _ in brute.TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        a, b = merkle.fingerprint(t), merkle.fingerprint(new)
        expected.append((i, t, new, a, b, merkle.likeness(a, b), merkle.likeness(a, merkle.fingerprint(after))))
    assert by_row(got, "doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == sorted(expected, key=repr)


def test_fingerprint_properties(spark):
    assert merkle.with_next(brute.empty(spark)).count() == 0
    a = "First line here. It goes on.\n\nSecond part. More of it.\nAnd a third."
    b = a.replace("More of it", "Less of it")
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert fa == merkle.fingerprint(a) and fa != merkle.fingerprint(a + " ")
    assert 0.5 < merkle.likeness(fa, fb) < 1 and merkle.likeness(fa, fa) == 1
    assert merkle.likeness(fa, fb) == merkle.likeness(fb, fa)
    assert merkle.differing(fa, fb) == [(1, 0)]
    assert merkle.likeness(merkle.fingerprint("other words entirely."), fa) == 0
    one = spark.createDataFrame([(1, "alone here")], "doc_id long, text string")
    assert merkle.with_next(one).first()["edited"] == "alone" + "alone"


def test_written_tables_can_be_cleared(spark):
    from tidemark.llm.common import clear_written, written

    df = written(spark.range(3).toDF("x"), "some")
    assert df.count() == 3 and clear_written(spark) > 0 and clear_written(spark) == 0
