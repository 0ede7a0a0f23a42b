"""The law, places and slots of shards against an independent count, and many null ids."""

import hashlib
import zlib
from collections import Counter, defaultdict

from tidemark.llm import sharding


def test_law_places_and_slots(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    placed, plan = sharding.assign(docs, 8)
    rows = placed.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(text.keys())
    load, places, slots = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["vslot"] == int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:8], 16) % sharding.N_SLOTS
        assert r["shard"] == plan.shard_of[r["vslot"]]
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        slots[r["vslot"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in places.values()) and all(len(x) == 1 for x in slots.values())
    # near equal: no shard is above the mean by more than the largest slot
    by_slot = Counter()
    for r in rows:
        by_slot[r["vslot"]] += r["size"]
    assert max(load[s] for s in range(8)) - sum(load.values()) / 8 <= max(by_slot.values())


def test_null_ids_are_spread(spark):
    rows = [(None, f"text {i}") for i in range(500)] + [(None, None)] * 3 + [(1, "a")] * 3
    out = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4)[0].collect()
    assert len(out) == len(rows) and len({r["vslot"] for r in out if r["doc_id"] is None}) > 400
    assert len({r["vslot"] for r in out if r["doc_id"] == 1}) == 1
    for shard in range(4):
        own = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert own == list(range(len(own)))
