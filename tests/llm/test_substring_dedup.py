"""Repeats: words and windows that hashes must tell apart, and odd tables."""

import brute
import pytest

from tidemark.llm import substring_dedup



def thue_morse(n, first):
    return "".join("ab"[(i.bit_count() + first) % 2] for i in range(n))


@pytest.mark.parametrize("batch_bytes", [1, 10**7])
def test_repeats_are_of_equal_words_only(spark, batch_bytes):
    # sums of letters times powers modulo 2**64 cannot tell these two words apart
    tail = " ".join(f"w{i}" for i in range(12))
    rows = [(1, thue_morse(2048, 0) + " " + tail), (2, thue_morse(2048, 1) + " " + tail), (3, tail), (4, thue_morse(2048, 1) + " " + tail + " more")]
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), batch_bytes=batch_bytes).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 13}


def test_windows_are_compared_by_both_halves(spark):
    import numpy as np
    import pyarrow as pa

    def row(doc, *keys):
        z = substring_dedup._zip
        return (0, z([doc]), z([len(keys)]), z(range(len(keys))), np.array(keys, "<u8").tobytes())

    rows = [row(1, (5, 6), (7, 8)), row(2, (5, 9), (7, 8)), row(3, (4, 6), (5, 9))]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["home", "doc_ids", "sizes", "places", "keys"])
    found = {}
    for out in substring_dedup._repeated(4)(iter([batch])):
        for ids, sizes, starts in zip(*(out.column(i).to_pylist() for i in (1, 2, 3))):
            for doc, place in zip(np.repeat(substring_dedup._unzip(ids), substring_dedup._unzip(sizes)), substring_dedup._unzip(starts)):
                found.setdefault(int(doc), []).append(int(place))
    assert found == {2: [1], 3: [1]}


def test_repeats_of_hostile_tables(spark):
    rows = [(None, None)] * 20 + [(i, None) for i in range(5)] + [(5, "x" * 3_000_000 + " " + "y " * 30), (6, "y " * 30), (7, "\x00 " * 20), (8, "\x00\x01 " * 20)]
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = [(i, *e) for (i, _), e in zip(rows, brute.repeats(rows))]
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr) == sorted(expected, key=repr)
