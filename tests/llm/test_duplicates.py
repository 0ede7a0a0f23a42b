"""Near duplicates, repeats, decontamination, chats, the pipeline and the queries."""

import itertools
import os
import random

import brute
import pytest

from tidemark.llm import chat, decontam, simhash_dedup, substring_dedup


@pytest.fixture(scope="module")
def docs(spark):
    return brute.table(spark).cache()


def test_components_against_all_pairs(spark, docs):
    got = simhash_dedup.near_duplicates(docs).collect()
    own = {i: brute.simhash(t) for i, t, _ in brute.TEXTS if i is not None}
    of = brute.closed(own, lambda a, b: (own[a] ^ own[b]).bit_count() <= 3)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else of[r["doc_id"]])
        if r["doc_id"] is not None:
            assert r["fp"] & (2**64 - 1) == own[r["doc_id"]]
    assert len(got) == len(brute.TEXTS)
    assert simhash_dedup.near_duplicates(brute.empty(spark)).count() == 0
    kept = simhash_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").select("doc_id").distinct().collect()) == sorted(set(of.values()))


@pytest.mark.parametrize("tile", [3, 4096])
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_links_close_to_all_pairs(spark, radius, tile):
    rng = random.Random(radius)
    fps = set()
    for _ in range(25):
        centre = rng.getrandbits(64) & 0xFFFFFFFF00FFFFFF  # bits that never differ, and clusters
        for _ in range(rng.randint(1, 14)):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, id long")
    closed = {r["id"]: r["component"] for r in simhash_dedup.components(simhash_dedup.links(distinct, radius, tile=tile)).collect()}
    expected = brute.closed(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= radius)
    assert {i: closed.get(i, i) for i in expected} == expected


def test_allocation_keeps_the_guarantee():
    import numpy as np

    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500.0)
    for radius in range(7):
        for n in (10, 10**5, 10**9):
            plan = simhash_dedup.allocate(n, both * n / 1000, radius)
            assert sorted(itertools.chain(*plan.parts)) == list(range(64))
            assert sum(plan.thresholds) == radius - len(plan.parts) + 1


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)], "a long, b long")
    assert {r["component"] for r in simhash_dedup.components(edges).collect()} == {0}


@pytest.mark.parametrize("batch_bytes", [1, 300, 10**7])
def test_repeats(spark, docs, batch_bytes):
    rows = [(i, t) for i, t, _ in brute.TEXTS]
    got = substring_dedup.without_repeats(docs, batch_bytes=batch_bytes).collect()
    expected = [(i, *e) for (i, _), e in zip(rows, brute.repeats(rows))]
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr) == sorted(expected, key=repr)
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["first"] for s in r["repeats"])


@pytest.mark.parametrize("window", [2, 5, 13])
def test_repeats_at_random(spark, window):
    rng = random.Random(window)
    pool = [[rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))] for _ in range(6)]
    rows = [(i, " ".join(w for _ in range(rng.randint(0, 5)) for w in rng.choice(pool)[rng.randint(0, 8) :])) for i in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.without_repeats(df, window=window, batch_bytes=500).collect()}
    assert got == {i: e for (i, _), e in zip(rows, brute.repeats(rows, window))}


def test_repeats_of_nothing(spark):
    assert substring_dedup.without_repeats(brute.empty(spark)).count() == 0


def test_decontamination(spark, docs):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
    w = item.split()
    near = " ".join([*w[:-1], "changed"])  # loses one shingle of twenty
    far = " ".join("x" if i % 4 == 0 else x for i, x in enumerate(w))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (None, item), (5, "quite other words that no one says here")], "item_id long, text string")
    more = [(50, "before " + item.upper() + " after", "en"), (51, "so " + near, "en"), (52, far, "en"), (53, item.replace(" ", "\n\t"), "en"), (54, "ALPHA beta", "en")]
    df = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True)
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(df, bench).collect()}
    assert set(got) == {(50, 1), (51, 1), (53, 1), (9, 4)}
    assert got[50, 1]["similarity"] == 1 and got[50, 1]["first_word"] == 1 and abs(got[51, 1]["similarity"] - 19 / 21) < 1e-9
    kept = decontam.without_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == df.count() - 4
    assert decontam.contaminated(brute.empty(spark), bench).count() == 0
    assert decontam.contaminated(df, bench.where("false")).count() == 0


def test_decontamination_of_items_cut_at_an_edge(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    items, docs, expected = [], [], {}
    for i in range(240):
        n = (13, 30, 40, 50, 60, 200)[i % 6]
        w, c = [word() for _ in range(n)], (n - 4) // 9
        items.append((i, " ".join(w)))
        own = [word() for _ in range(c)] + w[c:] if i % 2 else w[:-c] + [word() for _ in range(c)]
        docs.append((i, " ".join([word(), *own, word()])))
        expected[i, i] = (n - 4 - c) / (n - 4 + c)
    assert all(x >= 0.8 for x in expected.values())
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.contaminated(*frames).collect()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_decontamination_without_broadcast(spark, sf):
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    one, two = (sorted(map(tuple, decontam.contaminated(d, b, broadcast_rows=n).collect())) for n in (10**6, 0))
    assert one == two


def test_chats(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    got, true = {}, {}
    for r in chat.format_chats(c).orderBy("id", "part", "turn").collect():
        got.setdefault(r["id"], []).append((r["role"], r["content"]))
        assert r["rendered"].startswith(f"<|{r['role']}|>\n") and r["rendered"].endswith("<|end|>\n")
    for r in c.orderBy("conv_id", "turn").collect():
        true.setdefault(r["conv_id"], []).append((r["role"], r["text"].strip()))
    assert sum(got[k] == true[k] for k in true) >= 0.95 * len(true)


def test_chats_in_parts_are_one(spark, sf):
    raw = chat.transcripts(spark.read.parquet(f"{sf}/conversations.parquet"))
    model = chat.fit(raw)
    text = "\n\n".join(r["text"] for r in raw.orderBy("id").limit(12).collect())
    blocks = text.split("\n\n")
    cut = [(1, i // 3, "\n\n".join(blocks[i : i + 3])) for i in range(0, len(blocks), 3)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, part long, text string")
    whole = [r["role"] for r in chat.parse(frame([(1, 0, text)]), model).orderBy("turn").collect()]
    parts = [r["role"] for r in chat.parse(frame(cut), model).orderBy("part", "turn").collect() if not r["continued"]]
    assert whole == parts


def test_chats_odd(spark):
    rows = [(1, 0, "user", "Hi?"), (1, 0, "user", "Hi?"), (1, 1, "assistant", None), (1, 2, "assistant", "Fine <|user|> x"), (None, 0, "user", "lost"), (2, None, None, "text"), (3, 0, "other", ""), (4, 0, "user", "long " * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df).collect()
    assert {1, 2, 4} <= {r["id"] for r in out} <= {1, 2, 3, 4}
    assert all("<|user|> x" not in r["rendered"] for r in out)
    assert chat.format_chats(df.where("false")).count() == 0


def test_queries_run_whole(spark, sf):
    import duckdb

    from tidemark.llm import queries

    known = queries.queries()
    assert sorted(int(k[2:].split("_")[0]) for k in known) == list(range(1, 11))
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, f in known.items():
        rows = f(spark, sf)
        if name.startswith(("op1_", "op3_")):
            assert rows.count() > 0
        else:
            assert rows.count() == n, name
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = known[name](spark, sf)
        result = duck.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(map(tuple, df.select(*names).collect())) == sorted(result.fetchall())


def test_pipeline(spark, sf):
    if not os.path.exists(os.path.join(os.path.dirname(__file__), "..", "..", "corpus_pipeline.py")):
        pytest.skip("no corpus_pipeline.py")
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    own = docs
    for name, stage in p.STAGES[:-1]:
        own = p.written(stage(spark, own, sf), name)
        assert own.columns == docs.columns
        if name == "language_id":
            assert own.count() == sum(any(map(str.isalpha, t or "")) for t in rows.values())
    ids = [r["doc_id"] for r in own.select("doc_id").collect()]
    texts = [rows[i] for i in ids]
    assert len(texts) == len(set(texts)) and len(ids) > 0.5 * len(rows)
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(x in t for t in texts for x in items)
    for r in own.collect():
        assert brute.base_spans(r["text"]) == "" and r["n_chars"] == len(r["text"])
    out = p.run(spark, sf)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(ids)


def test_pipeline_odd(spark, docs, sf):
    import corpus_pipeline as p

    for frame in (docs, brute.empty(spark)):
        own = frame.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in p.STAGES:
            own = p.written(stage(spark, own, sf), name)
            own.count()


def jaccard_groups(rows, k=5):
    sets = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    return brute.closed(sets, lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0)


def test_near_copies_odd(spark, docs):
    got = simhash_dedup.similar_groups(docs).collect()
    of = jaccard_groups([(i, t) for i, t, _ in brute.TEXTS])
    assert len(got) == len(brute.TEXTS)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else of[r["doc_id"]])
    kept = simhash_dedup.without_near_copies(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 2").count() == 0 and kept.where("doc_id is null").count() == 2
    assert simhash_dedup.similar_groups(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("tile", [5, 4096])
def test_near_copies_of_edited_texts(spark, tile):
    rng = random.Random(tile)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 60))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    expected = jaccard_groups(rows)
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()}
    assert sum(got[i] == expected[i] for i in got) >= 0.95 * len(got)
    assert all(expected[i] == expected[got[i]] for i in got)  # nothing is joined that isn't linked


def test_near_copies_cut_or_continued(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for i in range(150):
        w = [word() for _ in range(rng.randint(60, 400))]
        short = len(w) - (len(w) - 4) // (5 if i % 3 else 9)  # similarity 0.8 or 0.89
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:short] if i % 2 else w[-short:]))]
    expected = jaccard_groups(rows)
    assert all(expected[2 * i + 1] == 2 * i for i in range(150))
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def test_near_copies_within_families_of_similar_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows, pairs = [], []
    for _ in range(8):
        shared = [word() for _ in range(170)]
        members = [[*shared, *(word() for _ in range(35))] for _ in range(60)]  # 0.70 from each other
        a, b = rng.sample(range(60), 2)
        members[b] = [*members[a][:188], *(word() for _ in range(17))]  # 0.84 from a
        pairs.append(sorted((len(rows) + a, len(rows) + b)))
        rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate(members)]
    expected = jaccard_groups(rows)
    assert [i for i in expected if expected[i] != i] == [b for _, b in pairs]
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def test_forest_is_least():
    import numpy as np

    rng = np.random.default_rng(1)
    n = 40
    a, b = rng.integers(0, n, 300), rng.integers(0, n, 300)
    keep = a != b
    a, b, w = a[keep], b[keep], rng.integers(0, 9, 300)[keep]
    chosen = simhash_dedup.forest(n, a, b, w)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    total = count = 0
    for i in np.argsort(w, kind="stable"):
        x, y = find(a[i]), find(b[i])
        if x != y:
            parent[max(x, y)] = min(x, y)
            total, count = total + w[i], count + 1
    assert len(chosen) == count and w[chosen].sum() == total
