from __future__ import annotations

import random
import re

import numpy as np
import pytest

from grainflow.llm.history import History, batch_by_batch, refused
from grainflow.llm.near_dups import class_ids, components, id_pairs, least_matches, miss_shares, near_duplicates, prune_loss
from grainflow.llm.neighbours import nearest, similar_pairs

WORD = re.compile(r"[^\W_]+")


def shingles(t):
    w = WORD.findall((t or "").lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 20 else set()


def overlap(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def texts(seed, groups=12, copies=5):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(25, 120))
        for c in range(copies):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 5, 9))):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w) if c else "<p>" + ", ".join(w).upper())
    rng.shuffle(out)
    return out


def test_near_duplicates_against_all_pairs(spark):
    rows = [(f"d{k}", t, "x", k) for k, t in enumerate(texts(1))]
    rows += [rows[3], ("d3", rows[3][1], "other", 99), ("n", None, "x", 1), ("e", "", "x", 1), ("s", "too short to count", "x", 1), (None, rows[0][1], "x", 2), ("long", "word " * 30_000, "x", 3)]
    # further columns have the names the operator uses within
    df = spark.createDataFrame(rows, "id string, text string, key string, cls int")
    found = near_duplicates(df, "id", "text", 0.5)
    s = {r[0]: shingles(r[1]) for r in rows if r[0]}
    ids = sorted(s)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if overlap(s[a], s[b]) >= 0.5}
    assert {(r["id_a"], r["id_b"]) for r in id_pairs(found).collect()} == want
    members = {r["key"]: r for r in class_ids(found).collect()}
    assert set(members) == {k for k in s if s[k]}
    for a in members:
        assert members[a]["copies"] == sum(s[a] == s[b] for b in members)
        assert members[a]["links"] == len({frozenset(s[b]) for b in members if s[b] != s[a] and overlap(s[a], s[b]) >= 0.5})
        assert members[a]["cls"] == min(b for b in members if s[b] == s[a])
        reached, open_ = {a}, [a]
        while open_:
            x = open_.pop()
            more = {b for b in members if b not in reached and overlap(s[x], s[b]) >= 0.5}
            reached |= more
            open_ += more
        assert members[a]["grp"] == min(reached)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id string, text string")
    assert id_pairs(near_duplicates(df, "id", "text")).count() == 0
    assert refused(spark.createDataFrame([], "seq bigint, text string"), df, "seq", ["seq"], "text", "id").count() == 0


def test_bounds_grow_with_what_was_compared():
    steps = least_matches(0.5)
    assert [n for n, _ in steps] == sorted(n for n, _ in steps)
    assert all(m < n * 0.5 for n, m in steps)


def brute_refused(rows, history, t):
    have, bad = [shingles(x) for x in history], set()
    for seq, _, text in sorted(rows, key=lambda r: (r[1], r[0])):
        s = shingles(text)
        if any(overlap(s, h) >= t for h in have):
            bad.add(seq)
        elif s:
            have.append(s)
    return bad


def test_batches_against_history(spark, tmp_path):
    all_texts = texts(2, groups=14, copies=6)
    history, new = all_texts[:25], all_texts[25:]
    rows = [(k, 1 + k % 3, t) for k, t in enumerate(new)] + [(900, 1, None), (901, 2, ""), (902, 3, new[0]), (903, 1, "few words")]
    h = spark.createDataFrame([(f"h{k}", t) for k, t in enumerate(history)] + [("hn", None)], "id string, text string")
    b = spark.createDataFrame(rows, "seq bigint, batch_no int, text string")
    want = brute_refused(rows, history, 0.5)
    got = {r["seq"] for r in refused(b, h, "seq", ["batch_no", "seq"], "text", "id", 0.5).collect()}
    assert got == want
    # batch after batch over a table that only grows
    store = History(spark, str(tmp_path / "store"), 0.5)
    store.append(h, "id", "text")
    one = set()
    for n in (1, 2, 3):
        part = b.where(b.batch_no == n)
        bad = {r["seq"] for r in store.check(part, "seq", "text", ["seq"]).collect()}
        one |= bad
        store.append(part.where(~part.seq.isin(list(bad) or [-1])), "seq", "text")
    assert one == want
    assert {(r["batch_no"], r["seq"]) for r in batch_by_batch(b, h, "batch_no", "seq", ["seq"], "text", "id", 0.5).collect()} == {(r[1], r[0]) for r in rows if r[0] in want}


def test_the_table_keeps_what_was_appended(spark, tmp_path):
    """A check reads only the folders of the ranges within reach, and old texts only where no sets are kept."""
    old = spark.createDataFrame([(f"s{k}", " ".join(f"a{k}x{j}" for j in range(30))) for k in range(5)] + [(f"l{k}", " ".join(f"b{k}x{j}" for j in range(3000))) for k in range(5)], "id string, text string")
    store = History(spark, str(tmp_path / "h"), 0.8)
    for part in ("id < 'm'", "id > 'm'"):
        store.append(old.where(part), "id", "text")
    assert store.table().count() == 10 and store.table().select("size").distinct().count() >= 2
    new = spark.createDataFrame([(1, " ".join(f"a3x{j}" for j in range(30)) + " more"), (2, " ".join(f"c{j}" for j in range(30)))], "seq bigint, text string")
    assert [r["seq"] for r in store.check(new, "seq", "text", ["seq"]).collect()] == [1]
    bare = History(spark, str(tmp_path / "b"), 0.8, sets=False)
    bare.append(old, "id", "text")
    assert [r["seq"] for r in bare.check(new, "seq", "text", ["seq"], (old, "id", "text")).collect()] == [1]
    assert bare.check(new.limit(0), "seq", "text", ["seq"], (old, "id", "text")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(40)] + [(300, 200 + k) for k in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        if a != b:
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_band_that_a_third_of_the_texts_share(spark, monkeypatch):
    """Pages of one template: hot bands are split, and no pair is lost."""
    from grainflow.operators import places

    monkeypatch.setattr(places, "SAMPLE", 1)
    monkeypatch.setattr(places.bucket_pairs, "__defaults__", ((), 10, None))
    rng = random.Random(3)
    frame = [f"t{j}" for j in range(40)]
    rows = [(f"p{k:02d}", " ".join(frame + [f"u{rng.randrange(10**6)}" for _ in range(rng.choice((10, 60)))])) for k in range(40)] + [(f"q{k:02d}", " ".join(f"v{rng.randrange(10**6)}" for _ in range(50))) for k in range(60)]
    s = {k: shingles(t) for k, t in rows}
    want = {(a, b) for a in s for b in s if a < b and overlap(s[a], s[b]) >= 0.5}
    assert {(r["id_a"], r["id_b"]) for r in id_pairs(near_duplicates(spark.createDataFrame(rows, "id string, text string"), "id", "text", 0.5)).collect()} == want


def vectors(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(20, dim))
    return [(f"v{k:03d}", (base[k % 20] + rng.normal(size=dim) * 0.35).astype("<f4")) for k in range(n)]


def brute_nearest(vs, k, least):
    ids = [i for i, _ in vs]
    x = np.array([v for _, v in vs], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = set()
    for i in range(len(ids)):
        s = np.round(x @ x[i], 5)
        s[i] = -2
        order = sorted(range(len(ids)), key=lambda j: (-s[j], ids[j]))[:k]
        out |= {tuple(sorted((ids[i], ids[j]))) for j in order if s[j] >= least}
    return out


@pytest.mark.parametrize(("relax", "floor"), [(1.0, 0.99), (8.0, 0.9)])
def test_nearest_vectors(spark, relax, floor):
    vs = vectors(3)
    vs += [("w1", vs[5][1] * 2), ("w2", vs[5][1])]  # length doesn't matter: copies
    bad = [("b1", None), ("b2", b"abc"), ("b3", np.zeros(16, "<f4").tobytes()), ("b4", np.full(16, np.nan, "<f4").tobytes()), (None, vs[0][1].tobytes())]
    rows = [(i, v.tobytes(), 1) for i, v in vs] + [(i, v, 2) for i, v in bad] + [(vs[7][0], vs[7][1].tobytes(), 3)]
    df = spark.createDataFrame(rows, "id string, emb binary, h int")
    got = nearest(df, "id", "emb", 5, 0.7, relax, dim=16, points=40, shards=5)
    pairs = {(r["id_a"], r["id_b"]) for r in similar_pairs(got).collect()}
    want = brute_nearest(vs, 5, 0.7)
    assert len(pairs & want) >= floor * len(want)
    assert len(pairs - want) <= (1 - floor) * len(want) + 1
    assert not {x for p in pairs for x in p} & {"b1", "b2", "b3", "b4", None}


def test_many_copies_of_one_vector(spark):
    v = np.ones(16, "<f4").tobytes()
    df = spark.createDataFrame([(f"c{k:03d}", v) for k in range(60)], "id string, emb binary")
    got = {}
    for r in nearest(df, "id", "emb", 5, dim=16).collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert sorted(got["c030"]) == [f"c{k:03d}" for k in range(5)]
    assert sorted(got["c002"]) == ["c000", "c001", "c003", "c004", "c005"]
    assert nearest(df.limit(0), "id", "emb", dim=16).count() == 0


@pytest.mark.parametrize(("relax", "floor"), [(1.0, 0.99), (8.0, 0.6)])
def test_loners_have_neighbours_too(spark, relax, floor):
    rng = np.random.default_rng(8)
    vs = vectors(5, 200) + [(f"x{k}", rng.normal(size=16).astype("<f4")) for k in range(40)]
    df = spark.createDataFrame([(i, v.tobytes()) for i, v in vs], "id string, emb binary")
    got = nearest(df, "id", "emb", 5, relax=relax, dim=16, points=40, shards=5)
    ranks = {}
    for r in got.collect():
        ranks.setdefault(r["id"], []).append(r["rank"])
    assert {i: sorted(x) for i, x in ranks.items()} == {i: [1, 2, 3, 4, 5] for i, _ in vs}
    pairs = {(r["id_a"], r["id_b"]) for r in similar_pairs(got).collect()}
    want = brute_nearest(vs, 5, -1)
    assert len(pairs & want) >= floor * len(want)


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8])
def test_bands_and_pruning_lose_no_more_than_miss(threshold):
    (rows, bands), prune = miss_shares(threshold, 0.001)
    assert (1 - threshold**rows) ** bands + prune_loss(threshold, prune) <= 0.001


def test_bands_propose_pairs_at_the_threshold(spark):
    """2000 pairs of overlap 0.5: 3 rows x 32 bands lost some 1.4 % of them."""
    rng, rows = random.Random(4), []
    for k in range(2000):
        w = [f"w{rng.randrange(10**6)}" for _ in range(32)]
        rows += [(f"a{k}", " ".join(w[:25])), (f"b{k}", " ".join(w[:18] + w[25:]))]  # 14 of 28 shingles
    want = {(f"a{k}", f"b{k}") for k in range(2000) if overlap(shingles(rows[2 * k][1]), shingles(rows[2 * k + 1][1])) >= 0.5}
    got = {(r["id_a"], r["id_b"]) for r in id_pairs(near_duplicates(spark.createDataFrame(rows, "id string, text string"), "id", "text", 0.5)).collect()}
    assert len(want) == 2000 and got <= want and len(got) >= 1990


def test_both_sides_of_a_hot_shard_are_split(spark, monkeypatch):
    """A dense area of more vectors than a slice holds, asked by more queries than a task answers."""
    import grainflow.llm.neighbours as N

    monkeypatch.setattr(N, "SLICE", 40)
    monkeypatch.setattr(N, "QUERIES", 60)
    monkeypatch.setattr(N, "SAMPLE", 1)
    monkeypatch.setattr(N, "LEAF", 8)
    vs = vectors(9, 400)
    df = spark.createDataFrame([(i, v.tobytes()) for i, v in vs], "id string, emb binary")
    got = nearest(df, "id", "emb", 5, relax=1.0, dim=16, points=30, shards=3)
    assert got.count() == 2000
    pairs, want = {(r["id_a"], r["id_b"]) for r in similar_pairs(got).collect()}, brute_nearest(vs, 5, -1)
    assert len(pairs & want) >= 0.99 * len(want)
