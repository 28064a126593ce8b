from __future__ import annotations

import numpy as np
import pytest

from grainflow.operators.dedup import cosine_pairs, nearest_prior, online_dedup

SCHEMA = "seq bigint, doc_id string, emb array<float>, sig array<bigint>, other string"


def brute(rows, threshold=0.9, surface=0.5):
    """One document after the other."""
    kept, gone = [], {}
    for seq, _, e, sig, _ in sorted(rows, key=lambda r: r[0]):
        if e is None or not np.any(e):
            continue
        e = np.asarray(e, np.float32).astype(float)
        e = e / np.linalg.norm(e)
        best = None
        for k, v, s in kept:
            sim = round(float(e @ v), 12)
            if best is None or sim > best[0]:
                best = (sim, k, s)
        if best and best[0] >= threshold and (sig is None or best[2] is None or np.mean(np.array(sig) == np.array(best[2])) >= surface):
            gone[seq] = best[1]
        else:
            kept.append((seq, e, sig))
    return gone


def rows_of(seed, n=120, dim=8, with_sig=True):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(10, dim))
    out = []
    for k in range(n):
        e = base[rng.integers(10)] + rng.normal(size=dim) * 0.15
        sig = [int(x) for x in rng.integers(0, 2, 8)] if with_sig and rng.random() < 0.9 else None
        out.append((k, f"d{k}", [float(x) for x in e], sig, "x"))
    out += [(n, "null", None, None, None), (n + 1, "zero", [0.0] * dim, None, None), (n + 2, "again", out[0][2], out[0][3], "x")]
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_matches_one_after_the_other(spark, seed):
    rows = rows_of(seed)
    got = online_dedup(spark.createDataFrame(rows, SCHEMA), "seq", "emb", "sig").where("neighbour is not null").collect()
    assert {r["seq"]: r["neighbour"] for r in got} == brute(rows)


def test_cosine_only(spark):
    rows = rows_of(3, with_sig=False)
    got = online_dedup(spark.createDataFrame(rows, SCHEMA), "seq", "emb").where("neighbour is not null").collect()
    assert {r["seq"]: r["neighbour"] for r in got} == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_copies_are_nodes(spark, seed):
    """A third of the rows are copies of one document, others of a few, some with its vector but another signature."""
    rng = np.random.default_rng(seed)
    base = rows_of(seed, 40)[:40]
    rows = []
    for k in range(150):
        b = base[0] if rng.random() < 0.34 else base[rng.integers(12)] if rng.random() < 0.5 else base[rng.integers(40)]
        sig = [9] * 8 if rng.random() < 0.15 else b[3]
        rows.append((k, f"d{k}", b[2], sig, "x"))
    got = online_dedup(spark.createDataFrame(rows, SCHEMA), "seq", "emb", "sig").where("neighbour is not null").collect()
    assert {r["seq"]: r["neighbour"] for r in got} == brute(rows)


def test_hot_buckets_and_places_are_split(spark, monkeypatch):
    from grainflow.operators import dedup, places

    x = spark.createDataFrame([(k, k % 3 if k % 2 else 0) for k in range(300)], "node bigint, bucket int")
    rows = x.collect()
    want = {(a["node"], b["node"]) for a in rows for b in rows if a["node"] < b["node"] and a["bucket"] == b["bucket"]}
    monkeypatch.setattr(places, "SAMPLE", 2)
    for hot in (20, 10**6):
        got = [(r["a"], r["b"]) for r in places.bucket_pairs(x, ["bucket"], "node", hot=hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    monkeypatch.setattr(dedup, "SLICE", 7)
    monkeypatch.setattr(dedup, "QUERIES", 11)
    monkeypatch.setattr(dedup, "SAMPLE", 1)
    e = np.random.default_rng(2).normal(size=(200, 4))
    df = spark.createDataFrame([(k, [float(v) for v in y]) for k, y in enumerate(e)], "seq bigint, emb array<double>")
    u = e / np.linalg.norm(e, axis=1, keepdims=True)
    want = {(i, j) for i, j in np.argwhere(np.tril(u @ u.T, -1) >= 0.7)}
    assert {(r["i"], r["j"]) for r in cosine_pairs(df, "seq", "emb", 0.7, pivots=6).collect()} == want


def test_second_nearest_does_not_reject(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(1, "a", [0.97, 0.2, 0.0], [1, 1], None), (2, "b", [0.99, -0.1, 0.0], [2, 2], None), (3, "c", e, [1, 1], None)]
    got = {r["doc_id"]: r["neighbour"] for r in online_dedup(spark.createDataFrame(rows, SCHEMA), "seq", "emb", "sig").collect()}
    assert got == {"a": None, "b": None, "c": None}


def test_pairs_are_exact_and_empty_is_empty(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6))
    df = spark.createDataFrame([(k, [float(v) for v in e]) for k, e in enumerate(x)], "seq bigint, emb array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i, j in np.argwhere(np.tril(u @ u.T, -1) >= 0.85)}
    assert {(r["i"], r["j"]) for r in cosine_pairs(df, "seq", "emb", 0.85, pivots=20).collect()} == want
    assert cosine_pairs(df.limit(0), "seq", "emb", 0.9).count() == 0
    near = {r["i"]: r["neighbour"] for r in nearest_prior(df, "seq", "emb", block=64).collect()}
    s = np.where(np.tril(np.ones((400, 400)), -1) > 0, u @ u.T, -2)
    assert near == {i: int(s[i].argmax()) for i in range(1, 400)}


def test_queries_are_sent_to_blocks_where_angles_exclude_nothing(spark, monkeypatch):
    """Far vectors and a wide radius: a row is sent as often as there are blocks or copies, not cells."""
    from grainflow.operators import dedup

    sent = []
    inner = dedup.per_place
    monkeypatch.setattr(dedup, "per_place", lambda df, *a, **k: sent.append(df.count()) or inner(df, *a, **k))
    monkeypatch.setattr(dedup, "SLICE", 100)
    monkeypatch.setattr(dedup, "MEASURED", 50)
    monkeypatch.setattr(dedup, "SAMPLE", 1)
    x = np.random.default_rng(7).normal(size=(600, 64))
    x[300:] = x[:300] + 0.3 * x[300:]
    df = spark.createDataFrame([(k, [float(v) for v in e]) for k, e in enumerate(x)], "seq bigint, emb array<float>")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = {(i, j) for i, j in np.argwhere(np.tril(u @ u.T, -1) >= 0.5)}
    got = [(r["i"], r["j"]) for r in cosine_pairs(df, "seq", "emb", 0.5).collect()]
    assert len(got) == len(want) >= 300 and set(got) == want
    assert sent[0] <= 600 * 20


def test_runs_of_an_experiment_are_settled_at_once(spark, monkeypatch):
    from grainflow.operators import evaluation

    calls = []
    inner = evaluation.settle
    monkeypatch.setattr(evaluation, "settle", lambda *a, **k: calls.append(1) or inner(*a, **k))
    rows = [(k, f"d{k}", e, sig, str(k % 15)) for k, _, e, sig, _ in rows_of(4, 60)[:60]]
    rows = [(k, d, e, sig or [0] * 8, g) for k, d, e, sig, g in rows]
    df = spark.createDataFrame(rows, SCHEMA)

    def brute_of(verify, threshold, part=lambda r: 0):
        return sum(len(brute([(r[0], r[1], r[2], r[3] if verify else None, r[4]) for r in rows if part(r) == p], threshold)) for p in {part(r) for r in rows})

    got = evaluation.threshold_sweep(df, "seq", "other", "emb", (0.8, 0.9, 0.999)).collect()
    assert [(r["threshold"], r["dropped"], r["dups"]) for r in got] == [(t, brute_of(False, t), 45) for t in (0.8, 0.9, 0.999)]
    got = evaluation.false_drops(df, "seq", "emb", "sig").collect()
    assert {r["mode"]: r["drops"] for r in got} == {"cosine": brute_of(False, 0.9), "verified": brute_of(True, 0.9)}
    got = evaluation.recall_by_partitions(df, "seq", "doc_id", "other", "emb", "sig", (1, 2)).collect()
    import hashlib

    two = lambda r: int(hashlib.md5(r[1].encode()).hexdigest(), 16) % 2
    band = lambda r: int(hashlib.md5(int(r[3][0]).to_bytes(8, "little")).hexdigest(), 16) % 2
    want = [("doc_id", 1, brute_of(False, 0.9)), ("doc_id", 2, brute_of(False, 0.9, two)), ("minhash", 1, brute_of(True, 0.9)), ("minhash", 2, brute_of(True, 0.9, band))]
    assert [(r["route"], r["parts"], r["dropped"]) for r in got] == want
    assert len(calls) == 3
