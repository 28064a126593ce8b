"""Most similar vectors for every vector, by vantage-point trees per shard.

A sample of the vectors are vantage points of the top level: the first of them own the shards, and each
vector lives in the shard of its nearest vantage point. A shard, or a slice of a large one, builds a
vantage-point tree over its own vectors: each node deals them to the nearest of some of them, down to
leaves of LEAF vectors, whatever the number of vectors. A query visits a child only if the triangle
inequality leaves room for a vector within its radius: with angles as the metric, it needs
    d(q, v) - radius(child) <= reach   and   (d(q, v) - d(q, nearest v)) / 2 <= reach
where reach is the query's radius divided by relax. relax = 1 is exact; more visits less, but always the
children whose vantage point lies within the radius. The radius is the angle of min_cosine, and shrinks
to the k-th best of the query's own leaf. Vectors with fewer than k within that radius search again, each
within the angle of its (k + 1)-th nearest vantage point: these are vectors too, so k others lie within.
Vectors travel as 16-bit integers scaled to their largest component (an error of some 1e-6 in the cosine),
once to their shard and as queries to the other shards they visit. A large shard is cut into slices, and
one that many ask is repeated, so both sides of a dense area are split. Exact copies are one vector: its
smallest ids stand for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.places import SAMPLE, per_place
from ..session import stored

DIM, RELAX = 256, 8.0
#: data rows that one task holds, and queries that it answers; a larger shard, as in a dense area, is split
SLICE, QUERIES = 16_384, 65_536
#: vectors of a leaf, and most vantage points of a node
LEAF, FAN = 96, 256
#: cosine within which all vectors search first; and what is added to an angle, as those of 32-bit cosines are inexact
FIRST, SLACK = 0.7, 2e-3
#: least and most vantage points and shards of the top level; in between they grow with the number of
#: vectors. Beyond the most (a table of 64 MB), at some 10^8 vectors, shards have more slices.
POINTS, SHARDS = (1024, 65_536), (16, 8192)


def usable_vectors(df: DataFrame, key: str, emb: str, dim: int = DIM) -> DataFrame:
    """key, h (64 bits of the unit vector's hash) and v (the unit vector in 16-bit integers) of each row
    whose binary is exactly dim finite little-endian floats that are not all zero; others drop out.
    Repeated rows drop out later."""
    src = df.select(F.col(key).alias("key"), F.col(emb).alias("emb")).where(F.octet_length("emb") == 4 * dim).where(F.col("key").isNotNull())
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), "<f4").reshape(-1, dim).astype(np.float64)
            good = np.flatnonzero(np.isfinite(x).all(1) & x.any(1))
            x = x[good] / np.abs(x[good]).max(1, keepdims=True)  # no overflow of the squares
            q = np.rint(x / np.abs(x).max(1, keepdims=True) * 32767).astype("<i2")
            vs = [v.tobytes() for v in q]
            h = np.array([xxhash.xxh3_64_intdigest(v) for v in vs], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(good)), pa.array(h), pa.array(vs, pa.binary())], names=["key", "h", "v"])

    return src.mapInArrow(run, f"key {kind}, h bigint, v binary")


def unit(vs: list[bytes] | pd.Series, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vs), "<i2").reshape(-1, dim).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


class Tree:
    """Vantage points, the shard of each, and (once known) the radius of each cell."""

    def __init__(self, points: np.ndarray, shards: int) -> None:
        self.points = points
        self.shard = angle(points, points[:shards]).argmin(1)
        self.radius = np.full(len(points), np.pi)

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = angle(x, self.points)
        at = d.argmin(1)
        return d, at, d[np.arange(len(x)), at]

    def visits(self, x: np.ndarray, reach: float, relax: float, k: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(queries, cells): whether a query visits a cell; each query's own cell; and its radius, which
        is reach or, with k, the angle within which k others lie for certain if that is more."""
        d, at, near = self.home(x)
        own = np.full((len(x), 1), reach)
        if k:
            own = np.maximum(own, np.partition(d, k, 1)[:, k : k + 1] + SLACK if d.shape[1] > k else np.pi)
        lower = np.maximum(d - self.radius, (d - near[:, None]) / 2)
        return (lower <= own / relax) | (d <= own), at, own[:, 0]


class Node:
    """A vantage-point tree over the rows lo..hi of x, which it reorders."""

    def __init__(self, x: np.ndarray, order: np.ndarray, lo: int, hi: int) -> None:
        self.lo, self.hi, self.children = lo, hi, []
        n = hi - lo
        if n <= LEAF:
            return
        m = min(FAN, max(2, n // (LEAF // 2)))
        own = x[order[lo:hi]]
        self.points = own[np.linspace(0, n - 1, m).astype(int)]
        at = np.empty(n, np.int64)
        far = np.empty(n, np.float32)
        for k in range(0, n, 4096):
            d = angle(own[k : k + 4096], self.points)
            at[k : k + 4096], far[k : k + 4096] = d.argmin(1), d.min(1)
        by = np.argsort(at, kind="stable")
        order[lo:hi] = order[lo:hi][by]
        ends = np.searchsorted(at[by], np.arange(m + 1))
        if (np.diff(ends) == n).any():  # vectors that can't be told apart stay one leaf
            return
        self.radius = np.full(m, -np.inf)
        np.maximum.at(self.radius, at, far)
        self.children = [Node(x, order, lo + a, lo + b) if b > a else None for a, b in zip(ends, ends[1:], strict=False)]

    def search(self, x: np.ndarray, q: np.ndarray, rows: np.ndarray, tau: np.ndarray, relax: float, hit, home: bool = False) -> None:  # noqa: ANN001
        """Calls hit(rows, lo, hi) for the leaves that the queries q[rows] visit; with home only the nearest one."""
        if not self.children:
            hit(rows, self.lo, self.hi)
            return
        d = angle(q[rows], self.points)
        near = d.min(1)
        if home:
            seen = np.zeros(d.shape, bool)
            seen[np.arange(len(rows)), d.argmin(1)] = True
        else:
            own = tau[rows][:, None]
            seen = (np.maximum(d - self.radius, (d - near[:, None]) / 2) <= own / relax) | (d <= own)
        for k, child in enumerate(self.children):
            if child is not None and seen[:, k].any():
                child.search(x, q, rows[seen[:, k]], tau, relax, hit, home)


def nearest(df: DataFrame, key: str, emb: str, k: int = 5, min_cosine: float | None = None, relax: float = RELAX, dim: int = DIM, points: int | None = None, shards: int | None = None) -> DataFrame:
    """id, neighbour, cosine, rank: for each usable vector the k most similar others (ties: the smaller
    id), with min_cosine only those of that cosine or more; fewer where there aren't k. A key with
    several different vectors is a vector each, without links to itself. No usable vector gives no rows.

    The top level is fitted on `points` vectors, chosen by their hash: eight per shard, within POINTS; a
    shard is a quarter of a SLICE of vectors, within SHARDS. All vectors are indexed.
    """
    spark = df.sparkSession
    rows = stored(usable_vectors(df, key, emb, dim), "vectors")
    # copies: all their ids, and for each distinct vector its k + 1 smallest ids (no more can be named)
    members = rows.select("h", "key").distinct()
    ranked = rows.groupBy("h").agg(F.count("*").alias("n"))
    copied = stored(ranked.where("n > 1").select("h"), "copied")
    w = _smallest(members.join(copied, "h", "left_semi"), k + 1)
    # only the copies are shuffled with their vectors
    nodes = rows.join(copied, "h", "left_anti").select("h", "v").unionByName(rows.join(copied, "h", "left_semi").select("h", "v").dropDuplicates(["h"]))
    n = ranked.count()
    shards = shards or min(SHARDS[1], max(SHARDS[0], 4 * n // SLICE))
    points = points or min(POINTS[1], max(POINTS[0], 8 * shards))
    share = 4 * points / max(1, n)  # so that each task sends a few candidates, not `points`
    few = nodes.where(F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < F.lit(int(1_000_000 * share)))
    picked = few.orderBy(F.xxhash64("h"), "h").limit(points).select("v").toPandas()["v"]
    if not len(picked):
        return spark.createDataFrame([], f"id {rows.schema['key'].dataType.simpleString()}, neighbour {rows.schema['key'].dataType.simpleString()}, cosine double, rank int")
    tree = Tree(unit(picked, dim), min(shards, len(picked)))
    placed = stored(_placed(nodes, tree, dim), "placed")
    for r in placed.groupBy("cell").agg(F.max("far").alias("far")).collect():  # a number per vantage point
        tree.radius[r["cell"]] = r["far"]
    filled = {r["cell"] for r in placed.select("cell").distinct().collect()}
    tree.radius[[c for c in range(len(tree.points)) if c not in filled]] = -np.inf
    floor = FIRST if min_cosine is None else min_cosine
    found = _search(nodes, placed, tree, k, floor, float(np.arccos(floor)), relax, dim)
    best = _best_pairs(found, k)
    if min_cosine is None:
        best = stored(best, "best")
        enough = best.groupBy("a").count().where(F.col("count") >= k).select(F.col("a").alias("h"))
        few = stored(nodes.select("h").join(enough, "h", "left_anti"), "few")
        again = _search(nodes, placed, tree, k, floor, float(np.arccos(floor)), relax, dim, few)
        best = best.join(few, F.col("a") == F.col("h"), "left_anti").unionByName(_best_pairs(again, k))
    return _expanded(best, members, w, copied, k)


def _smallest(members: DataFrame, k: int) -> DataFrame:
    """h and keys, the k smallest keys of each h, without gathering all of a group."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(64)))
    part = salted.groupBy("h", "salt").agg(F.slice(F.array_sort(F.collect_set("key")), 1, k).alias("keys"))
    return part.groupBy("h").agg(F.slice(F.array_sort(F.flatten(F.collect_list("keys"))), 1, k).alias("keys"))


def _placed(nodes: DataFrame, tree: Tree, dim: int) -> DataFrame:
    sent = nodes.sparkSession.sparkContext.broadcast(tree)  # POINTS vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, at, far = sent.value.home(unit(b.column(1).to_pylist(), dim))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(far.astype(np.float64))], names=["cell", "far"])

    return nodes.select("h", "v").mapInArrow(run, "cell int, far double")


def _search(nodes: DataFrame, placed: DataFrame, tree: Tree, k: int, min_cosine: float, reach: float, relax: float, dim: int, few: DataFrame | None = None) -> DataFrame:
    """a, b, cosine: the best k of each query a within each shard slice. With few (h), these alone are
    queries, and each has the radius that holds k others instead of min_cosine."""
    wide = 0 if few is None else k
    load = np.zeros(int(tree.shard.max()) + 1)
    for c, n in placed.select("cell").groupBy("cell").count().collect():  # a number per vantage point
        load[tree.shard[c]] += n
    slices = np.maximum(1, np.ceil(load / SLICE)).astype(int)
    sent = placed.sparkSession.sparkContext.broadcast(tree)
    number = len(slices)

    def visited(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(queries, shards): which shards each visits; and its own."""
        t, x = sent.value, unit(b.column(1).to_pylist(), dim)
        out, own = np.zeros((len(x), number), bool), np.empty(len(x), np.int64)
        for lo in range(0, len(x), 2000):
            seen, cell, _ = t.visits(x[lo : lo + 2000], reach, relax, wide)
            own[lo : lo + 2000] = t.shard[cell]
            q, c = np.nonzero(seen)
            out[lo + q, t.shard[c]] = True
        return out, own

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(visited(b)[0])[1].astype(np.int32))], names=["shard"])

    queries = nodes.select("h", "v") if few is None else nodes.join(few, "h", "left_semi").select("h", "v")
    some = queries.where(F.pmod(F.xxhash64("h", F.lit(5)), F.lit(SAMPLE)) == 0).mapInArrow(asked, "shard int")
    copies = np.ones(number, int)
    for r in some.groupBy("shard").count().collect():  # a number per shard; it only decides how the work is split
        copies[r["shard"]] = max(1, -(-r["count"] * SAMPLE // QUERIES))
    start = np.concatenate(([0], np.cumsum(slices * copies)))  # a shard's places: its slices, of each its copies
    first_copy = np.concatenate([np.arange(m * c) % c == 0 for m, c in zip(slices, copies, strict=True)])

    def rows_of(b: pa.RecordBatch, r: np.ndarray, place: np.ndarray, kind: int) -> pa.RecordBatch:
        take = pa.array(r)
        return pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(np.full(len(r), kind, np.int32)), b.column(0).take(take), b.column(1).take(take)], names=["place", "kind", "h", "v"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector as data to its slice, in each copy, and as a query to all slices, in one copy, of the
        shards it visits. Data queries its own slice too (see own), so that isn't sent."""
        for b in batches:
            if not b.num_rows:
                continue
            h = np.abs(b.column(0).to_numpy())
            out, shard = visited(b)
            if not wide:
                yield from home([b], shard)
            r, s, j = [], [], []
            for at in range(number):
                q = np.flatnonzero(out[:, at])
                for part in range(slices[at]):
                    mine = q if wide else q[(shard[q] != at) | (h[q] % slices[at] != part)]
                    r.append(mine), s.append(np.full(len(mine), at)), j.append(np.full(len(mine), part))
            r, s, j = map(np.concatenate, (r, s, j))
            yield rows_of(b, r, start[s] + j * copies[s] + (h[r] // 7) % copies[s], 1)

    def home(batches: Iterator[pa.RecordBatch], shard: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            t, h = sent.value, np.abs(b.column(0).to_numpy())
            own = shard
            if own is None:
                own = np.concatenate([t.shard[t.home(unit(b.column(1).slice(lo, 2000).to_pylist(), dim))[1]] for lo in range(0, b.num_rows, 2000)])
            r = np.repeat(np.arange(b.num_rows), copies[own])
            copy = np.arange(len(r)) - np.repeat(np.cumsum(copies[own]) - copies[own], copies[own])
            yield rows_of(b, r, start[own[r]] + h[r] % slices[own[r]] * copies[own[r]] + copy, 0)

    def build(t: pa.Table) -> tuple:
        x = unit(t["v"].to_pylist(), dim)
        order = np.argsort(t["h"].to_numpy(), kind="stable")  # the tree must not depend on the order of arrival
        root = Node(x, order, 0, len(order))
        return root, x[order], t["h"].to_numpy()[order]

    def ask(index: tuple, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        root, dx, dh = index
        for lo in range(0, b.num_rows, 1024):
            part = b.slice(lo, 1024)
            qh, qx = part.column(2).to_numpy(), unit(part.column(3).to_pylist(), dim)
            every = np.arange(len(qx))
            radius = np.full(len(qx), reach) if not wide else sent.value.visits(qx, reach, relax, wide)[2]
            least = np.full(len(qx), min_cosine) if not wide else np.cos(radius)
            top = np.full((len(qx), k), -2.0, np.float32)

            def first(rows: np.ndarray, a: int, z: int, qh: np.ndarray = qh, qx: np.ndarray = qx, top: np.ndarray = top) -> None:
                s = qx[rows] @ dx[a:z].T
                s[qh[rows][:, None] == dh[a:z]] = -2
                both = np.concatenate((top[rows], s), 1)
                top[rows] = np.partition(both, both.shape[1] - k, 1)[:, -k:]

            root.search(dx, qx, every, radius, relax, first, home=True)
            kth = top.min(1)
            tau = np.minimum(radius, np.arccos(np.clip(kth, -1, 1)) + SLACK)
            floor = np.maximum(least, kth) - 1e-6
            q_, d_, s_ = [], [], []

            def hits(rows: np.ndarray, a: int, z: int, qx: np.ndarray = qx, floor: np.ndarray = floor, q_: list = q_, d_: list = d_, s_: list = s_) -> None:
                s = qx[rows] @ dx[a:z].T
                y, x = np.nonzero(s >= floor[rows][:, None])
                q_.append(rows[y]), d_.append(x + a), s_.append(s[y, x])

            root.search(dx, qx, every, tau, relax, hits)
            if not q_:
                continue
            a, d, s = np.concatenate(q_), np.concatenate(d_), np.round(np.concatenate(s_).astype(np.float64), 7)
            keep = (qh[a] != dh[d]) & (s >= least[a] - (1e-6 if wide else 0))
            a, d, s = a[keep], d[keep], s[keep]
            # all ties of the k-th stay, as which of them counts depends on the ids
            o = np.lexsort((-s, a))
            a, d, s = a[o], d[o], s[o]
            start = np.concatenate(([0], np.flatnonzero(np.diff(a)) + 1)) if len(a) else np.zeros(0, int)
            lens = np.diff(np.concatenate((start, [len(a)])))
            last = np.repeat(s[np.minimum(start + k - 1, start + lens - 1)], lens) if len(a) else s
            ok = s >= last
            yield pa.RecordBatch.from_arrays([pa.array(qh[a[ok]]), pa.array(dh[d[ok]]), pa.array(s[ok])], names=["a", "b", "cosine"])

    def own(b: pa.RecordBatch) -> pa.RecordBatch:
        return b if not wide and b.num_rows and first_copy[b.column(0)[0].as_py()] else b.slice(0, 0)

    kinds = "place bigint, kind int, h bigint, v binary"
    routed = queries.mapInArrow(route, kinds)
    if wide:
        routed = nodes.select("h", "v").mapInArrow(home, kinds).unionByName(routed)
    return per_place(routed, int(start[-1]), build, ask, "a bigint, b bigint, cosine double", own)


def _best_pairs(found: DataFrame, k: int) -> DataFrame:
    """Of the shards' answers, those that may be among the best k: all with at least the k-th cosine."""
    # at most k and ties per shard; get() gives null where there are fewer than k
    x = found.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("cosine", "b")), asc=False).alias("all"))
    least = F.coalesce(F.get("all", F.lit(k - 1))["cosine"], F.lit(-2.0))
    x = x.select("a", F.explode(F.filter("all", lambda v: v["cosine"] >= least)).alias("v"))
    return x.select("a", F.col("v.b").alias("b"), F.col("v.cosine").alias("cosine"))


def _expanded(best: DataFrame, members: DataFrame, smallest: DataFrame, copied: DataFrame, k: int) -> DataFrame:
    """Pairs of distinct vectors and classes of copies as ranked neighbours of ids."""
    single = members.join(copied, "h", "left_anti")
    names = single.select("h", F.array("key").alias("keys")).unionByName(smallest)
    named = best.join(names.withColumnRenamed("h", "b"), "b").select(F.col("a").alias("h"), "cosine", "keys")
    same = smallest.select("h", F.lit(1.0).alias("cosine"), "keys")
    # per distinct vector the candidates: its own copies and those of the vectors near it
    cand = named.unionByName(same).groupBy("h").agg(F.array_sort(F.flatten(F.collect_list(F.transform("keys", lambda x: F.struct((-F.col("cosine")).alias("far"), x.alias("id")))))).alias("near"))
    # the k + 1 smallest are enough: one may be the vector itself
    cand = cand.withColumn("near", F.slice("near", 1, k + 1))
    out = members.join(cand, "h").select(F.col("key").alias("id"), F.posexplode(F.slice(F.filter("near", lambda x: x["id"] != F.col("key")), 1, k)).alias("pos", "x"))
    return out.select("id", F.col("x.id").alias("neighbour"), (-F.col("x.far")).alias("cosine"), (F.col("pos") + 1).alias("rank"))


def similar_pairs(ranked: DataFrame) -> DataFrame:
    """id_a < id_b of the pairs of which at least one names the other."""
    x = ranked.where("id <> neighbour")
    return x.select(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()
