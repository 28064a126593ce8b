"""Stage 4: order-sensitive near-duplicate removal by the nearest kept neighbour.

A document is rejected if its nearest earlier kept neighbour has a cosine of the threshold or more
and, where both have signatures, an estimated Jaccard similarity of the surface threshold or more;
rejected documents are no neighbours. In batch form only documents with a pair that could reject
them are in doubt. These pairs come from bands of the signatures; what else lies nearer to a document
in doubt than the farthest of them is found exactly, within that small radius, by the triangle
inequality over pivot cells. The documents in doubt are then settled in rounds. Rows of equal vector
and signature are one node, so copies make no pairs among themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.minhash import jaccard_estimate
from ..session import stored, stored_counted
from .places import SAMPLE, bucket_pairs, per_place

#: least and most pivots; in between their number grows with the root of the number of vectors
PIVOTS = (64, 8192)
#: data rows of a block at most (fewer of long vectors: so many numbers), and queries that it answers; more are split
SLICE, NUMBERS, QUERIES = 24_576, 6 << 20, 65_536
#: rows that are routed, and pairs that are measured, at a time: what a task holds depends on neither
ROUTED, MEASURED = 512, 2048
#: of a block's cells, the share that queries must see from which they are compared with all of it at once
WHOLE = 0.3
#: bands of two minima of a signature: of pairs with half of 128 minima equal they miss 1e-6
BANDS = 48
SLACK = 1e-6


def _floats(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _unit32(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return _unit(_floats(column, dim, kind)).astype(np.float32)


def _angles(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    d = x @ v.T
    return np.arccos(np.clip(d, -1.0, 1.0, out=d), out=d)


def _angles_to(x: np.ndarray, v: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """The angle of each vector to the pivot of its cell."""
    return np.concatenate([_angles(x[k : k + ROUTED], v)[np.arange(len(x[k : k + ROUTED])), cell[k : k + ROUTED]] for k in range(0, len(x), ROUTED)])


def _must_see(d: np.ndarray, near: np.ndarray, radius: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Queries by cells: whether a vector of the cell can have the cosine asked for, by the angles of the
    queries to the cells' pivots and to their nearest pivot."""
    reach = (np.arccos(np.clip(least, -1, 1)) + 2e-3).astype(np.float32)[:, None]  # 32-bit angles near 0 are that inexact
    return (d - radius <= reach) & ((d - near.astype(np.float32)[:, None]) / 2 <= reach)


def _kind(df: DataFrame, emb: str) -> str:
    return "<f4" if df.schema[emb].dataType.simpleString() == "array<float>" else "<f8"


def vector_rows(df: DataFrame, seq: str, emb: str, part: str | None = None, sig: str | None = None, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """seq, part, node, v, s, bands of each row whose vector is not null and not all zero: a hash of
    the row's vector, signature and part, the vector and the signature (32-bit, or null) as binary, and
    a hash of each two minima; of each one where signatures are short or surface is low, which is exact."""
    x = df.select(F.col(seq).alias("seq"), (F.col(part) if part else F.lit(0)).cast("int").alias("part"), F.col(emb).alias("emb"), (F.col(sig) if sig else F.lit(None).cast("array<bigint>")).alias("sig"))
    x = x.where(F.exists("emb", lambda v: v != 0))
    kind = _kind(x, "emb")

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.uint64(0x9E3779B97F4A7C15)
        for b in got:
            emb, sig, part = b.column(2), b.column(3), b.column(1).to_pylist()
            vs, ss, bands, nodes = [], [], [], []
            for k in range(b.num_rows):
                v = np.asarray(emb[k].values.to_numpy(zero_copy_only=False), kind).tobytes()
                m = None if not sig[k].is_valid or not len(sig[k]) else sig[k].values.to_numpy(zero_copy_only=False).astype(np.uint64)
                s = None if m is None else m.astype("<u4").tobytes()
                vs.append(v)
                ss.append(s)
                nodes.append(xxhash.xxh3_64_intdigest(v + (s or b"") + str(part[k]).encode()))
                if m is None:
                    bands.append([])
                    continue
                pairs = len(m) >= 2 * BANDS and surface >= 0.5
                n = BANDS if pairs else len(m)
                two = m[1 : 2 * n : 2] if pairs else np.zeros(n, np.uint64)
                h = (m[0 : 2 * n : 2] if pairs else m) * odd ^ (two + np.arange(n, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                bands.append(((h ^ (h >> np.uint64(29))) * odd).view(np.int64))
            cols = [b.column(0), b.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(vs, pa.binary()), pa.array(ss, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["seq", "part", "node", "v", "s", "bands"])

    return x.mapInArrow(run, f"seq {x.schema['seq'].dataType.simpleString()}, part int, node bigint, v binary, s binary, bands array<bigint>")


def _near(x: DataFrame, kind: str, least: float, asks: DataFrame | None = None, pivots: int | None = None) -> DataFrame:
    """i, j, sim: pairs j < i of x (seq, part, v) within a part. Without asks all of cosine >= least, with
    asks (seq, least) those that one end asks for. Exact.

    Vectors lie in the cell of their nearest pivot (a bounded sample); by the triangle inequality of
    angles a vector can only have partners in the cells that its angle to their pivot, less the
    cell's radius, and half its excess over the nearest pivot, reach. Small cells share a block, large ones
    are cut into slices, and blocks that many ask are repeated. A query goes once to each block in which it must
    see a cell: where the angles exclude nothing, as often as there are blocks, which is all pairs by blocks."""
    spark = x.sparkSession
    seq = x.schema["seq"].dataType.simpleString()
    none = spark.createDataFrame([], f"i {seq}, j {seq}, sim double")
    x = x.select("seq", "part", "v")
    n = x.count()
    pivots = pivots or min(PIVOTS[1], max(PIVOTS[0], 4 * isqrt(n)))
    few = x.where(F.pmod(F.xxhash64("seq"), F.lit(1_000_000)) < int(4e6 * pivots / max(1, n)) + 1)
    picked = few.orderBy(F.xxhash64("seq")).limit(pivots).select("v").toPandas()["v"]
    if not len(picked):
        return none
    size = len(picked.iloc[0])
    dim = size // np.dtype(kind).itemsize
    v = _unit(np.array([np.frombuffer(p, kind) for p in picked if len(p) == size])).astype(np.float32)
    x = x.where(F.octet_length("v") == size)
    names = ["place", "kind", "seq", "v", "least", "near"]
    schema = f"place bigint, kind int, seq {seq}, v binary, least double, near double"

    def nearest(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and its angle to the pivot."""
        d = _angles(e, v)
        return d.argmin(1), d.min(1)

    def place(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far: dict[int, np.ndarray] = {}
        rows: dict[int, np.ndarray] = {}
        for b in got:
            for lo in range(0, b.num_rows, ROUTED):
                t = b.slice(lo, ROUTED)
                cell, angle = nearest(_unit32(t.column(2), dim, kind))
                parts = t.column(1).to_numpy()
                for k in np.unique(parts).tolist():
                    at = parts == k
                    np.maximum.at(far.setdefault(k, np.full(len(v), -np.inf)), cell[at], angle[at])
                    np.add.at(rows.setdefault(k, np.zeros(len(v), np.int64)), cell[at], 1)
        for k, m in rows.items():
            c = np.flatnonzero(m)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), k, np.int32)), pa.array(c.astype(np.int32)), pa.array(far[k][c]), pa.array(m[c])], names=["part", "cell", "far", "n"])

    radius = np.full(len(v), -np.inf, np.float32)
    load: dict[int, np.ndarray] = {}
    cells = x.mapInArrow(place, "part int, cell int, far double, n bigint").groupBy("part", "cell").agg(F.max("far").alias("far"), F.sum("n").alias("n"))
    for r in cells.collect():  # a row per pivot and part
        radius[r["cell"]] = max(radius[r["cell"]], r["far"])
        load.setdefault(r["part"], np.zeros(len(v), np.int64))[r["cell"]] = r["n"]
    if asks is None:
        queries, many = x.withColumn("least", F.lit(float(least))).select("seq", "part", "v", "least"), n
    else:
        queries, seen = stored_counted(x.join(asks, "seq").select("seq", "part", "v", "least"), "asking", n=F.count("*"))
        many = max(1, seen["n"])
    # blocks and copies so that all cores have work and the fewest rows are sent
    most = max(1, min(SLICE, NUMBERS // dim))
    work = 2 * spark.sparkContext.defaultParallelism
    blocks = max(-(-n // most), min(work, isqrt(max(1, work * n // many))))
    rows = max(1, min(most, max(-(-n // blocks), min(most, 1024))))
    answers = max(1, min(QUERIES, max(1024, many * max(1, n // rows) // work + 1)))
    begin: dict[int, np.ndarray] = {}
    for k, m in load.items():
        cuts, held = [0], 0
        for c, one in enumerate(m.tolist()):
            if held and held + one > rows:
                cuts.append(c)
                held = 0
            held += one
        begin[k] = np.array(cuts)
    slices = {k: np.maximum(1, -(-np.add.reduceat(load[k], begin[k]) // rows)) for k in load}

    def visits(e: np.ndarray, parts: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and blocks (of the row's part): what each query must see; and its angle to the nearest pivot."""
        d = _angles(e, v)
        near = d.min(1)
        m = _must_see(d, near, radius, floor)
        q, g = [], []
        for k in np.unique(parts).tolist():
            at = np.flatnonzero(parts == k)
            y, z = np.nonzero(np.logical_or.reduceat(m[at], begin[k], axis=1))
            q.append(at[y])
            g.append(z)
        return np.concatenate(q), np.concatenate(g), near

    def count(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            for lo in range(0, b.num_rows, ROUTED):
                t = b.slice(lo, ROUTED)
                q, g, _ = visits(_unit32(t.column(2), dim, kind), t.column(1).to_numpy(), t.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([t.column(1).take(pa.array(q)), pa.array(g.astype(np.int32))], names=["part", "block"])

    sample = queries.where(F.pmod(F.xxhash64("seq", F.lit(5)), F.lit(SAMPLE)) == 0).mapInArrow(count, "part int, block int")
    copies = {k: np.ones(len(m), np.int64) for k, m in slices.items()}
    for r in sample.groupBy("part", "block").count().collect():  # a row per block
        copies[r["part"]][r["block"]] = max(1, -(-r["count"] * SAMPLE // answers))
    at, first, of = 0, {}, []
    for k in sorted(load):
        each = slices[k] * copies[k]
        first[k] = at + np.cumsum(each) - each
        at += int(each.sum())
        of += [(k, g) for g, m in enumerate(each.tolist()) for _ in range(m)]
    sent = spark.sparkContext.broadcast((v, radius, begin, slices, copies, first, of))  # PIVOTS vectors, and numbers per block and part

    def spread(t: pa.RecordBatch, rows: np.ndarray, block: np.ndarray, near: np.ndarray | None) -> pa.RecordBatch:
        """A data row (without near) goes to one slice of its block, in each copy; a query to all slices, in one copy."""
        _, _, _, slices, copies, first, _ = sent.value
        parts = t.column(1).to_numpy()
        h = np.array([xxhash.xxh3_64_intdigest(str(s)) for s in t.column(0).to_pylist()], np.uint64)
        take, places = [], []
        for r, g in zip(rows.tolist(), block.tolist(), strict=True):
            k = int(parts[r])
            s, m, at = int(slices[k][g]), int(copies[k][g]), int(first[k][g])
            own = int(h[r]) % (s if near is None else m)
            for j in range(m if near is None else s):
                take.append(r)
                places.append(at + (own * m + j if near is None else j * m + own))
        i = pa.array(take, pa.int64())
        kinds = pa.array(np.full(len(take), int(near is not None), np.int32))
        gap = pa.nulls(len(take), pa.float64())
        floor, near = (gap, gap) if near is None else (t.column(3).take(i), pa.array(near.astype(np.float64)).take(i))
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), kinds, t.column(0).take(i), t.column(2).take(i), floor, near], names=names)

    def as_data(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = sent.value[2]
        for b in got:
            for lo in range(0, b.num_rows, ROUTED):
                t = b.slice(lo, ROUTED)
                cell, parts = nearest(_unit32(t.column(2), dim, kind))[0], t.column(1).to_numpy()
                block = np.zeros(len(cell), np.int64)
                for k in np.unique(parts).tolist():
                    block[parts == k] = np.searchsorted(begin[k], cell[parts == k], "right") - 1
                yield spread(t, np.arange(t.num_rows), block, None)

    def as_query(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            for lo in range(0, b.num_rows, ROUTED):
                t = b.slice(lo, ROUTED)
                yield spread(t, *visits(_unit32(t.column(2), dim, kind), t.column(1).to_numpy(), t.column(3).to_numpy()))

    def build(t: pa.Table) -> tuple:
        """The rows of a block by cell, and its cells: pivots, radii and ends."""
        v, _, begin, *_, of = sent.value
        part, g = of[t["place"][0].as_py()]
        lo, hi = (*begin[part], len(v))[g : g + 2]
        raw = _floats(t["v"], dim, kind)
        e = np.concatenate([_unit(raw[k : k + ROUTED]).astype(np.float32) for k in range(0, len(raw), ROUTED)])
        cell = np.concatenate([_angles(e[k : k + ROUTED], v[lo:hi]).argmin(1) for k in range(0, len(e), ROUTED)])
        by = np.argsort(cell, kind="stable")
        raw, e, cell = raw[by], e[by], cell[by]
        far = _angles_to(e, v[lo:hi], cell)
        there, at = np.unique(cell, return_index=True)
        return t["seq"].combine_chunks().take(pa.array(by)), raw, e, v[lo:hi][there], np.maximum.reduceat(far, at), np.append(at, len(e))

    def ask(index: tuple, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ds, raw, e, pivot, radius, ends = index
        step = max(1, NUMBERS // 2 // len(e))
        for lo in range(0, b.num_rows, step):
            t = b.slice(lo, step)
            own, floor = _floats(t.column(3), dim, kind), t.column(4).to_numpy()
            x, low = _unit(own).astype(np.float32), (floor - 1e-5).astype(np.float32)
            m = _must_see(_angles(x, pivot), t.column(5).to_numpy(), radius, floor)
            if m.mean() > WHOLE:
                y, z = np.nonzero(x @ e.T >= low[:, None])
            else:
                ys, zs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for c in np.flatnonzero(m.any(0)).tolist():
                    q = np.flatnonzero(m[:, c])
                    a, d = np.nonzero(x[q] @ e[ends[c] : ends[c + 1]].T >= low[q, None])
                    ys.append(q[a])
                    zs.append(d + ends[c])
                y, z = np.concatenate(ys), np.concatenate(zs)
            for k in range(0, len(y), MEASURED):  # candidates in 32 bits, their cosines in 64
                yk, zk = y[k : k + MEASURED], z[k : k + MEASURED]
                sim = np.round(np.einsum("ij,ij->i", _unit(own[yk]), _unit(raw[zk])), 12)
                ok = sim >= floor[yk] - 1e-12
                yield pa.RecordBatch.from_arrays([t.column(2).take(pa.array(yk[ok])), ds.take(pa.array(zk[ok])), pa.array(sim[ok])], names=["i", "j", "sim"])

    data = x.select("seq", "part", "v").withColumn("least", F.lit(None).cast("double"))
    routed = data.mapInArrow(as_data, schema).unionByName(queries.mapInArrow(as_query, schema))
    found = per_place(routed, at, build, ask, f"i {seq}, j {seq}, sim double", tasks=max(int(spark.conf.get("spark.sql.shuffle.partitions")), at))
    if asks is None:  # both ends ask
        return found.where("i > j")
    found = found.where("i <> j")
    return found.groupBy(F.greatest("i", "j").alias("i"), F.least("i", "j").alias("j")).agg(F.max("sim").alias("sim"))


def cosine_pairs(df: DataFrame, seq: str, emb: str, threshold: float, part: str | None = None, pivots: int | None = None) -> DataFrame:
    """i, j, sim: all pairs j < i of seq (unique) with cosine >= threshold, within a part if one is named.

    Exact. Null and all-zero vectors, and vectors of another length than the first pivot's, have no
    partners. Each pair is a row, so this is for thresholds that few pairs reach."""
    return _near(stored(vector_rows(df, seq, emb, part).select("seq", "part", "v"), "vectors"), _kind(df, emb), threshold, pivots=pivots)


def with_surface(pairs: DataFrame, df: DataFrame, seq: str, sig: str | None) -> DataFrame:
    """pairs with `surface`, the estimated Jaccard similarity; null without signatures."""
    if sig is None:
        return pairs.withColumn("surface", F.lit(None).cast("double"))
    s = df.select(F.col(seq).alias("k"), F.col(sig).alias("s"))
    x = pairs.join(s.select(F.col("k").alias("i"), F.col("s").alias("s_i")), "i", "left").join(s.select(F.col("k").alias("j"), F.col("s").alias("s_j")), "j", "left")
    return x.select("i", "j", "sim", jaccard_estimate("s_i", "s_j").alias("surface"))


def _compared(pairs: DataFrame, nodes: DataFrame, column: str, name: str, f: Callable[[bytes, bytes], float | None]) -> DataFrame:
    """pairs (i, j, ...) with f of the nodes' column at both ends; null if either is null."""
    seq = nodes.schema["seq"].dataType.simpleString()
    x = pairs
    for end in ("i", "j"):
        x = x.join(nodes.select(F.col("seq").alias(end), F.col(column).alias(f"_{end}")), end)
    x = x.select(*pairs.columns, "_i", "_j")

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            out = [None if u is None or w is None else f(u, w) for u, w in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(out, pa.float64())], names=[*b.schema.names[:-2], name])

    return x.mapInArrow(run, ", ".join(f"{c.name} {seq if c.name in 'ij' else c.dataType.simpleString()}" for c in pairs.schema) + f", {name} double")


def _with_sim(pairs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """pairs with sim; null for vectors of different lengths."""

    def sim(u: bytes, w: bytes) -> float | None:
        x, y = np.frombuffer(u, kind).astype(np.float64), np.frombuffer(w, kind).astype(np.float64)
        return round(float(np.einsum("i,i->", x / np.linalg.norm(x), y / np.linalg.norm(y))), 12) if len(x) == len(y) else None

    return _compared(pairs, nodes, "v", "sim", sim)


def _with_surface(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs with surface; null if either end has no signature."""
    return _compared(pairs, nodes, "s", "surface", lambda u, w: float((np.frombuffer(u, "<u4") == np.frombuffer(w, "<u4")).mean()))


def settle(pairs: DataFrame, threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """i, neighbour, dedup_similarity of the rejected documents, from pairs (i, j, sim, surface) j < i.

    Of neighbours with equal cosine the earliest counts. A document without a pair that could reject it is kept
    whatever its neighbours are, and a neighbour known to be kept hides all less similar ones. Of what it leaves,
    if every pair would reject the document, it is rejected whichever of these neighbours is kept; if none would,
    it is kept. A round settles all documents of these two kinds; the others wait for their neighbours. The
    neighbours that the rejected documents are rejected by are looked up at the end.
    """
    every = pairs.where(F.col("sim") >= threshold).withColumn("kill", F.coalesce(F.col("surface") >= surface, F.lit(True)))
    every = stored(every.select("i", "j", (-F.col("sim")).alias("far"), "kill"), "pairs")
    open_, gone = every.join(every.where("kill").select("i").distinct(), "i", "left_semi"), every.select("i").limit(0)
    own = Window.partitionBy("i")
    while True:
        x = open_.join(open_.select(F.col("i").alias("j"), F.lit(True).alias("open")).distinct(), "j", "left")
        place = F.struct("far", "j")
        x = x.withColumn("best", F.min(F.when(F.col("open").isNull(), place)).over(own)).where(F.col("best").isNull() | (place <= F.col("best")))
        x = x.withColumn("risk", F.max("kill").over(own)).withColumn("dead", F.min("kill").over(own) & F.col("best").isNotNull())
        x, n = stored_counted(x.select("i", "j", "far", "kill", "risk", "dead"), "round", left=F.count_if(F.col("risk") & ~F.col("dead")))
        out = x.where("dead").select("i").distinct()
        gone = gone.unionByName(out)
        if not n["left"]:
            break
        # a rejected document is no neighbour
        open_ = x.where("risk and not dead").join(out.withColumnRenamed("i", "j"), "j", "left_anti").select("i", "j", "far", "kill")
    gone = stored(gone, "gone")
    left = every.join(gone, "i", "left_semi").join(gone.withColumnRenamed("i", "j"), "j", "left_anti")
    best = left.groupBy("i").agg(F.min(F.struct("far", "j")).alias("b"))
    return best.select("i", F.col("b.j").alias("neighbour"), (-F.col("b.far")).alias("dedup_similarity"))


def rejected(df: DataFrame, seq: str, emb: str, sig: str | None = None, part: str | None = None, threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """i, neighbour, dedup_similarity of the rows that online dedup rejects."""
    kind = _kind(df, emb)
    rows = stored(vector_rows(df, seq, emb, part, sig, surface), "vectors")
    copied, any_ = stored_counted(rows.groupBy("node").agg(F.min("seq").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "copied", n=F.count("*"))
    nodes = rows
    if any_["n"]:
        copies = stored(rows.select("node", "seq").join(copied, "node"), "copies")
        nodes = rows.join(copies.where("seq <> first").select("seq"), "seq", "left_anti")
    if sig is None:
        near = _near(nodes, kind, threshold)
    else:
        bands = nodes.select("seq", "part", F.explode("bands").alias("band"))
        cand = bucket_pairs(bands, ["part", "band"], "seq").distinct().select(F.col("b").alias("i"), F.col("a").alias("j"))
        # signatures first: they are shorter than vectors, and few pairs of a band have enough in common
        alike = stored(_with_surface(cand, nodes).where(F.col("surface") >= surface).select("i", "j"), "alike")
        kill = stored(_with_sim(alike, nodes, kind).where(F.col("sim") >= threshold), "kill")
        # in doubt: the later ends; the earlier ones that have copies, which may come after the later; copies; and what has no signature
        asks = kill.select(F.col("i").alias("seq"), F.col("sim").alias("least")).unionByName(kill.join(copied.select(F.col("first").alias("j")), "j", "left_semi").select(F.col("j").alias("seq"), F.col("sim").alias("least")))
        asks = asks.unionByName(copied.select(F.col("first").alias("seq"), F.lit(1.0).alias("least")))
        asks = asks.unionByName(nodes.where("s is null").select("seq", F.lit(float(threshold)).alias("least")))
        near = _near(nodes, kind, threshold, stored(asks.groupBy("seq").agg((F.min("least") - SLACK).alias("least")), "asks"))
    near = stored(near.where(F.col("sim") >= threshold), "near")
    pairs = stored(_with_surface(near, nodes), "measured") if sig is not None else near.withColumn("surface", F.lit(None).cast("double"))
    if not any_["n"]:
        return settle(pairs, threshold, surface)
    # between nodes, in both directions, and within a node of several rows
    both = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "sim", "surface"))
    both = both.unionByName(copied.select(F.col("first").alias("i"), F.col("first").alias("j"), F.lit(1.0).alias("sim"), F.lit(None).cast("double").alias("surface")))
    all_rows = both.select("i").distinct().join(copies.select(F.col("first").alias("i"), "seq"), "i", "left").select("i", F.coalesce("seq", "i").alias("row"))
    links = stored(all_rows.join(both, "i"), "links")
    reps = links.select(F.col("j"), F.col("j").alias("rep")).distinct()
    while True:
        each = links.join(reps, "j").where("rep < row").select(F.col("row").alias("i"), F.col("rep").alias("j"), "sim", "surface")
        gone = stored(settle(each, threshold, surface), "rejected")
        # the first row of a node stands for it; if that is rejected, its earliest kept row does
        lost = copies.join(gone.select(F.col("i").alias("first")), "first", "left_semi").join(gone.select(F.col("i").alias("seq")), "seq", "left_anti")
        late = lost.groupBy(F.col("first").alias("j")).agg(F.min("seq").alias("rep")).join(reps, ["j", "rep"], "left_anti")
        late, n = stored_counted(late, "late", n=F.count("*"))
        if not n["n"]:
            return gone
        reps = stored(reps.unionByName(late), "reps")


def online_dedup(df: DataFrame, seq: str, emb: str, sig: str | None = None, part: str | None = None, threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """df with `neighbour` and `dedup_similarity`, both null for the kept documents. seq is unique and
    not null; a null or all-zero vector is kept and no neighbour."""
    gone = rejected(df, seq, emb, sig, part, threshold, surface)
    return df.join(gone, df[seq] == gone["i"], "left").drop("i")


def partition_dedup(df: DataFrame, seq: str, emb: str, part: str, sig: str | None = None, threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """Independent indexes: decisions depend on the document's own part alone."""
    return online_dedup(df, seq, emb, sig, part, threshold, surface)


def nearest_prior(df: DataFrame, seq: str, emb: str, block: int = 2048) -> DataFrame:
    """i, neighbour, sim: the most similar earlier vector of each, whatever its similarity.

    Blocks of rows by order against all blocks: a stated query set against all rows. For corpora of
    evaluation size; online_dedup never needs it."""
    from .sampling import numbered

    x = numbered(df.where(F.exists(emb, lambda v: v != 0)).select(F.col(seq).alias("seq"), F.col(emb).alias("emb")), "seq", "rn")
    x = stored(x.withColumn("block", F.floor((F.col("rn") - 1) / block)).drop("rn"), "blocks")
    blocks = x.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("seq", "emb"))).alias("rows"))
    pairs = blocks.alias("q").join(blocks.alias("d"), F.col("d.block") <= F.col("q.block")).select(F.col("q.rows").alias("q"), F.col("d.rows").alias("d"))
    kind = x.schema["seq"].dataType.simpleString()

    def run(got: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in got:
            for q, d in zip(pdf["q"], pdf["d"], strict=True):
                qs, ds = np.array([r["seq"] for r in q]), np.array([r["seq"] for r in d])
                a, b = (np.array([r["emb"] for r in z], np.float64) for z in (q, d))
                s = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
                s[qs[:, None] <= ds[None]] = -2
                at = s.argmax(1)
                top = s[np.arange(len(s)), at]
                ok = top > -2
                yield pd.DataFrame({"i": qs[ok], "neighbour": ds[at[ok]], "sim": np.round(top[ok], 12)})

    got = pairs.mapInPandas(run, f"i {kind}, neighbour {kind}, sim double")
    best = got.groupBy("i").agg(F.min(F.struct((-F.col("sim")).alias("far"), "neighbour")).alias("b"))
    return best.select("i", F.col("b.neighbour").alias("neighbour"), (-F.col("b.far")).alias("sim"))


def first_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first by order."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
