"""Word shingles, MinHash bands and pivot counts of texts, computed in Arrow batches.

Words are the maximal runs of Unicode letters and digits in the lower-cased text; a shingle is a
sequence of five consecutive words. Everything is vectorised over many documents at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.places import bucket_pairs

WORD = re.compile(r"[^\W_]+")
SHINGLE, MIN_WORDS = 5, 20
ROWS, BANDS = 3, 32
PERMS = ROWS * BANDS
SLICES = 64  # pivots: one for each slice of the shingle space
RANGE = 4.0  # ratio of the ends of a range of sizes, the distances to the empty pivot
CHUNK_WORDS = 400_000

_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 2**63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, PERMS, dtype=np.uint64)
_P = _rng.integers(1, 2**63, SHINGLE + ROWS + 2, dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    """Word -> 62-bit hash; emptied when it has grown to a million words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) >> 2
        return h


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def chunks(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document numbers, starts and shingle hashes (not yet distinct) of the documents of at least
    MIN_WORDS words, in chunks of about CHUNK_WORDS words; a document is never split."""
    words, docs, lens = [], [], []
    for k, t in enumerate(texts):
        if not t:
            continue
        w = WORD.findall(t.lower())
        if len(w) < MIN_WORDS:
            continue
        words += w
        docs.append(k)
        lens.append(len(w))
        if len(words) >= CHUNK_WORDS:
            yield _hashed(words, docs, lens)
            words, docs, lens = [], [], []
    if docs:
        yield _hashed(words, docs, lens)


def _hashed(words: list, docs: list, lens: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    w = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.int64, count=len(words)).view(np.uint64)
    n = np.array(lens)
    h = w[: len(w) - SHINGLE + 1] * _P[0]
    for k in range(1, SHINGLE):
        h = (h ^ (h >> np.uint64(31))) * _P[SHINGLE] + w[k : len(w) - SHINGLE + 1 + k] * _P[k]
    ends = np.cumsum(n)
    inner = np.ones(len(h), bool)
    for k in range(1, SHINGLE):  # shingles that would run over into the next document
        at = ends[:-1] - k
        inner[at[at < len(h)]] = False
    h = _mix(h[inner])
    starts = np.concatenate(([0], np.cumsum(n - SHINGLE + 1)))
    return np.array(docs), starts, h


def _minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(documents, PERMS) 32-bit minima."""
    out = np.empty((len(starts) - 1, PERMS), np.uint32)
    for k in range(PERMS):
        out[:, k] = np.minimum.reduceat(((h ^ _B[k]) * _A[k]) >> np.uint64(32), starts[:-1])
    return out


def _binary(a: np.ndarray) -> pa.Array:
    """One binary value per row of a two-dimensional array."""
    a = np.ascontiguousarray(a)
    width = a.shape[1] * a.itemsize
    off = np.arange(len(a) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(off), pa.py_buffer(a)])


def bands_for(threshold: float, miss: float) -> tuple[int, int]:
    """Rows and bands: ROWS and BANDS if these lose a pair of the threshold with a chance of miss at most,
    else the most rows, and the fewest bands of them, that do."""
    for rows in range(ROWS, 0, -1):
        need = ceil(log(miss) / log1p(-(threshold**rows))) if threshold < 1 else 1
        if rows == ROWS and need <= BANDS:
            return ROWS, BANDS
        if rows * need <= PERMS:
            return rows, need
    raise ValueError(f"{PERMS} minima can't find pairs of overlap {threshold} with a miss of {miss}")


def fingerprints(df: DataFrame, key: str, text: str, shape: tuple[int, int] = (ROWS, BANDS)) -> DataFrame:
    """key, cls, n, bands, sig and slices of each row whose text has MIN_WORDS words or more.

    cls is a 64-bit hash of the set of shingles: rows of one cls are exact copies as far as overlap
    goes. n is the number of distinct shingles, bands one hash per band (shape: minima of each, and bands), sig 16 bits of each MinHash
    minimum, slices the number of distinct shingles in each of SLICES hash slices, at most 255. Null, empty and
    shorter texts, and null keys, give no row. Other columns are ignored.
    """
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where((F.length("text") >= MIN_WORDS) & F.col("key").isNotNull())
    kind = src.schema["key"].dataType.simpleString()

    n_rows, n_bands = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for docs, starts, h in chunks(batch.column(1).to_pylist()):
                m = _minima(h, starts)
                n = np.empty(len(docs), np.int32)
                cls = np.empty(len(docs), np.uint64)
                sl = np.empty((len(docs), SLICES), np.uint8)
                for k in range(len(docs)):
                    u = np.unique(h[starts[k] : starts[k + 1]])
                    n[k] = len(u)
                    cls[k] = xxhash.xxh3_64_intdigest(u.tobytes())
                    sl[k] = np.minimum(np.bincount((u >> np.uint64(58)).astype(np.int64), minlength=SLICES), 255)
                b = np.empty((len(docs), n_bands), np.uint64)
                for k in range(n_bands):
                    x = np.full(len(docs), k + 1, np.uint64) * _P[SHINGLE + 1]
                    for r in range(n_rows):
                        x = _mix(x + m[:, k * n_rows + r].astype(np.uint64) * _P[SHINGLE + 2 + r - 1])
                    b[:, k] = x
                off = pa.array(np.arange(len(docs) + 1, dtype=np.int32) * n_bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(docs)),
                        pa.array(cls.view(np.int64)),
                        pa.array(n),
                        pa.ListArray.from_arrays(off, pa.array(b.reshape(-1).view(np.int64))),
                        _binary(m.astype(np.uint16)),
                        _binary(sl),
                    ],
                    names=["key", "cls", "n", "bands", "sig", "slices"],
                )

    return src.mapInArrow(run, f"key {kind}, cls bigint, n int, bands array<bigint>, sig binary, slices binary")


def shingle_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, cls and the sorted distinct 64-bit shingle hashes, as binary, of each long enough text."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where((F.length("text") >= MIN_WORDS) & F.col("key").isNotNull())
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for docs, starts, h in chunks(batch.column(1).to_pylist()):
                sets = [np.unique(h[starts[k] : starts[k + 1]]).tobytes() for k in range(len(docs))]
                cls = np.array([xxhash.xxh3_64_intdigest(x) for x in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(docs)), pa.array(cls), pa.array(sets, pa.binary())], names=["key", "cls", "set"])

    return src.mapInArrow(run, f"key {kind}, cls bigint, set binary")


def overlap(a: bytes, b: bytes) -> float:
    """Shingles in both through shingles in either, of two sorted sets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def with_overlap(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with the exact overlap of the sets in columns a and b in place of them."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            x, y = t.column(t.schema.get_field_index(a)), t.column(t.schema.get_field_index(b))
            sims = [overlap(u.as_py(), v.as_py()) for u, v in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([*(t.column(t.schema.get_field_index(c)) for c in rest), pa.array(sims, pa.float64())], names=[*rest, "overlap"])

    return pairs.mapInArrow(run, f"{kinds}, overlap double")


def band_pairs(nodes: DataFrame, sizes: tuple[float, float]) -> DataFrame:
    """Distinct pairs a < b of cls that share a band, whose n differ by no more than the factors of sizes,
    which is the triangle inequality at the empty pivot. nodes has one row per cls. The bands of both
    sides are shuffled once; hot bands are split."""
    x = nodes.select("cls", "n", F.explode("bands").alias("band"))
    got = bucket_pairs(x, ["band"], "cls", ("n",))
    return got.where(F.col("n_b").between(F.col("n_a") * sizes[0], F.col("n_a") * sizes[1])).select("a", "b").distinct()


def size_range(n: F.Column) -> F.Column:
    """The number of the range of sizes that n lies in."""
    return F.floor(F.log(n) / float(log(RANGE)) + 1e-9).cast("int")


def range_pairs(new: DataFrame, old: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a of new, b of old) of cls that share a band and lie in ranges of sizes that an overlap
    of the threshold allows. The join is partitioned by band and range: a row of old is in its own range, one
    of new in the two or so that lie within reach."""
    key = F.xxhash64("band", "size").alias("key")
    reach = F.sequence(size_range(F.col("n") * threshold), size_range(F.col("n") / threshold))
    x = new.select("cls", F.explode("bands").alias("band"), reach.alias("sizes")).select("cls", "band", F.explode("sizes").alias("size")).select("cls", key)
    y = old.select("cls", size_range(F.col("n")).alias("size"), F.explode("bands").alias("band")).select("cls", key)
    return bucket_pairs(x, ["key"], "cls", other=y).select("a", "b").distinct()
