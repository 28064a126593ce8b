"""MinHash signatures over CRC-32 shingles, their comparison and the routes derived from them."""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, crc_set

# fixed values: the prime, the value of an empty text, and the seed of the permutations
PRIME, EMPTY, SEED = 4294967291, 4294967295, 42


class Permutations(NamedTuple):
    a: tuple[int, ...]
    b: tuple[int, ...]
    shingle_size: int = 5


def permutations(num: int = 128, seed: int = SEED, shingle_size: int = 5) -> Permutations:
    rng = np.random.RandomState(seed)
    a = rng.randint(1, 2**31, num, dtype=np.int64)
    return Permutations(tuple(map(int, a)), tuple(map(int, rng.randint(0, 2**31, num, dtype=np.int64))), shingle_size)


def to_json(p: Permutations) -> str:
    return json.dumps({"num_perm": len(p.a), "shingle_size": p.shingle_size, "a": p.a, "b": p.b})


def from_json(text: str) -> Permutations:
    x = json.loads(text)
    return Permutations(tuple(x["a"]), tuple(x["b"]), x["shingle_size"])


def minima(h, p: Permutations) -> np.ndarray:  # noqa: ANN001
    """The minimum of (a h + b) mod PRIME over the shingles h, per permutation; EMPTY without shingles."""
    if h is None or not len(h):
        return np.full(len(p.a), EMPTY, np.int64)
    a, b = np.array(p.a, np.uint64)[:, None], np.array(p.b, np.uint64)[:, None]
    h = np.asarray(h, np.uint64)
    parts = [((a * h[lo : lo + 4096] + b) % np.uint64(PRIME)).min(1) for lo in range(0, len(h), 4096)]
    return np.minimum.reduce(parts).astype(np.int64)


def signature(crcs: Column | str, p: Permutations | None = None) -> Column:
    """minima() of a column of shingles."""
    p = p or permutations()

    @F.pandas_udf("array<bigint>")
    def sig(s: pd.Series) -> pd.Series:
        return s.map(lambda h: minima(h, p))

    return sig(col(crcs))


def text_signature(text: Column | str, p: Permutations | None = None) -> Column:
    """The signature of a text, without its shingles leaving Python."""
    p = p or permutations()

    @F.pandas_udf("array<bigint>")
    def sig(s: pd.Series) -> pd.Series:
        return s.map(lambda t: minima(crc_set(t, p.shingle_size), p))

    return sig(col(text))


def jaccard_estimate(x: Column | str, y: Column | str) -> Column:
    """Share of equal minima."""
    same = F.filter(F.zip_with(col(x), col(y), lambda u, v: u == v), lambda e: e)
    return F.size(same) / F.size(col(x))


def band_key(sig: Column | str, rows: int = 1) -> Column:
    """The first minima as bytes, eight little-endian bytes each."""
    out = []
    for k in range(rows):
        hexed = F.lpad(F.hex(F.element_at(col(sig), k + 1)), 16, "0")
        out += [F.substring(hexed, 2 * i + 1, 2) for i in range(7, -1, -1)]
    return F.unhex(F.concat(*out))


def md5_route(key: Column | str, parts: int) -> Column:
    """The MD5 of the key, as a number of 128 bits, modulo parts."""
    digest = F.md5(col(key))
    out = F.lit(0).cast("long")
    for k in range(4):  # 32 bits at a time
        part = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
        out = (out * ((1 << 32) % parts) + part) % parts
    return out.cast("int")
