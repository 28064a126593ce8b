"""Embeddings behind a cache table: hits by join, misses through a provider in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from ..config import DEFAULT
from ..functions.text import cache_key

#: texts -> one vector of the dimension per text
Provider = Callable[[list[str], int], np.ndarray]


def hashing_provider(texts: list[str], dim: int) -> np.ndarray:
    """A stand-in without a network: signed hashes of the words and word pairs, normalised."""
    import zlib

    out = np.zeros((len(texts), dim), np.float32)
    for i, t in enumerate(texts):
        w = t.lower().split()
        for g in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]:
            h = zlib.crc32(g.encode())
            out[i, h % dim] += 1 if h & 0x80000000 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def with_key(df: DataFrame, text: str = "text", dim: int = DEFAULT.embed_dim) -> DataFrame:
    return df.withColumn("key", cache_key(text, dim))


def cache_hits(df: DataFrame, cache: DataFrame) -> DataFrame:
    """The rows whose key is cached, with the vector. cache: key (unique), embedding."""
    return df.join(cache, "key")


def cache_misses(df: DataFrame, cache: DataFrame) -> DataFrame:
    return df.join(cache.select("key"), "key", "left_anti")


def embed(df: DataFrame, text: str, provider: Provider = hashing_provider, dim: int = DEFAULT.embed_dim, batch: int = DEFAULT.embed_batch_size, retries: int = 6) -> DataFrame:
    """df with `embedding`, by the provider, `batch` texts a call. Null text gives a null vector. A call
    that raises is repeated after a growing pause (at most 70 s), then the error goes up."""
    import time

    at = df.columns.index(text)
    schema = StructType([*df.schema.fields, StructField("embedding", ArrayType(FloatType()))])

    def call(texts: list[str]) -> np.ndarray:
        for k in range(retries):
            try:
                return provider(texts, dim)
            except Exception:
                if k == retries - 1:
                    raise
                time.sleep(min(70.0, 2.0**k))
        raise AssertionError

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            texts = b.column(at).to_pylist()
            out: list = [None] * len(texts)
            have = [k for k, t in enumerate(texts) if t is not None]
            for lo in range(0, len(have), batch):
                part = have[lo : lo + batch]
                for k, v in zip(part, call([texts[k] for k in part]), strict=True):
                    out[k] = v
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.float32()))], names=[*b.schema.names, "embedding"])

    return df.mapInArrow(run, schema)


def embedded(df: DataFrame, text: str, cache: DataFrame, provider: Provider = hashing_provider, dim: int = DEFAULT.embed_dim) -> tuple[DataFrame, DataFrame]:
    """The rows with their vectors, and the new cache rows to append. A text in many rows is embedded once."""
    keyed = with_key(df, text, dim)
    missing = cache_misses(keyed, cache).groupBy("key").agg(F.min(text).alias("_text"))
    fresh = embed(missing, "_text", provider, dim).select("key", "embedding")
    return keyed.join(cache.select("key", "embedding").unionByName(fresh), "key").drop("key"), fresh
