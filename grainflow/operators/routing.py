"""Which partition a document belongs to: by band, by MD5 of a key, or in contiguous shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.minhash import band_key, md5_route
from .sampling import numbered

#: (id, signature, parts) -> a column with the partition's number
Route = Callable[[Column, Column, int], Column]


def by_id(key: Column, _sig: Column, parts: int) -> Column:
    return md5_route(key.cast("string").cast("binary"), parts)


def by_band(_key: Column, sig: Column, parts: int, rows: int = 1) -> Column:
    return md5_route(band_key(sig, rows), parts)


def routed(df: DataFrame, key: str, sig: str, parts: int, route: Route = by_band) -> DataFrame:
    """df with `part`, an explicit column: adaptive execution may merge physical partitions."""
    return df.withColumn("part", route(F.col(key), F.col(sig), parts))


def contiguous(df: DataFrame, order: str, parts: int) -> DataFrame:
    """df with `part`: ceil(n / parts) consecutive rows each."""
    size = max(1, -(-df.count() // parts))
    return numbered(df, order, "_rn").withColumn("part", F.floor((F.col("_rn") - 1) / size).cast("int")).drop("_rn")
