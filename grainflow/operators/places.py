"""Work that is dealt to places: rows of one kind (data) that others (queries) are compared with, and
pairs within buckets. Hot places and hot buckets are split on both sides."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: rows of a bucket that are joined as one; a larger bucket is split
HOT = 2000
#: one row in SAMPLE tells which buckets are hot: it only decides how the work is split
SAMPLE = 64
#: tasks at most; of more places several share one, one after the other
TASKS = 50_000

Build = Callable[[pa.Table], object]
Ask = Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]]


def per_place(df: DataFrame, places: int, build: Build, ask: Ask, schema: str, own: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, tasks: int | None = None) -> DataFrame:
    """The answers of each place. df: place (0 .. places - 1), kind (0: data, 1: queries), and what build and ask
    need. Each place is a task of its own, unless there are to be fewer tasks; a task's places come one after
    the other.

    The data of a place is gathered (the caller bounds it by slicing), its queries stream by in Arrow
    batches of any number. own, if given, makes queries of a batch of data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, data, index = None, [], None

        def opened() -> Iterator[pa.RecordBatch]:
            nonlocal index
            index = build(pa.Table.from_batches(data))
            for d in data if own else ():
                q = own(d)
                if q.num_rows:
                    yield from ask(index, q)

        for b in batches:
            p, k = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(p) != 0) | (np.diff(k) != 0)) + 1), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if p[lo] != place:
                    if data and index is None and own:
                        yield from opened()
                    place, data, index = p[lo], [], None
                if k[lo] == 0:
                    data.append(b.slice(lo, hi - lo))
                elif data:
                    if index is None:
                        yield from opened()
                    yield from ask(index, b.slice(lo, hi - lo))
        if data and index is None and own:
            yield from opened()

    return df.repartitionById(max(1, min(places, tasks or TASKS)), F.col("place").cast("int")).sortWithinPartitions("place", "kind").mapInArrow(run, schema)


def bucket_pairs(x: DataFrame, buckets: list[str], node: str, carry: tuple[str, ...] = (), hot: int = HOT, other: DataFrame | None = None) -> DataFrame:
    """Pairs of rows of one bucket: a, b (a < b, or a of x and b of other), and carry as <name>_a and
    <name>_b; a pair as often as it shares buckets. A bucket of more than some `hot` rows is split: one
    side is dealt by hash, the other goes to all parts."""
    y = x if other is None else other
    near = x.where(F.pmod(F.xxhash64(node, F.lit(11)), F.lit(SAMPLE)) == 0).groupBy(*buckets).agg(F.count("*").alias("_n"))
    ways = near.where(F.col("_n") >= max(2, hot // SAMPLE // 2)).select(*buckets, F.ceil(F.col("_n") * SAMPLE / hot).alias("_ways"))

    def joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        a = left.select(*on, F.col(node).alias("a"), *(F.col(c).alias(f"{c}_a") for c in carry))
        b = right.select(*on, F.col(node).alias("b"), *(F.col(c).alias(f"{c}_b") for c in carry))
        got = a.join(b, on)
        return (got.where("a < b") if other is None else got).drop(*on)

    if ways.isEmpty():
        return joined(x, y, buckets)
    ways = stored(ways, "hot")
    cold = joined(x.join(ways, buckets, "left_anti"), y if other is not None else x.join(ways, buckets, "left_anti"), buckets)
    left = x.join(ways, buckets).withColumn("_part", F.pmod(F.xxhash64(node, F.lit(3)), F.col("_ways"))).drop("_ways")
    right = y.join(ways, buckets).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_ways") - 1))).drop("_ways")
    return cold.unionByName(joined(left, right, [*buckets, "_part"]))
