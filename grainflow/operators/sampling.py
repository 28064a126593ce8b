"""Scans, limits, ordered numbering, batches, samples and splits. Order is an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..session import stored


def corpus_scan(df: DataFrame, seq: str, key: str, text: str, limit: int = DEFAULT.sample_size) -> DataFrame:
    """The first `limit` rows with text, in order; id is the key, or the order number where it is null."""
    x = df.where(F.length(text) > 0)
    x = x.join(cut_off(x, seq, limit), seq, "left_semi")
    return x.withColumn("id", F.coalesce(F.col(key).cast("string"), F.col(seq).cast("string")))


def cut_off(df: DataFrame, order: str, limit: int) -> DataFrame:
    """The first `limit` values of a unique order column. Only these values are moved, never the rows:
    each range partition gives its own, and the offsets of the ranges tell which count."""
    return numbered(df.select(order), order, "_rn").where(F.col("_rn") <= limit).select(order)


def first_passing(df: DataFrame, seq: str, n: int) -> DataFrame:
    """The first n rows without a reason."""
    x = df.where("reason is null")
    return x.join(cut_off(x, seq, n), seq, "left_semi")


def double_capped(df: DataFrame, seq: str, decided: Column, decisions: int = 200, rows: int = 300) -> DataFrame:
    """The decided rows until there are `decisions` of them or `rows` rows were read."""
    head = df.orderBy(seq).limit(rows).where(decided)  # a bounded number of rows
    return head.orderBy(seq).limit(decisions)


def numbered(df: DataFrame, order: str, name: str = "rn") -> DataFrame:
    """df with the row number 1, 2, ... by the order column, without moving all rows to one task.

    Rows are range-partitioned by order and numbered within their range; the ranges' sizes, one per
    partition, give the offsets."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored, since the bounds of the ranges are sampled and both uses must see the same
    x = stored(df.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = x.groupBy("_part").agg(F.count("*").alias("_n"), F.min(order).alias("_from"))
    w = Window.orderBy("_from")
    offsets = sizes.select("_part", (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
    inner = Window.partitionBy("_part").orderBy(order)
    return x.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.row_number().over(inner)).drop("_part", "_before")


def cumulated(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """df with the sum of value over the rows before, by a unique order, from range partitions and their sums."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = stored(df.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = x.groupBy("_part").agg(F.sum(value).alias("_sum"), F.min(order).alias("_from"))
    offsets = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_from")) - F.col("_sum")).alias("_before"))  # a row per partition
    inner = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return x.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + inner).drop("_part", "_before")


def every_nth(df: DataFrame, order: str, n: int = DEFAULT.reject_every) -> DataFrame:
    """Each n-th row by order."""
    return numbered(df, order, "_rn").where(F.col("_rn") % n == 0).drop("_rn")


def batches(df: DataFrame, order: str, size: int, name: str = "batch") -> DataFrame:
    """df with the batch number 0, 1, ... of `size` consecutive rows and the place in it, from 0."""
    x = numbered(df, order, "_rn")
    return x.withColumn(name, F.floor((F.col("_rn") - 1) / size)).withColumn("place", ((F.col("_rn") - 1) % size).cast("int")).drop("_rn")


def hash_order(key: str, seed: int = 42) -> Column:
    """A fixed pseudo-random order of the keys."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key)


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.75, seed: int = 42) -> DataFrame:
    """df with `part`, train for the first floor(share * n) rows of each label in the order of the key's
    hash, then the key, else test. key is unique; a null label is a label.

    The cut of a label is found by hash histograms: rows are counted by label and 12 bits of the hash, and
    only the bucket in which the cut lies is counted again by the next bits, so no label is gathered or
    sorted. Labels are few."""
    h = F.conv(F.substring(hash_order(key, seed), 1, 15), 16, 10).cast("long")
    x = stored(df.select(F.col(key).alias("_k"), F.col(label).alias("_l"), h.alias("_h")), "hashes")
    low = x.groupBy("_l").agg(F.floor(F.count("*") * share).cast("long").alias("_left")).withColumn("_low", F.lit(0).cast("long"))
    for shift in (48, 36, 24, 12, 0):
        low = stored(low, "cut")  # a row per label
        inside = x.join(F.broadcast(low), x["_l"].eqNullSafe(low["_l"])).where((F.col("_h") >= F.col("_low")) & (F.shiftright(F.col("_h") - F.col("_low"), shift) < 4096))
        each = inside.groupBy(x["_l"].alias("_l"), F.shiftright(F.col("_h") - F.col("_low"), shift).alias("_b")).agg(F.count("*").alias("_n"))
        upto = each.withColumn("_sum", F.sum("_n").over(Window.partitionBy("_l").orderBy("_b")))  # 4096 rows a label at most
        upto = low.alias("c").join(upto.alias("u"), F.col("c._l").eqNullSafe(F.col("u._l")), "left").where(F.col("u._sum").isNull() | (F.col("u._sum") <= F.col("c._left")) | (F.col("u._sum") - F.col("u._n") <= F.col("c._left")))
        full = F.coalesce(F.sum(F.when(F.col("u._sum") <= F.col("c._left"), F.col("u._n"))), F.lit(0))
        at = F.coalesce(F.min(F.when(F.col("u._sum") > F.col("c._left"), F.col("u._b"))), F.lit(4096))
        low = upto.groupBy(F.col("c._l").alias("_l"), F.col("c._left").alias("_left"), F.col("c._low").alias("_low")).agg(full.alias("_f"), at.cast("long").alias("_at"))
        low = low.select("_l", (F.col("_left") - F.col("_f")).alias("_left"), (F.col("_low") + F.shiftleft("_at", shift)).alias("_low"))
    low = stored(low, "cut")
    # rows of one 60-bit hash, if any, are told apart by their keys
    ties = x.join(F.broadcast(low), x["_l"].eqNullSafe(low["_l"])).where("_h = _low and _left > 0").select(x["_l"].alias("_l"), "_k", "_left")
    rank = F.row_number().over(Window.partitionBy("_l").orderBy("_k"))
    ties = ties.withColumn("_r", rank).where("_r <= _left").select(F.col("_k"), F.lit(True).alias("_tie"))
    cut = low.select(F.col("_l").alias("_label"), "_low")
    out = df.withColumn("_h", h).join(F.broadcast(cut), F.col("_label").eqNullSafe(F.col(label))).join(ties, F.col(key) == F.col("_k"), "left")
    return out.select(*df.columns, F.when((F.col("_h") < F.col("_low")) | F.col("_tie"), "train").otherwise("test").alias("part"))


def weighted_choice(u: Column, choices: list[tuple[str, float]]) -> Column:
    """The choice whose cumulative weight is the first above u (0 <= u < 1) times the sum of weights."""
    total, at, out = sum(w for _, w in choices), 0.0, None
    for name, w in choices:
        at += w
        test = u * total < at
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(choices[-1][0])


def first_seen(df: DataFrame, group: str, order: str, name: str = "is_repeat") -> DataFrame:
    """df with whether the group occurred at an earlier order value; by the group's minimum, not a window."""
    least = df.groupBy(group).agg(F.min(order).alias("_first"))
    return df.join(least, group).withColumn(name, F.col(order) > F.col("_first")).drop("_first")
