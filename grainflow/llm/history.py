"""Checking new batches against all history through a pivot-distance table.

The metric is the size of the symmetric difference of two shingle sets. Its pivots are fixed: the
slices of the shingle space (by the top bits of the hash) and the empty set. The distance of a text
to a slice follows from the number of its shingles in that slice, so the table holds these numbers
and the total, the distance to the empty set. Triangle inequality, slice by slice: two texts differ
by at least the sum of the differences of those numbers, and an overlap of t or more means that
they differ by at most (1 - t) / (1 + t) of their total size. Both bounds are exact, they lose no
pair. Alone they can't choose the candidates: unrelated texts of one size lie at the same distances
from any pivot, so a range join on them would meet a share of all pairs. Therefore the table, which is
partitioned by ranges of the distance to the empty set, is joined by range and MinHash band (see README).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, stored
from ._shingles import SLICES, bands_for, fingerprints, range_pairs, shingle_sets, size_range, with_overlap
from .near_dups import MISS

THRESHOLD = 0.8
COLUMNS = ["key", "cls", "n", "bands", "slices"]


def pivot_prune(pairs: DataFrame, threshold: float) -> DataFrame:
    """a and b of the pairs (a, b, p_a, p_b) that the triangle inequality at the pivots allows."""
    most = (1 - threshold) / (1 + threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            n = t.num_rows
            if not n:
                continue
            x, y = (np.frombuffer(b"".join(t.column(k).to_pylist()), np.uint8).reshape(n, SLICES).astype(np.int32) for k in (2, 3))
            # a slice's number is capped at 255, which only lowers the bound
            keep = np.flatnonzero(np.abs(x - y).sum(1) <= most * (t.column(4).to_numpy() + t.column(5).to_numpy()) + 1e-9)
            yield pa.RecordBatch.from_arrays([t.column(k).take(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "p_a", "p_b", "n_a", "n_b").mapInArrow(run, "a bigint, b bigint")


def _likely(new: DataFrame, old: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of cls that share a band, lie in ranges within reach, and pass the pivot bounds."""
    cand = range_pairs(new, old, threshold).where("a <> b")
    cand = cand.join(new.select(F.col("cls").alias("a"), F.col("slices").alias("p_a"), F.col("n").alias("n_a")), "a")
    cand = cand.join(old.select(F.col("cls").alias("b"), F.col("slices").alias("p_b"), F.col("n").alias("n_b")), "b")
    return pivot_prune(cand, threshold)


def _nodes(prints: DataFrame) -> DataFrame:
    """One row per cls. Copies are found on (cls, key) alone, without moving their bands."""
    reps = prints.groupBy("cls").agg(F.min("key").alias("rep"), F.count("*").alias("rows"))
    copied = stored(reps.where("rows > 1").select("cls", "rep"), "copied")
    first = prints.join(copied, "cls").where(F.col("key") == F.col("rep")).dropDuplicates(["cls"])
    return prints.join(copied, "cls", "left_anti").select(COLUMNS).unionByName(first.select(COLUMNS))


def _sets(df: DataFrame, key: str, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and set of the wanted classes, from the text of each one's node."""
    reps = stored(nodes.join(wanted, "cls", "left_semi").select(F.col("key").alias("rep")).distinct(), "wanted")
    texts = df.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(reps, "rep", "left_semi")
    return shingle_sets(texts, "rep", "text").select("cls", "set")


class History:
    """Everything accepted so far, as a table of pivot distances that grows by appending.

    The table has a folder per range of sizes (the distance to the empty pivot) and, unless sets is False,
    the shingle sets beside it. check() fingerprints the new batch alone, reads the folders within its
    reach and what it must verify; append() adds the accepted rows. Old rows are never computed again.
    The bands lose a pair at the threshold with a chance of miss at most; the pivots lose none.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = THRESHOLD, miss: float = MISS, sets: bool = True) -> None:
        self.spark, self.path, self.threshold, self.sets = spark, path.rstrip("/"), threshold, sets
        self.shape = bands_for(threshold, miss)

    def _prints(self, df: DataFrame, key: str, text: str) -> DataFrame:
        return stored(fingerprints(df, key, text, self.shape).drop("sig"), "prints")

    def append(self, df: DataFrame, key: str, text: str) -> None:
        """Adds the texts of df. A class that is there already may be added again; it counts once. Keys are kept as
        strings."""
        nodes = _nodes(self._prints(df, key, text)).withColumn("key", F.col("key").cast("string")).withColumn("size", size_range(F.col("n")))
        nodes.write.mode("append").partitionBy("size").parquet(f"{self.path}/pivots")
        if self.sets:
            shingle_sets(df, key, text).select("cls", "set").dropDuplicates(["cls"]).write.mode("append").parquet(f"{self.path}/sets")

    def table(self) -> DataFrame:
        """The table of pivot distances."""
        return self.spark.read.schema("key string, cls bigint, n int, bands array<bigint>, slices binary, size int").parquet(f"{self.path}/pivots")

    def check(self, batch: DataFrame, key: str, text: str, order: list[str], history: tuple[DataFrame, str, str] | None = None) -> DataFrame:
        """key of the rows of the batch that overlap by the threshold or more with a text of the history or
        with an earlier row, in the given order, that is itself not refused.

        key must be unique in batch. Rows whose text is null, empty or under 20 words are never refused and
        refuse nothing. Only texts count, not ids. Ties in the order are broken by key. history: the accepted
        texts with their keys, to verify on where the sets aren't kept."""
        prints = self._prints(batch, key, text)
        new = _nodes(prints)
        reach = new.select(F.explode(F.sequence(size_range(F.col("n") * self.threshold), size_range(F.col("n") / self.threshold))).alias("s")).distinct()
        old = self.table().where(F.col("size").isin([r["s"] for r in reach.collect()]))  # a number per range
        known = prints.select("cls").distinct().join(old.select("cls"), "cls", "left_semi")
        likely = stored(
            _likely(new, old, self.threshold).withColumn("side", F.lit(1)).unionByName(_likely(new, new, self.threshold).where("a < b").withColumn("side", F.lit(0))),
            "likely",
        )
        mine = likely.select(F.col("a").alias("cls")).unionByName(likely.where("side = 0").select(F.col("b").alias("cls"))).distinct()
        theirs = likely.where("side = 1").select(F.col("b").alias("cls")).distinct()
        sets = _sets(batch, key, text, new, mine)
        if history is None:
            sets = sets.unionByName(self.spark.read.schema("cls bigint, set binary").parquet(f"{self.path}/sets").join(theirs, "cls", "left_semi"))
        else:
            df, k, t = history
            sets = sets.unionByName(_sets(df.select(F.col(k).cast("string").alias("k"), F.col(t).alias("t")), "k", "t", old, theirs))
        sets = sets.dropDuplicates(["cls"])
        got = likely.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")), "a")
        got = got.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")), "b")
        pairs = stored(with_overlap(got.select("a", "b", "side", "set_a", "set_b"), "set_a", "set_b").where(F.col("overlap") >= self.threshold), "pairs")

        # a class stands where its first row stands: if that is refused, so are all others, else only they are
        place = F.struct(*(F.col(c) for c in dict.fromkeys([*order, key])))
        rows = prints.select("key", "cls").join(batch.select(F.col(key).alias("key"), place.alias("place")), "key")
        first = rows.groupBy("cls").agg(F.min("place").alias("place"))
        by_history = known.unionByName(pairs.where("side = 1").select(F.col("a").alias("cls"))).distinct()
        inner = pairs.where("side = 0").select("a", "b")
        p = first.select(F.col("cls").alias("a"), F.col("place").alias("p_a")), first.select(F.col("cls").alias("b"), F.col("place").alias("p_b"))
        earlier_later = inner.join(p[0], "a").join(p[1], "b").select(
            F.when(F.col("p_a") < F.col("p_b"), F.col("a")).otherwise(F.col("b")).alias("early"),
            F.when(F.col("p_a") < F.col("p_b"), F.col("b")).otherwise(F.col("a")).alias("late"),
        )
        bad = greedy_refused(stored(earlier_later, "edges"), stored(by_history, "refused"))
        flagged = rows.join(bad.withColumn("bad", F.lit(True)), "cls", "left").join(first.withColumnRenamed("place", "first"), "cls")
        return flagged.where(F.col("bad").isNotNull() | (F.col("place") > F.col("first"))).select(F.col("key").alias(key)).distinct()


def refused(batch: DataFrame, history: DataFrame, key: str, order: list[str], text: str, history_key: str, threshold: float = THRESHOLD) -> DataFrame:
    """key of the batch rows to be refused, for a history that has no table of pivot distances yet: it is
    made, and the batch checked against it. An empty batch gives no rows; an empty history checks the batch
    against itself. See History.check."""
    spark = batch.sparkSession
    table = History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", threshold, sets=False)
    table.append(history, history_key, text)
    return table.check(batch, key, text, order, (history, history_key, text))


def batch_by_batch(batches: DataFrame, history: DataFrame, number: str, key: str, order: list[str], text: str, history_key: str, threshold: float = THRESHOLD) -> DataFrame:
    """number and key of the refused rows, batch after batch: each is checked against a table that grows by
    the rows accepted before. Batches are few."""
    spark = batches.sparkSession
    table = History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}", threshold)
    table.append(history, history_key, text)
    out = batches.select(number, key).limit(0)
    for r in batches.select(number).distinct().orderBy(number).collect():  # a number per batch
        part = batches.where(F.col(number).eqNullSafe(r[number]))
        bad = stored(table.check(part, key, text, order), "bad")
        table.append(part.join(bad, key, "left_anti"), key, text)
        out = out.unionByName(bad.select(F.lit(r[number]).cast(batches.schema[number].dataType).alias(number), key))
    return out


def greedy_refused(edges: DataFrame, refused_: DataFrame) -> DataFrame:
    """cls refused when classes are taken in order: by refused_, or by an earlier accepted neighbour.

    edges: early, late. Each round accepts the classes without an open earlier neighbour and refuses
    their later neighbours; the rounds are as many as the longest chain of undecided neighbours.
    """
    bad, open_ = refused_, edges
    while True:
        # an edge is settled once either end is refused: the early end can't refuse, the late end is refused
        for end in ("early", "late"):
            open_ = open_.join(bad.withColumnRenamed("cls", end), end, "left_anti")
        open_ = stored(open_, "edges")
        if open_.isEmpty():
            return bad
        late = open_.select(F.col("late").alias("early")).distinct()
        hit = open_.join(late, "early", "left_anti").select(F.col("late").alias("cls")).distinct()
        bad = stored(bad.unionByName(hit).distinct(), "refused")
