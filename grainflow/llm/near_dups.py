"""Near-duplicate records with small edits, by sequential Bayesian verification.

Exact copies (equal sets of shingles) form a class with one representative. MinHash bands propose
pairs of representatives; their signatures are compared batch by batch, and a pair is dropped as
soon as the posterior probability that its similarity reaches the threshold falls under the chosen
miss probability; the survivors are verified exactly on their shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ._shingles import PERMS, band_pairs, bands_for, fingerprints, shingle_sets, with_overlap

THRESHOLD, MISS, BATCH = 0.8, 0.001, 16


class NearDuplicates(NamedTuple):
    """members: key, cls, one row per distinct key with a long enough text. pairs: a < b, overlap,
    the pairs of different classes that overlap by the threshold or more."""

    members: DataFrame
    pairs: DataFrame


def least_matches(threshold: float, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(n, m): after n compared minima, fewer than m equal ones make similarity >= threshold less
    likely than miss. Uniform prior: the posterior is Beta(m + 1, n - m + 1), whose tail above t
    is the chance of at most m successes in n + 1 trials of chance t."""
    out = []
    for n in range(batch, PERMS + 1, batch):
        tail, m = 0.0, 0
        while True:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def prune_loss(threshold: float, miss: float) -> float:
    """The chance that bayes_prune() drops a pair of exactly the threshold, at any of its steps."""
    live, at, lost = np.ones(1), 0, 0.0
    for n, least in least_matches(threshold, miss):
        k = n - at
        live = np.convolve(live, [comb(k, m) * threshold**m * (1 - threshold) ** (k - m) for m in range(k + 1)])
        lost += live[:least].sum()
        live[:least] = 0.0
        at = n
    return float(lost)


def miss_shares(threshold: float, miss: float) -> tuple[tuple[int, int], float]:
    """Rows and bands, and the miss of bayes_prune(), that together lose a pair of the threshold with a
    chance of miss at most: half of it each."""
    prune = miss / 2
    while prune_loss(threshold, prune) > miss / 2:
        prune /= 2
    return bands_for(threshold, miss / 2), prune


def bayes_prune(pairs: DataFrame, threshold: float, miss: float = MISS) -> DataFrame:
    """a and b of the pairs (a, b, sig_a, sig_b) that no batch of minima rules out."""
    steps = least_matches(threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            n = t.num_rows
            if not n:
                continue
            x, y = (np.frombuffer(b"".join(t.column(k).to_pylist()), np.uint16).reshape(n, PERMS) for k in (2, 3))
            live, same, at = np.arange(n), np.zeros(n, np.int32), 0
            for upto, least in steps:
                same[live] += (x[live, at:upto] == y[live, at:upto]).sum(1, dtype=np.int32)
                live, at = live[same[live] >= least], upto
            yield pa.RecordBatch.from_arrays([t.column(k).take(pa.array(live)) for k in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD, miss: float = MISS) -> NearDuplicates:
    """Classes of exact copies, and all pairs of different classes that overlap by threshold or more.

    Rows without text, or with fewer than 20 words, are in no class. Repeated rows of a key count
    once; if a key has several texts, each counts. Rows with a null key are left out. Three stages
    are written to the shared folder: fingerprints, surviving pairs and verified pairs.
    """
    shape, prune = miss_shares(threshold, miss)
    prints = stored(fingerprints(df, key, text, shape).drop("slices"), "prints")
    members = prints.select("key", "cls").distinct()
    # one row per class: the copies are few or many, but the rows that are no representative are
    # named in a table of their own, which the planner broadcasts only if it is small
    reps = prints.groupBy("cls").agg(F.min_by("key", F.xxhash64("key")).alias("rep"), F.count("*").alias("rows"))
    copied = stored(reps.where("rows > 1").select("cls", "rep"), "copied")
    single = prints.join(copied, "cls", "left_anti")
    first = prints.join(copied, "cls").where(F.col("key").eqNullSafe(F.col("rep"))).dropDuplicates(["cls"])
    cols = ["cls", "n", "bands", "sig"]
    nodes = single.select(cols).unionByName(first.select(cols))
    # overlap >= t bounds the sizes to within a factor of t
    cand = band_pairs(nodes, (threshold, 1 / threshold))
    sig = nodes.select("cls", "sig")
    cand = cand.join(sig.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a")
    cand = cand.join(sig.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b")
    likely = stored(bayes_prune(cand, threshold, prune), "likely")
    pairs = verified(df, key, text, prints, likely, threshold)
    return NearDuplicates(members, stored(pairs, "pairs"))


def verified(df: DataFrame, key: str, text: str, prints: DataFrame, likely: DataFrame, threshold: float) -> DataFrame:
    """a, b and overlap of the likely pairs that reach the threshold, on their exact shingle sets."""
    wanted = likely.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    who = stored(prints.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min_by("key", F.xxhash64("key")).alias("rep")), "wanted")
    texts = df.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    texts = texts.join(who.select("rep").distinct(), "rep", "left_semi")
    sets = shingle_sets(texts, "rep", "text").select("cls", "set").dropDuplicates(["cls"])
    got = likely.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("set_a")), "a")
    got = got.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("set_b")), "b")
    return with_overlap(got.select("a", "b", "set_a", "set_b"), "set_a", "set_b").where(F.col("overlap") >= threshold)


def components(edges: DataFrame) -> DataFrame:
    """node, root of the nodes of edges (a, b): root is the least node that a chain of edges leads to.

    Large-star and small-star rounds: each node's larger neighbours are tied to its least one, then its
    smaller ones, until nothing changes; the rounds grow with the logarithm of the longest chain, and every
    round is two shuffles of the edges. A node of very many edges is aggregated before its rows meet."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        # large star: every neighbour above a node goes to the least of the node and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its neighbours below go to the least of them
        large = stored(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = stored(tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if small.count() == e.count() and small.exceptAll(e).isEmpty():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        e = small


def class_ids(found: NearDuplicates) -> DataFrame:
    """key, cls, grp, copies, links of each key with a long enough text: the least key of its class (the keys of
    equal shingle sets), the least key of its group (what chains of overlaps connect), the keys of its class,
    and the other classes that its class overlaps."""
    size = stored(found.members.groupBy("cls").agg(F.count("*").alias("copies"), F.min("key").alias("rep")), "classes")
    names = size.select("cls", "rep")
    linked = found.pairs.join(names.select(F.col("cls").alias("a"), F.col("rep").alias("x")), "a").join(names.select(F.col("cls").alias("b"), F.col("rep").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    linked = stored(linked, "links")
    links = linked.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    whole = size.join(links, "rep", "left").join(components(linked).select(F.col("node").alias("rep"), F.col("root")), "rep", "left")
    out = found.members.join(whole, "cls")
    return out.select("key", F.col("rep").alias("cls"), F.coalesce("root", "rep").alias("grp"), "copies", F.coalesce("links", F.lit(0)).alias("links"))


def id_pairs(found: NearDuplicates) -> DataFrame:
    """id_a < id_b: all pairs of different keys whose texts overlap by the threshold or more."""
    m = found.members
    a, b = m.select(F.col("key").alias("k"), F.col("cls").alias("a")), m.select(F.col("key").alias("l"), F.col("cls").alias("b"))
    within = m.join(found.members.select(F.col("key").alias("l"), F.col("cls").alias("c2")), F.col("cls") == F.col("c2")).where("key < l")
    between = found.pairs.join(a, "a").join(b, "b").where("k <> l")
    both = between.select(F.least("k", "l").alias("id_a"), F.greatest("k", "l").alias("id_b"))
    return within.select(F.col("key").alias("id_a"), F.col("l").alias("id_b")).unionByName(both).distinct()
