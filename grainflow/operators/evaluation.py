"""Evaluation: precision and recall of dedup, sweeps, partition experiments, parity, gates, reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .dedup import cosine_pairs, nearest_prior, settle, with_surface
from .routing import by_band, by_id
from .sampling import first_seen

# fixed values: the thresholds of the sweep, the partition counts and prefix sizes of the experiments
SWEEP = (0.80, 0.84, 0.88, 0.90, 0.92, 0.94, 0.96, 0.98)
PARTS = (1, 2, 4, 8)
CUTS = (50, 100, 200, 300)
# fixed values: the gates
GATES = {"dedup_recall": 0.90, "dedup_precision": 0.95, "classifier_auc": 0.85, "docs_per_sec": 1000.0, "scaling": 3.0}


def precision_recall(flagged: DataFrame, *by: str) -> DataFrame:
    """A row (for each value of by) from (is_repeat, dropped): dropped, dups, hits, precision (1 with nothing dropped), recall (0 with no dups)."""
    hit = F.col("dropped") & F.col("is_repeat")
    x = flagged.groupBy(*by).agg(F.count_if("dropped").alias("dropped"), F.count_if("is_repeat").alias("dups"), F.count_if(hit).alias("hits"))
    return x.withColumn("precision", F.coalesce(F.try_divide("hits", "dropped"), F.lit(1.0))).withColumn("recall", F.coalesce(F.try_divide("hits", "dups"), F.lit(0.0)))


def _settled(pairs: DataFrame, threshold: float, surface: float = 0.5) -> DataFrame:
    """run, i: the rejected documents of each run, from pairs (run, i, j, sim, surface). The runs are settled
    together, each round at once: one after the other they are so many more plans for the driver."""
    ends = (F.struct("run", F.col(c).alias("at")).alias(c) for c in ("i", "j"))
    return settle(pairs.select(*ends, "sim", "surface"), threshold, surface).select("i.run", F.col("i.at").alias("i"))


def _flagged(seen: DataFrame, seq: str, gone: DataFrame, runs: int) -> DataFrame:
    """seen with dropped, for each run 0 .. runs - 1."""
    each = seen.withColumn("run", F.explode(F.array(*map(F.lit, range(runs)))))
    gone = gone.select("run", F.col("i").alias(seq), F.lit(True).alias("dropped"))
    return each.join(gone, ["run", seq], "left").withColumn("dropped", F.coalesce("dropped", F.lit(False)))


def threshold_sweep(docs: DataFrame, seq: str, group: str, emb: str, thresholds: tuple[float, ...] = SWEEP) -> DataFrame:
    """threshold and precision_recall() of each; the pairs are found once, at the lowest threshold."""
    seen = stored(first_seen(docs.select(seq, group), group, seq), "seen")
    pairs = stored(cosine_pairs(docs, seq, emb, min(thresholds)).withColumn("surface", F.lit(None).cast("double")), "sweep")
    runs = F.array(*(F.struct(F.lit(k).alias("run"), F.lit(float(t)).alias("t")) for k, t in enumerate(thresholds)))
    of = pairs.select("i", "j", "sim", "surface", F.explode(F.filter(runs, lambda r: r["t"] <= F.col("sim"))).alias("r")).select("i", "j", "sim", "surface", "r.run")
    x = precision_recall(_flagged(seen, seq, _settled(of, min(thresholds)), len(thresholds)), "run")
    return x.withColumn("threshold", F.element_at(F.array(*map(F.lit, map(float, thresholds))), F.col("run") + 1)).orderBy("run").drop("run")


def recall_by_partitions(docs: DataFrame, seq: str, key: str, group: str, emb: str, sig: str, parts: tuple[int, ...] = PARTS, threshold: float = 0.9, surface: float = 0.5) -> DataFrame:
    """parts, route (doc_id: cosine only; minhash: verified) and precision_recall() of each."""
    seen = stored(first_seen(docs.select(seq, group), group, seq), "seen")
    # pairs don't depend on the partition: found once, and kept where both ends share it
    pairs = stored(with_surface(cosine_pairs(docs, seq, emb, threshold), docs, seq, sig), "pairs")
    runs = [(name, route, p) for name, route in (("doc_id", by_id), ("minhash", by_band)) for p in parts]
    place = stored(docs.select(seq, F.array(*(route(F.col(key), F.col(sig), p) for _, route, p in runs)).alias("at")), "place")
    x = pairs.join(place.select(F.col(seq).alias("i"), F.col("at").alias("at_i")), "i").join(place.select(F.col(seq).alias("j"), F.col("at").alias("at_j")), "j")
    x = x.select("i", "j", "sim", "surface", F.posexplode(F.zip_with("at_i", "at_j", lambda a, b: a == b)).alias("run", "same")).where("same")
    verified = F.element_at(F.array(*(F.lit(name == "minhash") for name, _, _ in runs)), F.col("run") + 1)
    gone = _settled(x.withColumn("surface", F.when(verified, F.col("surface"))), threshold, surface)
    r = precision_recall(_flagged(seen, seq, gone, len(runs)), "run")
    what = F.array(*(F.struct(F.lit(p).alias("parts"), F.lit(name).alias("route")) for name, _, p in runs))
    return r.withColumn("_of", F.element_at(what, F.col("run") + 1)).orderBy("run").select("*", "_of.*").drop("run", "_of")


def nearest_prior_stats(docs: DataFrame, seq: str, emb: str, cuts: tuple[int, ...] = CUTS, threshold: float = 0.9) -> DataFrame:
    """n and p50, p95, p99, max of the similarity to the nearest earlier vector, and collisions at or
    above the threshold, among the first n documents, for each cut and all (n = 0)."""
    from .sampling import numbered

    sims = nearest_prior(docs, seq, emb)
    x = stored(numbered(docs.select(seq), seq, "rn").join(sims, F.col(seq) == F.col("i")).select("rn", "sim"), "nearest")
    out = None
    for n in (*cuts, 0):
        part = x.where(F.col("rn") <= n) if n else x
        p = F.percentile("sim", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
        r = part.agg(p.alias("p"), F.max("sim").alias("max"), F.count_if(F.col("sim") >= threshold).alias("collisions"))
        r = r.select(F.lit(n).alias("n"), F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"), "max", "collisions")
        out = r if out is None else out.unionByName(r)
    return out


def false_drops(docs: DataFrame, seq: str, emb: str, sig: str, threshold: float = 0.9, surface: float = 0.5) -> DataFrame:
    """mode (cosine, verified), drops: among distinct documents each drop is false."""
    pairs = stored(with_surface(cosine_pairs(docs, seq, emb, threshold), docs, seq, sig), "pairs")
    x = pairs.select("i", "j", "sim", F.explode(F.array(F.struct(F.lit("cosine").alias("run"), F.lit(None).cast("double").alias("surface")), F.struct(F.lit("verified").alias("run"), "surface"))).alias("r"))
    gone = _settled(x.select("r.run", "i", "j", "sim", "r.surface"), threshold, surface)
    n = gone.agg(*(F.count_if(F.col("run") == mode).alias(mode) for mode in ("cosine", "verified")))
    return n.select(F.explode(F.array(*(F.struct(F.col(mode).alias("drops"), F.lit(mode).alias("mode")) for mode in ("cosine", "verified")))).alias("r")).select("r.*")


def mismatches(reference: DataFrame, other: DataFrame, key: str, columns: list[str], limit: int = 10) -> DataFrame:
    """key of the first rows by key of reference whose columns differ, null-safe, or that other lacks."""
    o = other.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_o_{c}") for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return reference.join(o, F.col(key) == F.col("_k"), "left").where(F.col("_k").isNull() | ~same).select(key).orderBy(key).limit(limit)


def same_decisions(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows, repeated ones as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def speedups(bench: DataFrame, base: Column, rate: str = "docs_per_sec") -> DataFrame:
    """bench with `speedup`, the rate through that of the row base holds for (the best, if for several)."""
    b = bench.where(base).agg(F.max(rate).alias("_base"))
    return bench.join(F.broadcast(b), how="left", on=F.lit(True)).withColumn("speedup", F.try_divide(F.col(rate), F.col("_base"))).drop("_base")  # one row


def gates(report: dict[str, float], bars: dict[str, float] = GATES) -> dict[str, bool]:
    """Whether each measured figure reaches its bar; a figure that wasn't measured has no gate."""
    return {k: report[k] >= v for k, v in bars.items() if k in report}


def merge_report(path: str, part: dict) -> dict:
    """The report at path with the given entries added, written back."""
    p = Path(path)
    out = (json.loads(p.read_text()) if p.exists() else {}) | part
    p.write_text(json.dumps(out, indent=2, sort_keys=True))
    return out


