"""Funnel statistics over stage results, and the series the dashboard and charts show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .sampling import numbered

# fixed values: price of a million embedded tokens, characters per token, bins of the histogram
PRICE, CHARS_PER_TOKEN, BINS = 0.12, 4, 20
STAGES = ("heuristic", "quality", "dedup")


def decision() -> Column:
    return F.lower("decision")


def is_number(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c)


def cost(chars: Column) -> Column:
    return chars.cast("double") / CHARS_PER_TOKEN / 1e6 * PRICE


def totals(results: DataFrame) -> DataFrame:
    """ingested, kept, retention_rate (0 when empty), embed_calls, embedded_chars, est_cost."""
    used = F.col("embedded_chars") > 0
    x = results.agg(
        F.count("*").alias("ingested"),
        F.count_if(decision() == "keep").alias("kept"),
        F.count_if(used).alias("embed_calls"),
        F.coalesce(F.sum(F.when(used, F.col("embedded_chars"))), F.lit(0)).alias("embedded_chars"),
    )
    return x.withColumn("retention_rate", F.coalesce(F.try_divide(F.col("kept"), F.col("ingested")), F.lit(0.0))).withColumn("est_cost", cost(F.col("embedded_chars")))


def rejected_by(results: DataFrame, column: str) -> DataFrame:
    """column, rejects; a missing or empty reason counts as null."""
    x = results.where(decision() == "reject").withColumn(column, F.nullif(F.col(column), F.lit("")))
    return x.groupBy(column).agg(F.count("*").alias("rejects"))


def top_reasons(results: DataFrame, n: int = 10) -> DataFrame:
    return rejected_by(results, "reason").where("reason is not null").orderBy(F.desc("rejects"), "reason").limit(n)


def latency(results: DataFrame) -> DataFrame:
    """stage, rows, p50 (linear), upper_p50 (the upper median), over valid latencies (finite, not negative)."""
    good = is_number("latency_ms") & (F.col("latency_ms") >= 0) & (F.col("latency_ms") < float("inf"))
    # numbered over (stage, latency) in range partitions: no stage is gathered, whatever its size
    x = numbered(results.where(good).select(F.struct("stage", "latency_ms").alias("o")), "o", "rn").select("o.stage", "o.latency_ms", "rn")
    size = stored(x.groupBy("stage").agg(F.count("*").alias("rows"), F.min("rn").alias("from")), "stages").withColumnRenamed("stage", "_stage")
    place = F.col("rn") - F.col("from")
    mid = x.join(F.broadcast(size), F.col("stage").eqNullSafe(F.col("_stage"))).where((place == F.floor((F.col("rows") - 1) / 2)) | (place == F.floor(F.col("rows") / 2)))  # a row per stage
    return mid.groupBy("stage").agg(F.max("rows").alias("rows"), (F.min("latency_ms") + (F.max("latency_ms") - F.min("latency_ms")) * 0.5).alias("p50"), F.max("latency_ms").alias("upper_p50"))


def worst_p50(results: DataFrame) -> DataFrame:
    """p50: the largest median of a stage, 0 without any."""
    return latency(results).agg(F.greatest(F.lit(0.0), F.coalesce(F.max("p50"), F.lit(0.0))).alias("p50"))


def bin_of(q: Column, bins: int = BINS) -> Column:
    return F.least((q * bins).cast("int"), F.lit(bins - 1))


def quality_histogram(results: DataFrame, bins: int = BINS) -> DataFrame:
    """bin (its middle), count of the scores that are numbers, empty bins included."""
    got = results.where(is_number("quality_score")).groupBy(bin_of(F.col("quality_score"), bins).cast("bigint").alias("id")).agg(F.count("*").alias("n"))
    every = results.sparkSession.range(bins)
    return every.join(F.broadcast(got), "id", "left").select(F.round((F.col("id") + 0.5) / bins, 3).alias("bin"), F.coalesce("n", F.lit(0)).alias("count"))


def score_histogram(labels: DataFrame, score: str = "edu_score") -> DataFrame:
    """score 1..5, count, empty scores included."""
    got = labels.where(F.col(score).between(1, 5)).groupBy(F.col(score).cast("bigint").alias("score")).agg(F.count("*").alias("n"))
    return labels.sparkSession.range(1, 6).withColumnRenamed("id", "score").join(got, "score", "left").select("score", F.coalesce("n", F.lit(0)).alias("count"))


def survivors(results: DataFrame) -> DataFrame:
    """step, stage, survivors: what is left after each stage, from all ingested to all kept."""
    spark = results.sparkSession
    steps = spark.createDataFrame([(0, "ingested"), *((k + 1, s) for k, s in enumerate(STAGES))], "step int, stage string")
    lost = results.where(decision() == "reject").groupBy("stage").agg(F.count("*").alias("lost"))
    n = results.agg(F.count("*").alias("n"))
    x = steps.join(lost, "stage", "left").crossJoin(F.broadcast(n))  # four rows and one
    gone = F.sum(F.coalesce("lost", F.lit(0))).over(Window.orderBy("step"))  # four rows
    return x.select("step", "stage", (F.col("n") - gone).alias("survivors"))


def funnel_stats(results: DataFrame) -> DataFrame:
    """One row: totals and maps of rejects by stage and by reason and of median latency by stage."""
    def as_map(df: DataFrame, k: str, v: str, name: str) -> DataFrame:
        return df.where(F.col(k).isNotNull()).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias(name))

    out = totals(results)
    for m in (
        as_map(rejected_by(results, "stage"), "stage", "rejects", "rejected_by_stage"),
        as_map(rejected_by(results, "reason"), "reason", "rejects", "rejected_by_reason"),
        as_map(latency(results), "stage", "p50", "p50_ms"),
    ):
        out = out.crossJoin(m)  # one row each
    return out


def throughput(points: DataFrame, t: str, ingested: str, last: int = 60) -> DataFrame:
    """t, delta: growth per second between consecutive points, not below 0, of the last points."""
    x = points.select(F.col(t).alias("t"), F.col(ingested).alias("n")).orderBy(F.desc("t")).limit(last + 1)  # bounded before the window
    w = Window.orderBy("t")
    seconds = F.col("t").cast("double") - F.lag("t").over(w).cast("double")
    d = F.greatest(F.lit(0.0), F.try_divide((F.col("n") - F.lag("n").over(w)).cast("double"), seconds))
    return x.select("t", d.alias("delta")).where("delta is not null")


def rates(results: DataFrame, by: list[str], worker: str) -> DataFrame:
    """by, workers, docs, docs_per_sec: documents through the sum of the valid latencies."""
    spent = F.sum(F.when(is_number("latency_ms") & (F.col("latency_ms") > 0), F.col("latency_ms")))
    return results.groupBy(*by).agg(F.count_distinct(worker).alias("workers"), F.count("*").alias("docs"), F.try_divide(F.count("*"), spent / 1000).alias("docs_per_sec"))


def scaling(bench: DataFrame) -> DataFrame:
    """runtime, workers, docs_per_sec of bench rows, in the order a chart draws them."""
    return bench.select("runtime", "workers", "docs_per_sec").orderBy("runtime", "workers")


def throughput_by_runtime(bench: DataFrame) -> DataFrame:
    """runtime and its best docs_per_sec, the fastest first."""
    return bench.groupBy("runtime").agg(F.max("docs_per_sec").alias("docs_per_sec")).orderBy(F.desc("docs_per_sec"), "runtime")


def precision_recall_points(sweep: DataFrame) -> DataFrame:
    """threshold, measure, value: the two curves of a threshold sweep."""
    return sweep.select("threshold", F.explode(F.create_map(F.lit("precision"), F.col("precision"), F.lit("recall"), F.col("recall"))).alias("measure", "value")).orderBy("measure", "threshold")
