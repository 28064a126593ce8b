"""Mixing sources to target weights, by hash-threshold histograms.

Each document has a fixed hash. Tokens are summed by source and hash bucket; the budget of a source
gives the bucket in which its threshold lies, and only that bucket is summed again by the next bits
of the hash, until the threshold is exact to one document. The mix is then a filter: no sort, and
a smaller budget always selects a subset of the documents of a larger one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .token_sizes import VOCABULARY, token_sizes

BITS, STEP = 60, 12
SEED = 17


def plain_source(column: str) -> F.Column:
    """A source's name in lower case, without white space around it, with - for _ and white space within."""
    return F.regexp_replace(F.lower(F.trim(column)), r"[\s_]+", "-")


def budgets(totals: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens to draw per source. Without a total, the largest at which every target source that has
    documents keeps its share within its repeats; the shares of those without are spread over the
    rest in proportion. With a total, a source that is too small gives what it can."""
    have = [(s, w, r) for s, w, r in targets if totals.get(s, 0) > 0 and w and w > 0 and r and r > 0]
    weight = sum(w for _, w, _ in have)
    if not have:
        return {}
    most = min(r * totals[s] * weight / w for s, w, r in have)
    size = most if total is None else total
    return {s: min(r * totals[s], int(size * w / weight)) for s, w, r in have}


def thresholds(sized: DataFrame, need: dict[str, int]) -> dict[str, int]:
    """source -> hash below which its documents have at most need[source] tokens together, and with
    one document more would have more. sized: source, h (BITS bits), tokens."""
    spark = sized.sparkSession
    low = dict.fromkeys(need, 0)  # the boundary bucket starts here
    left = dict(need)
    for shift in range(BITS - STEP, -1, -STEP):
        if not low:
            break
        at = spark.createDataFrame([(s, v) for s, v in low.items()], "source string, low bigint")  # a row per target
        x = sized.join(F.broadcast(at), "source").where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + (1 << (shift + STEP))))
        x = x.withColumn("bucket", F.shiftright(F.col("h") - F.col("low"), shift))
        rows = x.groupBy("source", "bucket").agg(F.sum("tokens").alias("tokens")).collect()  # 2^STEP per target at most
        hist: dict[str, list[tuple[int, int]]] = {}
        for r in rows:
            hist.setdefault(r["source"], []).append((r["bucket"], r["tokens"]))
        for s in low:
            end = 1 << STEP
            for bucket, tokens in sorted(hist.get(s, [])):
                if tokens > left[s]:
                    end = bucket
                    break
                left[s] -= tokens
            low[s] += end << shift
    return low


def mixed(sizes: DataFrame, targets: DataFrame, total: int | None = None, seed: int = SEED) -> DataFrame:
    """key, source, tokens, uses from sizes (key, source, tokens): how often each document is used.

    targets: source, target_weight, max_repeats. A source's documents are all used a whole number of
    times and those below its hash threshold once more, never above max_repeats. Documents of no
    target source, of a null source or of no tokens are not used and give no row. Repeated targets of
    one source count once, the largest weight.
    """
    goal = targets.where("source is not null").groupBy(plain_source("source").alias("source")).agg(F.max("target_weight").alias("w"), F.max("max_repeats").alias("r"))
    wanted = [(r["source"], float(r["w"] or 0), int(r["r"] or 0)) for r in goal.collect()]  # a row per target
    h = F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 64 - BITS)
    x = sizes.where("tokens > 0").select("key", plain_source("source").alias("source"), "tokens", h.alias("h"))
    x = stored(x.where(F.col("source").isin([s for s, _, _ in wanted])), "sized")
    totals = {r["source"]: r["tokens"] for r in x.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    need = budgets(totals, wanted, total)
    rows = [(s, n // totals[s], n % totals[s]) for s, n in need.items()]
    cut = thresholds(x, {s: rest for s, _, rest in rows})
    kind = T.StructType([T.StructField("source", T.StringType()), T.StructField("times", T.LongType()), T.StructField("cut", T.LongType())])
    plan = sizes.sparkSession.createDataFrame([(s, times, cut[s]) for s, times, _ in rows], kind)
    uses = (F.col("times") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)).cast("int")
    return x.join(F.broadcast(plan), "source").select("key", "source", "tokens", uses.alias("uses")).where("uses > 0")


def actual_shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_weight, max_repeats, documents, tokens, actual_share of each target."""
    got = mix.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("uses")).alias("tokens"), F.max("uses").alias("most_uses"))
    every = mix.agg(F.sum(F.col("tokens") * F.col("uses")).alias("all_tokens"))
    x = targets.withColumn("source", plain_source("source")).join(got, "source", "left").join(F.broadcast(every), F.lit(True))
    share = F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.col("all_tokens")), F.lit(0.0))
    zero = F.lit(0)
    return x.select("source", "target_weight", "max_repeats", F.coalesce("documents", zero).alias("documents"), F.coalesce("tokens", zero).alias("tokens"), F.coalesce("most_uses", zero).alias("most_uses"), share.alias("actual_share"))


def source_mix(docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, total: int | None = None, path: str = VOCABULARY) -> DataFrame:
    """mixed() of documents sized in tokens; key is unique in docs."""
    sizes = token_sizes(docs.select(key, text, F.col(source).alias("source")), key, text, ("source",), path)
    return mixed(sizes, targets, total)
