"""Readers: documents, vectors, labels, caches, models and streams."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.vectors import decode_f32
from ..operators.sampling import weighted_choice

RAW = "id string, text string, source string, meta map<string,string>"
LABEL = "doc_id string, text string, edu_score int, rationale string"
# fixed values: the terminal states of the synthetic feed and their weights; 13 injected documents are spread over four reasons
INJECTED = 13 / 4
FEED = (
    ("kept", 86.0),
    ("low_quality", 101.0),
    ("near_duplicate", 14.0),
    ("too_short", 9 + INJECTED),
    ("symbol_ratio", 8 + INJECTED),
    ("short_lines", 8 + INJECTED),
    ("boilerplate", 7 + INJECTED),
    ("wrong_language", 6.0),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores if it would be read in fewer tasks than there are: for work on a small table
    that costs far more than its shuffle. A table of as many splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def documents(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Documents from Parquet, ORC, JSON lines, CSV or text files."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    return (r.schema(schema) if schema else r).load(path)


def with_defaults(df: DataFrame, source: str = "fineweb-sample") -> DataFrame:
    """A missing source and meta get their defaults."""
    return df.withColumn("source", F.coalesce("source", F.lit(source))).withColumn("meta", F.coalesce("meta", F.create_map().cast("map<string,string>")))


def embedded_documents(spark: SparkSession, path: str) -> DataFrame:
    """id, text, emb as an array; raises ValueError if a column is missing or emb is not binary."""
    df = spark.read.parquet(path)
    kinds = dict(df.dtypes)
    for c, k in (("id", "string"), ("text", "string"), ("emb", "binary")):
        if kinds.get(c) != k:
            raise ValueError(f"column {c}: {k} expected, found {kinds.get(c)}")
    return df.select("id", "text", decode_f32("emb").alias("emb"))


def labels(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """Cached labels, a JSON array; a missing file is an empty table, or an error."""
    if not Path(path).exists():
        if missing_ok:
            return spark.createDataFrame([], LABEL)
        raise FileNotFoundError(path)
    return spark.read.schema(LABEL).json(path, multiLine=True)


def report(path: str) -> dict:
    return json.loads(Path(path).read_text())


def kafka_documents(spark: SparkSession, servers: str, topic: str = "raw-docs", per_trigger: int = 10_000) -> DataFrame:
    """A stream of documents from a topic, from its earliest offset; needs the Kafka connector's jar."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    raw = raw.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_trigger).option("failOnDataLoss", "false").load()
    return raw.select(F.from_json(F.col("value").cast("string"), RAW).alias("d"), "offset", "partition").select("d.*", "offset", "partition")


def file_documents(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "parquet", files_per_trigger: int = 100, only: str | None = None) -> DataFrame:
    """A stream of documents from the files that arrive in a folder; only: a glob that their names must match."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger)
    return (r.option("pathGlobFilter", only) if only else r).load(path)


def uniform(value: Column, seed: int = 42) -> Column:
    """A fixed number 0 <= u < 1 per value: 28 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), value.cast("string"))), 1, 7), 16, 10).cast("long") / float(1 << 28)


def synthetic_feed(spark: SparkSession, rows_per_second: int = 30, seed: int = 42) -> DataFrame:
    """A stream of terminal states at a steady rate, chosen by fixed weights."""
    x = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return states(x.withColumnRenamed("value", "seq"), "seq", seed)


def states(df: DataFrame, seq: str, seed: int = 42) -> DataFrame:
    """df with decision, stage and reason, chosen by the FEED weights from the order number."""
    x = df.withColumn("_s", weighted_choice(uniform(F.col(seq), seed), list(FEED)))
    stage = F.when(F.col("_s") == "kept", "kept").when(F.col("_s") == "low_quality", "quality").when(F.col("_s") == "near_duplicate", "dedup").otherwise("heuristic")
    x = x.withColumn("decision", F.when(F.col("_s") == "kept", "keep").otherwise("reject")).withColumn("stage", stage)
    return x.withColumn("reason", F.when(F.col("_s") != "kept", F.col("_s"))).drop("_s")
