"""Sinks: kept documents, sampled rejects, keyed topics, caches, models and reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.minhash import Permutations, band_key, to_json
from ..functions.vectors import encode_f32
from ..operators.sampling import every_nth


def kept(df: DataFrame, path: str, per_file: int = 0, mode: str = "append") -> None:
    """Kept documents as Parquet; files of at most per_file rows (0: no limit). Appending never overwrites."""
    w = df.select("id", "text", "quality_score", "source").write.mode(mode)
    (w.option("maxRecordsPerFile", per_file) if per_file else w).parquet(path)


def reject_log(results: DataFrame, order: str, path: str, every: int = DEFAULT.reject_every) -> None:
    """Each every-th reject by order, appended as JSON lines."""
    every_nth(results.where(F.lower("decision") == "reject"), order, every).write.mode("append").json(path)


def as_messages(df: DataFrame, sig: str, rows: int = DEFAULT.lsh_band_rows) -> DataFrame:
    """key (the band's bytes) and value (the row as JSON, without the signature), as a topic takes them."""
    body = [c for c in df.columns if c != sig]
    return df.select(band_key(sig, rows).alias("key"), F.to_json(F.struct(*body)).alias("value"))


def to_kafka(messages: DataFrame, servers: str, topic: str = "raw-docs") -> None:
    """Needs the Kafka connector's jar."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def append_cache(df: DataFrame, path: str) -> None:
    """New cache rows: key, embedding."""
    df.select("key", "embedding").write.mode("append").parquet(path)


def label_cache(df: DataFrame, path: str) -> None:
    """Labels, appended as JSON lines, so that labelling can go on where it ended."""
    df.write.mode("append").json(path)


def permutations(p: Permutations, path: str) -> None:
    Path(path).write_text(to_json(p))


def embedded_input(docs: DataFrame, cached: DataFrame, path: str) -> None:
    """id, text, emb (binary) of the documents that have a cached vector. docs and cached: key."""
    x = docs.join(cached.select("key", "embedding"), "key").select("id", "text", encode_f32("embedding").alias("emb"))
    x.write.mode("overwrite").parquet(path)


def json_report(report: dict, path: str) -> None:
    Path(path).write_text(json.dumps(report, indent=2, sort_keys=True, default=str))
