"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .history import batch_by_batch, refused
from .mixing import actual_shares, source_mix
from .near_dups import class_ids, id_pairs, near_duplicates
from .neighbours import nearest, similar_pairs
from .packing import containers
from .reading_level import reading_levels, train
from .subjects import document_subjects
from .text_quality import not_prose, reference, sketches, text_stats, with_flags
from ..session import stored
from ..sources import readers
from .sql import SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are worked on in Python, dealt to all cores if it is small."""
    return readers.spread(table(spark, sf_dir, name))


def p1_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, labels = texts(spark, sf_dir, "raw_docs"), table(spark, sf_dir, "judge_labels")
    got = reading_levels(raw, "id", "text", train(raw, "text", labels, "doc_id", "text", "edu_score"))
    return got.withColumnRenamed("key", "id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_levels(spark, sf_dir).where("level >= 4 and tokens >= 40").select("id").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = texts(spark, sf_dir, "raw_docs")
    return id_pairs(near_duplicates(raw, "id", "text", 0.5))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = class_ids(near_duplicates(texts(spark, sf_dir, "raw_docs"), "id", "text"))
    return got.withColumnRenamed("key", "id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, clean = texts(spark, sf_dir, "batch_docs"), texts(spark, sf_dir, "clean_docs")
    return refused(batch, clean, "seq", ["batch_no", "seq"], "text", "id", 0.5)


def p3_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, clean = texts(spark, sf_dir, "batch_docs"), texts(spark, sf_dir, "clean_docs")
    return batch_by_batch(batch, clean, "batch_no", "seq", ["batch_no", "seq"], "text", "id", 0.5)


def p4_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(text_stats(texts(spark, sf_dir, "raw_docs"), "id", "text"), "stats")
    return with_flags(stats, reference(sketches(stats))).withColumnRenamed("key", "id")


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = text_stats(texts(spark, sf_dir, "raw_docs").select("seq", "text"), "seq", "text")
    return stats.select(F.col("key").alias("seq"), "words", *(F.round(c, 9).alias(c) for c in ("mean_word_length", "symbol_ratio", "line_end_share")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_prose(text_stats(texts(spark, sf_dir, "raw_docs"), "id", "text")).select(F.col("key").alias("id")).distinct()


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "doc_rows"), "id", "emb")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(nearest(table(spark, sf_dir, "doc_rows"), "id", "emb", min_cosine=0.7))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers(texts(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "pack_specs"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = table(spark, sf_dir, "pack_specs").select("spec_id", "capacity_tokens")
    each = p6_containers(spark, sf_dir).groupBy("spec_id", "container").agg(F.max("fill").alias("fill"))
    x = each.join(specs, "spec_id").groupBy("spec_id", "capacity_tokens").agg(F.count("*").alias("containers"), F.sum("fill").alias("tokens"))
    return x.withColumn("filled", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, targets = texts(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    return source_mix(docs, "doc_id", "text", "source", targets).withColumnRenamed("key", "doc_id")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = stored(p7_mix(spark, sf_dir), "mix")
    return actual_shares(mix, table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = texts(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels")
    return document_subjects(docs, "doc_id", "text", labels, "doc_id", "subject", "annotator").withColumnRenamed("key", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_shares(spark, sf_dir).select("doc_id", "subject").distinct()


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_shares(spark, sf_dir).groupBy("subject").agg(F.count("*").alias("documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
