"""Labelling by a judge: batches, prompts, replies, and the cache of labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import first_chars
from .sampling import batches

# fixed values: documents per prompt, characters of a document in a prompt
BATCH, CHARS = 8, 2000
REPLY = "struct<scores: array<struct<id: int, score: int>>>"

# fixed values: what a judge may be asked in a minute, and the margin added to the pause between calls
PER_MINUTE, MARGIN_S = 20, 0.5
#: the judge's instruction; a provider sends it with temperature 0 and a fixed seed
RUBRIC = """You grade web documents by how much a reader can learn from them. Each document starts with its number in
square brackets. Grade every one with a whole number:
1: nothing to learn - advertising, navigation, link lists, page debris, or text that makes no sense
2: hardly anything - shallow or mostly promotional
3: something of use, but not meant to teach
4: teaches - coherent and informative, as a good article, guide or reference page
5: teaches thoroughly - complete and well built, as a textbook or an encyclopedia
Reply with JSON alone: {"scores": [{"id": <number>, "score": <1 to 5>}, ...]}, an entry for each document."""
TEMPERATURE, SEED = 0.0, 42

#: a prompt -> the reply's JSON
Judge = Callable[[str], str]


def unlabelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.join(labels.select(key).distinct(), key, "left_anti")


def prompts(docs: DataFrame, order: str, key: str, text: str, size: int = BATCH) -> DataFrame:
    """batch, prompt, ids: `size` documents a prompt, numbered from 0, cut to CHARS characters."""
    x = batches(docs, order, size)
    line = F.concat(F.lit("["), F.col("place").cast("string"), F.lit("] "), first_chars(text, CHARS))
    got = x.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line"), F.col(key).alias("key")))).alias("rows"))  # `size` rows a group
    return got.select("batch", F.array_join(F.transform("rows", lambda r: r["line"]), "\n\n").alias("prompt"), F.transform("rows", lambda r: r["key"]).alias("ids"))


def asked(prompt_rows: DataFrame, judge: Judge, pause_s: float = 60 / PER_MINUTE + MARGIN_S) -> DataFrame:
    """prompt_rows with `reply`; one task asks, with a pause between calls, as the judge's rate is limited."""
    import time

    schema = StructType([*prompt_rows.schema.fields, StructField("reply", StringType())])
    at = prompt_rows.columns.index("prompt")

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            out = []
            for p in b.column(at).to_pylist():
                out.append(judge(p))
                time.sleep(pause_s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "reply"])

    return prompt_rows.coalesce(1).mapInArrow(run, schema)


def from_labels(prompt_rows: DataFrame, labels: DataFrame, key: str = "doc_id", score: str = "edu_score") -> DataFrame:
    """prompt_rows with `reply`, as a judge without a network gives it: the least valid score that the labels
    have for a document; documents without one are left out of the reply."""
    known = labels.where(F.col(score).between(1, 5)).groupBy(F.col(key).alias("_id")).agg(F.min(score).alias("_score"))
    each = prompt_rows.select("batch", F.posexplode("ids").alias("id", "_id")).join(known, "_id")
    lines = each.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct(F.col("id"), F.col("_score").alias("score")))).alias("scores"))  # a prompt's documents
    none = F.lit('{"scores": []}')
    return prompt_rows.join(lines.select("batch", F.to_json(F.struct("scores")).alias("reply")), "batch", "left").withColumn("reply", F.coalesce("reply", none))


def scores(replies: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, edu_score, rationale of the valid scores: a number of the batch and a score of 1..5.
    Anything else is ignored, and its document stays unlabelled."""
    x = replies.select("ids", F.explode(F.from_json("reply", REPLY)["scores"]).alias("s")).where("s.score between 1 and 5 and s.id >= 0 and s.id < size(ids)")
    x = x.select(F.element_at("ids", F.col("s.id") + 1).alias(key), F.col("s.score").alias("edu_score")).dropDuplicates([key])
    return docs.select(key, text).join(x, key).select(key, text, "edu_score", F.lit("").alias("rationale"))
