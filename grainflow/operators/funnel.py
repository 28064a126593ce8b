"""The funnel: every document ends in one terminal state, kept or rejected with stage and reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, CurationConfig
from ..functions.langid import Provider
from ..functions.text import cache_key
from ..session import stored
from .dedup import rejected
from .embedding import Provider as Embedder
from .embedding import embed, hashing_provider
from .heuristics import with_reason
from .quality import QualityModel, with_quality

RESULT = "seq bigint, doc_id string, decision string, stage string, reason string, quality_score double, dedup_similarity double, embed_dim int, embedded_chars bigint"


def _result(df: DataFrame, decision: str, stage: str, reason=None, quality=None, similarity=None, dim: int | None = None) -> DataFrame:  # noqa: ANN001
    null = F.lit(None)
    return df.select(
        "seq",
        F.col("id").cast("string").alias("doc_id"),
        F.lit(decision).alias("decision"),
        F.lit(stage).alias("stage"),
        (null if reason is None else reason).cast("string").alias("reason"),
        (null if quality is None else quality).cast("double").alias("quality_score"),
        (null if similarity is None else similarity).cast("double").alias("dedup_similarity"),
        F.lit(dim).cast("int").alias("embed_dim"),
        (F.lit(0) if stage == "heuristic" else F.col("chars")).cast("bigint").alias("embedded_chars"),
    )


def curate(
    docs: DataFrame,
    vectors: DataFrame,
    model: QualityModel | None,
    cfg: CurationConfig = DEFAULT,
    provider: Provider | None = None,
    sig: str | None = None,
    part: str | None = None,
    embedder: Embedder = hashing_provider,
    signer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """seq and the terminal state of each document of docs (seq unique, id, text; sig and part if named).

    vectors: id, emb, one row per id, what is embedded already; what passes the heuristics and has no
    vector is embedded by the embedder, each text once. The cheap stages come first, and texts are
    read again only for what must be embedded. Instead of sig, a signer makes the signatures from the
    texts that pass the heuristics. Vectors and signatures only move where they are needed. Null
    pattern: quality_score only for quality rejects and kept documents, dedup_similarity only for
    near-duplicates, embed_dim for kept documents.
    """
    extra = [c for c in (sig, part) if c]
    x = with_reason(docs.select(*dict.fromkeys(["seq", "id", "text", *extra])), "text", cfg, provider)
    passes = F.col("reason").isNull()
    x = x.withColumn("chars", F.length("text")).withColumn("key", F.when(passes, cache_key("text", cfg.embed_dim)))
    if signer:
        sig, extra = "_sig", ["_sig", *extra]
        x = x.withColumn(sig, signer(F.when(passes, F.col("text"))))
    staged = stored(x.select("seq", "id", "reason", "chars", "key", *(F.when(passes, F.col(c)).alias(c) for c in extra)), "heuristic")
    x = staged.where("reason is null").select("seq", "id", "key")
    known = vectors.select("id", F.col("emb").cast("array<float>").alias("emb"))
    misses = stored(x.join(known.select("id"), "id", "left_anti").select("seq", "key"), "misses")
    texts = misses.groupBy("key").agg(F.min("seq").alias("seq")).join(docs.select("seq", "text"), "seq")
    fresh = embed(texts, "text", embedder, cfg.embed_dim).select("key", F.col("embedding").alias("emb"))
    have = x.join(known, "id").select("seq", "emb").unionByName(misses.join(fresh, "key").select("seq", "emb"))
    scored = with_quality(have, "emb", model)
    scored = stored(scored.withColumn("emb", F.when(~F.col("low_quality"), F.col("emb"))), "scored")
    good = scored.where("not low_quality").select("seq", "emb")
    gone = rejected(good.join(staged.select("seq", *extra), "seq") if extra else good, "seq", "emb", sig, part, cfg.dedup_cosine_threshold, cfg.dedup_surface_threshold)
    ended = scored.drop("emb").join(staged.select("seq", "id", "chars"), "seq").join(gone.withColumnRenamed("i", "seq"), "seq", "left")
    low, good = ended.where("low_quality"), ended.where("not low_quality")
    gone, kept = good.where("dedup_similarity is not null"), good.where("dedup_similarity is null")
    q = F.col("quality_score")
    return (
        _result(staged.where("reason is not null"), "reject", "heuristic", F.col("reason"))
        .unionByName(_result(low, "reject", "quality", F.lit("low_quality"), q))
        .unionByName(_result(gone, "reject", "dedup", F.lit("near_duplicate"), similarity=F.col("dedup_similarity")))
        .unionByName(_result(kept, "keep", "kept", None, q, dim=cfg.embed_dim))
    )


def kept_documents(docs: DataFrame, results: DataFrame) -> DataFrame:
    """id, text, quality_score (1.0 without a model), source of the kept documents."""
    kept = results.where("decision = 'keep'").select("seq", "quality_score")
    return docs.join(kept, "seq").select("id", "text", F.coalesce("quality_score", F.lit(1.0)).alias("quality_score"), "source")


def conservation(results: DataFrame) -> DataFrame:
    """ingested, kept, rejected, conserved."""
    d = F.lower("decision")
    x = results.agg(F.count("*").alias("ingested"), F.count_if(d == "keep").alias("kept"), F.count_if(d == "reject").alias("rejected"))
    return x.withColumn("conserved", F.col("ingested") == F.col("kept") + F.col("rejected"))
