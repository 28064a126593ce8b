"""Injected duplicates: originals with a truncated and a rewritten variant each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_share, rotated, sentences, wrapped
from .sampling import hash_order


def with_variants(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text, group, is_variant: three rows per document - the text, its first 70 % (::trunc) and
    (::v2) its sentences rotated, or the text in a page's head and foot where there is but one."""
    v2 = F.when(F.size(sentences(text)) >= 2, rotated(text)).otherwise(wrapped(text))
    k = F.col(key).cast("string")
    each = F.array(
        F.struct(k.alias("doc_id"), F.col(text).alias("text"), F.lit(False).alias("is_variant")),
        F.struct(F.concat(k, F.lit("::trunc")).alias("doc_id"), first_share(text).alias("text"), F.lit(True).alias("is_variant")),
        F.struct(F.concat(k, F.lit("::v2")).alias("doc_id"), v2.alias("text"), F.lit(True).alias("is_variant")),
    )
    x = df.where(F.length(text) > 0).select(k.alias("group"), F.explode(each).alias("v"))
    return x.select("v.doc_id", "v.text", "group", "v.is_variant")


def in_fixed_order(variants: DataFrame, seed: int = 42) -> DataFrame:
    """variants with seq, their place in a fixed shuffle."""
    from .sampling import numbered

    return numbered(variants.withColumn("_o", F.concat(hash_order("doc_id", seed), "doc_id")), "_o", "seq").drop("_o")
