"""Stage 1: the first heuristic a document fails, or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, CurationConfig
from ..functions import text as T
from ..functions.langid import Provider, language

# fixed values: phrases of boilerplate pages
BOILERPLATE = ("lorem ipsum", "all rights reserved", "terms of service", "enable javascript")
REASONS = ("too_short", "too_long", "symbol_ratio", "short_lines", "boilerplate", "wrong_language")


def native_reason(c: Column | str, cfg: CurationConfig = DEFAULT) -> Column:
    """The first failure among the rules that need no Python. CASE stops at the first that holds."""
    c = T.col(c)
    return (
        F.when(F.length(c) < cfg.min_chars, "too_short")
        .when(F.length(c) > cfg.max_chars, "too_long")
        .when(T.symbol_ratio(c) > cfg.max_symbol_ratio, "symbol_ratio")
        .when(T.mean_line_length(c) < cfg.min_mean_line, "short_lines")
        .when(T.contains_any(c, BOILERPLATE), "boilerplate")
    )


def with_reason(df: DataFrame, text: str = "text", cfg: CurationConfig = DEFAULT, provider: Provider | None = None) -> DataFrame:
    """df, or a stream, with `reason`. Null text is an empty text, too_short. Everything is one scan: the
    rules of the JVM come first, and the language, the dearest, gets a text only from the rows that pass
    them (the others send it a null). Without a provider there is no rule of the language."""
    x = df.withColumn("reason", native_reason(F.coalesce(F.col(text), F.lit("")), cfg))
    if provider is None:
        return x
    lang = provider(F.when(F.col("reason").isNull(), F.col(text)))
    x = x.withColumn("_lang", lang)
    wrong = F.when(F.col("reason").isNull() & (F.coalesce("_lang", F.lit("und")) != cfg.target_language), "wrong_language")
    return x.withColumn("reason", F.coalesce("reason", wrong)).drop("_lang")


def flags(df: DataFrame, text: str = "text", cfg: CurationConfig = DEFAULT) -> DataFrame:
    """df with a boolean per native rule, each on its own."""
    c = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        "*",
        (F.length(c) < cfg.min_chars).alias("too_short"),
        (F.length(c) > cfg.max_chars).alias("too_long"),
        (T.symbol_ratio(c) > cfg.max_symbol_ratio).alias("symbol_ratio"),
        (T.mean_line_length(c) < cfg.min_mean_line).alias("short_lines"),
        T.contains_any(c, BOILERPLATE).alias("boilerplate"),
    )
