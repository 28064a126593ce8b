"""A language identifier as a provider: a function of a text column that gives its language.

The engine's identifier is a naive Bayes classifier over character trigrams, fitted on labelled texts:
any language that has labels can be told, and no word list is involved."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import col

Provider = Callable[[Column], Column]

#: hash buckets of trigrams, weight of an unseen one, and characters whose trigrams are held at a time
BUCKETS, UNSEEN, CHARS = 1 << 16, 0.5, 1 << 18

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters (none lies above the last ideographs)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x32400)), bool, 0x32400))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and bucket of each trigram. Texts are lower-cased, whatever is no letter is a
    blank, blanks in a row are one, and a text begins and ends with one; no letters, no trigrams."""
    low = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(low)), [len(t) for t in low])
    table = _letters()
    code = np.where((code < len(table)) & table[np.minimum(code, len(table) - 1)], code, 32)
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (doc[1:] != doc[:-1])
    code, doc = code[keep], doc[keep]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = doc[2:] == doc[:-2]
    h = (((code[:-2] * 961 + code[1:-1] * 31 + code[2:]) * 2654435761) & 0xFFFFFFFF) >> 16
    return doc[2:][inner], h[inner]


def _runs(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of CHARS characters in all, or a single longer one."""
    lo, n = 0, 0
    for k, t in enumerate(texts):
        if n and n + len(t) > CHARS:
            yield slice(lo, k)
            lo, n = k, 0
        n += len(t)
    if lo < len(texts):
        yield slice(lo, len(texts))


class Profiles(NamedTuple):
    """Languages in ascending order, and the logarithm of each bucket's share by language."""

    langs: tuple[str, ...]
    table: np.ndarray

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score, the chance of it against the others by the mean trigram; und and 0 for
        null, and for a text without letters. Ties: the first language."""
        doc, bucket = trigrams([t or "" for t in texts])
        n = np.bincount(doc, minlength=len(texts))
        sums = np.stack([np.bincount(doc, self.table[bucket, k], minlength=len(texts)) for k in range(len(self.langs))], 1)
        best = sums.argmax(1)
        mean = sums / np.maximum(1, n)[:, None]
        p = 1 / np.exp(mean - mean.max(1, keepdims=True)).sum(1)
        return [(self.langs[b], float(q)) if m else ("und", 0.0) for b, q, m in zip(best, p, n, strict=True)]


def plain_lang(c: Column | str) -> Column:
    """A label in lower case without blanks around it; null for an empty one and und."""
    x = F.lower(F.trim(col(c)))
    return F.when(~x.isin("", "und"), x)


def fit_profiles(docs: DataFrame, text: str, lang: str) -> Profiles | None:
    """Profiles from all texts that are labelled with a language; None without labels. Each task counts
    its own texts and gives a row per language and bucket. Wrong labels do little harm."""
    x = docs.select(F.col(text).alias("text"), plain_lang(lang).alias("lang")).where("length(text) > 0 and lang is not null")

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in got:
            by: dict[str, list[str]] = {}
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(k, []).append(t)
            for k, texts in by.items():
                n = counts.setdefault(k, np.zeros(BUCKETS, np.int64))
                for part in _runs(texts):
                    n += np.bincount(trigrams(texts[part])[1], minlength=BUCKETS)
        for k, n in counts.items():
            at = np.flatnonzero(n)  # none for texts without letters: they teach no language
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])

    rows = x.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # a row per language and bucket
    langs = sorted(set(rows["lang"].to_pylist()))
    if not langs:
        return None
    n = np.zeros((BUCKETS, len(langs)))
    number = {k: j for j, k in enumerate(langs)}
    n[rows["bucket"].to_numpy(), [number[k] for k in rows["lang"].to_pylist()]] = rows["n"].to_numpy()
    return Profiles(tuple(langs), np.log((n + UNSEEN) / (n.sum(0) + UNSEEN * BUCKETS)))


def by_profiles(p: Profiles) -> Provider:
    """The provider of fitted profiles."""

    def provide(c: Column) -> Column:
        @F.pandas_udf(StringType())
        def lang(s: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(s), dtype=object)
            have = np.flatnonzero(s.notna().to_numpy())
            texts = [s.iloc[j] for j in have]
            for part in _runs(texts):
                out.iloc[have[part]] = [k for k, _ in p.classify(texts[part])]
            return out

        return lang(c)

    return provide


def language(c: Column | str, provider: Provider) -> Column:
    """The language of a text; und for null."""
    return F.coalesce(provider(col(c)), F.lit("und"))
