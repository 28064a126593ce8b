"""Reading level of each document, by a regularised ordinal regression calibrated to graded texts.

The level 1..5 follows a proportional-odds model over features of a text's connected sentences:
graded vocabulary and word rarity, lexical diversity, connectives, a proxy of clause depth, and
lengths. Vocabulary features are medians over windows of equal length, so that a passage or two of
another level, layout and missing punctuation change little. Graded texts are a sample of at most
MAX_LABELS labelled documents; the frequencies behind word rarity count all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._prose import COMMON, ENTITY, SENTENCE_END, TAG, prose_units, words_of
from .text_quality import stats_of

MAX_LABELS, WINDOW, RIDGE = 4000, 16, 1.0
BUCKETS = 1 << 20  # of the table of document frequencies: all words count, those of one bucket together
LEVELS = 5
# fixed values: English connectives, and words that open a clause
CONNECTIVES = frozenset(
    """accordingly albeit although because but consequently conversely ergo furthermore hence however if insofar
    moreover nevertheless notwithstanding otherwise provided since so then therefore thereby though thus unless
    whereas while yet""".split()
)
OPENERS = frozenset("although because how if insofar that though unless what when where whereas whereby which while who whom whose why".split())
FEATURES = ("graded", "graded_low", "graded_high", "rarity", "diversity", "connectives", "depth", "sentence", "letters", "long_words", "length")


class _Buckets(dict):
    """Word -> bucket; emptied when it has grown to a million words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) % BUCKETS
        return h


_BUCKETS = _Buckets()


class Model(NamedTuple):
    graded: dict[str, float]
    rarity: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray


def prose_words(text: str, parsed: tuple[list, list[bool]] | None = None) -> tuple[list[str], float]:
    """The words of the connected sentences, and clause marks (commas, semicolons, colons, dashes) per word."""
    us, ok = parsed or prose_units(text)
    words = [w for u, k in zip(us, ok, strict=True) if k for w in u[1]]
    marks = sum(map(text.count, ",;:—–"))
    return words, marks / max(1, sum(len(u[1]) for u in us))


def features(text: str, graded: dict[str, float], rarity: np.ndarray, parsed: tuple[list, list[bool]] | None = None) -> list[float]:
    """FEATURES of one text."""
    words, marks = prose_words(text, parsed)
    n = max(1, len(words))
    g = np.array([graded.get(w, np.nan) for w in words] or [np.nan])
    r = rarity[[_BUCKETS[w] for w in words]] if words else np.ones(1)
    parts = max(1, n // WINDOW)
    by = np.arange(len(g)) * parts // len(g)
    known = ~np.isnan(g)
    num = np.bincount(by, np.where(known, g, 0), minlength=parts)
    den = np.bincount(by, known, minlength=parts)
    level = np.sort(num / np.maximum(den, 1))
    rare = np.bincount(by, r, minlength=parts) / np.maximum(1, np.bincount(by, minlength=parts))
    sentences = max(1, len(SENTENCE_END.findall(text)))
    return [
        float(np.median(level)),
        float(level[len(level) // 4]),
        float(level[(3 * len(level)) // 4]),
        float(np.median(rare)),
        float(np.log(max(2, len(set(words)))) / np.log(max(3, n))),
        sum(map(CONNECTIVES.__contains__, words)) / n,
        sum(map(OPENERS.__contains__, words)) / n + marks,
        float(np.log(1 + min(60.0, n / sentences))),
        sum(map(len, words)) / n,
        sum(len(w) >= 9 for w in words) / n,
        float(np.log(1 + n)),
    ]


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """bucket and docs, the documents that hold a word of the bucket; counted per task before the shuffle. Words
    are cut as in units(), so that these are the words looked up later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    at = {_BUCKETS[w] for w in words_of(ENTITY.sub(" ", TAG.sub(" ", t)) if "<" in t or "&" in t else t)}
                    seen[np.fromiter(at, np.int64, len(at))] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "docs"])

    return df.select(text).mapInArrow(run, "bucket int, docs bigint").groupBy("bucket").agg(F.sum("docs").alias("docs"))


def rarity_table(df: DataFrame, text: str) -> np.ndarray:
    """Rarity 0..1 of each bucket of words, from all documents: 0 for the most frequent, 1 for a word that none
    holds. BUCKETS numbers, whatever the documents."""
    rows = word_counts(df, text).toArrow()
    docs = np.zeros(BUCKETS)
    docs[rows["bucket"].to_numpy()] = rows["docs"].to_numpy()
    top = np.log(docs.max() + 1)
    return ((top - np.log(docs + 1)) / max(1e-9, top)).astype(np.float32)


def graded_sample(labels: DataFrame, key: str, text: str, score: str, limit: int = MAX_LABELS) -> DataFrame:
    """key, text, score (mean), fold of at most limit labelled documents that have a score 1..LEVELS."""
    x = labels.where(F.col(score).between(1, LEVELS) & (F.length(F.trim(text)) > 0))
    x = x.groupBy(F.col(key).alias("key")).agg(F.min(text).alias("text"), F.avg(score).alias("score"))
    return x.orderBy(F.xxhash64("key"), "key").limit(limit).withColumn("fold", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(2)).cast("int"))


def graded_words(sample: DataFrame) -> dict[int, dict[str, float]]:
    """Per fold left out (and -1, none): word -> mean score of the graded English prose that has it,
    drawn towards the overall mean; words of fewer than three documents don't tell. The words are those of at
    most MAX_LABELS documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, s, sorted(set(prose_words(t)[0]))) for t, s, f in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) if usable(t)]
            fs, ss, ws = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(fs, pa.int32()), pa.array(ss, pa.float64()), pa.array(ws, pa.list_(pa.string()))], names=["fold", "score", "words"])

    x = sample.select("text", "score", "fold").mapInArrow(run, "fold int, score double, words array<string>")
    got = x.select("fold", "score", F.explode("words").alias("word")).groupBy("word", "fold").agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    top = got.groupBy("word").agg(F.sum("n").alias("all_n"), F.collect_list(F.struct("fold", "n", "s")).alias("by"))
    rows = top.where("all_n >= 3").orderBy(F.desc("all_n"), "word").collect()
    out = {}
    for left in (-1, 0, 1):
        use = {r["word"]: [(b["n"], b["s"]) for b in r["by"] if b["fold"] != left] for r in rows}
        total, weight = sum(s for v in use.values() for _, s in v), sum(n for v in use.values() for n, _ in v)
        mean = total / max(1, weight)
        out[left] = {w: (sum(s for _, s in v) + 4 * mean) / (sum(n for n, _ in v) + 4) - mean for w, v in use.items() if v and w not in COMMON}
    return out


def usable(text: str, parsed: tuple[list, list[bool]] | None = None) -> bool:
    """English running prose."""
    s = stats_of(text, parsed)
    return s[0] == "en" and s[6] >= 0.5


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the proportional-odds model P(level > k) = sigmoid(x w - cut_k), by
    gradient descent with momentum on the penalised mean log-likelihood; y may lie between levels."""
    n, d = x.shape
    over = (y[:, None] > np.arange(1, LEVELS)[None] + 0.5).astype(float)  # level above k
    w, cuts = np.zeros(d), np.linspace(-2, 2, LEVELS - 1)
    vw, vc = np.zeros(d), np.zeros(LEVELS - 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:, None] - cuts, -30, 30)))
        e = p - over
        vw = 0.9 * vw - 0.1 * (x.T @ e.sum(1) / n + ridge / n * w)
        vc = 0.9 * vc + 0.1 * e.mean(0)
        w, cuts = w + vw, np.sort(cuts + vc)
    return w, cuts


def train(df: DataFrame, text: str, labels: DataFrame, label_key: str, label_text: str, score: str, limit: int = MAX_LABELS) -> Model | None:
    """The model, or None without graded English prose."""
    sample = graded_sample(labels, label_key, label_text, score, limit)
    lex = graded_words(sample)
    rarity = rarity_table(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(s, *features(t, lex[f], rarity)) for t, s, f in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) if usable(t)]
            cols = list(zip(*rows, strict=True)) or [()] * (len(FEATURES) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in cols], names=["score", *FEATURES])

    rows = sample.select("text", "score", "fold").mapInArrow(run, ", ".join(f"{c} double" for c in ("score", *FEATURES))).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(list(rows.columns))  # the order of addition must not depend on the tasks
    x, y = rows[list(FEATURES)].to_numpy(), rows["score"].to_numpy()
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    w, cuts = fit((x - mean) / scale, y)
    return Model(lex[-1], rarity, mean, scale, w, cuts)


def reading_levels(df: DataFrame, key: str, text: str, model: Model | None) -> DataFrame:
    """key, lang, prose_share, tokens (white-space words), level 1..5 and demand, the chance of a level
    above 3, of each row. level and demand are null for a null, empty or blank text, for what is no
    English running prose, and without a model."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType.simpleString()
    names = ["key", "lang", "prose_share", "tokens", "level", "demand"]
    sent = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, and the words of the graded sample

    def one(text: str | None) -> tuple:
        if not text or text.isspace():
            return (None, None, 0, None, None)
        parsed = prose_units(text)
        s = stats_of(text, parsed)
        m = sent.value
        if s[0] != "en" or s[6] < 0.5 or m is None:
            return (s[0], s[6], len(text.split()), None, None)
        x = (np.array(features(text, m.graded, m.rarity, parsed)) - m.mean) / m.scale
        p = 1 / (1 + np.exp(-(float(x @ m.weights) - m.cuts)))
        return (s[0], s[6], len(text.split()), 1 + int((p >= 0.5).sum()), float(p[LEVELS - 3]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*map(one, b.column(1).to_pylist()), strict=True)) or [()] * 5
            types = (pa.string(), pa.float64(), pa.int64(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return src.mapInArrow(run, f"key {kind}, lang string, prose_share double, tokens bigint, level int, demand double")
