"""Subject areas of each document, by propagating labels over a document-similarity graph.

The graph is kept in factored form: documents are linked through the terms they share, document -
term - document, so that neither a hot term nor a group of copies yields pairs. A term is a verified
link for a subject if the documents that hold it and whose subjects are known or inferred agree on
that subject. Copies are one document. Each round infers the documents' subjects from the verified
terms and, in the same pass, counts the terms by subject to verify them anew; labelled documents
that can be trusted stay clamped to all of their subjects. At the end a document has each subject that at least
SHARE of its sentences treat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ._prose import COMMON, ENTITY, TAG, prose_units, repeated_share, words_of

LEAST_DOCS = 3
SEED_WEIGHT, PRIOR = 2.0, 1.5
#: rounds at most, and the share of verified terms that may change in the last
ROUNDS, STILL = 12, 0.01
AGREE, OTHER, HINT, ODDS = 0.6, 0.45, 0.3, 6.0
SHARE = 0.18
RUN = 15  # words of a stretch that stands for a sentence where there is no sentence end
KNOWN, ALL = -1, -2
BREAK = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|\n\s*\n|\n(?=[^\s:]{1,24}:\s)")


class _Terms(dict):
    """Word -> 62-bit hash, 0 for function words and words of one or two letters; emptied when it has
    grown to a million words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[word] = (xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) >> 2) if len(word) > 2 and word not in COMMON else 0
        return h


_TERMS = _Terms()


def sentences(text: str, us: list, ok: list[bool]) -> list[list[str]]:
    """Words of each sentence of three words or more among the connected sentences; us and ok as
    prose_units() gives them."""
    lines, k = [], 0
    if all(o for u, o in zip(us, ok, strict=True) if u[0]):
        kept = text
    else:
        # units follow the lines; a long line has several units, and is kept if most of it is prose
        for line in text.splitlines():
            if not line or line.isspace():
                k += 1
                lines.append("")
                continue
            left, good = len(line) - line.count(" "), 0
            total = left
            while k < len(us) and left > total // 50:
                left -= us[k][0]
                good += us[k][0] if ok[k] else 0
                k += 1
                if us[k - 1][0] == total:
                    break
            lines.append(line if 2 * good >= total else "")
        kept = "\n".join(lines)
    out = []
    for s in BREAK.split(TAG.sub(" ", ENTITY.sub(" ", kept))):
        w = words_of(s)
        parts = max(1, round(len(w) / RUN)) if len(w) > 45 else 1
        out += [p for j in range(parts) if len(p := w[j * len(w) // parts : (j + 1) * len(w) // parts]) > 2]
    return out


def term_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, h, terms and seq of each document that is mainly prose: a hash of the text, the distinct
    terms, and per sentence a 0 and its terms. A term is the hash of a word of three letters or more
    that is no function word. Null, empty and blank texts, lists, tables and junk give no row."""
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") > 0)
    kind = src.schema["key"].dataType.simpleString()

    def one(text: str) -> list[int] | None:
        us, ok = prose_units(text)
        chars = sum(u[0] for u in us)
        prose = sum(u[0] for u, k in zip(us, ok, strict=True) if k)
        if not chars or prose < 0.5 * chars or prose / chars - repeated_share(text) < 0.5:
            return None
        seq: list[int] = []
        for s in sentences(text, us, ok):
            seq.append(0)
            seq += [t for w in s if (t := _TERMS[w])]
        return seq or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            got = [one(t) for t in texts]
            keep = [k for k, s in enumerate(got) if s]
            h = np.array([xxhash.xxh3_64_intdigest(texts[k].encode("utf-8", "replace")) for k in keep], np.uint64).view(np.int64)
            terms = [list(set(got[k]) - {0}) for k in keep]
            cols = [b.column(0).take(pa.array(keep, pa.int64())), pa.array(h), pa.array(terms, pa.list_(pa.int64())), pa.array([got[k] for k in keep], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "h", "terms", "seq"])

    return src.mapInArrow(run, f"key {kind}, h bigint, terms array<bigint>, seq array<bigint>")


def seeds(labels: DataFrame, key: str, subject: str, annotator: str) -> DataFrame:
    """key and subjects (an array, empty for none) of the labelled documents whose annotators agree."""
    each = labels.groupBy(F.col(key).alias("key"), F.col(annotator).alias("a")).agg(F.array_sort(F.collect_set(subject)).alias("subjects"))
    x = each.groupBy("key").agg(F.collect_set("subjects").alias("sets"))
    return x.where(F.size("sets") == 1).select("key", F.col("sets")[0].alias("subjects"))


def distinct_texts(rows: DataFrame, seed: DataFrame) -> DataFrame:
    """h, terms, seq, own of each distinct text. own: the subjects that most of its labelled copies
    have, null without labels or where no set of subjects has most."""
    ids = rows.select("key", "h")
    copied = stored(ids.groupBy("h").agg(F.min("key").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"), "copied")
    rest = stored(ids.join(copied, "h").where(F.col("key") != F.col("rep")).select("key"), "rest")
    votes = ids.join(seed, "key").groupBy("h", "subjects").agg(F.count("*").alias("n"))
    by = F.sort_array(F.collect_list(F.struct("n", "subjects")), asc=False)  # sets of subjects are few
    own = votes.groupBy("h").agg(by.alias("by")).where((F.size("by") == 1) | (F.col("by")[0]["n"] > F.get("by", F.lit(1))["n"]))
    first = rows.join(rest, "key", "left_anti").drop("key")
    return first.join(own.select("h", F.col("by")[0]["subjects"].alias("own")), "h", "left")


class Terms(NamedTuple):
    """Verified terms in ascending order, and p by term and subject of the sure ones and of the hints;
    the last row, for all other terms, is 0."""

    terms: np.ndarray
    sure: np.ndarray
    hint: np.ndarray

    def at(self, t: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.terms, t)
        k[k == len(self.terms)] = 0
        return np.where(self.terms[k] == t, k, len(self.terms)) if len(self.terms) else k


def counted(nodes: DataFrame, names: list[str], terms: Terms | None) -> DataFrame:
    """term, s, w: the weight of the texts of known or inferred subjects that hold a term, by number of
    subject (s), of all these texts (s = KNOWN), and the number of all texts (s = ALL). Term 0 is in every text.

    A text's subjects are inferred where a fifth or more, and two at least, of its sure terms speak for
    them. A labelled text is trusted, and stays clamped to its subjects with the weight SEED_WEIGHT, as
    long as its terms don't say something else altogether. Without terms only the labelled texts are known."""
    sent = nodes.sparkSession.sparkContext.broadcast(terms)  # the verified terms
    number = {s: k for k, s in enumerate(names)}
    size = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for b in batches:
            n = b.num_rows
            flat = b.column(0).flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(n), np.diff(b.column(0).offsets.to_numpy()))
            labels = b.column(1).to_pylist()
            has = np.array([x is not None for x in labels], bool)
            own = np.zeros((n, size), bool)
            for k in np.flatnonzero(has):
                own[k, [number[s] for s in labels[k]]] = True
            if t is None:
                subjects, weight = own, has.astype(float)
            else:
                at = t.at(flat)
                best = t.sure.argmax(1)
                good = t.sure[np.arange(len(best)), best][at] >= AGREE
                hits = np.bincount(doc[good] * size + best[at[good]], minlength=n * size).reshape(n, size)
                got = (hits >= 2) & (hits >= 0.2 * hits.sum(1, keepdims=True))
                clamped = has & (~got.any(1) | (got & own).any(1))
                subjects = np.where(clamped[:, None], own, got)
                weight = np.where(clamped, SEED_WEIGHT, subjects.any(1).astype(float))
            each = np.concatenate((subjects * weight[:, None], weight[:, None], np.ones((n, 1))), axis=1)
            words, at = np.unique(flat, return_inverse=True)
            w = np.stack([np.bincount(at, each[doc, k], minlength=len(words)) for k in range(size + 2)], 1)
            w = np.concatenate((each.sum(0)[None], w))
            r, c = np.nonzero(w)
            kinds = np.array([*range(size), KNOWN, ALL], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([0], words))[r]), pa.array(kinds[c]), pa.array(w[r, c])], names=["term", "s", "w"])

    each = nodes.select("terms", "own").mapInArrow(run, "term bigint, s int, w double")
    return each.groupBy("term", "s").agg(F.sum("w").alias("w"))


def verified_terms(counts: DataFrame, names: list[str]) -> Terms:
    """The terms that speak for one subject alone (sure) or for few (a hint), and how much; of the terms
    that LEAST_DOCS distinct texts or more hold."""
    whole = {r["s"]: r["w"] for r in counts.where("term = 0").collect()}  # a row per subject
    base = F.array(*(F.lit(float(whole.get(k, 0.0) / max(1e-9, whole.get(KNOWN, 0.0)))) for k in range(len(names))))
    one = counts.where("term <> 0").groupBy("term").agg(
        F.max(F.when(F.col("s") == KNOWN, F.col("w"))).alias("n"),
        F.max(F.when(F.col("s") == ALL, F.col("w"))).alias("texts"),
        F.collect_list(F.when(F.col("s") >= 0, F.struct("s", F.col("w").alias("c")))).alias("by"),  # an entry per subject
    )
    one = one.where((F.col("texts") >= LEAST_DOCS) & F.col("n").isNotNull())
    p = F.transform("by", lambda v: F.struct(((v["c"] + PRIOR * F.get(base, v["s"])) / (F.col("n") + PRIOR)).alias("p"), v["s"].alias("s"), F.get(base, v["s"]).alias("base")))
    top = one.select("term", F.sort_array(p, asc=False).alias("by")).where(F.size("by") > 0)
    # a subject that many documents have must stand out the more, or words of all subjects would drift to it
    p1, b1 = F.col("by")[0]["p"], F.col("by")[0]["base"]
    sure = (p1 >= AGREE) & (p1 * (1 - b1) >= ODDS * b1 * (1 - p1)) & (F.coalesce(F.get("by", F.lit(1))["p"], F.lit(0.0)) <= OTHER)
    top = top.withColumn("sure", sure).select("term", "sure", F.explode("by").alias("x"))
    got = top.select("term", "sure", "x.s", F.col("x.p").cast("float").alias("p")).where(F.col("p") >= HINT).toArrow()
    term = got["term"].to_numpy()
    terms, at = np.unique(term, return_inverse=True)
    table = np.zeros((2, len(terms) + 1, max(1, len(names))), np.float32)
    table[np.where(got["sure"].to_numpy(zero_copy_only=False), 0, 1), at, got["s"].to_numpy()] = got["p"].to_numpy()
    return Terms(terms, table[0], table[1])


def changed(a: Terms, b: Terms) -> float:
    """The share of the sure terms of either that aren't sure of the same subject in both."""
    sure = [{int(t): int(k) for t, k, p in zip(x.terms, x.sure.argmax(1), x.sure.max(1), strict=False) if p > 0} for x in (a, b)]
    every = sure[0].keys() | sure[1].keys()
    return sum(sure[0].get(t) != sure[1].get(t) for t in every) / max(1, len(every))


def propagate(nodes: DataFrame, names: list[str], rounds: int = ROUNDS, still: float = STILL) -> Terms:
    """The verified terms when they hardly change any more: in rounds, until at most `still` of them do. Where
    labels are few, inferred subjects begin to feed on themselves: a round that changes more than the one
    before it is not taken, and ends the propagation."""
    terms, before = None, None
    for _ in range(rounds + 1):
        last, terms = terms, verified_terms(stored(counted(nodes, names, terms), "counts"), names)
        if last is None:
            continue
        now = changed(last, terms)
        if before is not None and now > before:
            return last
        if now <= still:
            break
        before = now
    return terms


def subject_shares(nodes: DataFrame, terms: Terms, names: list[str]) -> DataFrame:
    """h, subject, share, clamped: the part of a text's sentences that treat a subject, and whether the text is
    labelled with it. A sentence treats the subject its terms speak for most; hints count only for subjects
    the text has anyway."""
    sent = nodes.sparkSession.sparkContext.broadcast(terms)  # the verified terms

    def some(keys: pa.Array, seqs: pa.Array, own: list) -> pa.RecordBatch:
        t = sent.value
        seq = seqs.flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(seqs)), np.diff(seqs.offsets.to_numpy()))
        starts = np.flatnonzero(seq == 0)  # a sentence is a 0 and its terms
        owner = doc[starts]
        total = np.maximum(1, np.bincount(owner, minlength=len(seqs)))[:, None]
        seq = t.at(seq)
        width = t.sure.shape[1]

        def counted(which: np.ndarray, best: np.ndarray) -> np.ndarray:
            return np.bincount(owner[which] * width + best, minlength=len(seqs) * width).reshape(-1, width) / total

        score = np.add.reduceat(t.sure[seq], starts)
        first = score.max(1) >= AGREE
        share = counted(first, score[first].argmax(1))
        rest = np.add.reduceat(t.hint[seq], starts) * (share[owner] >= SHARE / 2)
        second = ~first & (rest.max(1) >= HINT)
        share = share + counted(second, rest[second].argmax(1))
        d, s = np.nonzero(share)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(d)), pa.array([names[k] for k in s], pa.string()), pa.array(share[d, s]), pa.array([names[k] in (own[j] or ()) for j, k in zip(d, s, strict=True)], pa.bool_())], names=["h", "subject", "share", "clamped"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                yield some(b.column(0).slice(lo, 500), pa.concat_arrays([b.column(1).slice(lo, 500)]), b.column(2).slice(lo, 500).to_pylist())

    return nodes.select("h", "seq", "own").mapInArrow(run, "h bigint, subject string, share double, clamped boolean")


def document_subjects(df: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, subject: str, annotator: str, share: float = SHARE) -> DataFrame:
    """key, subject, share of each subject that at least `share` of a document's sentences treat. A labelled
    document keeps a subject of its labels if half as much of it does: the labels are clamped unless the text
    speaks against them, as some are wrong.

    key is unique in df. Documents without text or without connected sentences have none; without
    labels no document has any. Labels of unknown documents are ignored. Copies count as one text."""
    seed = stored(seeds(labels, label_key, subject, annotator), "seeds")
    names = sorted(r["s"] for r in seed.select(F.explode("subjects").alias("s")).distinct().collect())  # subjects are few
    rows = stored(term_rows(df, key, text), "term-rows")
    nodes = stored(distinct_texts(rows, seed), "texts")
    got = subject_shares(nodes, propagate(nodes, names), names).where((F.col("share") >= share) | (F.col("clamped") & (F.col("share") >= share / 2)))
    return rows.select("key", "h").join(got, "h").select("key", "subject", "share")
