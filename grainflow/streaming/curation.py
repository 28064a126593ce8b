"""Curation as streams: stateful dedup per part, running totals, the batch writer, console and stop; the
heuristics are those of operators.heuristics.with_reason, which takes streams as well."""

from __future__ import annotations

import signal
import threading
import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import DEFAULT
from ..sources.writers import kept

OUT = "part int, seq bigint, id string, duplicate boolean, neighbour string, dedup_similarity double"


def keeps(threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> Callable:
    """The stateful function of dedup(). The state holds the part's kept rows: ids, vectors, and one mark
    per row, its signature as bytes, empty where it has none."""

    def run(key: tuple, got: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ids, vecs, marks = (list(x) for x in state.get) if state.exists else ([], [], [])
        pdf = pd.concat(list(got)).sort_values("seq", kind="stable")
        matrix = np.zeros((0, 0), np.float32)
        if vecs:
            matrix = np.frombuffer(b"".join(vecs), np.float32).reshape(len(vecs), -1)
        n, rows = len(vecs), []
        for r in pdf.itertuples():
            e = None if r.emb is None else np.asarray(r.emb, np.float32)
            if e is None or not e.any() or (n and matrix.shape[1] != len(e)):
                rows.append((key[0], r.seq, r.id, False, None, None))
                continue
            e = e / np.linalg.norm(e)
            mark = b"" if r.sig is None else np.asarray(r.sig, np.int64).tobytes()
            near, sim = None, None
            if n:
                s = matrix[:n] @ e
                k = int(s.argmax())
                both = marks[k] and mark and len(marks[k]) == len(mark)
                same = float((np.frombuffer(marks[k], np.int64) == np.frombuffer(mark, np.int64)).mean()) if both else 1.0
                if s[k] >= threshold and same >= surface:
                    near, sim = ids[k], float(s[k])
            if near is None:
                if n == len(matrix):  # grows by doubling
                    matrix = np.concatenate((matrix.reshape(n, len(e)), np.zeros((max(64, n), len(e)), np.float32)))
                matrix[n] = e
                n += 1
                ids.append(r.id)
                vecs.append(e.tobytes())
                marks.append(mark)
            rows.append((key[0], r.seq, r.id, near is not None, near, sim))
        state.update((ids, vecs, marks))
        yield pd.DataFrame(rows, columns=["part", "seq", "id", "duplicate", "neighbour", "dedup_similarity"])

    return run


def dedup(stream: DataFrame, threshold: float = DEFAULT.dedup_cosine_threshold, surface: float = DEFAULT.dedup_surface_threshold) -> DataFrame:
    """Online near-duplicate removal of a stream (part, seq, id, emb array<float>, sig array<bigint> or
    null): decisions depend on the part's documents so far. The state survives restarts with the
    query's checkpoint; each part's state grows with its kept documents, so choose parts accordingly.
    Rows with a null or all-zero vector, or one of another length, are kept and no neighbours."""
    x = stream.select("part", "seq", "id", "emb", "sig").groupBy("part")
    return x.applyInPandasWithState(keeps(threshold, surface), OUT, "ids array<string>, vecs array<binary>, marks array<binary>", "append", GroupStateTimeout.NoTimeout)


def running_totals(results: DataFrame) -> DataFrame:
    """stage, reason, rows so far; for the complete output mode."""
    return results.groupBy("stage", "reason").agg(F.count("*").alias("rows"))


def windowed_totals(results: DataFrame, t: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Rows per window of event time and stage; rows later than `late` drop out."""
    return results.withWatermark(t, late).groupBy(F.window(t, width), "stage").agg(F.count("*").alias("rows"))


def memory_totals(results: DataFrame, name: str, every: str | None = "500 milliseconds") -> StreamingQuery:
    """Running totals in a table of the session, for a dashboard to read."""
    w = running_totals(results).writeStream.outputMode("complete").format("memory").queryName(name)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def write_kept(results: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Kept documents as Parquet, exactly once: a file sink's log makes repeated batches harmless."""
    w = results.where("decision = 'keep'").select("id", "text", "quality_score", "source").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def curate_batches(stream: DataFrame, checkpoint: str, curate_one: Callable[[DataFrame], tuple[DataFrame, DataFrame]], kept_path: str, results_path: str, available_now: bool = True) -> StreamingQuery:
    """Each micro-batch through curate_one (-> results, kept documents). Both are written under the
    batch's number, so that a batch that is repeated after a failure replaces its first attempt."""

    def each(df: DataFrame, batch_id: int) -> None:
        results, good = curate_one(df)
        results.write.mode("overwrite").parquet(f"{results_path}/batch={batch_id}")
        kept(good, f"{kept_path}/batch={batch_id}", mode="overwrite")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def to_console(results: DataFrame, every: str | None = "500 milliseconds") -> StreamingQuery:
    """A JSON line per terminal state, for runs without a metrics store."""
    w = results.select(F.to_json(F.struct(*results.columns)).alias("value")).writeStream.outputMode("append").format("console").option("truncate", False)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def stats(spark: SparkSession, name: str) -> dict:
    """The figures of a table of memory_totals() as a dashboard asks for them: ingested, kept, retention_rate,
    rejected_by_stage, rejected_by_reason."""
    rows = [r.asDict() for r in spark.table(name).collect()]  # a row per stage and reason
    total = sum(r["rows"] for r in rows)
    kept_rows = sum(r["rows"] for r in rows if r["stage"] == "kept")
    by: dict[str, Counter] = {"stage": Counter(), "reason": Counter()}
    for r in rows:
        if r["stage"] != "kept":
            for k, c in by.items():
                if r[k]:
                    c[r[k]] += r["rows"]
    return {"ingested": total, "kept": kept_rows, "retention_rate": kept_rows / total if total else 0.0, "rejected_by_stage": dict(by["stage"]), "rejected_by_reason": dict(by["reason"])}


def pushed(spark: SparkSession, name: str, every_s: float = 0.5, ticks: int | None = None) -> Iterator[dict]:
    """stats() again and again, at a steady interval."""
    k = 0
    while ticks is None or k < ticks:
        yield stats(spark, name)
        k += 1
        time.sleep(every_s)


def stop_on_signal(query: StreamingQuery, signals: tuple[int, ...] = (signal.SIGINT, signal.SIGTERM)) -> threading.Event:
    """Ends a query after its running micro-batch when a signal comes or the returned event is set: what
    was not committed is read again at the next start."""
    asked = threading.Event()

    def watch() -> None:
        asked.wait()
        while query.isActive and query.status["isTriggerActive"]:
            time.sleep(0.05)
        query.stop()

    if threading.current_thread() is threading.main_thread():
        for s in signals:
            signal.signal(s, lambda *_: asked.set())
    threading.Thread(target=watch, daemon=True).start()
    return asked
