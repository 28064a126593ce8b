"""python -m grainflow curate|judge|train|eval|stress|query|bench ..."""

from __future__ import annotations

import argparse
import json
import sys
import time


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="grainflow")
    p.add_argument("--shared", default="", help="folder that all executors share; needed where spark.checkpoint.dir is unset")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("curate", help="documents and vectors (Parquet) through the funnel")
    c.add_argument("--input", required=True, help="seq, id, text, source")
    c.add_argument("--vectors", required=True, help="id, emb (binary)")
    c.add_argument("--model", default="", help="JSON of a quality model; left out if missing")
    c.add_argument("--languages", default="", help="Parquet with text and lang, which teach the language identifier; without it that rule is left out")
    c.add_argument("--kept", required=True)
    c.add_argument("--results", required=True)
    c.add_argument("--dim", type=int, default=1024)
    c.add_argument("--dedup-threshold", type=float, default=0.90)
    c.add_argument("--surface-threshold", type=float, default=0.5)
    c.add_argument("--parts", type=int, default=1, help="independent dedup indexes, by band")
    j = sub.add_parser("judge", help="labels of documents that have none, by known labels (a judge without a network)")
    j.add_argument("--input", required=True, help="doc_id, text")
    j.add_argument("--known", required=True, help="Parquet with doc_id and edu_score")
    j.add_argument("--cache", required=True, help="JSON lines that the new labels are appended to")
    j.add_argument("--n", type=int, default=600, help="documents at most, in order")
    j.add_argument("--batch", type=int, default=8, help="documents a prompt")
    t = sub.add_parser("train", help="a quality model from labels and vectors")
    t.add_argument("--labels", required=True, help="Parquet with doc_id and edu_score")
    t.add_argument("--vectors", required=True, help="id, emb (binary)")
    t.add_argument("--model", required=True, help="JSON to write")
    for name, text in (("eval", "precision and recall of dedup on injected duplicates, against the gates"), ("stress", "collisions and recall as collections and partitions grow")):
        e = sub.add_parser(name, help=text)
        e.add_argument("--data", required=True, help="folder with judge_labels")
        e.add_argument("--report", default="", help="JSON that the figures are merged into")
    q = sub.add_parser("query", help="one registered query to Parquet")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--output", required=True)
    b = sub.add_parser("bench", help="time curate over pre-embedded documents for several numbers of workers")
    b.add_argument("--data", required=True, help="folder with raw_docs, doc_rows and documents")
    b.add_argument("--workers", type=int, nargs="+", default=[1, 2, 4])
    return p


def bench_row(spark, data: str, workers: int) -> dict:  # noqa: ANN001
    """workers, docs, elapsed_sec, docs_per_sec, p50_latency_us and decisions of a whole run of the funnel,
    with as many independent dedup indexes as workers. The work is not done document by document: p50 is
    the time of a document at this rate times the workers."""
    from .config import CurationConfig
    from .functions.langid import by_profiles
    from .operators.funnel import curate
    from .operators.routing import routed
    from .plans import queries as plans
    from .session import stored

    docs = stored(routed(plans.with_signature(plans.raw(spark, data).select("seq", "id", "text")), "id", "sig", workers), "input")
    cfg, vectors, told = CurationConfig(embed_dim=plans.DIM), stored(plans.vectors(spark, data), "vectors"), by_profiles(plans.told(spark, data))
    n = docs.count()
    began = time.time()
    got = stored(curate(docs, vectors, plans.rule_model(plans.DIM), cfg, told, "sig", "part"), "results")
    took = time.time() - began
    decisions = {f"{r['decision']}:{r['reason'] or ''}": r["count"] for r in got.groupBy("decision", "reason").count().collect()}
    return {"runtime": "spark", "workers": workers, "docs": n, "elapsed_sec": round(took, 3), "docs_per_sec": round(n / took, 1), "p50_latency_us": round(1e6 * took * workers / max(1, n), 1), "decisions": decisions}


def main(argv: list[str] | None = None) -> int:
    from .session import get_spark, require_shared

    a = parser().parse_args(argv)
    spark = get_spark(f"grainflow {a.command}")
    try:
        require_shared(spark, a.shared)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    if a.command == "curate":
        from .config import CurationConfig
        from .functions.langid import by_profiles, fit_profiles
        from .functions.minhash import text_signature
        from .functions.vectors import decode_f32
        from .operators.funnel import conservation, curate, kept_documents
        from .operators.quality import QualityModel
        from .operators.routing import routed
        from .sources.writers import kept

        docs = spark.read.parquet(a.input)
        signed = docs.withColumn("sig", text_signature("text"))
        part = "part" if a.parts > 1 else None
        if part:
            signed = routed(signed, "id", "sig", a.parts)
        told = fit_profiles(spark.read.parquet(a.languages), "text", "lang") if a.languages else None
        cfg = CurationConfig(embed_dim=a.dim, dedup_cosine_threshold=a.dedup_threshold, dedup_surface_threshold=a.surface_threshold)
        vectors = spark.read.parquet(a.vectors).select("id", decode_f32("emb").alias("emb"))
        got = curate(signed, vectors, QualityModel.load(a.model) if a.model else None, cfg, by_profiles(told) if told else None, sig="sig", part=part)
        got.write.mode("overwrite").parquet(a.results)
        got = spark.read.parquet(a.results)
        kept(kept_documents(docs, got), a.kept)
        print(json.dumps(conservation(got).first().asDict()))
    elif a.command == "judge":
        from .operators import judge
        from .operators.sampling import cut_off
        from .sources.readers import LABEL
        from .sources.writers import label_cache

        docs, known = spark.read.parquet(a.input).where("length(text) > 0").select("doc_id", "text"), spark.read.parquet(a.known)
        done = spark.createDataFrame([], LABEL)
        if spark._jvm.java.io.File(a.cache.removeprefix("file://")).exists() or "://" in a.cache:
            done = spark.read.schema(LABEL).json(a.cache)
        open_ = judge.unlabelled(docs, done).dropDuplicates(["doc_id"])
        open_ = open_.join(cut_off(open_, "doc_id", a.n), "doc_id", "left_semi")
        got = judge.scores(judge.from_labels(judge.prompts(open_.withColumn("o", open_["doc_id"]), "o", "doc_id", "text", a.batch), known), open_)
        label_cache(got, a.cache)
        print(json.dumps({"labels": spark.read.schema(LABEL).json(a.cache).count()}))
    elif a.command == "train":
        from .functions.vectors import decode_f32
        from .operators.quality import auc, binarised, cross_validated, train, with_quality
        from .session import stored

        y = binarised(spark.read.parquet(a.labels)).groupBy("doc_id").agg({"y": "max"}).toDF("id", "y")
        x = stored(y.join(spark.read.parquet(a.vectors).select("id", decode_f32("emb").alias("emb")).where("emb is not null").dropDuplicates(["id"]), "id"), "train")
        counts = {r["y"]: r["count"] for r in x.groupBy("y").count().collect()}
        if len(counts) < 2:
            print("both classes are needed; label more documents", file=sys.stderr)
            return 1
        m = train(x, "emb")
        m.save(a.model)
        out = {"rows": sum(counts.values()), "positive": counts[1], "auc": auc(with_quality(x, "emb", m), "quality_score").first()["auc"]}
        if min(counts.values()) >= 5:
            out |= {k: v for k, v in cross_validated(x, "emb", "id").items() if k.endswith(("mean", "std"))}
        print(json.dumps(out))
    elif a.command in ("eval", "stress"):
        from .operators import evaluation
        from .plans.queries import eval_documents

        docs = eval_documents(spark, a.data)
        if a.command == "eval":
            sweep = [r.asDict() for r in evaluation.threshold_sweep(docs, "seq", "group", "emb").collect()]
            at = next(r for r in sweep if r["threshold"] == 0.9)
            out = {"dedup_precision": at["precision"], "dedup_recall": at["recall"], "sweep": sweep}
            out["gates"] = evaluation.gates(out)
        else:
            whole = docs.where("not is_variant")
            out = {
                "nearest_prior": [r.asDict() for r in evaluation.nearest_prior_stats(whole, "seq", "emb").collect()],
                "false_drops": {r["mode"]: r["drops"] for r in evaluation.false_drops(whole, "seq", "emb", "sig").collect()},
                "recall_by_partitions": [r.asDict() for r in evaluation.recall_by_partitions(docs, "seq", "id", "group", "emb", "sig").collect()],
            }
        print(json.dumps(evaluation.merge_report(a.report, out) if a.report else out, default=str))
        return int(a.command == "eval" and not all(out["gates"].values()))
    elif a.command == "query":
        from .plans.queries import queries

        queries()[a.name](spark, a.data).write.mode("overwrite").parquet(a.output)
    else:
        rows = [bench_row(spark, a.data, w) for w in a.workers]
        for r in sorted(rows, key=lambda r: r["workers"]):
            print(json.dumps(r | {"speedup": round(r["docs_per_sec"] / rows[0]["docs_per_sec"], 3)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
