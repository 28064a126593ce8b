from __future__ import annotations

import numpy as np
import pytest

from grainflow.config import CurationConfig
from grainflow.operators import evaluation, inject, judge, metrics, sampling
from grainflow.operators.embedding import embedded, hashing_provider
from grainflow.operators.funnel import conservation, curate, kept_documents
from grainflow.operators.quality import QualityModel, auc, cross_validated, score, train, with_quality
from grainflow.session import stored

RESULT = "doc_id string, decision string, stage string, reason string, quality_score double, dedup_similarity double, embed_dim int, latency_ms double, embedded_chars bigint"
GOLD = [
    ("a", "reject", "heuristic", "too_short", None, None, None, 0.2, 0),
    ("b", "REJECT", "quality", "low_quality", 0.3, None, 4, 1.1, 500),
    ("c", "keep", "kept", None, 0.8, None, 4, 1.5, 600),
    ("d", "keep", "kept", "", 0.6, None, 4, 1.4, 700),
]


def test_funnel_statistics(spark):
    df = spark.createDataFrame(GOLD, RESULT)
    r = metrics.funnel_stats(df).first()
    assert (r["ingested"], r["kept"], r["retention_rate"], r["embed_calls"]) == (4, 2, 0.5, 3)
    assert r["est_cost"] > 0
    assert r["rejected_by_stage"] == {"heuristic": 1, "quality": 1}
    assert r["rejected_by_reason"] == {"too_short": 1, "low_quality": 1}
    assert r["p50_ms"] == pytest.approx({"heuristic": 0.2, "quality": 1.1, "kept": 1.45})
    assert [x["survivors"] for x in metrics.survivors(df).orderBy("step").collect()] == [4, 3, 2, 2]
    empty = metrics.funnel_stats(df.limit(0)).first()
    assert (empty["ingested"], empty["retention_rate"]) == (0, 0.0)


def test_medians_and_bins(spark):
    rows = [("x", "keep", "kept", None, q, None, 1, lat, 1) for q, lat in ((0.82, 1.0), (0.05, 2.0), (None, 3.0), (float("nan"), 10.0), (1.0, -1.0), (0.5, None))]
    df = spark.createDataFrame(rows, RESULT)
    r = metrics.latency(df).first()
    assert (r["rows"], r["p50"], r["upper_p50"]) == (4, 2.5, 3.0)
    bins = {b["bin"]: b["count"] for b in metrics.quality_histogram(df).collect()}
    assert len(bins) == 20 and bins[0.825] == 1 and bins[0.075] == 1 and bins[0.975] == 1 and sum(bins.values()) == 4


def test_curation_ends_each_document_once(spark, tmp_path):
    good = "The keeper of the house said that it was a good day and that the others had not been there before. "
    docs = [(1, "a", good * 4, "s"), (2, "b", "short", "s"), (3, "c", good * 4, None), (4, "d", good * 5, "s"), (5, "e", good * 6, "s"), (6, None, None, "s")]
    vecs = [("a", [1.0, 0.0]), ("c", [0.999, 0.01]), ("d", [-1.0, 0.0])]
    d = spark.createDataFrame(docs, "seq bigint, id string, text string, source string")
    v = spark.createDataFrame(vecs, "id string, emb array<float>")
    m = QualityModel([4.0, 0.0], 0.0, 2)
    calls = spark.sparkContext.accumulator(0)

    def embedder(texts, dim):
        calls.add(len(texts))
        return np.array([[1.0, 1.0]] * len(texts), np.float32) / 2**0.5

    got = stored(curate(d, v, m, CurationConfig(embed_dim=2), embedder=embedder))
    assert calls.value == 1  # only the document without a vector
    by = {r["seq"]: (r["decision"], r["stage"], r["reason"]) for r in got.collect()}
    assert by == {
        1: ("keep", "kept", None),
        2: ("reject", "heuristic", "too_short"),
        3: ("reject", "dedup", "near_duplicate"),
        4: ("reject", "quality", "low_quality"),
        5: ("keep", "kept", None),
        6: ("reject", "heuristic", "too_short"),
    }
    c = conservation(got).first()
    assert (c["ingested"], c["kept"], c["conserved"]) == (6, 2, True)
    assert sorted(r["id"] for r in kept_documents(d, got).collect()) == ["a", "e"]
    none = curate(d, v, None, CurationConfig(embed_dim=2)).where("seq = 1").first()
    assert none["quality_score"] is None
    p = str(tmp_path / "m.json")
    m.save(p)
    assert QualityModel.load(p) == m and QualityModel.load(p + "x") is None


def test_quality_training(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=4) + (k % 2)], k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "id bigint, emb array<float>, y int")
    m = train(df, "emb")
    assert auc(with_quality(df, "emb", m), "quality_score").first()["auc"] > 0.8
    cv = cross_validated(df, "emb", "id", 3)
    assert len(cv["auc"]) == 3 and cv["auc_mean"] == pytest.approx(np.mean(cv["auc"])) and cv["accuracy_std"] == pytest.approx(np.std(cv["accuracy"]))
    with pytest.raises(ValueError):
        train(df.where("y = 1"), "emb")
    x = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1)], "s double, y int")
    assert auc(x, "s").first()["auc"] == 0.875
    assert df.select(score("emb", m).alias("s")).where("s < 0 or s > 1").count() == 0


def test_embedding_cache(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "seq bigint, text string")
    empty = spark.createDataFrame([], "key string, embedding array<float>")
    got, fresh = embedded(docs, "text", empty, dim=8)
    assert got.count() == 3 and fresh.count() == 2
    again, none = embedded(docs, "text", fresh, dim=8)
    assert again.count() == 3 and none.count() == 0
    calls = []

    def flaky(texts, dim):
        calls.append(1)
        if len(calls) < 2:
            raise RuntimeError("busy")
        return hashing_provider(texts, dim)

    from grainflow.operators.embedding import embed

    assert embed(docs, "text", flaky, 4).count() == 3


def test_variants_prompts_and_samples(spark):
    docs = spark.createDataFrame([(1, "x", "One. Two."), (2, "y", "single"), (3, "z", "")], "seq bigint, doc_id string, text string")
    v = {r["doc_id"]: (r["text"], r["is_variant"]) for r in inject.with_variants(docs, "doc_id", "text").collect()}
    assert len(v) == 6 and v["x::v2"] == ("Two. One.", True) and v["x::trunc"] == ("One. T", True) and v["y"] == ("single", False)
    many = spark.range(20).selectExpr("id as seq", "cast(id as string) as doc_id", "concat('text ', id) as text")
    p = judge.prompts(many, "seq", "doc_id", "text").orderBy("batch").collect()
    assert [len(r["ids"]) for r in p] == [8, 8, 4] and p[0]["prompt"].startswith("[0] text 0\n\n[1] text 1")
    rep = spark.createDataFrame([(["a", "b"], '{"scores": [{"id": 0, "score": 4}, {"id": 1, "score": 9}, {"id": 7, "score": 2}]}'), (["c"], "no json")], "ids array<string>, reply string")
    d = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "t")], "doc_id string, text string")
    assert [(r["doc_id"], r["edu_score"]) for r in judge.scores(rep, d).collect()] == [("a", 4)]
    assert [r["seq"] for r in sampling.every_nth(many, "seq", 6).orderBy("seq").collect()] == [5, 11, 17]
    for y, n in ((many.seq % 2, {0: 7, 1: 7}), (many.seq * 0, {0: 15})):
        cut = sampling.stratified_split(many.withColumn("y", y), "doc_id", "y")
        assert {r["y"]: r["count"] for r in cut.where("part = 'train'").groupBy("y").count().collect()} == n and cut.count() == 20
    assert [r["seq"] for r in sampling.cut_off(many, "seq", 3).orderBy("seq").collect()] == [0, 1, 2]
    known = spark.createDataFrame([("3", 4), ("3", 2), ("5", 9), ("99", 1)], "doc_id string, edu_score int")
    again = judge.scores(judge.from_labels(judge.prompts(many, "seq", "doc_id", "text"), known), many)
    assert [(r["doc_id"], r["edu_score"]) for r in again.collect()] == [("3", 2)]


def test_parity_and_gates(spark):
    a = spark.createDataFrame([(1, "keep", None), (2, "reject", "x"), (3, "keep", None)], "id bigint, decision string, reason string")
    b = spark.createDataFrame([(1, "keep", None), (2, "reject", "y"), (9, "keep", None)], "id bigint, decision string, reason string")
    assert [r["id"] for r in evaluation.mismatches(a, b, "id", ["decision", "reason"]).collect()] == [2, 3]
    assert evaluation.same_decisions(a, a) and not evaluation.same_decisions(a, b)
    assert evaluation.gates({"dedup_recall": 0.95, "classifier_auc": 0.8}) == {"dedup_recall": True, "classifier_auc": False}
    f = spark.createDataFrame([(True, True), (True, False), (False, False)], "is_repeat boolean, dropped boolean")
    r = evaluation.precision_recall(f).first()
    assert (r["precision"], r["recall"]) == (1.0, 0.5)


def test_streams(spark, tmp_path):
    from grainflow.streaming import curation

    src = str(tmp_path / "in")
    rows = [(0, 1, "a", [1.0, 0.0], None), (0, 2, "b", [0.99, 0.01], None), (0, 3, "c", [0.0, 1.0], None), (1, 4, "d", [1.0, 0.0], None)]
    schema = "part int, seq bigint, id string, emb array<float>, sig array<bigint>"
    spark.createDataFrame(rows[:2], schema).coalesce(1).write.parquet(src)
    spark.createDataFrame(rows[2:] + [(0, 5, "e", [0.01, 0.99], None)], schema).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = curation.dedup(s).writeStream.format("memory").queryName("dedup_out").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(90)
    got = {r["id"]: r["duplicate"] for r in spark.table("dedup_out").collect()}
    assert got == {"a": False, "b": True, "c": False, "d": False, "e": True}
    res = str(tmp_path / "res")
    spark.createDataFrame([("heuristic", "too_short"), ("kept", None), ("heuristic", "too_short")], "stage string, reason string").write.parquet(res)
    t = curation.memory_totals(spark.readStream.schema("stage string, reason string").parquet(res), "totals", None)
    t.awaitTermination(60)
    assert {(r["stage"], r["rows"]) for r in spark.table("totals").collect()} == {("heuristic", 2), ("kept", 1)}


SIGNED = "part int, seq bigint, id string, emb array<float>, sig array<bigint>"


def test_streams_read_a_table_of_one_file_or_a_folder(spark, tmp_path):
    from grainflow.plans.queries import queries

    rows = [(f"d{k}", "text", 0.5, None if k % 2 else "s") for k in range(20)]
    clean = spark.createDataFrame(rows, "id string, text string, quality_score double, source string")
    clean.repartition(3).write.parquet(f"{tmp_path}/folder/clean_docs.parquet")
    clean.repartition(2).write.parquet(f"{tmp_path}/folder/clean_docs2.parquet")  # another table
    clean.toPandas().to_parquet(f"{tmp_path}/clean_docs.parquet")
    for d in (f"{tmp_path}/folder", str(tmp_path)):
        assert sorted(map(str, queries()["x5_kept_stream"](spark, d).collect())) == sorted(map(str, clean.collect()))


def test_signer_signs_what_passes(spark):
    """The funnel's own signatures decide as given ones do, and texts that fail the rules get none."""
    from grainflow.functions.minhash import text_signature

    good = "The keeper of the house said that it was a good day and that the others had not been there before. "
    docs = [(k, f"d{k % 9}", good * (3 + k % 4) if k % 5 else "short", "s") for k in range(24)]
    d = spark.createDataFrame(docs, "seq bigint, id string, text string, source string")
    v = spark.createDataFrame([("d1", [1.0, 0.0]), ("d2", [0.999, 0.01])], "id string, emb array<float>")
    given = curate(d.withColumn("sig", text_signature("text")), v, None, CurationConfig(embed_dim=2), sig="sig").collect()
    own = curate(d, v, None, CurationConfig(embed_dim=2), signer=text_signature).collect()
    assert sorted(map(str, own)) == sorted(map(str, given)) and len(own) == 24


def test_stream_dedup_with_and_without_signatures_over_batches_and_a_restart(spark, tmp_path):
    """One mark per kept row, null allowed: the same state whatever the order of rows with and without."""
    from grainflow.streaming import curation

    src, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    one, other = [1, 2, 3, 4], [5, 6, 7, 8]
    batches = [
        [(0, 1, "a", [1.0, 0.0], None), (0, 2, "b", [0.0, 1.0], one), (0, 3, "c", [0.01, 1.0], one)],
        [(0, 4, "d", [0.01, 0.99], other), (0, 5, "e", [1.0, 0.01], other), (0, 6, "f", None, one), (1, 7, "g", [0.0, 1.0], one)],
        [(0, 8, "h", [0.0, 1.0], one), (0, 9, "i", [0.0, 1.0], None), (0, 10, "j", [1.0, 1.0, 1.0], one)],
    ]
    for k, rows in enumerate(batches):  # a start each, from the checkpoint of the last
        spark.createDataFrame(rows, SIGNED).coalesce(1).write.mode("append").parquet(src)
        got = curation.dedup(spark.readStream.schema(SIGNED).parquet(src))
        q = got.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
        q.awaitTermination(90)
        assert spark.read.parquet(out).count() == sum(map(len, batches[: k + 1]))
    by = {r["id"]: r["neighbour"] for r in spark.read.parquet(out).collect()}
    assert by == {"a": None, "b": None, "c": "b", "d": None, "e": "a", "f": None, "g": None, "h": "b", "i": "b", "j": None}


def test_console_push_and_stop(spark, tmp_path):
    from grainflow.streaming import curation

    res = str(tmp_path / "res")
    spark.createDataFrame([("reject", "heuristic", "too_short"), ("keep", "kept", None), ("reject", "quality", "low_quality")], "decision string, stage string, reason string").write.parquet(res)
    rows = spark.readStream.schema("decision string, stage string, reason string").parquet(res)
    curation.to_console(rows, None).awaitTermination(60)
    q = curation.memory_totals(rows, "pushed", "100 milliseconds")
    q.processAllAvailable()
    got = list(curation.pushed(spark, "pushed", 0.01, 2))[-1]
    assert got == {"ingested": 3, "kept": 1, "retention_rate": 1 / 3, "rejected_by_stage": {"heuristic": 1, "quality": 1}, "rejected_by_reason": {"too_short": 1, "low_quality": 1}}
    curation.stop_on_signal(q, ()).set()
    q.awaitTermination(30)
    assert not q.isActive


def test_command_line(spark, tmp_path, capsys):
    from grainflow.__main__ import main

    labels = spark.createDataFrame([(f"d{k}", f"text {k}", 1 + k % 5) for k in range(30)], "doc_id string, text string, edu_score int")
    labels.write.parquet(str(tmp_path / "labels"))
    cache = str(tmp_path / "cache")
    for n in (4, 40):
        assert main(["judge", "--input", str(tmp_path / "labels"), "--known", str(tmp_path / "labels"), "--cache", cache, "--n", str(n)]) == 0
    assert '"labels": 30' in capsys.readouterr().out
    rng = np.random.default_rng(1)
    vec = [(f"d{k}", (rng.normal(size=4) + (k % 5 >= 3) * 2).astype("<f4").tobytes()) for k in range(30)]
    spark.createDataFrame(vec, "id string, emb binary").write.parquet(str(tmp_path / "vec"))
    assert main(["train", "--labels", str(tmp_path / "labels"), "--vectors", str(tmp_path / "vec"), "--model", str(tmp_path / "m.json")]) == 0
    assert "auc_mean" in capsys.readouterr().out and QualityModel.load(str(tmp_path / "m.json")).embed_dim == 4


def test_bench_rows_and_chart_frames(spark):
    b = spark.createDataFrame([("spark", 1, 100.0), ("spark", 4, 350.0), ("other", 1, 50.0)], "runtime string, workers int, docs_per_sec double")
    got = {(r["runtime"], r["workers"]): r["speedup"] for r in evaluation.speedups(b, (b.runtime == "spark") & (b.workers == 1)).collect()}
    assert got == {("spark", 1): 1.0, ("spark", 4): 3.5, ("other", 1): 0.5}
    assert [(r["runtime"], r["workers"]) for r in metrics.scaling(b).collect()] == [("other", 1), ("spark", 1), ("spark", 4)]
    assert [r["runtime"] for r in metrics.throughput_by_runtime(b).collect()] == ["spark", "other"]
    sweep = spark.createDataFrame([(0.8, 1.0, 0.9)], "threshold double, precision double, recall double")
    assert {(r["measure"], r["value"]) for r in metrics.precision_recall_points(sweep).collect()} == {("precision", 1.0), ("recall", 0.9)}
