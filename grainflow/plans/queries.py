"""One query per operator of the engine, and the equivalent SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, CurationConfig
from ..functions import text as T
from ..functions.langid import Profiles, by_profiles, fit_profiles, language
from ..functions.minhash import band_key, from_json, jaccard_estimate, md5_route, permutations, text_signature, to_json
from ..functions.vectors import cosine, decode_f32, is_vector
from ..operators import evaluation, inject, judge, metrics, sampling
from ..operators.dedup import cosine_pairs, first_by, nearest_prior, online_dedup
from ..operators.embedding import cache_hits, cache_misses, embedded, with_key
from ..operators.funnel import conservation, curate, kept_documents
from ..operators.heuristics import flags, with_reason
from ..operators.quality import QualityModel, auc, binarised, score, train, with_quality
from ..operators.routing import by_band, by_id, contiguous, routed
from ..session import shared_dir, stored
from ..sources import readers, writers
from ..sources.readers import FEED, states, table
from ..streaming import curation
from . import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIM = 256


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rule_model(dim: int) -> QualityModel:
    """A model whose coefficients follow a rule, to check the score's arithmetic."""
    return QualityModel([((k * 37) % 101 - 50) / 100 for k in range(dim)], 0.25, dim)


_Z = "list_sum(list_transform(range(1, len(e) + 1), lambda k: e[k] * ((((k - 1) * 37) % 101 - 50)::DOUBLE / 100)))"
_FIRST = "SELECT seq, id, text AS t, source FROM raw_docs WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1"
#: ready: seq, id, t, e, sig of the first arrivals that have a vector
_READY = f"""first AS ({_FIRST}), {sql.vectors(DIM)}, arrived AS (SELECT seq, id, t, e FROM first JOIN vecs USING (id)), {sql.signatures("arrived", "seq")},
  ready AS MATERIALIZED (SELECT seq, id, e, sig FROM arrived JOIN signed USING (seq))"""
#: ended: the terminal state of each row of raw_docs
_ENDED = f"""{sql.reasoned()}, {sql.vectors(DIM)}, open AS (SELECT seq, id, t FROM reasoned WHERE reason IS NULL), miss AS (SELECT seq, t FROM open WHERE id IS NULL OR id NOT IN (SELECT id FROM vecs)),
  {sql.hashed_vectors("miss", "seq", DIM)}, have AS (SELECT seq, t, e FROM open JOIN vecs USING (id) UNION ALL SELECT seq, t, e FROM open JOIN embedded USING (seq)),
  scored AS MATERIALIZED (SELECT seq, t, e, 1 / (1 + exp(-({_Z} + 0.25))) AS q FROM have), apt AS (SELECT seq, t, e FROM scored WHERE q >= 0.5), {sql.signatures("apt", "seq")},
  ready AS MATERIALIZED (SELECT seq, e, sig FROM apt JOIN signed USING (seq)), {sql.greedy("ready")},
  ended AS (SELECT seq, id AS doc_id, CASE WHEN reason IS NULL AND q >= 0.5 AND i IS NULL THEN 'keep' ELSE 'reject' END AS decision,
    CASE WHEN reason IS NOT NULL THEN 'heuristic' WHEN q < 0.5 THEN 'quality' WHEN i IS NOT NULL THEN 'dedup' ELSE 'kept' END AS stage,
    CASE WHEN reason IS NOT NULL THEN reason WHEN q < 0.5 THEN 'low_quality' WHEN i IS NOT NULL THEN 'near_duplicate' END AS reason,
    CASE WHEN reason IS NULL AND i IS NULL THEN round(q, 6) END AS quality_score, round(sim, 4) AS dedup_similarity,
    CASE WHEN reason IS NULL AND q >= 0.5 AND i IS NULL THEN 256 END::INTEGER AS embed_dim, CASE WHEN reason IS NULL THEN length(reasoned.t) ELSE 0 END AS embedded_chars
    FROM reasoned LEFT JOIN scored USING (seq) LEFT JOIN rejected ON i = seq)"""
#: judged: the variants with their vectors (e) and signatures; seen: seq, is_repeat
_JUDGED = f"""{sql.variants()}, {sql.hashed_vectors("variants", "seq", DIM)}, {sql.signatures("variants", "seq")},
  judged AS MATERIALIZED (SELECT seq, doc_id, grp, is_variant, e, sig FROM variants JOIN embedded USING (seq) JOIN signed USING (seq)),
  seen AS (SELECT seq, seq > min(seq) OVER (PARTITION BY grp) AS is_repeat FROM judged)"""


def raw(spark: SparkSession, d: str) -> DataFrame:
    return readers.spread(table(spark, d, "raw_docs"))


def results(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stage_results")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """id, emb (an array) of the usable vectors, one row per id."""
    x = readers.spread(table(spark, d, "doc_rows").select("id", "emb").where(F.octet_length("emb") == 4 * DIM)).select("id", decode_f32("emb").alias("emb")).where(is_vector("emb", DIM))
    return x.groupBy("id").agg(F.min("emb").alias("emb"))


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    """First arrivals: one row of raw_docs per id."""
    x = raw(spark, d).where("id is not null").select("seq", "id", "text", "source")
    return x.join(x.groupBy("id").agg(F.min("seq").alias("seq")).select("seq"), "seq", "left_semi")  # seq is unique


def told(spark: SparkSession, d: str) -> Profiles:
    """The language profiles that the labelled documents teach."""
    return fit_profiles(table(spark, d, "documents"), "text", "lang")


def reasons(spark: SparkSession, d: str) -> DataFrame:
    return with_reason(raw(spark, d), provider=by_profiles(told(spark, d)))


def with_signature(df: DataFrame) -> DataFrame:
    return df.withColumn("sig", text_signature("text"))


def embedded_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """seq, id, text, emb, sig of the first arrivals that have a vector."""
    return stored(with_signature(arrivals(spark, d).join(vectors(spark, d), "id")), "arrivals")


# --- sources and scans --------------------------------------------------------------------------


@query("SELECT seq, coalesce(id, seq::VARCHAR) AS id, length(text) AS chars FROM raw_docs WHERE length(text) > 0 ORDER BY seq LIMIT 200000")
def s1_corpus_scan(spark, d):  # noqa: ANN001, ANN201
    return sampling.corpus_scan(raw(spark, d), "seq", "id", "text").select("seq", "id", F.length("text").alias("chars"))


@query(f"WITH {sql.reasoned()} SELECT seq, id FROM reasoned WHERE reason IS NULL ORDER BY seq LIMIT 600")
def s2_first_passing(spark, d):  # noqa: ANN001, ANN201
    return sampling.first_passing(stored(reasons(spark, d).select("seq", "id", "reason"), "reasons"), "seq", 600).select("seq", "id")


@query(f"""WITH {sql.reasoned()}, head AS (SELECT * FROM reasoned ORDER BY seq LIMIT 300),
  done AS (SELECT * FROM head WHERE reason IS NOT NULL OR id IN (SELECT id FROM doc_rows WHERE emb IS NOT NULL))
  SELECT seq, id, reason FROM done ORDER BY seq LIMIT 200""")
def s3_double_capped(spark, d):  # noqa: ANN001, ANN201
    cached = table(spark, d, "doc_rows").where("emb is not null").select("id").distinct().withColumn("cached", F.lit(True))
    x = reasons(spark, d).select("seq", "id", "reason").join(cached, "id", "left")
    return sampling.double_capped(x, "seq", F.col("reason").isNotNull() | F.col("cached")).select("seq", "id", "reason")


@query(f"""WITH h AS (SELECT id, octet_length(emb) AS n, hex(emb) AS h FROM doc_rows), u AS (SELECT id, n, list_transform(range(0, n // 4), lambda i: {sql._BITS}) AS us FROM h)
  SELECT id, CASE WHEN n % 4 = 0 THEN n // 4 END::INTEGER AS dim,
    coalesce(n = {4 * DIM} AND len(list_filter(us, lambda u: ((u >> 23) & 255) = 255)) = 0 AND len(list_filter(us, lambda u: (u & 2147483647) <> 0)) > 0, false) AS usable FROM u""")
def s5_embedded_scan(spark, d):  # noqa: ANN001, ANN201
    x = table(spark, d, "doc_rows").select("id", decode_f32("emb").alias("emb"))
    return x.select("id", F.size("emb").alias("dim"), is_vector("emb", DIM).alias("usable"))


@query("SELECT doc_id, edu_score FROM judge_labels ORDER BY doc_id, edu_score, text LIMIT 200")
def s12_inject_scan(spark, d):  # noqa: ANN001, ANN201
    x = table(spark, d, "judge_labels")
    return x.orderBy(F.asc_nulls_last("doc_id"), F.asc_nulls_last("edu_score"), F.asc_nulls_last("text")).limit(200).select("doc_id", "edu_score")


def _feed_sql() -> str:
    total, at, arms = sum(w for _, w in FEED), 0.0, []
    for name, w in FEED:
        at += w
        arms.append(f"WHEN u * {total} < {at} THEN '{name}'")
    return f"CASE {' '.join(arms)} ELSE '{FEED[-1][0]}' END"


@query(f"""WITH u AS (SELECT ('0x' || substr(md5('42:' || seq), 1, 7))::BIGINT / 268435456.0::DOUBLE AS u FROM raw_docs), s AS (SELECT {_feed_sql()} AS s FROM u)
  SELECT CASE WHEN s = 'kept' THEN 'keep' ELSE 'reject' END AS decision, CASE s WHEN 'kept' THEN 'kept' WHEN 'low_quality' THEN 'quality' WHEN 'near_duplicate' THEN 'dedup' ELSE 'heuristic' END AS stage,
    nullif(s, 'kept') AS reason, count(*) AS rows FROM s GROUP BY ALL""")
def s11_synthetic_feed(spark, d):  # noqa: ANN001, ANN201
    x = states(raw(spark, d).select("seq"), "seq")
    return x.groupBy("decision", "stage", "reason").agg(F.count("*").alias("rows"))


# --- heuristics ---------------------------------------------------------------------------------


@query(f"WITH {sql.rules()} SELECT seq, too_short, too_long, symbol_ratio, short_lines, boilerplate FROM ruled")
def h1_h5_flags(spark, d):  # noqa: ANN001, ANN201
    return flags(raw(spark, d)).select("seq", "too_short", "too_long", "symbol_ratio", "short_lines", "boilerplate")


@query(f"WITH b AS (SELECT seq, coalesce(text, '') AS t FROM raw_docs), {sql.languages('b')} SELECT seq, coalesce(lang, 'und') AS lang FROM b LEFT JOIN told USING (seq)")
def h6_language(spark, d):  # noqa: ANN001, ANN201
    return raw(spark, d).select("seq", language("text", by_profiles(told(spark, d))).alias("lang"))


@query(f"WITH {sql.reasoned()} SELECT seq, id, reason FROM reasoned")
def h7_reasons(spark, d):  # noqa: ANN001, ANN201
    return reasons(spark, d).select("seq", "id", "reason")


# --- text and hash functions --------------------------------------------------------------------


@query(f"""WITH base AS (SELECT seq, text AS t, string_split_regex(text, '{sql.LE}') AS l FROM raw_docs WHERE text IS NOT NULL),
  m AS (SELECT seq, t, {sql.LINES} AS ls FROM base)
  SELECT seq, length(t) AS chars, CASE WHEN length(t) = 0 THEN 0.0 ELSE round({sql.SYMBOLS}::DOUBLE / length(t), 9) END AS symbols, len(ls) AS lines,
    round(list_sum(list_transform(ls, lambda x: length(x)))::DOUBLE / len(ls), 9) AS mean_line FROM m""")
def t1_t4_measures(spark, d):  # noqa: ANN001, ANN201
    return raw(spark, d).where("text is not null").select(
        "seq",
        T.char_length("text").alias("chars"),
        F.round(T.symbol_ratio("text"), 9).alias("symbols"),
        F.size(T.lines("text")).alias("lines"),
        F.round(T.mean_line_length("text"), 9).alias("mean_line"),
    )


@query("SELECT seq, md5(left(text, 2000)) AS head, md5(left(text, (length(text) * 0.7::DOUBLE)::BIGINT - CASE WHEN (length(text) * 0.7::DOUBLE)::BIGINT > length(text) * 0.7::DOUBLE THEN 1 ELSE 0 END)) AS most FROM raw_docs WHERE text IS NOT NULL")
def t7_t8_truncations(spark, d):  # noqa: ANN001, ANN201
    return raw(spark, d).where("text is not null").select("seq", F.md5(T.first_chars("text", 2000).cast("binary")).alias("head"), F.md5(T.first_share("text").cast("binary")).alias("most"))


@query(f"""WITH b AS (SELECT seq, text AS t FROM raw_docs WHERE text IS NOT NULL), {sql.shingles("b", "seq")}, c AS (SELECT DISTINCT seq, crc FROM grams JOIN gram_crc USING (s))
  SELECT seq, coalesce(len(w), 0)::INTEGER AS words, count(crc)::INTEGER AS shingles, coalesce(sum(crc), 0)::BIGINT AS crc_sum, max(crc)::BIGINT AS most FROM worded LEFT JOIN c USING (seq) GROUP BY seq, w""")
def t11_shingles(spark, d):  # noqa: ANN001, ANN201
    x = raw(spark, d).where("text is not null").select("seq", F.size(T.words("text")).alias("words"), T.shingle_crcs("text").alias("c"))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, v: a + v)
    return x.select("seq", "words", F.size("c").alias("shingles"), total.alias("crc_sum"), F.array_max("c").alias("most"))


@query(f"""WITH b AS (SELECT seq, text AS t FROM raw_docs WHERE length(text) > 0), {sql.signatures("b", "seq")}
  SELECT seq, sig[1] AS first, {sql.band(2)} AS band, list_min(sig) AS least FROM signed""")
def t12_signatures(spark, d):  # noqa: ANN001, ANN201
    x = with_signature(raw(spark, d).where("length(text) > 0").select("seq", "text"))
    return x.select("seq", F.col("sig")[0].alias("first"), F.hex(band_key("sig", 2)).alias("band"), F.array_min("sig").alias("least"))


@query(f"""WITH b AS (SELECT 'j' || doc_id AS k, min(text) AS t FROM judge_labels WHERE length(text) > 0 GROUP BY doc_id UNION ALL SELECT 'd' || id, min(text) FROM doc_rows WHERE length(text) > 0 GROUP BY id), {sql.signatures("b", "k")}
  SELECT substr(a.k, 2) AS doc_id, {sql.same_minima("a.sig", "b.sig")} AS jaccard FROM signed a JOIN signed b ON a.k = 'j' || substr(b.k, 2) AND b.k[1] = 'd'""")
def t13_jaccard(spark, d):  # noqa: ANN001, ANN201
    def one(name: str, key: str) -> DataFrame:
        return with_signature(table(spark, d, name).where("length(text) > 0").groupBy(F.col(key).alias("doc_id")).agg(F.min("text").alias("text")))

    a, b = one("judge_labels", "doc_id").select("doc_id", F.col("sig").alias("s1")), one("doc_rows", "id").select("doc_id", F.col("sig").alias("s2"))
    return a.join(b, "doc_id").select("doc_id", jaccard_estimate("s1", "s2").alias("jaccard"))


@query("""SELECT doc_id, ((((('0x' || substr(m, 1, 8))::UBIGINT % 7 * 4 + ('0x' || substr(m, 9, 8))::UBIGINT) % 7 * 4 + ('0x' || substr(m, 17, 8))::UBIGINT) % 7 * 4
  + ('0x' || substr(m, 25, 8))::UBIGINT) % 7)::INTEGER AS part FROM (SELECT doc_id, md5(doc_id::VARCHAR) AS m FROM documents)""")
def t16_md5_route(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "documents").select("doc_id", md5_route(F.col("doc_id").cast("string").cast("binary"), 7).alias("part"))


@query("SELECT seq, sha256(text) || ':1024' AS key FROM raw_docs WHERE text IS NOT NULL")
def t17_cache_keys(spark, d):  # noqa: ANN001, ANN201
    return with_key(raw(spark, d).where("text is not null")).select("seq", "key")


@query("""SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])
  * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def t18_cosine(spark, d):  # noqa: ANN001, ANN201
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine("embedding", "next"), 6).alias("cosine"))


@query("SELECT doc_id, CASE WHEN edu_score >= 4 THEN 1 ELSE 0 END AS y FROM judge_labels WHERE edu_score BETWEEN 1 AND 5 AND edu_score <> 3")
def t22_binarised(spark, d):  # noqa: ANN001, ANN201
    return binarised(table(spark, d, "judge_labels")).select("doc_id", "y")


# --- embedding and quality ----------------------------------------------------------------------


def _cache(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "doc_rows").where("emb is not null and text is not null")
    return with_key(x, "text", DIM).groupBy("key").agg(F.min(F.octet_length("emb")).alias("bytes"))


@query("""WITH c AS (SELECT sha256(text) AS k, min(octet_length(emb)) AS bytes FROM doc_rows WHERE emb IS NOT NULL AND text IS NOT NULL GROUP BY 1)
  SELECT seq, bytes FROM raw_docs JOIN c ON sha256(left(text, 160)) = k""")
def j1_cache_hits(spark, d):  # noqa: ANN001, ANN201
    x = with_key(raw(spark, d).select("seq", T.first_chars("text", 160).alias("text")), "text", DIM)
    return cache_hits(x, _cache(spark, d)).select("seq", "bytes")


@query("SELECT seq FROM raw_docs WHERE text IS NOT NULL AND sha256(left(text, 160)) NOT IN (SELECT sha256(text) FROM doc_rows WHERE emb IS NOT NULL AND text IS NOT NULL)")
def j2_cache_misses(spark, d):  # noqa: ANN001, ANN201
    x = with_key(raw(spark, d).where("text is not null").select("seq", T.first_chars("text", 160).alias("text")), "text", DIM)
    return cache_misses(x, _cache(spark, d)).select("seq")


@query("SELECT DISTINCT r.id FROM raw_docs r WHERE r.id IS NOT NULL AND r.id NOT IN (SELECT doc_id FROM judge_labels WHERE doc_id IS NOT NULL)")
def j3_unlabelled(spark, d):  # noqa: ANN001, ANN201
    ids = raw(spark, d).where("id is not null").select(F.col("id").alias("doc_id")).distinct()
    return judge.unlabelled(ids, table(spark, d, "judge_labels")).select(F.col("doc_id").alias("id"))


@query(f"""WITH b AS (SELECT seq, text AS t FROM raw_docs WHERE text IS NOT NULL), {sql.hashed_vectors("b", "seq", 64)}
  SELECT seq, coalesce(len(e), 64)::INTEGER AS dim, coalesce(len(list_filter(e, lambda x: x <> 0)), 0)::INTEGER AS filled, round(coalesce(list_sum(list_transform(range(1, 65), lambda k: k * e[k])), 0), 3) AS sum
  FROM b LEFT JOIN embedded USING (seq)""")
def e1_embed(spark, d):  # noqa: ANN001, ANN201
    empty = spark.createDataFrame([], "key string, embedding array<float>")
    docs = raw(spark, d).where("text is not null").select("seq", "text")
    got, _ = embedded(docs, "text", empty, dim=64)
    total = F.aggregate(F.transform("embedding", lambda v, k: (k + 1) * v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return got.select("seq", F.size("embedding").alias("dim"), F.size(F.filter("embedding", lambda v: v != 0)).alias("filled"), F.round(total, 3).alias("sum"))



@query(f"WITH b AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), z AS (SELECT vec_id, {_Z} + 0.25 AS z FROM b) SELECT vec_id, round(1 / (1 + exp(-z)), 6) AS quality_score FROM z")
def q1_scores(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "embeddings").select("vec_id", F.round(score("embedding", rule_model(64)), 6).alias("quality_score"))


@query(f"WITH b AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), z AS (SELECT vec_id, {_Z} + 0.25 AS z FROM b) SELECT vec_id FROM z WHERE 1 / (1 + exp(-z)) < 0.5")
def q2_low_quality(spark, d):  # noqa: ANN001, ANN201
    return with_quality(table(spark, d, "embeddings"), "embedding", rule_model(64)).where("low_quality").select("vec_id")


def labelled_vectors(spark: SparkSession, d: str) -> DataFrame:
    y = binarised(table(spark, d, "judge_labels")).groupBy(F.col("doc_id").alias("id")).agg(F.max("y").alias("y"))
    return y.join(vectors(spark, d), "id")


@query()
def u5_held_out_auc(spark, d):  # noqa: ANN001, ANN201
    x = stored(sampling.stratified_split(labelled_vectors(spark, d), "id", "y"), "split")
    m = train(x.where("part = 'train'"), "emb")
    return auc(x.where("part = 'test'").withColumn("s", score("emb", m)), "s")


@query(f"""WITH b AS (SELECT label, embedding::DOUBLE[] AS e FROM embeddings), z AS (SELECT (label % 2) AS y, {_Z} AS s FROM b),
  r AS (SELECT y, rank() OVER (ORDER BY round(s, 6)) + (count(*) OVER (PARTITION BY round(s, 6)) - 1) / 2.0 AS k FROM z)
  SELECT round((sum(CASE WHEN y = 1 THEN k END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0) / (count_if(y = 1)::DOUBLE * count_if(y = 0)), 6) AS auc FROM r""")
def a18_auc(spark, d):  # noqa: ANN001, ANN201
    m = rule_model(64)
    from ..functions.vectors import linear

    x = table(spark, d, "embeddings").select((F.col("label") % 2).alias("y"), F.round(linear("embedding", m.coef, 0.0), 6).alias("s"))
    return auc(x, "s").select(F.round("auc", 6).alias("auc"))


# --- dedup and funnel ---------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {_READY}, {sql.greedy("ready")} SELECT seq, id, j AS neighbour, round(sim, 6) AS dedup_similarity FROM ready LEFT JOIN rejected ON i = seq""")
def d1_online_dedup(spark, d):  # noqa: ANN001, ANN201
    x = embedded_arrivals(spark, d)
    return online_dedup(x, "seq", "emb", "sig").select("seq", "id", "neighbour", F.round("dedup_similarity", 6).alias("dedup_similarity"))


@query("""WITH n AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS e FROM embeddings)
  SELECT a.vec_id AS i, b.vec_id AS j, round(list_dot_product(a.e, b.e), 6) AS sim FROM n a JOIN n b ON b.vec_id < a.vec_id WHERE list_dot_product(a.e, b.e) >= 0.35""")
def j5_cosine_pairs(spark, d):  # noqa: ANN001, ANN201
    return cosine_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", 0.35).select("i", "j", F.round("sim", 6).alias("sim"))


@query("""WITH n AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS e FROM embeddings)
  SELECT a.vec_id AS i, round(max(list_dot_product(a.e, b.e)), 6) AS sim FROM n a JOIN n b ON b.vec_id < a.vec_id GROUP BY 1""")
def j7_nearest_prior(spark, d):  # noqa: ANN001, ANN201
    return nearest_prior(table(spark, d, "embeddings"), "vec_id", "embedding").select("i", F.round("sim", 6).alias("sim"))


@query(f"""WITH RECURSIVE {_READY}, dealt AS MATERIALIZED (SELECT seq, e, sig, {sql.md5_mod("m", 4)} AS part FROM (SELECT *, md5(unhex({sql.band()})) AS m FROM ready)), {sql.greedy("dealt", part="part")}
  SELECT seq, part, j AS neighbour FROM dealt LEFT JOIN rejected ON i = seq""")
def d5_partition_dedup(spark, d):  # noqa: ANN001, ANN201
    x = stored(routed(embedded_arrivals(spark, d), "id", "sig", 4), "routed")
    return online_dedup(x, "seq", "emb", "sig", "part").select("seq", "part", "neighbour")


def curated(spark: SparkSession, d: str) -> DataFrame:
    """Every row of raw_docs through the whole funnel; what has no vector is embedded."""
    docs = raw(spark, d).select("seq", "id", "text")
    got = curate(docs, vectors(spark, d), rule_model(DIM), CurationConfig(embed_dim=DIM), by_profiles(told(spark, d)), signer=text_signature)
    return stored(got.withColumn("quality_score", F.round("quality_score", 6)).withColumn("dedup_similarity", F.round("dedup_similarity", 4)), "curated")


@query(f"WITH RECURSIVE {_ENDED} SELECT * FROM ended")
def c1_stage_results(spark, d):  # noqa: ANN001, ANN201
    return curated(spark, d)


@query(f"WITH RECURSIVE {_ENDED} SELECT id, length(text) AS chars, quality_score, source FROM ended JOIN raw_docs USING (seq) WHERE decision = 'keep'")
def c2_kept_documents(spark, d):  # noqa: ANN001, ANN201
    got = kept_documents(raw(spark, d), curated(spark, d))
    return got.select("id", F.length("text").alias("chars"), "quality_score", "source")


@query(f"""WITH RECURSIVE {_ENDED} SELECT (SELECT count(*) FROM raw_docs) AS ingested, count_if(decision = 'keep')::BIGINT AS kept, count_if(decision = 'reject')::BIGINT AS rejected,
  (SELECT count(DISTINCT seq) FROM raw_docs) = count(*) AND count(DISTINCT seq) = count(*) AS conserved FROM ended""")
def c3_conservation(spark, d):  # noqa: ANN001, ANN201
    return conservation(curated(spark, d))


# --- aggregates ---------------------------------------------------------------------------------


@query("""SELECT count(*) AS ingested, count_if(lower(decision) = 'keep')::BIGINT AS kept, count_if(embedded_chars > 0)::BIGINT AS embed_calls,
  coalesce(sum(CASE WHEN embedded_chars > 0 THEN embedded_chars END), 0)::BIGINT AS embedded_chars, round(count_if(lower(decision) = 'keep') / count(*), 9) AS retention_rate,
  round(coalesce(sum(CASE WHEN embedded_chars > 0 THEN embedded_chars END), 0)::DOUBLE / 4 / 1e6 * 0.12, 9) AS est_cost FROM stage_results""")
def a1_a6_totals(spark, d):  # noqa: ANN001, ANN201
    x = metrics.totals(results(spark, d))
    return x.withColumn("retention_rate", F.round("retention_rate", 9)).withColumn("est_cost", F.round("est_cost", 9))


@query("SELECT nullif(stage, '') AS stage, count(*) AS rejects FROM stage_results WHERE lower(decision) = 'reject' GROUP BY 1")
def a2_rejected_by_stage(spark, d):  # noqa: ANN001, ANN201
    return metrics.rejected_by(results(spark, d), "stage")


@query("SELECT nullif(reason, '') AS reason, count(*) AS rejects FROM stage_results WHERE lower(decision) = 'reject' GROUP BY 1")
def a3_rejected_by_reason(spark, d):  # noqa: ANN001, ANN201
    return metrics.rejected_by(results(spark, d), "reason")


@query("""WITH g AS (SELECT stage, latency_ms FROM stage_results WHERE latency_ms IS NOT NULL AND NOT isnan(latency_ms) AND latency_ms >= 0),
  o AS (SELECT stage, latency_ms, row_number() OVER (PARTITION BY stage ORDER BY latency_ms) AS k, count(*) OVER (PARTITION BY stage) AS n FROM g)
  SELECT stage, max(n) AS rows, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(max(CASE WHEN k = n // 2 + 1 THEN latency_ms END), 6) AS upper_p50 FROM o GROUP BY 1""")
def a7_a8_latency(spark, d):  # noqa: ANN001, ANN201
    return metrics.latency(results(spark, d)).select("stage", "rows", F.round("p50", 6).alias("p50"), F.round("upper_p50", 6).alias("upper_p50"))


@query("""SELECT round(max(p), 6) AS p50 FROM (SELECT quantile_cont(latency_ms, 0.5) AS p FROM stage_results
  WHERE latency_ms IS NOT NULL AND NOT isnan(latency_ms) AND latency_ms >= 0 GROUP BY stage)""")
def a17_worst_p50(spark, d):  # noqa: ANN001, ANN201
    return metrics.worst_p50(results(spark, d)).select(F.round("p50", 6).alias("p50"))


@query("""WITH h AS (SELECT least(trunc(quality_score * 20)::BIGINT, 19) AS b, count(*) AS n FROM stage_results WHERE quality_score IS NOT NULL AND NOT isnan(quality_score) GROUP BY 1)
  SELECT round((r.range + 0.5::DOUBLE) / 20, 3) AS bin, coalesce(n, 0) AS count FROM range(20) r LEFT JOIN h ON h.b = r.range""")
def a11_quality_histogram(spark, d):  # noqa: ANN001, ANN201
    return metrics.quality_histogram(results(spark, d))


@query("""SELECT r.range AS score, coalesce(n, 0) AS count FROM range(1, 6) r
  LEFT JOIN (SELECT edu_score, count(*) AS n FROM judge_labels GROUP BY 1) h ON h.edu_score = r.range""")
def a12_score_histogram(spark, d):  # noqa: ANN001, ANN201
    return metrics.score_histogram(table(spark, d, "judge_labels"))


@query("""WITH s(step, stage) AS (VALUES (0, 'ingested'), (1, 'heuristic'), (2, 'quality'), (3, 'dedup')),
  l AS (SELECT stage, count(*) AS lost FROM stage_results WHERE lower(decision) = 'reject' GROUP BY 1)
  SELECT step, stage, ((SELECT count(*) FROM stage_results) - sum(coalesce(lost, 0)) OVER (ORDER BY step))::BIGINT AS survivors FROM s LEFT JOIN l USING (stage)""")
def a16_survivors(spark, d):  # noqa: ANN001, ANN201
    return metrics.survivors(results(spark, d))


@query("""WITH r AS (SELECT nullif(stage, '') AS stage, nullif(reason, '') AS reason FROM stage_results WHERE lower(decision) = 'reject'),
  g AS (SELECT stage, latency_ms FROM stage_results WHERE latency_ms IS NOT NULL AND NOT isnan(latency_ms) AND latency_ms >= 0)
  SELECT 'ingested' AS figure, '' AS key, count(*)::DOUBLE AS value FROM stage_results UNION ALL SELECT 'kept', '', count_if(lower(decision) = 'keep') FROM stage_results
  UNION ALL SELECT 'retention_rate', '', round(count_if(lower(decision) = 'keep') / count(*), 6) FROM stage_results
  UNION ALL SELECT 'rejected_by_stage', stage, count(*) FROM r WHERE stage IS NOT NULL GROUP BY 2 UNION ALL SELECT 'rejected_by_reason', reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'p50_ms', stage, round(quantile_cont(latency_ms, 0.5), 6) FROM g WHERE stage IS NOT NULL GROUP BY 2""")
def a_funnel_stats(spark, d):  # noqa: ANN001, ANN201
    x = metrics.funnel_stats(results(spark, d))

    def one(name: str) -> DataFrame:
        return x.select(F.lit(name).alias("figure"), F.lit("").alias("key"), F.round(F.col(name).cast("double"), 6).alias("value"))

    def each(name: str) -> DataFrame:
        return x.select(F.lit(name).alias("figure"), F.explode(name).alias("key", "value")).withColumn("value", F.round(F.col("value").cast("double"), 6))

    out = one("ingested").unionByName(one("kept")).unionByName(one("retention_rate"))
    return out.unionByName(each("rejected_by_stage")).unionByName(each("rejected_by_reason")).unionByName(each("p50_ms"))


@query("SELECT reason, count(*) AS rejects FROM stage_results WHERE lower(decision) = 'reject' AND reason <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def o2_top_reasons(spark, d):  # noqa: ANN001, ANN201
    return metrics.top_reasons(results(spark, d))


# --- evaluation ---------------------------------------------------------------------------------


def eval_documents(spark: SparkSession, d: str) -> DataFrame:
    """seq, doc_id, group, is_variant, emb, sig: judged documents and their variants in a fixed order."""
    src = table(spark, d, "judge_labels").where("length(text) > 0").groupBy("doc_id").agg(F.min("text").alias("text"))
    x = stored(inject.in_fixed_order(inject.with_variants(src, "doc_id", "text")), "variants")
    empty = spark.createDataFrame([], "key string, embedding array<float>")
    got, _ = embedded(x.withColumnRenamed("doc_id", "id"), "text", empty, dim=DIM)
    return stored(with_signature(got.withColumnRenamed("embedding", "emb")), "evaluated")


@query(f"""WITH {sql.variants()} SELECT doc_id, md5(t) AS text, grp AS "group", is_variant FROM variants""")
def u1_variants(spark, d):  # noqa: ANN001, ANN201
    src = table(spark, d, "judge_labels").where("length(text) > 0").groupBy("doc_id").agg(F.min("text").alias("text"))
    return inject.with_variants(src, "doc_id", "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"), "group", "is_variant")


@query("""WITH f AS (SELECT doc_id, min(recorded_at) AS t FROM stage_results GROUP BY 1) SELECT result_no, recorded_at > t AS is_repeat FROM stage_results JOIN f USING (doc_id)""")
def w1_seen_before(spark, d):  # noqa: ANN001, ANN201
    return sampling.first_seen(results(spark, d).select("result_no", "doc_id", "recorded_at"), "doc_id", "recorded_at").select("result_no", "is_repeat")


def _sweep_sql() -> str:
    each = [(t, f"r{round(t * 100)}") for t in evaluation.SWEEP]
    parts = ", ".join(sql.greedy("judged", False, t, name=n) for t, n in each)
    return f"WITH RECURSIVE {_JUDGED}, {parts} " + " UNION ALL ".join(f"SELECT {t}::DOUBLE AS threshold, * FROM ({sql.drops(n)})" for t, n in each)


def _rounded(x: DataFrame) -> DataFrame:
    return x.withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


@query(_sweep_sql())
def a14_threshold_sweep(spark, d):  # noqa: ANN001, ANN201
    return _rounded(evaluation.threshold_sweep(eval_documents(spark, d), "seq", "group", "emb"))


def _parts_sql() -> str:
    each = [(r, p, f"{r}{p}") for r in ("doc_id", "minhash") for p in evaluation.PARTS]
    dealt = "dealt AS MATERIALIZED (SELECT seq, e, sig, md5(doc_id) AS m_id, md5(unhex(" + sql.band() + ")) AS m_band FROM judged)"
    parts = ", ".join(sql.greedy("dealt", r == "minhash", 0.9, sql.md5_mod("m_band" if r == "minhash" else "m_id", p), n) for r, p, n in each)
    return f"WITH RECURSIVE {_JUDGED}, {dealt}, {parts} " + " UNION ALL ".join(f"SELECT {p}::INTEGER AS parts, '{r}' AS route, * FROM ({sql.drops(n)})" for r, p, n in each)


@query(_parts_sql())
def a21_recall_by_partitions(spark, d):  # noqa: ANN001, ANN201
    return _rounded(evaluation.recall_by_partitions(eval_documents(spark, d), "seq", "id", "group", "emb", "sig"))


@query(f"""WITH {_JUDGED}, u AS MATERIALIZED (SELECT seq, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM judged),
  near AS MATERIALIZED (SELECT a.seq, max(list_dot_product(a.e, b.e)) AS sim FROM u a JOIN u b ON b.seq < a.seq GROUP BY 1), cuts(n) AS (VALUES (50), (100), (200), (300), (0))
  SELECT n, round(quantile_cont(sim, 0.5), 5) AS p50, round(quantile_cont(sim, 0.95), 5) AS p95, round(quantile_cont(sim, 0.99), 5) AS p99, round(max(sim), 5) AS max, count_if(sim >= 0.9)::BIGINT AS collisions
  FROM cuts JOIN near ON n = 0 OR near.seq <= n GROUP BY 1""")
def a9_a10_nearest_prior(spark, d):  # noqa: ANN001, ANN201
    x = evaluation.nearest_prior_stats(eval_documents(spark, d), "seq", "emb")
    return x.select("n", *(F.round(c, 5).alias(c) for c in ("p50", "p95", "p99", "max")), "collisions")


@query(f"""WITH RECURSIVE {_JUDGED}, whole AS MATERIALIZED (SELECT * FROM judged WHERE NOT is_variant), {sql.greedy("whole", False, name="bare")}, {sql.greedy("whole", True, name="checked")}
  SELECT 'cosine' AS mode, count(*) AS drops FROM bare UNION ALL SELECT 'verified', count(*) FROM checked""")
def a22_false_drops(spark, d):  # noqa: ANN001, ANN201
    return evaluation.false_drops(eval_documents(spark, d).where("not is_variant"), "seq", "emb", "sig")


_RUN = "SELECT doc_id, lower(decision) AS decision, nullif(reason, '') AS reason, row_number() OVER (PARTITION BY doc_id ORDER BY result_no) AS k FROM stage_results WHERE run_no = "


@query(f"""WITH a AS (SELECT * FROM ({_RUN}2) WHERE k = 1), b AS (SELECT * FROM ({_RUN}1) WHERE k = 1)
  SELECT a.doc_id FROM a LEFT JOIN b ON a.doc_id = b.doc_id WHERE b.doc_id IS NULL OR a.decision IS DISTINCT FROM b.decision OR a.reason IS DISTINCT FROM b.reason ORDER BY 1 LIMIT 10""")
def j8_mismatches(spark, d):  # noqa: ANN001, ANN201
    r = results(spark, d).select("doc_id", "run_no", "result_no", F.lower("decision").alias("decision"), F.nullif("reason", F.lit("")).alias("reason"))
    one, two = (first_by(r.where(F.col("run_no") == k), "doc_id", "result_no") for k in (1, 2))
    return evaluation.mismatches(two, one, "doc_id", ["decision", "reason"])


# --- order, batches, samples, routes ------------------------------------------------------------


@query("SELECT result_no FROM (SELECT result_no, row_number() OVER (ORDER BY result_no) AS k FROM stage_results WHERE lower(decision) = 'reject') WHERE k % 10 = 0")
def w2_every_tenth_reject(spark, d):  # noqa: ANN001, ANN201
    return sampling.every_nth(results(spark, d).where(F.lower("decision") == "reject").select("result_no"), "result_no")


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS t, count(*) AS n FROM events GROUP BY 1), c AS (SELECT t, (sum(n) OVER (ORDER BY t))::BIGINT AS n FROM h),
  l AS (SELECT t, n FROM c ORDER BY t DESC LIMIT 61), x AS (SELECT t, greatest(0, (n - lag(n) OVER (ORDER BY t))::DOUBLE / (epoch(t) - epoch(lag(t) OVER (ORDER BY t)))) AS delta FROM l)
  SELECT t, round(delta, 9) AS delta FROM x WHERE delta IS NOT NULL""")
def w4_throughput(spark, d):  # noqa: ANN001, ANN201
    from pyspark.sql import Window

    h = table(spark, d, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("t")).agg(F.count("*").alias("n"))
    # a row per hour: few, whatever the number of events
    c = h.withColumn("n", F.sum("n").over(Window.orderBy("t")))
    return metrics.throughput(c, "t", "n").select(F.col("t").cast("timestamp_ntz").alias("t"), F.round("delta", 9).alias("delta"))


@query("SELECT seq, ((k - 1) // 96)::BIGINT AS batch, ((k - 1) % 96)::INTEGER AS place FROM (SELECT seq, row_number() OVER (ORDER BY seq) AS k FROM raw_docs)")
def w5_batches(spark, d):  # noqa: ANN001, ANN201
    return sampling.batches(raw(spark, d).select("seq"), "seq", DEFAULT.embed_batch_size).select("seq", "batch", "place")


@query("""WITH p AS (SELECT text, row_number() OVER (ORDER BY seq) - 1 AS k FROM raw_docs WHERE length(text) > 0)
  SELECT k // 8 AS batch, md5(string_agg('[' || (k % 8) || '] ' || left(text, 2000), chr(10) || chr(10) ORDER BY k)) AS prompt, count(*) AS docs FROM p GROUP BY 1""")
def t26_prompts(spark, d):  # noqa: ANN001, ANN201
    x = judge.prompts(raw(spark, d).where("length(text) > 0").select("seq", "id", "text"), "seq", "id", "text")
    return x.select("batch", F.md5(F.col("prompt").cast("binary")).alias("prompt"), F.size("ids").cast("bigint").alias("docs"))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place FROM documents")
def o6_shuffle(spark, d):  # noqa: ANN001, ANN201
    x = table(spark, d, "documents").select("doc_id", F.concat(sampling.hash_order("doc_id"), F.lit(" "), F.col("doc_id").cast("string")).alias("o"))
    return sampling.numbered(x, "o", "place").select("doc_id", "place")


@query("""SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER (PARTITION BY lang) * 0.75) THEN 'train' ELSE 'test' END AS part FROM documents""")
def o7_stratified_split(spark, d):  # noqa: ANN001, ANN201
    return sampling.stratified_split(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang").select("doc_id", "part")


@query(f"""WITH b AS (SELECT seq, text AS t FROM raw_docs WHERE length(text) > 0), {sql.signatures("b", "seq")} SELECT seq, {sql.md5_mod("m", 4)} AS part FROM (SELECT seq, md5(unhex({sql.band()})) AS m FROM signed)""")
def x1_band_routes(spark, d):  # noqa: ANN001, ANN201
    x = with_signature(raw(spark, d).where("length(text) > 0").select("seq", "text"))
    return routed(x, "seq", "sig", 4, by_band).select("seq", "part")


@query("""SELECT part, count(*) AS docs FROM (SELECT (((((('0x' || substr(m, 1, 8))::UBIGINT % 4 * 0 + ('0x' || substr(m, 9, 8))::UBIGINT) % 4 * 0 + ('0x' || substr(m, 17, 8))::UBIGINT) % 4 * 0
  + ('0x' || substr(m, 25, 8))::UBIGINT) % 4))::INTEGER AS part FROM (SELECT md5(id) AS m FROM raw_docs WHERE id IS NOT NULL)) GROUP BY 1""")
def x2_id_routes(spark, d):  # noqa: ANN001, ANN201
    x = routed(raw(spark, d).where("id is not null").select("id", F.lit(None).alias("sig")), "id", "sig", 4, by_id)
    return x.groupBy("part").agg(F.count("*").alias("docs"))


@query("""WITH n AS (SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS k, count(*) OVER () AS n FROM raw_docs) SELECT seq, (k // ((n + 3) // 4))::INTEGER AS part FROM n""")
def x3_contiguous_shards(spark, d):  # noqa: ANN001, ANN201
    return contiguous(raw(spark, d).select("seq"), "seq", 4).select("seq", "part")


# --- sinks, written and read again --------------------------------------------------------------


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT id, length(text) AS chars, 1.0::DOUBLE AS quality_score, source FROM raw_docs WHERE length(text) > 0")
def k2_kept_sink(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "kept")
    x = raw(spark, d).where("length(text) > 0").withColumn("quality_score", F.lit(1.0))
    for half in (0, 1):  # appended in two runs
        writers.kept(x.where(F.col("seq") % 2 == half), at, per_file=500)
    return spark.read.parquet(at).select("id", F.length("text").alias("chars"), "quality_score", "source")


@query("SELECT result_no FROM (SELECT result_no, row_number() OVER (ORDER BY result_no) AS k FROM stage_results WHERE lower(decision) = 'reject') WHERE k % 10 = 0")
def k3_reject_log(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "rejects")
    writers.reject_log(results(spark, d).select("result_no", "doc_id", "decision", "stage", "reason"), "result_no", at)
    return spark.read.schema("result_no bigint").json(at)


@query(f"""WITH b AS (SELECT seq, text AS t FROM raw_docs WHERE length(text) > 0), {sql.signatures("b", "seq")} SELECT r.id, length(r.text) AS chars, {sql.band()} AS key FROM signed JOIN raw_docs r USING (seq)""")
def k1_messages(spark, d):  # noqa: ANN001, ANN201
    x = with_signature(raw(spark, d).where("length(text) > 0").select("id", "text", "source", "meta"))
    m = writers.as_messages(x, "sig")
    back = m.select(F.hex("key").alias("key"), F.from_json("value", readers.RAW).alias("d"))
    return back.select("d.id", F.length("d.text").alias("chars"), "key")


@query("SELECT sha256(text) || ':256' AS key, min(octet_length(emb)) / 4 AS dim FROM doc_rows WHERE octet_length(emb) = 1024 AND text IS NOT NULL GROUP BY 1")
def k5_cache_put(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "cache")
    x = with_key(table(spark, d, "doc_rows").where("octet_length(emb) = 1024 and text is not null"), "text", DIM)
    writers.append_cache(first_by(x, "key", "id").withColumn("embedding", decode_f32("emb")), at)
    return spark.read.parquet(at).select("key", F.size("embedding").cast("double").alias("dim"))


@query("SELECT doc_id, edu_score, length(text) AS chars FROM judge_labels")
def k6_label_cache(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "labels")
    writers.label_cache(table(spark, d, "judge_labels"), at)
    return spark.read.schema(readers.LABEL).json(at).select("doc_id", "edu_score", F.length("text").alias("chars"))


@query("SELECT DISTINCT r.id, octet_length(c.emb)::INTEGER AS bytes FROM raw_docs r JOIN (SELECT sha256(text) AS k, emb FROM doc_rows WHERE octet_length(emb) = 1024 AND text IS NOT NULL) c ON sha256(left(r.text, 160)) = c.k")
def k10_bench_input(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "input")
    docs = with_key(raw(spark, d).select("id", T.first_chars("text", 160).alias("text")), "text", DIM)
    x = with_key(table(spark, d, "doc_rows").where("octet_length(emb) = 1024 and text is not null"), "text", DIM)
    writers.embedded_input(docs, first_by(x, "key", "id").withColumn("embedding", decode_f32("emb")), at)
    return spark.read.parquet(at).select("id", F.octet_length("emb").alias("bytes")).distinct()


# --- judge, reports -----------------------------------------------------------------------------


@query("SELECT doc_id, min(edu_score) AS edu_score FROM judge_labels WHERE edu_score BETWEEN 1 AND 5 AND doc_id IN (SELECT doc_id FROM judge_labels WHERE length(text) > 0) GROUP BY 1")
def u4_judged(spark, d):  # noqa: ANN001, ANN201
    labels = table(spark, d, "judge_labels")
    docs = labels.where("length(text) > 0").groupBy("doc_id").agg(F.min("text").alias("text"))
    asked = judge.from_labels(judge.prompts(docs.withColumn("o", F.col("doc_id")), "o", "doc_id", "text"), labels)
    return judge.scores(asked, docs).select("doc_id", "edu_score")


@query("SELECT CASE WHEN edu_score >= 4 THEN 1 ELSE 0 END AS y, count(*) AS rows FROM judge_labels WHERE edu_score BETWEEN 1 AND 5 AND edu_score <> 3 GROUP BY 1")
def a15_class_counts(spark, d):  # noqa: ANN001, ANN201
    return binarised(table(spark, d, "judge_labels")).groupBy("y").agg(F.count("*").alias("rows"))


@query("""WITH r AS (SELECT run_no, count(DISTINCT worker_id) AS workers, count(*) AS docs, count(*) / (sum(CASE WHEN latency_ms > 0 AND NOT isnan(latency_ms) THEN latency_ms END) / 1000) AS rate FROM stage_results GROUP BY 1)
  SELECT run_no, workers, docs, round(rate, 3) AS docs_per_sec, round(rate / (SELECT rate FROM r WHERE run_no = 1), 6) AS speedup FROM r ORDER BY workers, run_no""")
def a5_a20_o4_bench_rows(spark, d):  # noqa: ANN001, ANN201
    x = metrics.rates(results(spark, d), ["run_no"], "worker_id")
    got = evaluation.speedups(x, F.col("run_no") == 1)
    return got.select("run_no", "workers", "docs", F.round("docs_per_sec", 3).alias("docs_per_sec"), F.round("speedup", 6).alias("speedup")).orderBy("workers", "run_no")


@query(f"""WITH RECURSIVE {_JUDGED}, {sql.greedy("judged", False, 0.9, name="gone")}, r AS ({sql.drops("gone")}), m(measure, value, bar) AS (SELECT 'dedup_recall', recall, 0.90::DOUBLE FROM r UNION ALL SELECT 'dedup_precision', precision, 0.95::DOUBLE FROM r)
  SELECT measure, value, bar, value >= bar AS passed FROM m""")
def a13_u6_gates(spark, d):  # noqa: ANN001, ANN201
    r = evaluation.threshold_sweep(eval_documents(spark, d), "seq", "group", "emb", (0.9,)).first()
    report = {k: round(float(r[k.removeprefix("dedup_")]), 6) for k in ("dedup_recall", "dedup_precision")}
    passed = evaluation.gates(report)
    return spark.createDataFrame([(k, v, evaluation.GATES[k], passed[k]) for k, v in report.items()], "measure string, value double, bar double, passed boolean")


@query("SELECT vec_id, NULL::DOUBLE AS quality_score, false AS low_quality FROM embeddings")
def q3_without_model(spark, d):  # noqa: ANN001, ANN201
    return with_quality(table(spark, d, "embeddings"), "embedding", None).select("vec_id", "quality_score", "low_quality")


def _permutation_sql() -> str:
    import numpy as np

    rng = np.random.RandomState(42)
    a = rng.randint(1, 2**31, 128, dtype=np.int64)
    rows = ", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(zip(a, rng.randint(0, 2**31, 128, dtype=np.int64), strict=True)))
    return f"SELECT k::INTEGER AS k, a::BIGINT AS a, b::BIGINT AS b FROM (VALUES {rows}) t(k, a, b)"


@query(_permutation_sql())
def t14_permutations(spark, d):  # noqa: ANN001, ANN201
    p = from_json(to_json(permutations()))
    return spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(zip(p.a, p.b, strict=True))], "k int, a bigint, b bigint")


@query("""WITH a AS (SELECT DISTINCT doc_id, lower(decision) AS decision FROM stage_results WHERE run_no = 2), b AS (SELECT DISTINCT doc_id, lower(decision) AS decision FROM stage_results WHERE run_no = 1 AND doc_id IN (SELECT doc_id FROM a))
  SELECT 'run' AS compared, NOT EXISTS ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)) AS same UNION ALL SELECT 'itself', true""")
def u_3_same_decisions(spark, d):  # noqa: ANN001, ANN201
    r = results(spark, d).select("doc_id", "run_no", F.lower("decision").alias("decision"))
    two = r.where("run_no = 2").drop("run_no").distinct()
    one = r.where("run_no = 1").drop("run_no").distinct().join(two.select("doc_id").distinct(), "doc_id", "left_semi")
    return spark.createDataFrame([("run", evaluation.same_decisions(two, one)), ("itself", evaluation.same_decisions(two, two))], "compared string, same boolean")


# --- streams, run once over what is there -------------------------------------------------------


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    # a pattern that only this name matches: a stream takes it for a file as well as for a folder of files
    return readers.file_documents(spark, f"{d}/{name}.parque[t]", table(spark, d, name).schema)


@query("SELECT stage, reason, count(*) AS rows FROM stage_results GROUP BY 1, 2")
def x8_running_totals(spark, d):  # noqa: ANN001, ANN201
    name = f"totals_{uuid.uuid4().hex}"
    curation.memory_totals(_stream(spark, d, "stage_results"), name, None).awaitTermination()
    return spark.table(name)


@query("SELECT id, text, quality_score, source FROM clean_docs")
def x5_kept_stream(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "kept-stream")
    x = _stream(spark, d, "clean_docs").withColumn("decision", F.lit("keep"))
    for _ in (1, 2):  # a second start reads nothing again: the offsets are committed
        curation.write_kept(x, at, f"{at}-log").awaitTermination()
    return spark.read.parquet(at)


@query(f"""WITH RECURSIVE {_READY}, dealt AS MATERIALIZED (SELECT seq, e, sig, {sql.md5_mod("m", 4)} AS part FROM (SELECT *, md5(unhex({sql.band()})) AS m FROM ready)), {sql.greedy("dealt", part="part")}
  SELECT seq, part, i IS NOT NULL AS duplicate FROM dealt LEFT JOIN rejected ON i = seq""")
def x4_stream_dedup(spark, d):  # noqa: ANN001, ANN201
    at = _fresh(spark, "arrivals")
    routed(embedded_arrivals(spark, d), "id", "sig", 4).select("part", "seq", "id", "emb", "sig").coalesce(1).write.parquet(at)
    out = _fresh(spark, "deduped")
    got = curation.dedup(spark.readStream.schema("part int, seq bigint, id string, emb array<float>, sig array<bigint>").parquet(at))
    got.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("seq", "part", "duplicate")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["queries", "oracle_sql", "rule_model", "permutations"]
