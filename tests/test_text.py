from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from grainflow.functions import text as T
from grainflow.functions.langid import by_profiles, fit_profiles, language
from grainflow.functions.minhash import band_key, from_json, jaccard_estimate, md5_route, permutations, signature, text_signature, to_json
from grainflow.functions.vectors import cosine, decode_f32, encode_f32, is_vector
from grainflow.operators.heuristics import with_reason

SENTENCE = "This is a sufficiently long and clean English paragraph that was written for the test. "
GOLD = "the quick brown fox jumps over the lazy dog and runs away fast"


def frame(spark, *texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "seq bigint, text string")


def test_lines_as_python_has_them(spark):
    cases = ["", "a", "a\n", "a\r\nb", "\n\n", "a\x0bb\x1cc d\x85e", "a\n\nb\r"]
    got = frame(spark, *cases).select("seq", T.lines("text").alias("l")).orderBy("seq").collect()
    assert [r["l"] for r in got] == [c.splitlines() or [c] for c in cases]


def test_reasons_and_their_order(spark):
    good = SENTENCE * 5
    cases = {
        "short": "too_short",
        None: "too_short",
        "": "too_short",
        good: None,
        "x" * 199: "too_short",
        "word " * 20_001: "too_long",
        ("abcdefghi the and of " * 9)[:180] + "#" * 20: None,
        ("abcdefghi the and of " * 9)[:180] + "#" * 21: "symbol_ratio",
        "short line\n" * 40: "short_lines",
        good + " ALL RIGHTS reserved": "boilerplate",
        good + " Lorem Ipsum": "boilerplate",
        "der die das und ist ein nicht auch von mit " * 8: "wrong_language",
        "!" * 50: "too_short",
        "lorem ipsum\n" * 30: "short_lines",
    }
    got = {r["text"]: r["reason"] for r in with_reason(frame(spark, *cases), provider=by_profiles(taught(spark))).collect()}
    assert got == cases


def test_symbol_ratio_counts_characters(spark):
    r = frame(spark, "ab# é", "", None).select(T.symbol_ratio("text").alias("s")).collect()
    assert [x["s"] for x in r] == [0.2, 0.0, None]


def test_truncations_and_rewrites(spark):
    t = "One here. Two there! Three?"
    r = frame(spark, t).select(T.first_share("text").alias("a"), T.rotated("text").alias("b"), T.wrapped("text").alias("c"), T.first_chars("text", 3).alias("d")).first()
    assert r["a"] == t[: int(len(t) * 0.7)]
    assert r["b"] == "Two there! Three? One here."
    assert r["c"] == T.WRAP_HEAD + t + T.WRAP_FOOT
    assert r["d"] == "One"


def test_signature_is_the_known_one(spark):
    df = frame(spark, GOLD, "", "a b c", None)
    got = df.select("seq", signature(T.shingle_crcs("text")).alias("s"), text_signature("text").alias("t")).orderBy("seq").collect()
    assert got[0]["s"][:6] == [50383417, 776864844, 1395673139, 77063379, 823443672, 2500240318]
    assert set(got[1]["s"]) == set(got[3]["s"]) == {4294967295}
    assert all(r["s"] == r["t"] for r in got)
    crc = zlib.crc32(b"a b c")
    p = permutations()
    assert got[2]["s"] == [(a * crc + b) % 4294967291 for a, b in zip(p.a, p.b, strict=True)]
    assert from_json(to_json(p)) == p


def test_variants_stay_similar(spark):
    t = " ".join(f"Sentence {k} tells of thing {k * 7} and more about place {k * 3}." for k in range(30))
    df = frame(spark, t).select(*(text_signature(x).alias(n) for n, x in (("s", "text"), ("a", T.first_share("text")), ("b", T.rotated("text")), ("c", T.wrapped("text")))))
    r = df.select(*(jaccard_estimate("s", x).alias(x) for x in "sabc")).first()
    assert r["s"] == 1.0
    assert min(r["a"], r["b"], r["c"]) >= 0.5


def test_routes(spark):
    import hashlib

    df = frame(spark, GOLD, "other words in a text here").withColumn("s", text_signature("text"))
    for r in df.select("s", band_key("s", 2).alias("k"), md5_route(band_key("s", 2), 7).alias("p")).collect():
        key = b"".join(int(v).to_bytes(8, "little") for v in r["s"][:2])
        assert bytes(r["k"]) == key
        assert r["p"] == int(hashlib.md5(key).hexdigest(), 16) % 7


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, float("nan")]), (5, [1.0])], "id int, v array<float>")
    x = df.withColumn("b", encode_f32("v")).withColumn("w", decode_f32("b")).withColumn("ok", is_vector("v", 2)).withColumn("c", cosine("v", F.array(F.lit(1.0), F.lit(1.0))))
    got = {r["id"]: r for r in x.collect()}
    assert got[1]["w"] == [1.0, 0.0] and got[3]["w"] is None
    assert [got[k]["ok"] for k in range(1, 6)] == [True, False, False, False, False]
    assert abs(got[1]["c"] - 0.5**0.5) < 1e-9 and got[2]["c"] is None and got[5]["c"] is None
    assert spark.createDataFrame([(b"abc",)], "b binary").select(decode_f32("b").alias("v")).first()["v"] is None


TAUGHT = {
    "en": ["the cat and the dog were in the house", "this is what they would have done with it", "there was nothing else that she could say"],
    "de": ["der hund und die katze waren nicht im haus", "das ist ein schöner tag für einen spaziergang", "wir haben gestern noch lange darüber gesprochen"],
    "fi": ["kissa ja koira olivat talossa koko päivän", "tämä on kaunis päivä kävelylle metsässä", "emme ole vielä puhuneet siitä asiasta"],
    "ru": ["кошка и собака были в доме весь день", "это было очень давно и никто не помнит", "мы ещё не говорили об этом деле"],
}


def taught(spark):
    rows = [(t, k.upper() if j else f" {k} ") for k, ts in TAUGHT.items() for j, t in enumerate(ts)] + [("xx yy", "und"), ("zz", None), (None, "en"), ("", "de")]
    return fit_profiles(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")


def test_languages_are_learnt_from_labels(spark):
    p = taught(spark)
    assert p.langs == ("de", "en", "fi", "ru")
    cases = {"the dog could have been there": "en", "die katze und der hund sind nicht hier": "de", "koira on metsässä": "fi", "собака не помнит": "ru", "12 34 !": "und", "": "und", None: "und"}
    got = {r["text"]: r["l"] for r in frame(spark, *cases).select("text", language("text", by_profiles(p)).alias("l")).collect()}
    assert got == cases
    assert fit_profiles(spark.createDataFrame([], "text string, lang string"), "text", "lang") is None


def test_all_labelled_texts_and_languages_teach(spark, monkeypatch):
    from grainflow.functions import langid

    few = [(chr(0x4E00 + k) * 9, f"l{k}") for k in range(70)] + [("12 34", "digits")]
    many = spark.range(50_010).selectExpr("'the cat sat' AS text", "'en' AS lang")
    p = fit_profiles(spark.createDataFrame(few, "text string, lang string").unionByName(many), "text", "lang")
    assert p.langs == tuple(sorted(["en", *(k for _, k in few[:70])]))  # what has no letters teaches nothing
    assert [k for k, _ in p.classify([t for t, _ in few[:70]])] == [k for _, k in few[:70]]
    monkeypatch.setattr(langid, "CHARS", 5)
    assert (fit_profiles(spark.createDataFrame(few, "text string, lang string"), "text", "lang").table == p.table[:, 1:]).all()


def test_mean_line_length_counts_as_splitting_does(spark):
    cases = ["", "a", "ab\n", "a\r\nbcd", "\n\n", "a\x0bb\x1cc d\x85e", "a\n\nb\r", "\r\n", "x\u2028yz\n\r"]
    got = frame(spark, *cases).select("text", T.mean_line_length("text").alias("m")).collect()
    for r in got:
        ls = r["text"].splitlines() or [""]
        assert r["m"] == sum(map(len, ls)) / len(ls)
