"""SQL of the training-data queries that SQL can express, by plain comparison of everything with everything."""

from __future__ import annotations

from ._prose import STRIP

# fixed values: line ends and white space, as DuckDB's regular expressions write them
_LE = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BITS = "('0x' || substr(h, 8*i+7, 2) || substr(h, 8*i+5, 2) || substr(h, 8*i+3, 2) || substr(h, 8*i+1, 2))::UBIGINT"
_FLOAT = """CASE WHEN (u & 2147483647) < 8388608 THEN (u & 8388607)::DOUBLE * pow(2, -149) ELSE (1 + (u & 8388607)::DOUBLE / 8388608) * pow(2, ((u >> 23) & 255)::INTEGER - 127) END
  * CASE WHEN u >= 2147483648 THEN -1 ELSE 1 END"""


def shingled(source: str) -> str:
    """grams: cls and s, the distinct five-word sequences of each distinct text of source (k, t) of 20 words or more;
    classes: k and cls, a number per set of sequences; sizes: cls and n."""
    return rf"""
  texts AS (SELECT t, row_number() OVER (ORDER BY t) AS no FROM (SELECT DISTINCT t FROM {source} WHERE t IS NOT NULL)),
  word_of AS (SELECT no, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM (SELECT no, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') AS w FROM texts) WHERE len(w) >= 20),
  five AS (SELECT no, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s FROM word_of WINDOW o AS (PARTITION BY no ORDER BY i)),
  text_grams AS MATERIALIZED (SELECT DISTINCT no, s FROM five WHERE s IS NOT NULL),
  sets AS (SELECT no, md5(string_agg(s, '|' ORDER BY s)) AS m FROM text_grams GROUP BY 1),
  same AS MATERIALIZED (SELECT no, min(no) OVER (PARTITION BY m) AS cls FROM sets),
  classes AS MATERIALIZED (SELECT k, cls FROM {source} JOIN texts USING (t) JOIN same USING (no) WHERE k IS NOT NULL),
  grams AS MATERIALIZED (SELECT cls, s FROM text_grams JOIN same USING (no) WHERE no = cls),
  sizes AS (SELECT cls, count(*) AS n FROM grams GROUP BY 1)"""


def linked(threshold: float) -> str:
    """links: a, b, the classes a < b that overlap by the threshold or more."""
    return f"""
  links AS MATERIALIZED (SELECT a, b FROM (SELECT x.cls AS a, y.cls AS b, count(*) AS shared FROM grams x JOIN grams y ON x.s = y.s AND x.cls < y.cls GROUP BY 1, 2)
    JOIN sizes p ON p.cls = a JOIN sizes q ON q.cls = b WHERE shared >= {threshold} * (p.n + q.n - shared))"""


_VECTORS = f"""
  hexed AS (SELECT DISTINCT id, hex(emb) AS h FROM doc_rows WHERE octet_length(emb) = 1024 AND id IS NOT NULL),
  bits AS (SELECT id, list_transform(range(0, 256), lambda i: {_BITS}) AS us FROM hexed),
  good AS (SELECT id, list_transform(us, lambda u: {_FLOAT}) AS e FROM bits WHERE len(list_filter(us, lambda u: ((u >> 23) & 255) = 255)) = 0 AND len(list_filter(us, lambda u: (u & 2147483647) <> 0)) > 0),
  units AS MATERIALIZED (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM good),
  near AS MATERIALIZED (SELECT a.id, b.id AS neighbour, list_dot_product(a.e, b.e) AS c FROM units a JOIN units b ON a.id <> b.id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(c, 6) DESC, neighbour) AS k FROM near)"""

_STRIP = STRIP.replace("'", "''")
_TAG = r"<[^<>\n]{0,400}>"
_WORDS = rf"""
  plain AS (SELECT seq, regexp_replace(text, '{_LE}', chr(10), 'g') AS t FROM raw_docs),
  bare AS (SELECT seq, t, lower(regexp_replace(regexp_replace(t, '{_TAG}', ' ', 'g'), '&#?[\p{{L}}\p{{N}}_]{{1,10}};', ' ', 'g')) AS b,
    string_split(regexp_replace(t, '{_TAG}', '', 'g'), chr(10)) AS ls FROM plain WHERE length(regexp_replace(t, '{_WS}', '', 'g')) > 0),
  cut AS (SELECT seq, t, list_filter(list_transform(string_split_regex(replace(replace(b, '’', chr(39)), chr(39), chr(39) || ' '), '{_WS}+'), lambda x: trim(x, '{_STRIP}')), lambda x: x <> '') AS w,
    list_filter(list_transform(ls, lambda x: regexp_replace(x, '{_WS}+$', '')), lambda x: x <> '') AS ls,
    list_sum(list_transform(list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_WS}', '', 'g') <> ''), lambda x: length(replace(x, ' ', '')))) AS chars FROM bare),
  counted AS (SELECT seq, len(w)::BIGINT AS words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::DOUBLE / greatest(1, len(w)) AS mean_word_length,
    length(regexp_replace(t, '[\p{{L}}\p{{N}}]|{_WS}', '', 'g'))::DOUBLE / chars AS symbol_ratio,
    len(list_filter(ls, lambda x: contains('.!?…:;"”’»)' || chr(39), right(x, 1))))::DOUBLE / greatest(1, len(ls)) AS line_end_share FROM cut)"""

SQL = {
    "p2_found": f"""WITH source AS (SELECT DISTINCT id AS k, text AS t FROM raw_docs), {shingled("source")}, {linked(0.5)},
  pairs AS (SELECT a, b FROM links UNION ALL SELECT DISTINCT cls, cls FROM classes)
  SELECT DISTINCT least(x.k, y.k) AS id_a, greatest(x.k, y.k) AS id_b FROM pairs JOIN classes x ON x.cls = a JOIN classes y ON y.cls = b WHERE x.k <> y.k""",
    "p2_classes": f"""WITH RECURSIVE source AS (SELECT DISTINCT id AS k, text AS t FROM raw_docs), {shingled("source")}, {linked(0.8)},
  named AS MATERIALIZED (SELECT cls, min(k) AS rep, count(DISTINCT k) AS copies FROM classes GROUP BY 1),
  edges AS MATERIALIZED (SELECT x.rep AS a, y.rep AS b FROM links JOIN named x ON x.cls = a JOIN named y ON y.cls = b UNION SELECT y.rep, x.rep FROM links JOIN named x ON x.cls = a JOIN named y ON y.cls = b),
  reached AS (SELECT rep AS a, rep AS b FROM named UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b),
  roots AS (SELECT a, min(b) AS grp FROM reached GROUP BY 1), degree AS (SELECT a, count(*) AS links FROM edges GROUP BY 1)
  SELECT DISTINCT k AS id, rep AS cls, grp, copies, coalesce(links, 0) AS links FROM classes JOIN named USING (cls) JOIN roots ON roots.a = rep LEFT JOIN degree ON degree.a = rep""",
    "p3_found": f"""WITH RECURSIVE source AS (SELECT 'b' || seq AS k, text AS t FROM batch_docs UNION ALL SELECT 'h' || id, text FROM clean_docs), {shingled("source")}, {linked(0.5)},
  row_of AS MATERIALIZED (SELECT seq, cls, row_number() OVER (ORDER BY batch_no, seq) AS place FROM batch_docs JOIN classes ON k = 'b' || seq),
  old AS (SELECT DISTINCT cls FROM classes WHERE k[1] = 'h'), pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links UNION ALL SELECT DISTINCT cls, cls FROM classes),
  known AS (SELECT DISTINCT a AS cls FROM pairs JOIN old ON old.cls = b), fresh AS MATERIALIZED (SELECT * FROM row_of WHERE cls NOT IN (SELECT cls FROM known)),
  earlier AS MATERIALIZED (SELECT x.place, x.seq, list(y.place) AS before FROM fresh x JOIN pairs ON a = x.cls JOIN fresh y ON y.cls = b AND y.place < x.place GROUP BY 1, 2),
  steps AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY place) AS k FROM earlier),
  walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone, NULL::BIGINT AS seq UNION ALL
    SELECT k + 1, CASE WHEN hit THEN list_append(gone, place) ELSE gone END, CASE WHEN hit THEN sq END FROM (SELECT w.k, w.gone, s.place, s.seq AS sq, len(list_filter(s.before, lambda x: NOT list_contains(w.gone, x))) > 0 AS hit FROM walk w JOIN steps s ON s.k = w.k + 1))
  SELECT seq FROM row_of WHERE cls IN (SELECT cls FROM known) UNION SELECT seq FROM walk WHERE seq IS NOT NULL""",
    "p4_counts": f"""WITH {_WORDS} SELECT seq, words, round(mean_word_length, 9) AS mean_word_length, round(symbol_ratio, 9) AS symbol_ratio, round(line_end_share, 9) AS line_end_share FROM raw_docs LEFT JOIN counted USING (seq)""",
    "p5_found": f"""WITH {_VECTORS} SELECT DISTINCT least(id, neighbour) AS id_a, greatest(id, neighbour) AS id_b FROM ranked WHERE k <= 5 AND c >= 0.7""",
}
SQL["p3_batches"] = f"SELECT batch_no, seq FROM ({SQL['p3_found']}) JOIN batch_docs USING (seq)"
