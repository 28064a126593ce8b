"""SQL that the equivalents of several queries share: pieces of a WITH clause, each a CTE or several."""

from __future__ import annotations

from ..functions.langid import BUCKETS, UNSEEN
from ..functions.minhash import EMPTY, PRIME, permutations
from ..operators.heuristics import BOILERPLATE

# fixed values: white space and line ends, as DuckDB's regular expressions write them
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LE = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
TEXT = "coalesce(text, '')"
SYMBOLS = rf"length(regexp_replace(t, '[\p{{L}}\p{{N}}]|{WS}', '', 'g'))"
LINES = "(CASE WHEN len(l) > 1 AND l[len(l)] = '' THEN l[1:len(l)-1] ELSE l END)"
#: what DuckDB calls a vector of little-endian 32-bit floats: u, the 32 bits of each, from h, the hex digits
_BITS = "('0x' || substr(h, 8*i+7, 2) || substr(h, 8*i+5, 2) || substr(h, 8*i+3, 2) || substr(h, 8*i+1, 2))::UBIGINT"
_FLOAT = """CASE WHEN (u & 2147483647) < 8388608 THEN (u & 8388607)::DOUBLE * pow(2, -149) ELSE (1 + (u & 8388607)::DOUBLE / 8388608) * pow(2, ((u >> 23) & 255)::INTEGER - 127) END
  * CASE WHEN u >= 2147483648 THEN -1 ELSE 1 END"""


def rules() -> str:
    """ruled: seq, id, t and a column per native rule of raw_docs."""
    phrases = " OR ".join(f"contains(lower(t), '{b}')" for b in BOILERPLATE)
    return f"""
  base AS (SELECT seq, id, {TEXT} AS t, string_split_regex({TEXT}, '{LE}') AS l FROM raw_docs),
  measured AS (SELECT seq, id, t, length(t) AS n, {SYMBOLS} AS symbols, {LINES} AS ls FROM base),
  ruled AS (SELECT seq, id, t,
    n < 200 AS too_short, n > 100000 AS too_long,
    CASE WHEN n = 0 THEN false ELSE symbols::DOUBLE / n > 0.10 END AS symbol_ratio,
    list_sum(list_transform(ls, lambda x: length(x)))::DOUBLE / len(ls) < 20 AS short_lines,
    {phrases} AS boilerplate FROM measured)"""


def _trigrams(name: str, source: str, keep: str) -> str:
    """name: keep and b, a row per trigram of t of source."""
    return f"""
  {name}_c AS (SELECT {keep}, unnest(c) AS u, generate_subscripts(c, 1) AS i FROM (SELECT {keep}, string_split(regexp_replace(' ' || lower(t) || ' ', '[^\\p{{L}}]+', ' ', 'g'), '') AS c FROM {source})),
  {name}_l AS (SELECT {keep}, unicode(u)::UBIGINT AS c0, lead(unicode(u)::UBIGINT, 1) OVER w AS c1, lead(unicode(u)::UBIGINT, 2) OVER w AS c2 FROM {name}_c WINDOW w AS (PARTITION BY {keep} ORDER BY i)),
  {name} AS (SELECT {keep}, (((c0 * 961 + c1 * 31 + c2) * 2654435761) & 4294967295) >> 16 AS b FROM {name}_l WHERE c2 IS NOT NULL)"""


def languages(source: str, key: str = "seq") -> str:
    """told: key and lang of the rows (key, t) of source, by naive Bayes over character trigrams that the
    labelled documents teach."""
    return f"""
  taught AS (SELECT doc_id, text AS t, lower(trim(lang)) AS lang FROM documents WHERE length(text) > 0 AND lower(trim(lang)) NOT IN ('', 'und')),
  {_trigrams("taught_b", "taught", "lang, doc_id")},
  seen AS (SELECT lang, b, count(*)::DOUBLE AS n FROM taught_b GROUP BY 1, 2),
  size_of AS (SELECT lang, sum(n) AS total FROM seen GROUP BY 1),
  {_trigrams("asked_b", source, key)},
  asked_n AS (SELECT {key}, b, count(*)::DOUBLE AS n FROM asked_b GROUP BY 1, 2),
  told_s AS (SELECT {key}, z.lang, sum(a.n * ln((coalesce(s.n, 0) + {UNSEEN}) / (z.total + {UNSEEN * BUCKETS}))) AS score
    FROM asked_n a CROSS JOIN size_of z LEFT JOIN seen s ON s.b = a.b AND s.lang = z.lang GROUP BY 1, 2),
  told AS (SELECT {key}, max_by(lang, score) AS lang FROM told_s GROUP BY 1)"""


def reasoned() -> str:
    """reasoned: seq, id, t, reason of raw_docs."""
    first = "CASE WHEN too_short THEN 'too_short' WHEN too_long THEN 'too_long' WHEN symbol_ratio THEN 'symbol_ratio' WHEN short_lines THEN 'short_lines' WHEN boilerplate THEN 'boilerplate' END"
    return f"""{rules()},
  passed AS (SELECT seq, t FROM ruled WHERE {first} IS NULL),
  {languages("passed")},
  reasoned AS (SELECT seq, id, t, coalesce({first}, CASE WHEN coalesce(lang, 'und') <> 'en' THEN 'wrong_language' END) AS reason FROM ruled LEFT JOIN told USING (seq))"""


def _crc_table() -> list[int]:
    """The table of CRC-32, by its rule."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        out.append(n)
    return out


def crcs(name: str, source: str) -> str:
    """name: s and crc, the CRC-32 of each distinct s of source."""
    table = ",".join(map(str, _crc_table()))
    return f"""
  {name} AS (SELECT s, xor(list_reduce(list_transform(range(0, strlen(s)), lambda i: ('0x' || substr(h, 2*i+1, 2))::UINTEGER),
    lambda c, x: xor(list_extract([{table}]::UINTEGER[], (xor(c, x) & 255)::BIGINT + 1), c >> 8), 4294967295::UINTEGER), 4294967295::UINTEGER) AS crc
    FROM (SELECT DISTINCT s, hex(encode(s)) AS h FROM {source}))"""


def shingles(source: str, key: str) -> str:
    """grams: key and s, the distinct sequences of five words of t; gram_crc: s, crc."""
    return f"""
  worded AS (SELECT {key}, list_filter(string_split_regex(lower(t), '{WS}+'), lambda x: x <> '') AS w FROM {source}),
  word_at AS (SELECT {key}, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM worded),
  five AS (SELECT {key}, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s FROM word_at WINDOW o AS (PARTITION BY {key} ORDER BY i)),
  grams AS (SELECT DISTINCT {key}, s FROM five WHERE s IS NOT NULL UNION SELECT {key}, array_to_string(w, ' ') FROM worded WHERE len(w) BETWEEN 1 AND 4),
  {crcs("gram_crc", "grams")}"""


def signatures(source: str, key: str) -> str:
    """signed: key and sig, the 128 minima of the rows (key, t) of source."""
    p = permutations()
    mins = ", ".join(f"min(({a}::UBIGINT * crc + {b}) % {PRIME})" for a, b in zip(p.a, p.b, strict=True))
    return f"""{shingles(source, key)},
  minima AS (SELECT {key}, list_value({mins})::BIGINT[] AS sig FROM grams JOIN gram_crc USING (s) GROUP BY 1),
  signed AS MATERIALIZED (SELECT {key}, coalesce(sig, list_resize([]::BIGINT[], {len(p.a)}, {EMPTY})) AS sig FROM {source} LEFT JOIN minima USING ({key}))"""


def band(rows: int = 1) -> str:
    """The hex digits of the first minima of sig, eight little-endian bytes each."""
    one = [f"printf('%02X%02X%02X%02X00000000', sig[{k}] & 255, (sig[{k}] >> 8) & 255, (sig[{k}] >> 16) & 255, (sig[{k}] >> 24) & 255)" for k in range(1, rows + 1)]
    return " || ".join(one)


def md5_mod(digest: str, parts: int) -> str:
    """The 128-bit number of a hex digest modulo parts."""
    out = "0"
    for k in range(4):
        out = f"(({out}) * {(1 << 32) % parts} + ('0x' || substr({digest}, {8 * k + 1}, 8))::UBIGINT) % {parts}"
    return f"({out})::INTEGER"


def same_minima(x: str, y: str) -> str:
    return f"len(list_filter(list_zip({x}, {y}), lambda z: z[1] = z[2]))::DOUBLE / len({x})"


def vectors(dim: int) -> str:
    """vecs: id and e, the usable vector of each id of doc_rows (the least, if there are several)."""
    floats = f"list_transform(list_transform(range(0, {dim}), lambda i: {_BITS}), lambda u: {_FLOAT})"
    bits = f"list_transform(range(0, {dim}), lambda i: {_BITS})"
    return f"""
  hexed AS (SELECT id, hex(emb) AS h FROM doc_rows WHERE octet_length(emb) = {4 * dim}),
  bits AS (SELECT id, h, {bits} AS us FROM hexed),
  good AS (SELECT id, h FROM bits WHERE len(list_filter(us, lambda u: ((u >> 23) & 255) = 255)) = 0 AND len(list_filter(us, lambda u: (u & 2147483647) <> 0)) > 0),
  vecs AS MATERIALIZED (SELECT id, min({floats}) AS e FROM good WHERE id IS NOT NULL GROUP BY 1)"""


def hashed_vectors(source: str, key: str, dim: int) -> str:
    """embedded: key and e, the signed hashes of the words and word pairs of t, as 32-bit unit vectors."""
    return f"""
  e_words AS (SELECT {key}, list_filter(string_split_regex(lower(t), '{WS}+'), lambda x: x <> '') AS w FROM {source}),
  e_at AS (SELECT {key}, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM e_words),
  e_two AS (SELECT {key}, x, x || ' ' || lead(x) OVER (PARTITION BY {key} ORDER BY i) AS y FROM e_at),
  e_grams AS (SELECT {key}, s, count(*) AS n FROM (SELECT {key}, x AS s FROM e_two UNION ALL SELECT {key}, y FROM e_two WHERE y IS NOT NULL) GROUP BY 1, 2),
  {crcs("e_crc", "e_grams")},
  e_sums AS (SELECT {key}, crc % {dim} AS d, sum(CASE WHEN crc >= 2147483648 THEN n ELSE -n END)::DOUBLE AS v FROM e_grams JOIN e_crc USING (s) GROUP BY 1, 2),
  e_maps AS (SELECT {key}, map_from_entries(list((d, v))) AS m, sqrt(sum(v * v))::FLOAT AS norm FROM e_sums GROUP BY 1),
  embedded AS MATERIALIZED (SELECT {key}, list_transform(range(0, {dim}), lambda d: (coalesce(m[d], 0)::FLOAT / greatest(norm, 1e-9::FLOAT))::DOUBLE) AS e FROM e_maps WHERE norm > 0)"""


def greedy(source: str, verify: bool = True, threshold: float = 0.9, part: str = "0", name: str = "rejected") -> str:
    """rejected: i, j, sim. Documents of source (seq, e, and sig if verified) in the order of seq: a document
    is rejected by its nearest earlier document that is not. A step for each document with a close one."""
    unit = "list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))"
    kill = f"coalesce({same_minima('a.sig', 'b.sig')} >= 0.5, true)" if verify else "true"
    sig = ", sig" if verify else ""
    return f"""
  {name}_u AS MATERIALIZED (SELECT seq, {part} AS part, {unit} AS e{sig} FROM {source} WHERE list_dot_product(e, e) > 0),
  {name}_p AS MATERIALIZED (SELECT a.seq AS i, b.seq AS j, round(list_dot_product(a.e, b.e), 12) AS sim, {kill} AS kill FROM {name}_u a JOIN {name}_u b ON b.seq < a.seq AND a.part = b.part WHERE list_dot_product(a.e, b.e) >= {threshold}),
  {name}_n AS MATERIALIZED (SELECT i, list((j, kill, sim) ORDER BY sim DESC, j) AS near, row_number() OVER (ORDER BY i) AS k FROM {name}_p GROUP BY i HAVING bool_or(kill)),
  {name}_r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone, NULL::BIGINT AS i, NULL::BIGINT AS j, NULL::DOUBLE AS sim
    UNION ALL SELECT k + 1, CASE WHEN hit[2] THEN list_append(gone, i) ELSE gone END, CASE WHEN hit[2] THEN i END, hit[1], hit[3]
    FROM (SELECT r.k, r.gone, n.i, list_filter(n.near, lambda x: NOT list_contains(r.gone, x[1]))[1] AS hit FROM {name}_r r JOIN {name}_n n ON n.k = r.k + 1)),
  {name} AS (SELECT i, j, sim FROM {name}_r WHERE i IS NOT NULL)"""


def variants() -> str:
    """variants: doc_id, t, grp, is_variant, seq: the labelled documents, their first 70 % and their rewrites, in a fixed order."""
    from ..functions.text import WRAP_FOOT, WRAP_HEAD

    head, foot = (x.replace("\n", "' || chr(10) || '") for x in (WRAP_HEAD, WRAP_FOOT))
    return f"""
  origin AS (SELECT doc_id, min(text) AS t FROM judge_labels WHERE length(text) > 0 GROUP BY 1),
  cut AS (SELECT doc_id, t, string_split(regexp_replace(regexp_replace(t, '^{WS}+|{WS}+$', '', 'g'), '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS a FROM origin),
  variants_ AS (SELECT doc_id, t, doc_id AS grp, false AS is_variant FROM cut UNION ALL SELECT doc_id || '::trunc', left(t, trunc(length(t) * 0.7::DOUBLE)::BIGINT), doc_id, true FROM cut
    UNION ALL SELECT doc_id || '::v2', CASE WHEN len(a) >= 2 THEN array_to_string(list_concat(a[2:], a[1:1]), ' ') ELSE '{head}' || t || '{foot}' END, doc_id, true FROM cut),
  variants AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id) || doc_id) AS seq FROM variants_)"""


def drops(rejected: str, seen: str = "seen") -> str:
    """Columns dropped, dups, hits, precision, recall of a table of rejected rows against seen (seq, is_repeat)."""
    return f"""SELECT count(i) AS dropped, count_if(is_repeat)::BIGINT AS dups, count_if(is_repeat AND i IS NOT NULL)::BIGINT AS hits,
    CASE WHEN count(i) = 0 THEN 1.0 ELSE round(count_if(is_repeat AND i IS NOT NULL)::DOUBLE / count(i), 6) END AS precision,
    CASE WHEN count_if(is_repeat) = 0 THEN 0.0 ELSE round(count_if(is_repeat AND i IS NOT NULL)::DOUBLE / count_if(is_repeat), 6) END AS recall
    FROM {seen} LEFT JOIN {rejected} ON i = seq"""
