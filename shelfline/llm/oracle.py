"""SQL that the registered queries of this subpackage are compared with."""

from __future__ import annotations

from shelfline.llm.quality import BOILERPLATE

WORDS = r"[^\x20\x09-\x0D]+"

_OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
),
s AS (
  SELECT r, unnest(CASE WHEN len(w) >= 5 THEN [list_slice(w, i, i + 4) for i in range(1, len(w) - 3)]
                        WHEN len(w) > 0 THEN [w] ELSE [] END) AS shingle
  FROM d
),
c AS (SELECT r, shingle, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT r, sum(n) AS n FROM c GROUP BY r),
p AS (
  SELECT a.r AS x, b.r AS y, sum(least(a.n, b.n)) AS n FROM c a JOIN c b ON a.shingle = b.shingle AND a.r < b.r GROUP BY ALL
),
e AS (
  SELECT x, y FROM p JOIN t tx ON x = tx.r JOIN t ty ON y = ty.r WHERE 5 * p.n >= 4 * (tx.n + ty.n - p.n)
),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (
  SELECT r AS x, r AS y FROM d UNION SELECT reach.x, b.y FROM reach JOIN b ON reach.y = b.x
)
SELECT d.doc_id, min(o.doc_id) AS class_id
FROM reach JOIN d ON reach.x = d.r JOIN d o ON reach.y = o.r GROUP BY d.r, d.doc_id
"""


def sharding_sql(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(30)), coalesce(md5(text), chr(30)))),
                         1, 15))::BIGINT AS key
  FROM documents
),
node AS (
  SELECT depth, key >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS bytes, min(key) = max(key) AS alone
  FROM d, range(61) r(depth) GROUP BY ALL
),
leaf AS (
  SELECT d.doc_id, d.key, d.n_bytes, min(depth) AS depth, arg_min(bytes, depth) AS bytes, arg_min(alone, depth) AS alone,
         row_number() OVER (PARTITION BY d.key) - 1 AS nth
  FROM (SELECT *, row_number() OVER () AS row_no FROM d) d, node
  WHERE d.key >> (60 - depth) = prefix AND (bytes <= {limit} OR alone)
  GROUP BY row_no, d.doc_id, d.key, d.n_bytes
),
paged AS (
  SELECT *, CASE WHEN alone AND bytes > {limit} THEN nth // greatest({limit} // n_bytes, 1) ELSE 0 END AS page FROM leaf
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(key >> (60 - depth)), depth::INT, '0') END AS bucket,
       depth::INT AS depth, page::BIGINT AS page,
       sum(n_bytes) OVER (PARTITION BY depth, key >> (60 - depth), page)::BIGINT AS shard_bytes
FROM paged
"""


_OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w
  FROM documents
),
win AS (
  SELECT row_no, i, list_slice(w, i, i + 7) AS ws
  FROM (SELECT row_no, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
again AS (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, ws) AS n FROM win),
repeated AS (
  SELECT row_no, count(DISTINCT i + k) AS n FROM again, range(8) r(k) WHERE n > 1 GROUP BY row_no
),
line AS (
  SELECT row_no, l, regexp_extract_all(l, '{WORDS}') AS w,
         length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(l, '[^!]', '', 'g')) AS bangs,
         length(regexp_replace(l, '[^A-Z]', '', 'g')) AS uppers,
         length(regexp_replace(l, '[^A-Za-z]', '', 'g')) AS letters,
         length(regexp_replace(l, '[^.,;:!?]', '', 'g')) AS marks,
         translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM (SELECT row_no, unnest(string_split(t, chr(10))) AS l FROM d)
),
judged AS (
  SELECT row_no, l, list_sum([length(x) for x in w])::BIGINT AS chars,
         len([i for i in range(2, len(w) + 1) if w[i] = w[i - 1]]) AS stammers, len(w) AS n, *
  FROM line WHERE len(w) > 0
),
failed AS (
  SELECT row_no, l, chars,
         (symbols >= 2 AND 5 * symbols >= n) OR (bangs >= 3 AND 3 * bangs >= n) OR (n >= 3 AND 5 * uppers > 3 * letters)
         OR (stammers >= 5 AND 10 * stammers >= 3 * n) OR (n >= 50 AND marks = 0)
         OR (notice > 0 AND 10 * notice >= n) AS fails
  FROM (SELECT *, {" + ".join(f"{p.count(' ') + 1} * len(regexp_extract_all(low, '{p}'))" for p in BOILERPLATE)} AS notice
        FROM judged)
),
lost AS (
  SELECT row_no, sum(chars) AS word_chars, count(*) - count(DISTINCT l) AS n_dup_lines,
         count(*) FILTER (fails) AS n_failed_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
  FROM failed GROUP BY row_no
),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM d LEFT JOIN repeated USING (row_no) LEFT JOIN lost USING (row_no)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 10 * lost_chars <= 3 * word_chars AS kept
FROM base
"""

_OP9 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS size FROM documents
),
k AS (
  SELECT *, ('0x' || substr(md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(30)), coalesce(source, chr(30)),
                                           size::VARCHAR)), 1, 15))::BIGINT AS key
  FROM d
),
w AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::BIGINT AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source
),
-- the rate per weight: the least one at which caps and shares add up to the wanted total
r AS (
  SELECT a.cap / a.weight AS rate,
         sum(CASE WHEN b.cap / b.weight < a.cap / a.weight THEN b.cap ELSE 0 END) AS full_cap,
         sum(CASE WHEN b.cap / b.weight < a.cap / a.weight THEN 0 ELSE b.weight END) AS open_weight
  FROM w a, w b GROUP BY a.cap / a.weight
),
lam AS (
  SELECT full_cap, open_weight FROM r
  WHERE full_cap + open_weight * rate > 1.5::DOUBLE * (SELECT sum(source_size) FROM w)
  ORDER BY rate LIMIT 1
),
t AS (
  SELECT w.source, w.source_size,
         CASE WHEN l.open_weight IS NULL
                OR w.cap * l.open_weight <= (1.5::DOUBLE * (SELECT sum(source_size) FROM w) - l.full_cap) * w.weight
              THEN w.cap
              ELSE (1.5::DOUBLE * (SELECT sum(source_size) FROM w) - l.full_cap) * w.weight / l.open_weight END AS target
  FROM w LEFT JOIN lam l ON true
),
s AS (
  SELECT k.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(least(start + size, floor(target)) - start, 0)
        + greatest(least(start + source_size + size, floor(target)) - start - source_size, 0))::BIGINT AS taken
FROM s
"""

_OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_OP12 = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
f AS (
  SELECT lang, size, phrase, count(*) AS f
  FROM (
    SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM p, range(1, 6) s(size) WHERE len(w) >= size
  ) GROUP BY ALL
),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100),
gone AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM c s JOIN c b ON s.lang = b.lang AND b.size > s.size AND b.f >= s.f
                   AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n.n,
         (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN range(1, 5) s(k) ON k < c.size JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
),
best AS (
  SELECT lang, phrase, a, l, r, n, score FROM cut ANTI JOIN gone USING (lang, phrase)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_near_dedup": _OP1,
    "op2_sharding": sharding_sql(16 << 20),
    "op6_quality": _OP6,
    "op9_mixing": _OP9,
    "op11_topk": _OP11,
    "op12_phrases": _OP12,
}
