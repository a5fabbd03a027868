"""DuckDB SQL for the numbered queries that SQL can express on whole tables.

Each states the contract by comparing everything with everything, without the operators' methods.
"""

from __future__ import annotations

from winnow.llm.sharding import SHARDS, SIZE

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op2_suffix_dedup"] = """WITH docs AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
windows AS (
  SELECT doc_id, p, md5(substr(x, (2 * p + 1)::INT, 200)) AS w
  FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM docs)),
later AS (SELECT doc_id, p FROM windows
          QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1),
starts AS (
  SELECT doc_id, p, p > 100 + coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) AS fresh
  FROM later),
spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM starts)
  GROUP BY doc_id, g),
pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start FROM spans),
cut AS (
  SELECT d.doc_id, any_value(n) AS n, any_value(x) AS x, coalesce(sum(b - a), 0)::BIGINT AS gone,
         count(a) AS spans, max(b) AS tail,
         string_agg(substr(x, (2 * start + 1)::INT, (2 * (a - start))::INT), '' ORDER BY a) AS kept
  FROM docs d LEFT JOIN pieces p ON p.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, gone AS n_removed, spans AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, (2 * coalesce(tail, 0) + 1)::INT))) AS kept_sha256
FROM cut"""

LLM_ORACLE["op3_substring_dedup"] = f"""WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM docs)),
later AS (SELECT doc_id, p FROM windows
          QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later),
spots AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (
  SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.p) AS text, count(*) AS n
  FROM spots s ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p GROUP BY s.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LLM_ORACLE["op4_ngram_join"] = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", _LOWER)} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
  SELECT a, b FROM ways UNION SELECT r.id, w.b FROM reach r JOIN ways w ON w.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, min(other)) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach ON id = d.doc_id
GROUP BY d.doc_id"""

LLM_ORACLE["op5_mtree"] = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank
  FROM scored) WHERE rank <= 20"""


LLM_ORACLE["op11_lemp_negatives"] = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other, a.label = o.label AS same,
         list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
mined AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INT AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 3"""

LLM_ORACLE["op12_minhash_bayes"] = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", _LOWER)} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS p FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
  SELECT a, b FROM ways UNION SELECT r.id, w.b FROM reach r JOIN ways w ON w.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, min(other)) AS component_id, d.doc_id = least(d.doc_id, min(other)) AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach ON id = d.doc_id
GROUP BY d.doc_id"""


def _number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


LLM_ORACLE["op6_sharding"] = f"""WITH RECURSIVE names AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 3, '0') AS shard FROM range({SHARDS}) r(i)),
prefer AS (
  SELECT list({_number("'offset:' || shard")} % {SIZE} ORDER BY i) AS first,
         list({_number("'skip:' || shard")} % {SIZE - 1} + 1 ORDER BY i) AS skip FROM names),
turns(turn, slot, taken) AS (
  SELECT -1, -1::BIGINT, list_transform(range({SIZE}), lambda x: false) FROM prefer
  UNION ALL
  SELECT turn + 1, slot, list_concat(list_concat(taken[:slot], [true]), taken[slot + 2:])
  FROM (
    SELECT turn, taken, list_filter(
      list_transform(range({SIZE}),
                     lambda j: (first[(turn + 1) % {SHARDS} + 1] + j * skip[(turn + 1) % {SHARDS} + 1]) % {SIZE}),
      lambda s: NOT taken[s + 1])[1] AS slot
    FROM turns, prefer WHERE turn + 1 < {SIZE}))
SELECT d.doc_id, d.source, d.n_chars, t.slot, 'shard-' || lpad((turn % {SHARDS})::VARCHAR, 3, '0') AS shard
FROM documents d JOIN turns t ON t.slot = {_number("coalesce(d.doc_id::VARCHAR, '')")} % {SIZE} AND turn >= 0"""
