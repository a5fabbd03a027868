"""DuckDB SQL that states what each registered query must return."""

from __future__ import annotations

from winnow.functions import minhash as mh
from winnow.functions.limits import (
    ENGLISH_STOP_WORDS,
    EVAL_METRIC,
    EVAL_ROW,
    MINHASH_BANDS,
    MINHASH_ROWS,
    SHINGLE_WORDS,
)
from winnow.functions.text import TOKEN, WORD
from winnow.operators import pii
from winnow.operators.language import MIN_SCORE
from winnow.plans import oracle_text as t

BLOCKED_DOMAINS = ["cheap-pills.example.com", "casino-win.example.org"]
BLOCKED_WORDS = ["casino", "pills"]

DOCS = "docs AS (SELECT doc_id AS id, text FROM documents)"
VERDICT = "SELECT id AS doc_id, reason IS NULL AS keep, reason AS drop_reason FROM r"

ORACLE: dict[str, str] = {}
for _name, _part in (
    ("gopher_repetition", t.repetition),
    ("gopher_quality", t.quality),
    ("fineweb_quality", t.fineweb),
):
    ORACLE[_name] = f"WITH {DOCS}, {_part('docs', 'r')} {VERDICT}"
ORACLE["c4_quality"] = f"""WITH {DOCS}, {t.c4('docs', 'r')}
SELECT id AS doc_id, md5(text) AS text_md5, reason IS NULL AS keep, reason AS drop_reason FROM r"""

ORACLE["url_filter"] = f"""WITH r AS (
  SELECT page_id, {t.url_reason('url', BLOCKED_DOMAINS, BLOCKED_WORDS)} AS reason FROM pages)
SELECT page_id, reason IS NULL AS keep, reason AS drop_reason FROM r"""
ORACLE["url_filter_table"] = ORACLE["url_filter"]
ORACLE["extract_main_text"] = f"SELECT page_id, {t.main_text('html')} AS text FROM pages"

TRAIN = "train AS (SELECT doc_id AS id, text, lang FROM documents)"
PROFILES = f"{TRAIN}, {t.language_profiles('train')}"
ORACLE["language_filter"] = f"""WITH {DOCS}, {PROFILES}, {t.language('docs', 'r', 'en', MIN_SCORE)}
SELECT id AS doc_id, language, round(score, 4) AS language_score, reason IS NULL AS keep,
       reason AS drop_reason FROM r"""
ORACLE["language_filter_joined"] = ORACLE["language_filter"]

REFINED = f"""{PROFILES},
  s1 AS (SELECT page_id AS id, {t.url_reason('url', BLOCKED_DOMAINS, BLOCKED_WORDS)} AS reason, html
         FROM pages),
  p2 AS (SELECT id, {t.main_text('html')} AS text FROM s1 WHERE reason IS NULL),
  {t.language('p2', 's2', 'en', MIN_SCORE)},
  p3 AS (SELECT id, text FROM s2 WHERE reason IS NULL), {t.repetition('p3', 's3')},
  p4 AS (SELECT id, text FROM s3 WHERE reason IS NULL), {t.quality('p4', 's4')},
  p5 AS (SELECT id, text FROM s4 WHERE reason IS NULL), {t.c4('p5', 's5')},
  p6 AS (SELECT id, text FROM s5 WHERE reason IS NULL), {t.fineweb('p6', 's6')},
  refined AS (
    SELECT s1.id, coalesce(s5.text, s2.text) AS text, s2.language,
      CASE WHEN s1.reason IS NOT NULL THEN '1_url' WHEN s2.reason IS NOT NULL THEN '2_non_english'
           WHEN s3.reason IS NOT NULL THEN '3_gopher_rep'
           WHEN s4.reason IS NOT NULL THEN '4_gopher_qual' WHEN s5.reason IS NOT NULL THEN '5_c4'
           WHEN s6.reason IS NOT NULL THEN '6_fineweb_qual' END AS drop_stage,
      coalesce(s1.reason, s2.reason, s3.reason, s4.reason, s5.reason, s6.reason) AS drop_reason
    FROM s1 LEFT JOIN s2 USING (id) LEFT JOIN s3 USING (id) LEFT JOIN s4 USING (id)
      LEFT JOIN s5 USING (id) LEFT JOIN s6 USING (id))"""
ORACLE["refine_corpus"] = f"""WITH {REFINED}
SELECT id AS page_id, md5(text) AS text_md5, language, drop_stage, drop_reason FROM refined"""
ORACLE["stage_stats"] = f"""WITH {REFINED},
stages(stage) AS (VALUES ('1_url'), ('2_non_english'), ('3_gopher_rep'), ('4_gopher_qual'),
  ('5_c4'), ('6_fineweb_qual'), ('kept')),
d AS (SELECT stage, count(id) AS documents, coalesce(sum(length(text)), 0)::BIGINT AS chars
      FROM stages LEFT JOIN refined ON stage = coalesce(drop_stage, 'kept') GROUP BY stage),
i AS (SELECT *, (sum(documents) OVER (ORDER BY stage DESC))::BIGINT AS documents_in FROM d)
SELECT *, documents_in - CASE WHEN stage <> 'kept' THEN documents ELSE 0 END AS documents_left FROM i"""

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IP = pii.IP.removeprefix(r"\b").removesuffix(r"\b")


def masked(src: str) -> str:
    """CTEs ending in `masked`(doc_id, text) over `src`(doc_id, text)."""
    private = "|".join(pii.PRIVATE)
    return rf"""
    mails AS (SELECT doc_id, regexp_replace(text, '{EMAIL}', '{pii.MASK_EMAIL}', 'g') AS t
              FROM {src}),
    wrapped AS (SELECT doc_id,
      regexp_replace(t, '\b({_IP})\b', chr(1) || '\1' || chr(2), 'g') AS t FROM mails),
    opened AS (SELECT doc_id, regexp_replace(
      t, chr(1) || '((?:{private})[0-9.]*)' || chr(2), '\1', 'g') AS t FROM wrapped),
    masked AS (SELECT doc_id, regexp_replace(
      t, chr(1) || '[0-9.]+' || chr(2), '{pii.MASK_IP}', 'g') AS text FROM opened)"""


ORACLE["pii_mask"] = f"WITH {masked('documents')} SELECT doc_id, text FROM masked"
_TOKENS = f"len(regexp_extract_all(text, '{TOKEN}'))"
ORACLE["token_count"] = f"SELECT doc_id, {_TOKENS} AS token_count FROM documents"
ORACLE["token_totals"] = f"""SELECT count(*) AS documents, sum({_TOKENS})::BIGINT AS tokens
FROM documents"""

_FOLDED = f"regexp_extract_all(lower(text), '{WORD}')"
ORACLE["shingles"] = f"""
SELECT doc_id, pos - 1 AS pos, array_to_string(w[pos:pos + {SHINGLE_WORDS - 1}], ' ') AS shingle
FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE_WORDS - 2})) AS pos
      FROM (SELECT doc_id, {_FOLDED} AS w FROM documents) WHERE len(w) >= {SHINGLE_WORDS})"""

_TERMS = " + ".join(
    f"(lead(h, {i}) OVER w * {c}) % {mh.PRIME}" if i else f"(h * {c}) % {mh.PRIME}"
    for i, c in enumerate(mh.word_coefficients(SHINGLE_WORDS))
)
_PERMUTATIONS = ", ".join(
    f"({k}, {a}, {b})" for k, (a, b) in enumerate(mh.permutations(MINHASH_BANDS * MINHASH_ROWS))
)


def clustered(source: str) -> str:
    """The CTEs below with another relation (doc_id, text) as input."""
    return CLUSTERS.replace("FROM documents)", f"FROM {source})")


SIGNATURES = f"""words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word
  FROM (SELECT doc_id, {_FOLDED} AS w FROM documents)),
hashed AS (SELECT doc_id, pos, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM words),
hashes AS (SELECT doc_id, ({_TERMS}) % {mh.PRIME} AS h FROM hashed
           WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
perms(k, a, b) AS (VALUES {_PERMUTATIONS}),
mins AS (SELECT doc_id, k, min((h * a + b) % {mh.PRIME}) AS v
         FROM hashes CROSS JOIN perms WHERE h IS NOT NULL GROUP BY doc_id, k)"""
ORACLE["minhash_signature"] = f"""WITH {SIGNATURES}
SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY k) AS sig FROM mins GROUP BY doc_id"""
EDGES = f"""{SIGNATURES},
bands AS (SELECT doc_id, k // {MINHASH_ROWS} AS band, string_agg(v::VARCHAR, ',' ORDER BY k) AS key
          FROM mins GROUP BY doc_id, k // {MINHASH_ROWS}),
edges AS (SELECT DISTINCT doc_id AS src, dst FROM (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY band, key) AS dst FROM bands) WHERE doc_id <> dst)"""
ORACLE["lsh_candidates"] = f"WITH {EDGES} SELECT src, dst FROM edges"
CLUSTERS = f"""{EDGES},
both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach(id, other) AS (
  SELECT src, dst FROM both_ways
  UNION SELECT r.id, b.dst FROM reach r JOIN both_ways b ON b.src = r.other),
clusters AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id)"""
ORACLE["dedup_clusters"] = f"WITH RECURSIVE {CLUSTERS} SELECT id, component FROM clusters"
ORACLE["dedup_cluster_sizes"] = f"""WITH RECURSIVE {CLUSTERS},
sizes AS (SELECT component, count(*) AS cluster_size FROM clusters GROUP BY component)
SELECT cluster_size, count(*) AS clusters FROM sizes GROUP BY cluster_size"""
ORACLE["minhash_dedup"] = f"""WITH RECURSIVE {CLUSTERS}
SELECT doc_id, md5(text) AS text_md5 FROM documents
WHERE doc_id NOT IN (SELECT id FROM clusters WHERE id <> component)"""

EVAL = EVAL_ROW.format(metric=EVAL_METRIC)

# --- audit -------------------------------------------------------------------


def _sample(id_column: str) -> str:
    return f"md5('7:' || {id_column}::VARCHAR)"


ORACLE["sample_rows"] = f"SELECT doc_id FROM documents ORDER BY {_sample('doc_id')}, doc_id LIMIT 30"
ORACLE["sample_rows_by_source"] = f"""SELECT doc_id, source FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_sample('doc_id')}, doc_id) <= 5"""
SAMPLED = f"SELECT page_id FROM pages ORDER BY {_sample('page_id')}, page_id LIMIT 30"
ORACLE["lookup_sources"] = f"""SELECT page_id, md5(html) AS text_md5 FROM pages
WHERE page_id IN ({SAMPLED})"""


def content_words(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}-]+'), lambda w: "
        f"regexp_matches(w, '^\\p{{L}}+$') AND w NOT IN ({t.quoted(ENGLISH_STOP_WORDS)}))"
    )


ORACLE["content_words"] = f"""
SELECT doc_id, array_to_string({content_words('text')}, ' ') AS words FROM documents"""


def overlap(src: str) -> str:
    """CTE `overlapping`(page_id, similarity) over `src`(page_id, original, refined)."""
    return f"""
    counted AS (
      SELECT page_id, word, sum(o) AS o, sum(r) AS r FROM (
        SELECT page_id, unnest({content_words('original')}) AS word, 1 AS o, 0 AS r FROM {src}
        UNION ALL
        SELECT page_id, unnest({content_words('refined')}) AS word, 0, 1 FROM {src})
      GROUP BY page_id, word),
    matched AS (SELECT page_id, sum(least(o, r)) AS m, sum(r) AS n FROM counted GROUP BY page_id),
    overlapping AS (
      SELECT s.page_id, CASE WHEN n > 0 THEN m::DOUBLE / n * 100 ELSE 0.0 END AS similarity
      FROM {src} s LEFT JOIN matched USING (page_id))"""


PAIRS = f"pairs AS (SELECT page_id, html AS original, {t.main_text('html')} AS refined FROM pages"
ORACLE["word_overlap"] = f"""WITH {PAIRS}), {overlap('pairs')}
SELECT page_id, round(similarity, 6) AS similarity FROM overlapping"""
ORACLE["audit_corpus"] = f"""WITH {PAIRS} WHERE page_id IN ({SAMPLED})), {overlap('pairs')}
SELECT page_id, round(similarity, 2) AS similarity FROM overlapping"""

HANDED_IN = f"""handed_in AS (
  SELECT DISTINCT unnest([page_id % 20, (page_id * 7 + 3) % 20]) AS uid, page_id FROM pages),
picked AS (SELECT * FROM handed_in QUALIFY row_number() OVER (
  PARTITION BY uid ORDER BY {_sample('page_id')}, page_id) <= 30),
handed AS (
  SELECT uid * 1000000000 + page_id AS page_id, html AS original,
         CASE WHEN uid % 3 = 0 THEN reverse({t.main_text('html')}) ELSE {t.main_text('html')} END AS refined
  FROM picked JOIN pages USING (page_id)), {overlap('handed')},
samples AS (
  SELECT page_id // 1000000000 AS uid, page_id % 1000000000 AS page_id,
         round(similarity, 2) AS similarity FROM overlapping)"""
ORACLE["audit_samples"] = f"WITH {HANDED_IN} SELECT uid, page_id, similarity FROM samples"
ORACLE["audit_submissions"] = f"""WITH {HANDED_IN}
SELECT n_nationkey AS uid,
       CASE WHEN count(*) FILTER (WHERE similarity <= 70) >= 0.3::DOUBLE * count(similarity)
            THEN 0 ELSE 1 END AS gate
FROM nation LEFT JOIN samples ON uid = n_nationkey GROUP BY n_nationkey"""

EVENTS = """ev AS (
  SELECT event_id, user_id AS uid, event_type,
         date_diff('second', TIMESTAMP '1970-01-01', ts) // 12 AS block,
         round(value * 100)::BIGINT AS cents, 'c' || json_extract_string(props, '$.k') AS commit,
         (round(value * 100)::BIGINT % 1000) / 1000.0::DOUBLE AS score
  FROM events)"""
GATES = """gates AS (
  SELECT c_custkey AS uid,
         CASE WHEN coalesce(low, 0)::DOUBLE >= 0.3::DOUBLE * coalesce(n, 0) THEN 0 ELSE 1 END AS gate
  FROM customer LEFT JOIN (
    SELECT uid, count(*) AS n, count(*) FILTER (WHERE (cents % 4000) / 100.0::DOUBLE + 60 <= 70) AS low
    FROM ev GROUP BY uid) ON uid = c_custkey)"""
ORACLE["similarity_gate"] = f"WITH {EVENTS}, {GATES} SELECT uid, gate FROM gates"
PARSED = f"""{EVENTS}, logs AS (
  SELECT uid, event_id, '|   ' || CASE WHEN event_type = 'click' THEN 'other_metric'
    ELSE 'truthfulqa_mc2' END || '  ' || CASE WHEN event_type = 'error' THEN '|0.41|'
    ELSE '|0.' || lpad((cents % 10000)::VARCHAR, 4, '0') || '|' END || ' ± |0.0'
    || lpad((cents % 1000)::VARCHAR, 3, '0') || '|' AS row FROM ev),
lines AS (SELECT uid, event_id, '|Task|Value|' || chr(10) || row || chr(10) || row AS line FROM logs),
parsed AS (
  SELECT uid AS run_id, event_id, unnest(regexp_extract_all(line, '{EVAL}', 1)) AS metric,
         unnest(regexp_extract_all(line, '{EVAL}', 2))::DOUBLE AS value,
         unnest(regexp_extract_all(line, '{EVAL}', 3))::DOUBLE AS stderr
  FROM lines)"""
ORACLE["parse_eval_log"] = f"WITH {PARSED} SELECT run_id, event_id, metric, value, stderr FROM parsed"
ORACLE["eval_summary"] = f"""WITH {PARSED}, found AS (
  SELECT run_id, metric, value, stderr FROM parsed
  UNION ALL SELECT uid, 'other_metric', 1.0, 0.5 FROM ev WHERE event_type = 'click')
SELECT run_id, round(coalesce(avg(value) FILTER (WHERE metric = 'truthfulqa_mc2'), 0), 12) AS value,
       round(coalesce(avg(stderr) FILTER (WHERE metric = 'truthfulqa_mc2'), 0), 12) AS stderr
FROM found GROUP BY run_id"""
ORACLE["corpus_quality_eval"] = f"""WITH rows AS (
  SELECT d.doc_id, quality = 1 AS good, {_FOLDED} AS words,
         ('0x' || substr(md5('0:' || d.doc_id::VARCHAR), 1, 4))::INT < 13107 AS held_out
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
counts AS (
  SELECT word, count(*) FILTER (WHERE good) AS yes, count(*) FILTER (WHERE NOT good) AS no
  FROM (SELECT good, unnest(words) AS word FROM rows WHERE NOT held_out) GROUP BY word),
sums AS (SELECT sum(yes) AS yes, sum(no) AS no, count(*) AS n FROM counts),
prior AS (SELECT ln((count(*) FILTER (WHERE good) + 1.0) / (count(*) FILTER (WHERE NOT good) + 1.0)) AS p
          FROM rows WHERE NOT held_out),
seen AS (SELECT doc_id, good, unnest(words) AS word FROM rows WHERE held_out),
odds AS (
  SELECT s.doc_id, sum(ln((coalesce(c.yes, 0) + 1.0) / (coalesce(c.no, 0) + 1.0)
                          * ((t.no + t.n + 1.0) / (t.yes + t.n + 1.0)))) AS o
  FROM seen s CROSS JOIN sums t LEFT JOIN counts c ON c.word = s.word GROUP BY s.doc_id),
judged AS (
  SELECT r.good = (coalesce(o, 0) + p > 0) AS correct
  FROM (SELECT * FROM rows WHERE held_out) r CROSS JOIN prior LEFT JOIN odds USING (doc_id))
SELECT round(avg(correct::INT), 8) AS value,
       round(sqrt(avg(correct::INT) * (1 - avg(correct::INT)) / count(*)), 8) AS stderr FROM judged"""
SUBMITTED = f"""{EVENTS}, tasks AS (
  SELECT uid, min(event_id) AS task_id, min(block) AS request_block
  FROM ev WHERE event_type = 'purchase' GROUP BY uid),
submitted AS (SELECT ev.*, task_id, (block - request_block) * 12 AS elapsed
              FROM ev JOIN tasks ON tasks.uid = ev.uid)"""
ORACLE["elapsed_time"] = f"WITH {SUBMITTED} SELECT event_id, uid, task_id, elapsed FROM submitted"
ORACLE["submission_score"] = f"""WITH {SUBMITTED}, {GATES}
SELECT event_id, s.uid, round(CASE WHEN gate = 0 THEN 0.0::DOUBLE ELSE
  0.7::DOUBLE * score * (1 - (cents % 100) / 1000.0::DOUBLE)
  + 0.3::DOUBLE * (1 - greatest(least(elapsed, 86400), 0) / 86400.0::DOUBLE) END, 8) AS score
FROM submitted s JOIN gates g ON g.uid = s.uid"""

# --- commits and scores --------------------------------------------------------

ORACLE["commit_key"] = f"""WITH {EVENTS}
SELECT event_id, CASE WHEN event_type <> 'error' THEN 'u/r' || uid END AS url,
       CASE WHEN event_type <> 'error' THEN md5(commit) END AS hash FROM ev"""
ORACLE["pair_hash"] = """SELECT event_id, to_base64(unhex(sha256(event_type || props))) AS hash
FROM events"""
ORACLE["eligible_submitters"] = f"""WITH {EVENTS} SELECT event_id, uid FROM ev
WHERE uid IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 4096)"""
OBSERVED = f"""{EVENTS}, seen AS (
  SELECT event_id, uid, commit, block AS seen_block,
         block - (event_id * 37) % 9000 AS commit_block FROM ev)"""
ORACLE["late_commits"] = f"""WITH {OBSERVED}
SELECT event_id, seen_block - commit_block >= 7200 AS late FROM seen"""
ORACLE["recent_commits"] = f"""WITH {OBSERVED}
SELECT event_id, uid, commit FROM seen WHERE seen_block - commit_block < 7200"""
REPLAY = f"""{OBSERVED}, polls AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seen_block, commit_block, commit, event_id) AS k
  FROM seen WHERE commit IS NOT NULL),
replay(uid, k, last, timer, kind, commit, block, event_id, commit_block) AS (
  SELECT DISTINCT uid, 0::BIGINT, NULL::VARCHAR, 0::BIGINT, NULL::VARCHAR, NULL::VARCHAR,
         NULL::BIGINT, NULL::BIGINT, NULL::BIGINT
  FROM polls
  UNION ALL
  SELECT uid, k, CASE WHEN kind IS NULL THEN last ELSE commit END,
         CASE kind WHEN 'commit' THEN commit_block WHEN 'decay' THEN seen_block ELSE timer END,
         kind, commit, seen_block, event_id, commit_block
  FROM (SELECT p.*, r.last, r.timer, CASE
          WHEN seen_block - p.commit_block < 7200 AND p.commit IS DISTINCT FROM r.last THEN 'commit'
          WHEN seen_block - r.timer > 7200 THEN 'decay' END AS kind
        FROM replay r JOIN polls p ON p.uid = r.uid AND p.k = r.k + 1))"""
ORACLE["new_commits"] = f"""WITH RECURSIVE {REPLAY}
SELECT event_id, uid, commit, block AS seen_block, commit_block FROM replay WHERE kind = 'commit'"""
ORACLE["stale_decay"] = f"WITH RECURSIVE {REPLAY} SELECT uid, block FROM replay WHERE kind = 'decay'"
ORACLE["ema_score"] = f"""WITH {EVENTS}, aged AS (
  SELECT uid, score, row_number() OVER (PARTITION BY uid ORDER BY block DESC, event_id DESC) - 1 AS age
  FROM ev)
SELECT uid, round(sum(0.2::DOUBLE * score * pow(0.8::DOUBLE, age)), 8) AS score FROM aged GROUP BY uid"""
ORACLE["latest_score"] = f"""WITH {EVENTS}
SELECT uid, score FROM ev WHERE event_id % 3 <> 0
QUALIFY row_number() OVER (PARTITION BY uid ORDER BY block DESC, event_id DESC) = 1"""
ORACLE["dense_scores"] = f"""WITH {EVENTS}, latest AS (
  SELECT uid, score FROM ev
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY block DESC, event_id DESC) = 1)
SELECT c_nationkey AS netuid, c_custkey AS uid, coalesce(score, 0.0) AS score
FROM customer LEFT JOIN latest ON uid = c_custkey"""

YEARLY = """best AS (
  SELECT o_custkey AS uid, year(o_orderdate) AS epoch, max(o_totalprice) AS price
  FROM orders GROUP BY ALL),
scores AS (
  SELECT c_nationkey AS netuid, epoch, uid,
         round(pow(greatest(price - 100000, 0.0) / 100000, 4), 4) AS score
  FROM best JOIN customer ON c_custkey = uid),
weights AS (
  SELECT netuid, epoch, uid, score / CASE WHEN norm = 0 THEN 1.0 ELSE norm END AS weight
  FROM (SELECT *, sum(abs(score)) OVER (PARTITION BY netuid, epoch) AS norm FROM scores))"""


def capped(src: str, out: str, limit: float) -> str:
    return f"""
    {out}_s AS (
      SELECT *, count(*) OVER g AS n, sum(weight) OVER g AS total,
             row_number() OVER (PARTITION BY netuid, epoch ORDER BY weight, uid DESC) AS i
      FROM {src} WINDOW g AS (PARTITION BY netuid, epoch)),
    {out}_e AS (SELECT *, CASE WHEN total <> 0 THEN weight / total ELSE 0 END AS e FROM {out}_s),
    {out}_c AS (SELECT *, sum(e) OVER (PARTITION BY netuid, epoch ORDER BY i) AS cum,
                       max(e) OVER (PARTITION BY netuid, epoch) AS top FROM {out}_e),
    {out}_n AS (SELECT *, count(*) FILTER (WHERE e / ((n - i) * e + cum + 1e-7) < {limit})
                            OVER (PARTITION BY netuid, epoch) AS fit FROM {out}_c),
    {out}_k AS (
      SELECT *, ({limit} * max(CASE WHEN i = fit THEN cum END) OVER (PARTITION BY netuid, epoch) - 1e-7)
                / (1 - {limit} * (n - fit)) * total AS cutoff FROM {out}_n),
    {out} AS (
      SELECT netuid, epoch, uid,
        CASE WHEN total = 0 OR n * {limit} <= 1 THEN 1.0 / n WHEN top <= {limit} THEN weight / total
             ELSE least(weight, cutoff) / sum(least(weight, cutoff)) OVER (PARTITION BY netuid, epoch)
        END AS weight FROM {out}_k)"""


def processed(src: str, out: str, min_allowed: int, limit: float, quantile: float) -> str:
    return f"""
    {out}_m AS (
      SELECT *, count(*) OVER g AS n, count(*) FILTER (WHERE weight > 0) OVER g AS positive
      FROM {src} WINDOW g AS (PARTITION BY netuid, epoch)),
    {out}_q AS (
      SELECT netuid, epoch, list_sort(list(weight)) AS ws,
             least({quantile}::DOUBLE, greatest(max(positive) - {min_allowed}, 0)::DOUBLE / max(positive))
             * (count(*) - 1) AS spot
      FROM {out}_m WHERE weight > 0 GROUP BY netuid, epoch),
    {out}_l AS (
      SELECT netuid, epoch, ws[floor(spot)::INT + 1]
             + (ws[ceil(spot)::INT + 1] - ws[floor(spot)::INT + 1]) * (spot - floor(spot)) AS low
      FROM {out}_q),
    {out}_a AS (
      SELECT s.netuid, s.epoch, uid,
        CASE WHEN positive = 0 OR n < {min_allowed} THEN 0.0
             WHEN positive < {min_allowed} THEN 1e-5 + greatest(weight, 0) ELSE weight END AS weight
      FROM {out}_m s LEFT JOIN {out}_l l ON l.netuid = s.netuid AND l.epoch = s.epoch
      WHERE positive < {min_allowed} OR n < {min_allowed} OR (weight > 0 AND weight >= low)),
    {capped(f'{out}_a', out, limit)}"""


_ROUNDED = "SELECT netuid, epoch, uid, round(weight, 8) AS weight FROM"
ORACLE["l1_weights"] = f"WITH {YEARLY} {_ROUNDED} weights"
ORACLE["capped_weights"] = f"WITH {YEARLY}, {capped('weights', 'r', 0.05)} {_ROUNDED} r"
ORACLE["process_weights"] = (
    f"WITH {YEARLY}, {processed('weights', 'r', 8, 0.05, 6553 / 65535)} {_ROUNDED} r"
)
ORACLE["process_weights_all"] = (
    f"WITH {YEARLY}, {processed('weights', 'r', 25, 0.1, 0.0)} {_ROUNDED} r"
)
ORACLE["emit_weights"] = f"""WITH {YEARLY}, scaled AS (
  SELECT *, max(weight) OVER (PARTITION BY netuid, epoch) AS top FROM weights)
SELECT netuid, epoch, uid, round_even(weight / top * 65535, 0)::INT AS w_u16 FROM scaled
WHERE top > 0 AND round_even(weight / top * 65535, 0) <> 0"""
EPOCHS = """last AS (
  SELECT uid, ((block + 99) // 100) * 100 AS epoch, arg_max(score, (block, event_id)) AS score
  FROM ev GROUP BY ALL),
spans AS (
  SELECT *, coalesce(lead(epoch) OVER (PARTITION BY uid ORDER BY epoch),
                     (SELECT max(epoch) + 100 FROM last)) AS until FROM last)"""
ORACLE["weight_epochs"] = f"""WITH {EVENTS}, {EPOCHS}
SELECT unnest(range(epoch, until, 100)) AS epoch, uid, score FROM spans"""
ORACLE["weight_intervals"] = f"WITH {EVENTS}, {EPOCHS} SELECT uid, epoch, until, score FROM spans"
ORACLE["epoch_norms"] = f"""WITH {EVENTS}, {EPOCHS}, points AS (
  SELECT DISTINCT epoch FROM last)
SELECT p.epoch, coalesce(lead(p.epoch) OVER (ORDER BY p.epoch), max(max(s.until)) OVER ()) AS until,
       count(*) AS members, round(sum(abs(score)), 6) AS norm
FROM points p JOIN spans s ON s.epoch <= p.epoch AND p.epoch < s.until GROUP BY p.epoch"""

# --- training sequences ----------------------------------------------------------

PACKED = f"""toks AS (
  SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS token
  FROM (SELECT doc_id, regexp_extract_all(text, '{TOKEN}') AS w FROM documents)),
placed AS (SELECT token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS spot FROM toks),
packed AS (
  SELECT spot // 2048 AS block, count(*) AS n, md5(string_agg(token, ' ' ORDER BY spot)) AS tokens_md5
  FROM placed GROUP BY 1 HAVING count(*) = 2048)"""
ORACLE["pack_sequences"] = f"WITH {PACKED} SELECT block, n, tokens_md5 FROM packed"
ORACLE["token_budget"] = f"""WITH {PACKED}, c AS (SELECT count(*) AS blocks FROM packed)
SELECT 163840 AS needed, blocks * 2048 AS have, blocks * 2048 >= 163840 AS enough,
       blocks // 8 AS max_steps FROM c"""
PLAN = f"""{PACKED}, plan AS (
  SELECT block, block // 8 AS step, (block % 8) // 2 AS micro_batch, block % 2 AS slot
  FROM packed WHERE block // 8 < (SELECT count(*) // 8 FROM packed))"""
ORACLE["batch_plan"] = f"WITH {PLAN} SELECT block, step, micro_batch, slot FROM plan"
ORACLE["data_stages"] = f"""WITH {PLAN}, stages(stage, start, stop) AS (
  VALUES ('Stable Training Stage', 1, 10), ('Annealing Phase', 10, 11))
SELECT stage, min(step + 1) AS first_step, max(step + 1) AS last_step, count(*) AS planned,
       count(*) FILTER (WHERE step + 1 <= 4) AS consumed,
       greatest(max(stop) - greatest(max(start), 5), 0) AS remaining_steps
FROM plan JOIN stages ON step + 1 >= start AND step + 1 < stop GROUP BY stage"""
_HASH = "('0x' || substr(md5('7:' || id::VARCHAR), 1, 15))::BIGINT"
ORACLE["weighted_mix"] = f"""WITH total AS (SELECT count(*) AS n FROM documents),
rows AS (
  SELECT 'documents' AS source, doc_id AS id FROM documents
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn FROM conversations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_HASH}, id) AS k,
         count(*) OVER (PARTITION BY source) AS size FROM rows),
parts AS (
  SELECT r.*, CASE WHEN source = 'documents' THEN floor(round(0.3 * n, 6))
                   ELSE n - floor(round(0.3 * n, 6)) END::BIGINT AS part FROM ranked r, total)
SELECT source, id, unnest(range(1, part // size + 1
                                   + CASE WHEN k <= part % size THEN 1 ELSE 0 END))::INT AS copy
FROM parts"""

# --- sources and sinks -------------------------------------------------------------

ORACLE["read_warc"] = """SELECT '<urn:page:' || page_id || '>' AS id, url,
  epoch(TIMESTAMP '2024-10-09 21:13:35')::BIGINT AS date_seconds, md5(html) AS html_md5 FROM pages"""
ORACLE["read_jsonl"] = "SELECT conv_id, turn, role, text FROM conversations"
ORACLE["write_jsonl"] = """SELECT doc_id::VARCHAR AS id, lang AS language, md5(text) AS text_md5,
  source FROM documents"""
ORACLE["write_removed"] = f"""WITH {REFINED}
SELECT id AS page_id, drop_reason, CASE WHEN drop_stage <> '2_non_english' THEN drop_stage END
         AS drop_stage, CASE WHEN drop_stage = '2_non_english' THEN language END AS language
FROM refined WHERE drop_stage IS NOT NULL"""
ORACLE["publish_dataset"] = """
SELECT doc_id, md5(text) AS text_md5, source, 'train' AS split FROM documents
UNION ALL SELECT -item_id - 1, md5(text), NULL, 'train' FROM benchmark"""
ORACLE["report_scores"] = f"WITH {EVENTS} SELECT event_id AS task_id, score FROM ev"

# --- streaming ---------------------------------------------------------------------

ORACLE["commit_stream"] = f"""WITH RECURSIVE {REPLAY}
SELECT uid, kind, commit, block FROM replay WHERE kind IS NOT NULL"""
# The loop: every event in turn moves the total; a commit without its task is none.
LOOP = f"""{REPLAY}, {GATES}, tasks AS (
  SELECT uid, min(event_id) AS task_id, min(block) AS request_block
  FROM ev WHERE event_type = 'purchase' GROUP BY uid),
evaluated AS (
  SELECT uid, commit, max(score) AS value, max((cents % 100) / 1000.0::DOUBLE) AS stderr
  FROM ev GROUP BY ALL),
happened AS (
  SELECT r.uid, r.kind, r.block, CASE WHEN kind = 'commit' THEN task_id END AS task_id,
         row_number() OVER (PARTITION BY r.uid ORDER BY k) AS seq, request_block IS NOT NULL AS known,
         CASE WHEN kind = 'commit' THEN CASE WHEN gate = 0 THEN 0.0::DOUBLE ELSE
           0.7::DOUBLE * value * (1 - stderr) + 0.3::DOUBLE
           * (1 - greatest(least((r.commit_block - request_block) * 12, 86400), 0) / 86400.0::DOUBLE)
         END END AS score
  FROM replay r LEFT JOIN (tasks JOIN gates USING (uid)) t ON t.uid = r.uid
  LEFT JOIN evaluated e ON e.uid = r.uid AND e.commit = r.commit WHERE kind IS NOT NULL),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seq) AS i
  FROM happened WHERE kind = 'decay' OR known),
logged(uid, i, seq, block, kind, task_id, score, total) AS (
  SELECT DISTINCT uid, 0::BIGINT, 0::BIGINT, 0::BIGINT, NULL::VARCHAR, NULL::BIGINT, NULL::DOUBLE, 0.0::DOUBLE
  FROM counted
  UNION ALL
  SELECT c.uid, c.i, c.seq, c.block, c.kind, c.task_id, c.score,
         0.8::DOUBLE * l.total + CASE c.kind WHEN 'decay' THEN 0.0 ELSE 0.2::DOUBLE * c.score END
  FROM logged l JOIN counted c ON c.uid = l.uid AND c.i = l.i + 1)"""
ORACLE["score_stream"] = f"""WITH RECURSIVE {LOOP}
SELECT uid, seq, block, kind, task_id, round(score, 8) AS score, round(total, 8) AS total
FROM logged WHERE i > 0"""
ORACLE["score_restart"] = f"""WITH RECURSIVE {LOOP}
SELECT uid, round(arg_max(total, seq), 8) AS score FROM logged WHERE i > 0 GROUP BY uid"""
ORACLE["weight_stream"] = f"""WITH RECURSIVE {LOOP},
bounds AS (SELECT (min(block) + 99) // 100 * 100 AS low, (max(block) + 99) // 100 * 100 AS high FROM ev),
held AS (SELECT uid, block, arg_max(total, seq) AS total FROM logged WHERE i > 0 GROUP BY ALL),
wanted AS (
  SELECT s_suppkey AS uid, epoch FROM supplier, (SELECT unnest(range(low, high + 1, 100)) AS epoch FROM bounds)),
filled AS (
  SELECT w.epoch, w.uid, coalesce(h.total, 0.0) AS score
  FROM wanted w ASOF LEFT JOIN held h ON w.uid = h.uid AND h.block <= w.epoch),
vectors AS (
  SELECT 0 AS netuid, epoch, uid, score / CASE WHEN norm = 0 THEN 1.0 ELSE norm END AS weight
  FROM (SELECT *, sum(abs(score)) OVER (PARTITION BY epoch) AS norm FROM filled)),
{processed('vectors', 'r', 8, 0.1, 0.0)},
scaled AS (SELECT *, max(weight) OVER (PARTITION BY epoch) AS top FROM r)
SELECT epoch, uid, round_even(weight / top * 65535, 0)::INT AS w_u16 FROM scaled
WHERE top > 0 AND round_even(weight / top * 65535, 0) <> 0"""
ORACLE["chunk_reassembly"] = """
SELECT conv_id, md5(string_agg(replace(text, chr(10), ''), '' ORDER BY turn)) AS completion_md5
FROM conversations GROUP BY conv_id"""
ORACLE["chunk_stream"] = """
SELECT conv_id, 0 AS at,
       md5(string_agg(replace(text, chr(10), ''), '' ORDER BY turn)) AS text_md5
FROM conversations GROUP BY conv_id HAVING sum(length(replace(text, chr(10), ''))) > 0"""
_UNIQUE = f"""{REFINED},
kept AS (SELECT id AS doc_id, text, language FROM refined WHERE drop_stage IS NULL),
{clustered('kept')},
distinct_docs AS (SELECT doc_id, text, language FROM kept
                  WHERE doc_id NOT IN (SELECT id FROM clusters WHERE id <> component))"""
ORACLE["publish_corpus"] = f"""WITH RECURSIVE {_UNIQUE},
{masked('distinct_docs')}
SELECT m.doc_id AS page_id, d.language, len(regexp_extract_all(d.text, '{TOKEN}')) AS token_count,
       md5(m.text) AS text_md5, 'train' AS split
FROM masked m JOIN distinct_docs d ON d.doc_id = m.doc_id"""
ORACLE["publish_stats"] = f"""WITH RECURSIVE {_UNIQUE},
stages(stage) AS (VALUES ('1_url'), ('2_non_english'), ('3_gopher_rep'), ('4_gopher_qual'),
  ('5_c4'), ('6_fineweb_qual'), ('7_duplicates'), ('kept')),
ends AS (SELECT r.id, r.text, CASE WHEN drop_stage IS NOT NULL THEN drop_stage
           WHEN EXISTS (SELECT 1 FROM distinct_docs u WHERE u.doc_id = r.id) THEN 'kept'
           ELSE '7_duplicates' END AS at_stage FROM refined r),
d AS (SELECT stage, count(id) AS documents, coalesce(sum(length(text)), 0)::BIGINT AS chars
      FROM stages LEFT JOIN ends ON stage = at_stage GROUP BY stage),
i AS (SELECT *, (sum(documents) OVER (ORDER BY stage DESC))::BIGINT AS documents_in FROM d)
SELECT *, documents_in - CASE WHEN stage <> 'kept' THEN documents ELSE 0 END AS documents_left FROM i"""
ORACLE["refine_stream"] = f"""WITH RECURSIVE {REFINED},
kept AS (SELECT id AS doc_id, text FROM refined WHERE drop_stage IS NULL),
{clustered('kept')},
distinct_docs AS (SELECT doc_id, text FROM kept
                  WHERE doc_id NOT IN (SELECT id FROM clusters WHERE id <> component)),
{masked('distinct_docs')}
SELECT m.doc_id AS page_id, len(regexp_extract_all(d.text, '{TOKEN}')) AS token_count,
       md5(m.text) AS text_md5
FROM masked m JOIN distinct_docs d ON d.doc_id = m.doc_id"""
