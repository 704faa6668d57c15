"""One query for each operator, over its whole table, and the SQL twins that DuckDB can run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import codes, decontaminate, dedup_exact, jaccard, langid, license, lmscore, merkle, mixing, pii, quality, tokenfile, warc
from tickerloom.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.licences(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact.exact_groups(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.text_scores(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.product_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_licences, op3_exact_dedup, op4_source_mix, op5_warc, op6_jaccard_join, op7_decontaminate, op8_quality, op9_lm_score, op10_language_id, op11_merkle, op12_token_files, op13_vector_codes)}

OP3_SQL = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
"""

OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), members AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM members a JOIN members b ON a.m = b.m AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * k >= 80 * (na + nb - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON s.doc_id = c.a
"""

OP5_SQL = r"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
  regexp_extract(replace(replace(coalesce(url, ''), chr(13), ' '), chr(10), ' '), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)', ['host', 'path']) AS u FROM pages),
hosts AS (SELECT *, lower(u.path) AS path, regexp_replace(lower(regexp_replace(u.host, '^.*@', '')), '^(www[0-9]*|m)[.]', '') AS host FROM hashed),
keyed AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id,
  array_to_string(list_reverse(string_split(split_part(host, ':', 1), '.')), ',') || CASE WHEN host LIKE '%:%' AND regexp_replace(host, '^[^:]*:', '') NOT IN ('', '80', '443') THEN ':' || regexp_replace(host, '^[^:]*:', '') ELSE '' END
    || ')' || CASE WHEN path = '' THEN '/' ELSE path END AS url_key,
  strftime(TIMESTAMP '2024-01-01' + to_microseconds(greatest(-60000000000000000, least(60000000000000000, coalesce(page_id, 0)))), '%Y-%m-%dT%H:%M:%S.%fZ') AS ts FROM hosts)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((((instr('0123456789abcdef', substr(h, CAST(i * 5 // 4 + 1 AS BIGINT), 1)) - 1) * 16
              + (CASE WHEN i * 5 // 4 + 2 > 40 THEN 0 ELSE instr('0123456789abcdef', substr(h, CAST(i * 5 // 4 + 2 AS BIGINT), 1)) - 1 END)) >> CAST(3 - (i * 5) % 4 AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to,
       url_key, ts, row_number() OVER (ORDER BY url_key, ts, page_id) - 1 AS place
FROM keyed
"""

# Of 15 aligned words with two different ones, some five in a row are the same: so five-word runs find all candidates.
OP7_SQL = r"""
WITH docs AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS d FROM documents),
items AS (SELECT item_id, w FROM (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark) WHERE len(w) >= 8),
runs_d AS (SELECT doc_id, p, array_to_string(d[p:p + 4], ' ') AS run FROM (SELECT doc_id, d, unnest(range(1, len(d) - 3)) AS p FROM docs)),
runs_i AS (SELECT item_id, p, array_to_string(w[p:p + 4], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM items)),
hits AS (SELECT DISTINCT doc_id, item_id, a.p - b.p AS shift FROM runs_d a JOIN runs_i b USING (run)),
same AS (SELECT doc_id, item_id, shift, len(w) AS size, list_transform(range(greatest(1, 1 - shift), least(len(w), len(d) - shift) + 1), lambda k: CAST(w[k] = d[k + shift] AS INT)) AS s FROM hits JOIN docs USING (doc_id) JOIN items USING (item_id)),
best AS (SELECT *, list_max(list_transform(range(1, len(s) - least(15, size) + 2), lambda i: list_sum(s[i:i + least(15, size) - 1]))) AS most FROM same WHERE len(s) >= least(15, size)),
found AS (SELECT doc_id, item_id, len(s) AS n_aligned, list_sum(s) AS n_same, greatest(shift, 0) AS first_word FROM best WHERE most >= CASE WHEN size >= 15 THEN 13 ELSE size END)
SELECT doc_id, item_id, CAST(n_aligned AS INT) AS n_aligned, CAST(n_same AS INT) AS n_same, CAST(first_word AS INT) AS first_word FROM found
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_same DESC, n_aligned DESC, first_word) = 1
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = lambda n_chars: "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"
# CRC-32 of the digits of doc_id: each byte is added and eight bits are shifted out.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""


def _tree_sql(name: str, nodes: str) -> str:
    """Levels of the trees over nodes(key, idx, n, digest), from l = 0."""
    return f"""{name} AS (SELECT key, 0 AS l, idx, n, digest FROM {nodes} UNION ALL
  SELECT key, l + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY key, l, idx // 2, n)"""


def _walk_sql(name: str, start: str, tree: str) -> str:
    """Rows of start(id, key, idx, now, proof), up the tree."""
    return f"""{name} AS (SELECT id, key, 0 AS l, idx, now, proof FROM {start} UNION ALL
  SELECT w.id, w.key, w.l + 1, w.idx // 2, sha256(CASE WHEN s.digest IS NULL THEN now WHEN w.idx % 2 = 0 THEN now || s.digest ELSE s.digest || now END), proof || coalesce(s.digest, '')
  FROM {name} w JOIN {tree} m ON m.key = w.key AND m.l = w.l AND m.idx = w.idx AND m.n > 1 LEFT JOIN {tree} s ON s.key = w.key AND s.l = w.l AND s.idx = xor(w.idx, 1))"""


OP11_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS key, {_LEAF("n_chars")} AS digest,
  CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_LEAF("(n_chars + 1)")} ELSE {_LEAF("n_chars")} END AS now FROM documents),
rows AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, digest, id) - 1 AS idx, count(*) OVER (PARTITION BY key) AS n FROM leaves),
{_tree_sql("tree", "rows")},
tops AS MATERIALIZED (SELECT '' AS key, key AS lang, row_number() OVER (ORDER BY key) - 1 AS idx, count(*) OVER () AS n, digest FROM tree WHERE n = 1),
{_tree_sql("top", "tops")},
start AS (SELECT id, key, idx, now, '' AS proof FROM rows), {_walk_sql("walk", "start", "tree")},
arrived AS (SELECT w.id, t.key, t.idx, w.now, w.proof FROM walk w JOIN tree m ON m.key = w.key AND m.l = w.l AND m.n = 1 JOIN tops t ON t.lang = w.key), {_walk_sql("climb", "arrived", "top")},
root AS (SELECT l, digest FROM top WHERE n = 1)
SELECT doc_id, r.digest AS leaf, t.digest AS subroot, root.digest AS root, sha256(c.proof) AS proof_sha256, c.now AS folded_root, c.now = root.digest AS verified
FROM climb c JOIN root ON root.l = c.l JOIN rows r ON r.id = c.id JOIN tops t ON t.lang = r.key
"""

_SQUARE = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - e.v[i]) * (x.v[i] - e.v[i])))"


def _round_sql(i: int) -> str:
    """near{i}: each part's nearest entry of book{i}; book{i + 1}: the entries moved."""
    return f"""near{i} AS MATERIALIZED (SELECT x.id, x.p, min({{'d': {_SQUARE}, 'e': e.e}}) AS m FROM parts x JOIN book{i} e ON e.p = x.p GROUP BY x.id, x.p),
means{i} AS (SELECT p, e, list(mean ORDER BY k) AS v FROM (SELECT p, e, k, CAST(floor(sum(c) / count(*)) AS BIGINT) AS mean
  FROM (SELECT n.p, n.m.e AS e, unnest(range(1, len(v) + 1)) AS k, unnest(v) AS c FROM near{i} n JOIN parts x ON x.id = n.id AND x.p = n.p) GROUP BY p, e, k) GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN means{i} m ON m.p = b.p AND m.e = b.e)"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * c::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS v FROM (SELECT id, unnest(range(4)) AS p, v FROM kept)),
book0 AS MATERIALIZED (SELECT p, id - 1 AS e, v FROM parts WHERE id <= 256),
{", ".join(_round_sql(i) for i in range(4))},
last AS (SELECT x.id, x.p, min({{'d': {_SQUARE}, 'e': e.e}}) AS m FROM parts x JOIN book4 e ON e.p = x.p GROUP BY x.id, x.p),
coded AS (SELECT id, string_agg(printf('%02x', m.e::INT), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM last GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c, ',' ORDER BY p, e)) FROM (SELECT p, e, array_to_string(v, ',') AS c FROM book4)) AS codebooks_sha256
FROM coded JOIN kept USING (id)
"""

ORACLE_SQL = {"op13_vector_codes": OP13_SQL, "op11_merkle": OP11_SQL, "op7_decontaminate": OP7_SQL, "op5_warc": OP5_SQL, "op6_jaccard_join": OP6_SQL, "op3_exact_dedup": OP3_SQL}
