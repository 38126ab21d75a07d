"""Registered queries of the operators: each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.llm import bpe, bytenet, chat, collocations, licenses, linededup, minhash, mtree, packing, quality, repair, secrets, urlfilter
from mediamix.llm.common import table

Q, S = {}, {}


def query(function):
    Q[function.__name__] = function
    return function


@query
def op2_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary)


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    return secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", *(f"secrets.{f}" for f in fields))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "quality.*")


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat.history_of_rows(table(spark, sf_dir, "conversations")).unionByName(chat.history_of_rows(chat.probe(spark)))
    return chat.digests(chat.format_log(log, order=chat.HISTORY_ORDER))


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op1_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "dedup.*")


@query
def op9_packing(spark: SparkSession, sf_dir: str, vocabulary: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)


@query
def op7_bytenet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = bytenet.train(docs, table(spark, sf_dir, "labels"))
    return bytenet.classify(docs, network, keep=["doc_id"]).select("doc_id", "quality.*")


@query
def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), every=50)


S["op3_mtree"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths; a document stands at source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", "text", path.alias("path")))


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, sf_dir, "conversations"))


S["op11_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(3988292384::BIGINT, x >> 1) ELSE x >> 1 END, c)) AS t
), keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ord(substr(key, i, 1))::BIGINT), lambda x, b: xor(t[(xor(x, b) & 255) + 1], x >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0)
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content FROM damaged
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    CASE WHEN content = '' THEN 'b' WHEN again > 1 THEN 'd' WHEN right(content, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS place FROM seen
), neighbours AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM placed
), summed AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM neighbours GROUP BY conv_id
), walk AS (
  SELECT conv_id, n AS place, {'c': 0, 'e': ''} AS o0, {'c': 6, 'e': 'II'} AS o1, {'c': 3, 'e': 'I'} AS o2, {'c': 0, 'e': ''} AS o3 FROM summed
  UNION ALL
  SELECT conv_id, place, list_min([b0, {'c': b2.c + 3, 'e': 'I' || b2.e}, {'c': b3.c + 6, 'e': 'II' || b3.e}]), list_min([b1, {'c': b2.c + 3, 'e': 'I' || b2.e}, {'c': b3.c + 6, 'e': 'II' || b3.e}]),
    list_min([b2, {'c': b3.c + 3, 'e': 'I' || b3.e}]), list_min([b3, {'c': b2.c + 3, 'e': 'I' || b2.e}])
  FROM (
    SELECT w.conv_id, w.place - 1 AS place,
      list_min([{'c': o0.c + 4, 'e': 'D' || o0.e}, {'c': o2.c + 3 + x, 'e': 'R' || o2.e}, {'c': CASE initial WHEN 's' THEN o1.c WHEN 'u' THEN o2.c ELSE 999999 END + x, 'e': 'K' || CASE initial WHEN 's' THEN o1.e ELSE o2.e END}]) AS b0,
      list_min([{'c': o1.c + 4, 'e': 'D' || o1.e}, {'c': o2.c + 3 + x, 'e': 'R' || o2.e}, {'c': CASE initial WHEN 'u' THEN o2.c ELSE 999999 END + x, 'e': 'K' || o2.e}]) AS b1,
      list_min([{'c': o2.c + 4, 'e': 'D' || o2.e}, {'c': o3.c + 3 + x, 'e': 'R' || o3.e}, {'c': CASE initial WHEN 'a' THEN o3.c ELSE 999999 END + x, 'e': 'K' || o3.e}]) AS b2,
      list_min([{'c': o3.c + 4, 'e': 'D' || o3.e}, {'c': o2.c + 3 + x, 'e': 'R' || o2.e}, {'c': CASE initial WHEN 'u' THEN o2.c ELSE 999999 END + x, 'e': 'K' || o2.e}]) AS b3
    FROM walk w JOIN (SELECT *, CASE fault WHEN 't' THEN 3 WHEN '' THEN 0 ELSE 999999 END AS x FROM placed) p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.place = w.place
  )
), solved AS (SELECT conv_id, CAST(o0.c AS BIGINT) AS cost, o0.e AS audit FROM walk WHERE place = 0
), edits AS (
  SELECT conv_id, i, audit[i] AS edit, length(replace(audit[1:i], 'I', '')) AS place FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS i FROM solved)
), kept AS (
  SELECT e.conv_id, e.i, e.edit, p.role, p.initial, p.text FROM edits e LEFT JOIN placed p ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.place = e.place AND e.edit <> 'I' WHERE e.edit <> 'D'
), counted AS (
  SELECT *, sum(CASE WHEN edit = 'K' AND initial = 's' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS nth FROM kept
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS whole FROM counted GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN summed s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN solved v ON v.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, urlfilter.RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


# The given pages declare no canonical links or refreshes; edges of those are held against brute force in the tests.
S["op13_urlfilter"] = r"""
WITH RECURSIVE split AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM split
), own AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, coalesce(query, '') AS query FROM parts
), plain AS (
  SELECT *, CASE WHEN regexp_matches(host, '^(www|m)\.[^.]+\.') THEN regexp_replace(host, '^(www|m)\.', '') ELSE host END AS plain_host,
    regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') AS plain_path,
    array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_\w*|ref|fbclid|gclid)(=|$)'))), '&') AS plain_query FROM own
), addresses AS (
  SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS a, plain_host || plain_path || CASE WHEN plain_query <> '' THEN '?' || plain_query ELSE '' END AS b FROM plain
), rules(rule_verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), places AS (
  SELECT DISTINCT a AS node, host, path FROM addresses WHERE host <> '' UNION SELECT DISTINCT b, plain_host, plain_path FROM addresses WHERE host <> ''
), fits AS (
  SELECT host, path, rule_host || rule_path AS rule, rule_verdict FROM (SELECT DISTINCT host, path FROM places), rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule_verdict, rule) = 1
), links AS (
  SELECT DISTINCT a, b FROM addresses WHERE host <> '' UNION SELECT DISTINCT b, a FROM addresses WHERE host <> ''
), reach AS (
  SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), spread AS (
  SELECT r.node FROM reach r JOIN places p ON p.node = r.other LEFT JOIN fits f ON f.host = p.host AND f.path = p.path
  GROUP BY r.node HAVING bool_or(rule_verdict = 'block') AND NOT coalesce(bool_or(rule_verdict = 'allow'), false)
)
SELECT page_id, d.host, d.path, rule, coalesce(rule_verdict, CASE WHEN d.host <> '' AND a IN (SELECT node FROM spread) THEN 'block' ELSE 'allow' END) AS verdict
FROM addresses d LEFT JOIN fits f ON f.host = d.host AND f.path = d.path
"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


S["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1
), found AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)
), f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM found GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1)
), scored AS (
  SELECT c.*, p.f AS l, q.f AS r, n, CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = x JOIN f q ON q.lang = c.lang AND q.phrase = y JOIN sizes s ON s.lang = c.lang
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i:j], ' ') AS phrase
  FROM (SELECT lang, a, m, string_split(phrase, ' ') AS w, i, unnest(range(i + 1, m + 1)) AS j
        FROM (SELECT lang, f AS a, m, phrase, unnest(range(1, m)) AS i FROM f WHERE m > 2)) WHERE j - i + 1 < m
), kept AS (
  SELECT * FROM worst w WHERE NOT EXISTS (SELECT 1 FROM inner_parts i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.a >= 100 * w.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


S["op6_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized AS (
  SELECT *, len(regexp_extract_all(text, '\\|<\||</?s>|\[/?INST\]|<</?SYS>>')) AS escapes FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + length(text) + escapes + 11) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

S["op10_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), listed AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END AS s FROM words
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(x) AS h FROM (SELECT doc_id, unnest(s) AS x FROM listed)
), sizes AS MATERIALIZED (
  SELECT d.doc_id, count(h) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY 1
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * p.n >= 85 * (s.n + t.n - p.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN roots USING (doc_id)
"""
