"""Registered queries of this package, each over its whole table, and the SQL they are checked with."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm import (chat, codebooks, decontamination, lexical, line_dedup, mixing, neighbours, quality, secret_scan, sharding, simhash, toxicity,
                          url_filter)
from statlake.llm.common import LOWER, UPPER, table

SHARDS = 24
#: Appended to the conversations: control strings inside texts.
TRIAL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_link_graph_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, secret_scan.is_kind(*secret_scan.BASE))
    counts = [F.size(F.filter(spans, secret_scan.is_kind(k))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.joined(spans).alias("spans"))


def op3_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_incremental_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trial = spark.createDataFrame(TRIAL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(trial)))


def op5_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_winnowed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_sha256")


def op8_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_member_resident_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codebooks.compressed(table(spark, sf_dir, "embeddings"))
    return codebooks.with_label_error(coded).select(
        "vec_id", codebooks.hex_code(F.col("code")).alias("code"), "error", "label_error", F.lit(codebooks.digest(books)).alias("codebooks_sha256"))


def op13_perfect_hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_link_graph_url_filter, op2_blob_ledger_secrets, op3_lpt_shards, op4_incremental_chat_format, op5_pivotal_mix,
        op6_simhash_components, op7_winnowed_decontamination, op8_one_bit_neighbours, op9_lexicon_toxicity,
        op10_positive_unlabelled_quality, op11_nra_search, op12_member_resident_codes, op13_perfect_hash_lines)
}


def _url_sql(damping: float = 0.85, threshold: float = 0.5) -> str:
    host = "coalesce(translate(regexp_extract(CASE WHEN {u} LIKE '%://%' THEN substr({u}, strpos({u}, '://') + 3) END, '^([^/?#]*)', 1), '" \
        + UPPER + "', '" + LOWER + "'), '')"
    page_host = host.format(u="url")
    path = "coalesce(regexp_extract(CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END, '^[^/?#]*([^?#]*)', 1), '')"
    keep = 1 - damping
    rounds = math.ceil(math.log(1e-10) / math.log(damping))                # what is still on its way then is below the query's tolerance
    return f"""
WITH RECURSIVE parsed AS MATERIALIZED (SELECT page_id, {page_host} AS host, {path} AS path, html FROM pages),
judged AS MATERIALIZED (
  SELECT page_id, host, path, html,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parsed),
ruled AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS rule_verdict FROM judged),
seeds AS MATERIALIZED (
  SELECT host, count(*) FILTER (rule_verdict = 'allow') / count(*) * {keep}::DOUBLE AS t, count(*) FILTER (rule_verdict = 'block') / count(*) * {keep}::DOUBLE AS d
  FROM ruled WHERE host <> '' GROUP BY host),
links AS (
  SELECT src, dst, count(*) AS links FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1)), '{UPPER}', '{LOWER}') AS dst
    FROM parsed) WHERE src <> '' AND src <> dst GROUP BY src, dst),
edges AS MATERIALIZED (SELECT src, dst, links / sum(links) OVER (PARTITION BY src) * {damping}::DOUBLE AS part FROM links),
hosts AS MATERIALIZED (SELECT h.host AS host, coalesce(t, 0) AS t, coalesce(d, 0) AS d
  FROM (SELECT host FROM seeds UNION SELECT src FROM edges UNION SELECT dst FROM edges) h LEFT JOIN seeds ON h.host = seeds.host),
moves AS MATERIALIZED (
  SELECT host AS src, host AS dst, 0::DOUBLE AS give, 0::DOUBLE AS earn, t, d FROM hosts
  UNION ALL SELECT src, dst, part, 0, 0, 0 FROM edges UNION ALL SELECT dst, src, 0, part, 0, 0 FROM edges),
s(i, host, t, d) AS (
  SELECT 0, host, t, d FROM hosts
  UNION ALL SELECT s.i + 1, m.dst, sum(m.t + m.give * s.t), sum(m.d + m.earn * s.d) FROM s JOIN moves m ON s.host = m.src WHERE s.i < {rounds} GROUP BY s.i, m.dst),
last AS MATERIALIZED (SELECT host, t, d FROM s WHERE i = {rounds})
SELECT page_id, r.host AS host, path, rule, coalesce(rule_verdict, CASE WHEN d > t AND d >= {threshold}::DOUBLE * {keep}::DOUBLE THEN 'block' END, 'allow') AS verdict
FROM ruled r LEFT JOIN last s ON r.host = s.host"""


def _secret_sql() -> str:
    parts = []
    for rule in secret_scan.RULES:
        pattern = rule.pattern.replace("'", "''")
        if rule.kind == "access":
            pattern = "AKIA[A-Z0-9]+"
        if rule.kind == "hex":
            pattern = "[0-9a-f]+"
        parts.append(f"""
  SELECT doc_id, '{rule.kind}' AS kind, {rule.order} AS kind_order, {rule.least} AS least, string_split_regex(t, '{pattern}') AS pieces,
    regexp_extract_all(t, '{pattern}', 0) AS found, regexp_extract_all(t, '{pattern}', {rule.group}) AS tested
  FROM d WHERE regexp_matches(t, '{rule.pattern.replace("'", "''")}')""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({' UNION ALL '.join(parts)}),
each AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM raw),
spans AS (
  SELECT doc_id, kind, kind_order, length(found[i]) AS n,
    list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
  FROM each WHERE length(tested[i]) >= least),
text_of AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS s FROM spans),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(s, ',' ORDER BY start, kind_order) FILTER (kind IN ('assign', 'access', 'hex')), '') AS base,
    string_agg(s, ',' ORDER BY start, kind_order) AS spans
  FROM text_of GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc USING (doc_id)"""


def _chat_sql() -> str:
    trial = ", ".join("({}, {}, '{}', '{}')".format(*row) for row in TRIAL_CONVERSATION)

    def escaped(column: str) -> str:
        return f"length(regexp_replace({column}, '(\\\\|<</SYS>>|<<SYS>>|\\[/INST\\]|\\[INST\\]|</role>|<role:|</s>|<s>)', '\\1_', 'g'))"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {trial}))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({escaped('text')} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 14 + {escaped('role')} + length(role) - length(replace(role, '>', '')) END) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


def _contamination_sql() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{decontamination.WORD}')"
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, {words} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, ws, least(len(ws), {decontamination.LENGTH}) AS n
          FROM (SELECT item_id, {words} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
dw AS (
  SELECT doc_id, i AS start, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
met AS MATERIALIZED (SELECT doc_id, start, dw.n AS n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(start, start + n)) AS pos FROM (SELECT DISTINCT doc_id, start, n FROM met)) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM met GROUP BY doc_id)
SELECT w.doc_id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id LEFT JOIN found ON w.doc_id = found.doc_id"""


_NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

_LINES_SQL = f"""
WITH l AS MATERIALIZED (
  SELECT rn, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT rn, doc_id, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
        FROM (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
often AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {line_dedup.LEAST_CHARS}
          GROUP BY key HAVING count(DISTINCT rn) >= {line_dedup.LEAST_DOCS}),
judged AS (SELECT rn, l.doc_id AS doc_id, pos, line, often.key IS NOT NULL AND l.doc_id IS DISTINCT FROM keeper AS dropped
           FROM l LEFT JOIN often ON l.key = often.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY rn, doc_id"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_SEARCH_SQL = f"""
WITH d AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER () AS dn, doc_id, {_TERMS} AS ts FROM documents) WHERE len(ts) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS words FROM d),
tf AS MATERIALIZED (SELECT dn, t, count(*) AS tf FROM (SELECT dn, unnest(ts) AS t FROM d) GROUP BY dn, t),
asked AS (SELECT DISTINCT itn, item_id, t FROM (SELECT itn, item_id, unnest(ts) AS t FROM (
  SELECT row_number() OVER () AS itn, item_id, {_TERMS} AS ts FROM benchmark))),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY t, docs),
m AS (SELECT dn, doc_id, 100 - 50 + ((50 * len(ts) * docs) // words) AS m FROM d, whole),
scored AS (
  SELECT itn, item_id, tf.dn AS dn, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN tf ON asked.t = tf.t JOIN weight ON asked.t = weight.t JOIN m ON tf.dn = m.dn GROUP BY itn, item_id, tf.dn, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY itn ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= {lexical.K}"""


def _codes_sql(parts: int = codebooks.PARTS, entries: int = codebooks.ENTRIES, rounds: int = codebooks.ROUNDS) -> str:
    gap = "list_inner_product(p.part, p.part) - 2 * list_inner_product(p.part, b.part) + list_inner_product(b.part, b.part)"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT rn, pos, CAST(best[1] AS BIGINT) AS error, CAST(best[2] AS BIGINT) AS idx
  FROM (SELECT rn, p.pos AS pos, min([{gap}, CAST(idx AS DOUBLE)]) AS best FROM p JOIN b{i} b ON p.pos = b.pos GROUP BY rn, p.pos))""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT b.pos AS pos, b.idx AS idx, coalesce(m.part, b.part) AS part FROM b{i} b LEFT JOIN (
    SELECT pos, idx, list(floor(total / n) ORDER BY k) AS part FROM (
      SELECT pos, idx, k, sum(x) AS total, count(*) AS n
      FROM (SELECT a.pos AS pos, a.idx AS idx, unnest(p.part) AS x, generate_subscripts(p.part, 1) AS k FROM a{i} a JOIN p ON a.rn = p.rn AND a.pos = p.pos)
      GROUP BY pos, idx, k) GROUP BY pos, idx) m ON b.pos = m.pos AND b.idx = m.idx)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
    list_transform(embedding, lambda x: floor({codebooks.SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (
  SELECT rn, pos, e[pos * (len(e) // {parts}) + 1:(pos + 1) * (len(e) // {parts})] AS part FROM (SELECT *, unnest(range({parts})) AS pos FROM v)),
b0 AS MATERIALIZED (SELECT pos, rn - 1 AS idx, part FROM p WHERE rn <= {entries}),
{', '.join(x.strip() for x in steps)},
coded AS (
  SELECT vec_id, label, code, error FROM v JOIN (
    SELECT rn, string_agg(lower(lpad(hex(idx), 2, '0')), '' ORDER BY pos) AS code, CAST(sum(error) AS BIGINT) AS error FROM a{rounds} GROUP BY rn) c ON v.rn = c.rn),
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY pos, idx, k)) AS h
  FROM (SELECT pos, idx, unnest(part) AS x, generate_subscripts(part, 1) AS k FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, books"""


ORACLES = {
    "op1_link_graph_url_filter": _url_sql(),
    "op2_blob_ledger_secrets": _secret_sql(),
    "op4_incremental_chat_format": _chat_sql(),
    "op7_winnowed_decontamination": _contamination_sql(),
    "op8_one_bit_neighbours": _NEAREST_SQL,
    "op11_nra_search": _SEARCH_SQL,
    "op12_member_resident_codes": _codes_sql(),
    "op13_perfect_hash_lines": _LINES_SQL,
}
