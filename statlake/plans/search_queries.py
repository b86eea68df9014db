"""Registered queries: catalog, keywords and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import text as X
from statlake.operators import catalog as C, impacts as IM, mapping as M, search as S, substrings as SUB, tfidf as TF
from statlake.operators.ranking import select_diverse
from statlake.plans import views as V
from statlake.plans.mapping_queries import CANDIDATE_SQL, LANDING_SQL, SELECTION_SQL
from statlake.plans.registered import query
from statlake.session import materialise, scratch_path

QUERIES = ["人口 統計", "労働", "経済", "医療 病院", "the", "雇用", "総合データ"]
# What each query expands to, written out for the check: (query, position, word).
EXPANDED = {
    "人口 統計": ["人口 統計", "人口", "統計", "世帯", "国勢調査", "population"],
    "労働": ["労働", "雇用", "就業", "失業", "labor", "employment"],
    "経済": ["経済", "gdp", "景気", "economy"],
    "医療 病院": ["医療 病院", "医療", "病院", "健康", "health"],
    "the": ["the"], "雇用": ["雇用"], "総合データ": ["総合データ"],
}
_EXP_SQL = "q(query_id, query, word_idx, word) AS (VALUES " + ", ".join(
    f"({i}, '{q}', {j}, '{w}')" for i, q in enumerate(QUERIES) for j, w in enumerate(EXPANDED[q])) + ")"
_MATCH = """(lower(title) LIKE '%' || word || '%' OR contains(lower(description), word) OR len(list_filter(keywords, lambda k: contains(lower(k), word))) > 0
 OR len(list_filter(column_names, lambda k: contains(lower(k), word))) > 0 OR len(list_filter(tags, lambda k: contains(lower(k), word))) > 0)"""


def _cscore(w):
    return f"""(CASE WHEN contains(lower(title), {w}) THEN 10.0 ELSE 0 END + CASE WHEN starts_with(lower(title), {w}) THEN 5.0 ELSE 0 END
 + 3.0 * len(list_filter(keywords, lambda k: contains(lower(k), {w}))) + CASE WHEN contains(lower(description), {w}) THEN 2.0 ELSE 0 END
 + 1.0 * len(list_filter(column_names, lambda k: contains(lower(k), {w}))) + CASE WHEN record_count > 10000 THEN 1.0 ELSE 0 END
 + CASE WHEN time_range_start IS NOT NULL THEN 0.5 ELSE 0 END)::DOUBLE"""


def _fscore(w):
    return f"""(CASE WHEN contains(lower(title), {w}) THEN 100.0 ELSE 0 END + CASE WHEN lower(title) = {w} THEN 50.0 ELSE 0 END + CASE WHEN starts_with(lower(title), {w}) THEN 25.0 ELSE 0 END
 + CASE WHEN contains(lower(description), {w}) THEN 50.0 ELSE 0 END + 30.0 * len(list_filter(keywords, lambda k: contains(lower(k), {w})))
 + 10.0 * len(list_filter(column_names, lambda k: contains(lower(k), {w}))) + CASE WHEN record_count > 100000 THEN 20.0 WHEN record_count > 10000 THEN 10.0 WHEN record_count > 1000 THEN 5.0 ELSE 0 END
 + CASE WHEN time_range_start IS NOT NULL THEN 15.0 ELSE 0 END + CASE WHEN len(partition_fields) > 0 THEN 10.0 ELSE 0 END + CASE WHEN ingestion_status = 'success' THEN 5.0 ELSE 0 END)::DOUBLE"""


@query("k05_catalog_search", "catalog", f"SELECT dataset_id, score FROM (SELECT *, {_cscore('word')} AS score FROM (SELECT *, '労働' AS word FROM catalog)) WHERE {_MATCH}")
def catalog_search(spark, sf):
    return S.search_catalog(V.catalog(spark, sf), "労働").select("dataset_id", "score")


@query("f12_filtered_search", "catalog", f"""SELECT dataset_id, score FROM (SELECT *, {_cscore('word')} AS score FROM (SELECT *, 'the' AS word FROM catalog)) WHERE {_MATCH}
 AND domain = 'labor' AND time_range_start >= '1995' AND time_range_end <= '2015' AND record_count >= 50000 AND ingestion_status = 'success' AND list_contains(tags, 'official')""")
def filtered_search(spark, sf):
    return S.search_catalog(V.catalog(spark, sf), "the", domain="labor", start="1995", end="2015", min_records=50000, status="success",
                            tags=["official"]).select("dataset_id", "score")


@query("k06_expand_queries", "listing", """SELECT id, array_to_string(list_sort(list_distinct([title] || list_filter(string_split(title, ' '), lambda t: length(t) >= 2)
  || CASE WHEN contains(title, '人口') THEN ['人口', '世帯', '国勢調査', 'population'] ELSE [] END || CASE WHEN contains(title, '労働') THEN ['労働', '雇用', '就業', '失業', 'labor', 'employment'] ELSE [] END
  || CASE WHEN contains(title, '経済') THEN ['経済', 'GDP', '景気', 'economy'] ELSE [] END || CASE WHEN contains(title, '医療') THEN ['医療', '健康', '病院', 'health'] ELSE [] END
  || CASE WHEN contains(title, '農業') THEN ['農業', '農家', 'agriculture'] ELSE [] END || CASE WHEN contains(title, '商業') THEN ['商業', '小売', 'commerce'] ELSE [] END)), '|') AS words FROM listing""")
def expand_queries(spark, sf):
    return V.listing(spark, sf).select("id", F.concat_ws("|", F.array_sort(X.expand_query(F.col("title")))).alias("words"))


_HITS = f"""{_EXP_SQL}, m AS (SELECT q.query_id, q.query, q.word_idx, q.word, c.* FROM q JOIN catalog c ON ingestion_status = 'success' AND {_MATCH}
  QUALIFY row_number() OVER (PARTITION BY query_id, dataset_id ORDER BY word_idx) = 1)"""


@query("k07_expanded_search", "catalog", f"WITH {_HITS} SELECT query_id, query, dataset_id, word_idx, word FROM m")
def expanded_search(spark, sf):
    return S.expanded_matches(V.catalog(spark, sf), QUERIES).select("query_id", "query", "dataset_id", "word_idx", "word")


_RANKED = f"""{_HITS}, r AS (SELECT query_id, query, dataset_id, title, {_fscore('lower(query)')} AS score, {_cscore('word')} AS ws, word_idx, seq FROM m),
 s AS (SELECT query_id, query, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, word_idx, ws DESC, seq) AS INT) AS rank, dataset_id, title, score FROM r)"""


@query("k09_search", "catalog", f"WITH {_RANKED} SELECT * FROM s WHERE rank <= 20")
def search(spark, sf):
    return S.search(V.catalog(spark, sf), QUERIES)


@query("k09_filtered_search", "catalog", f"WITH {_RANKED.replace('c ON ingestion', 'c ON c.domain = ' + chr(39) + 'labor' + chr(39) + ' AND record_count >= 50000 AND ingestion')} SELECT * FROM s WHERE rank <= 5")
def search_filtered(spark, sf):
    return S.search(V.catalog(spark, sf), QUERIES, 5, domain="labor", min_records=50000)


def indexed(spark, sf):
    path = scratch_path(spark, "substrings")
    SUB.build(V.catalog(spark, sf), SUB.CATALOG_FIELDS, path)
    return path


def query_table(spark, queries=QUERIES):
    return spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")


@query("k05_indexed_search", "catalog", f"SELECT dataset_id, score FROM (SELECT *, {_cscore('word')} AS score FROM (SELECT *, '労働' AS word FROM catalog)) WHERE {_MATCH}")
def indexed_catalog_search(spark, sf):
    return SUB.search_word(spark, indexed(spark, sf), "労働").select("dataset_id", "score")


@query("k07_indexed_matches", "catalog", f"WITH {_HITS} SELECT query_id, query, dataset_id, word_idx, word FROM m")
def indexed_matches(spark, sf):
    hits = SUB.expanded_matches(spark, indexed(spark, sf), query_table(spark), SUB.CATALOG_FIELDS)
    first = hits.groupBy("query_id", "query", "dataset_id").agg(F.min(F.struct("word_idx", "word")).alias("w"))
    return first.select("query_id", "query", "dataset_id", "w.word_idx", "w.word")


@query("k09_indexed_search", "catalog", f"WITH {_RANKED} SELECT * FROM s WHERE rank <= 20")
def indexed_search(spark, sf):
    return SUB.search(spark, indexed(spark, sf), query_table(spark))


@query("k34_indexed_phrases", "catalog", """SELECT w.word, dataset_id FROM catalog JOIN (SELECT DISTINCT lower(substr(description, 1, 24)) AS word FROM catalog) w
 ON contains(lower(description), w.word) WHERE length(w.word) = 24""")
def indexed_phrases(spark, sf):
    """Many phrases at once: the beginnings of all descriptions, looked for in all descriptions."""
    path, c = scratch_path(spark, "substrings"), V.catalog(spark, sf)
    SUB.build(c.select("dataset_id", "description"), ["description"], path)
    words = c.select(F.lower(F.substring("description", 1, 24)).alias("word")).filter(F.length("word") == 24)
    return SUB.containing(spark, path, words, ["description"]).select("word", "dataset_id")


_TOP3 = "(SELECT list(domain || '関連データ' ORDER BY n DESC, s) FROM (SELECT domain, count(*) AS n, min(seq) AS s FROM catalog GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 3))"


_SUGGESTED = f"""CASE query_id WHEN 0 THEN '世帯|国勢調査|人口動態|人口推計|人口統計' WHEN 1 THEN '雇用|就業|失業率|賃金' WHEN 2 THEN 'GDP|景気動向|物価|消費'
  WHEN 3 THEN '病院|患者|医療費|健康' WHEN 6 THEN '統計データ|調査データ|集計データ' ELSE array_to_string({_TOP3}, '|') END AS suggestions"""
_QUERY_ROWS = f"(VALUES {', '.join(f"({i}, '{q}')" for i, q in enumerate(QUERIES))}) v(query_id, query)"


@query("k10_suggestions", "catalog", f"SELECT query_id, query, {_SUGGESTED} FROM {_QUERY_ROWS}")
def suggestions(spark, sf):
    return S.suggestions(V.catalog(spark, sf), QUERIES).withColumn("suggestions", F.concat_ws("|", "suggestions"))


@query("k09_suggest_when_few", "catalog", f"""WITH {_RANKED}, h AS (SELECT query_id AS hq, count(*) AS n FROM s WHERE rank <= 20 GROUP BY 1)
 SELECT query_id, query, coalesce(h.n, 0) AS hits, {_SUGGESTED} FROM {_QUERY_ROWS} LEFT JOIN h ON query_id = hq WHERE coalesce(h.n, 0) < 3""")
def suggest_when_few(spark, sf):
    c = V.catalog(spark, sf)
    found = S.search(c, QUERIES)
    few = S.suggestions(c, QUERIES, found)
    hits = found.groupBy("query_id").agg(F.count("*").alias("n"))
    return few.join(hits, "query_id", "left").select("query_id", "query", F.coalesce("n", F.lit(0)).alias("hits"), F.concat_ws("|", "suggestions").alias("suggestions"))


_KEYWORDS_SQL = """SELECT id, array_to_string(list_transform(list_sort(list_transform(list_filter(list_distinct(t || list_filter(list_transform(t, lambda w: CASE w
   WHEN '医療' THEN 'healthcare' WHEN '病院' THEN 'hospital' WHEN '農業' THEN 'agriculture' WHEN '住宅' THEN 'housing' WHEN '運輸' THEN 'transport'
   WHEN '小売' THEN 'retail' WHEN '介護' THEN 'care' WHEN '月次' THEN 'monthly' WHEN '四半期' THEN 'quarter' END), lambda w: w IS NOT NULL)),
   lambda w: length(w) BETWEEN 2 AND 20 AND w NOT IN ('について', 'に関する', 'による', 'など', 'その他', '全国', '都道府県', '市区町村', 'に係る', 'における', 'に関して')),
  lambda w: {'s': -(CASE WHEN contains(lower(title), lower(w)) THEN 15 ELSE 0 END + CASE WHEN length(w) BETWEEN 3 AND 6 THEN 5 WHEN length(w) BETWEEN 2 AND 8 THEN 3 ELSE 1 END
   + CASE WHEN w IN ('人口', '経済', '労働', '教育', '医療', '農業', '建設', '運輸', '商業', '福祉') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(w, '^[\\x00-\\x7F]*$') THEN 2 ELSE 0 END), 'w': w}))[1:15],
  lambda s: s.w), '|') AS keywords
 FROM (SELECT *, list_distinct(list_filter(string_split_regex(title, '[、。・ ]+'), lambda x: length(x) >= 2) || [organization]) AS t FROM listing)"""


@query("k11_extract_keywords", "listing", _KEYWORDS_SQL)
def extract_keywords(spark, sf):
    return C.keyword_column(V.listing(spark, sf)).select("id", F.concat_ws("|", "keywords").alias("keywords"))


@query("k14_keyword_quality", "catalog", """SELECT dataset_id, round_even(coverage, 2) AS coverage, round_even(relevance, 2) AS relevance, round_even(diversity, 2) AS diversity,
  round_even((coverage + relevance + diversity) / 3, 2) AS overall FROM (SELECT dataset_id,
   len(list_filter(t, lambda w: len(list_filter(keywords, lambda k: contains(lower(k), w))) > 0)) / len(t) AS coverage,
   len(list_filter(keywords, lambda k: contains(lower(title), lower(k)))) / len(keywords) AS relevance,
   least(len(list_distinct(string_split(array_to_string(keywords, ''), ''))) / 50.0, 1.0)::DOUBLE AS diversity
  FROM (SELECT *, list_distinct(list_filter(string_split_regex(lower(title), '[、。・ ]+'), lambda x: length(x) >= 2)) AS t FROM catalog))""")
def keyword_quality(spark, sf):
    return V.catalog(spark, sf).select("dataset_id", X.keyword_quality(F.col("title"), F.col("keywords")).alias("q")).select("dataset_id", "q.*")


@query("j09_english_synonyms", "catalog", """SELECT dataset_id, keyword, english FROM (SELECT dataset_id, unnest(keywords) AS keyword FROM catalog)
 JOIN (VALUES ('医療', 'healthcare'), ('病院', 'hospital'), ('農業', 'agriculture'), ('住宅', 'housing'), ('運輸', 'transport'), ('小売', 'retail'), ('介護', 'care'), ('月次', 'monthly'), ('四半期', 'quarter')) e(keyword, english) USING (keyword)""")
def english_synonyms(spark, sf):
    return C.english_synonyms(V.catalog(spark, sf).select("dataset_id", F.explode("keywords").alias("keyword")))


@query("k01_register_entries", "catalog listing", """SELECT doc.dataset_id, c.title, 'dataset_' || doc.dataset_id AS table_name, l.landing_domain AS domain, c.record_count, len(c.column_names) AS columns,
  len(list_distinct(list_filter(string_split_regex(c.title, '[、。・ ]+') || string_split_regex(c.description, '[、。・ \\t\\n\\r\\f\\v\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: length(x) >= 2))) AS keywords
 FROM catalog doc JOIN catalog c USING (dataset_id) JOIN (""" + LANDING_SQL + """) l ON l.id = doc.dataset_id""")
def register_entries(spark, sf):
    c = V.catalog(spark, sf)
    listing = c.select("dataset_id", "title", "description")
    stats = c.select("dataset_id", "time_range_start", "time_range_end", "record_count")
    out = C.catalog_entries(listing, stats, c.select("dataset_id", "column_names"), "api")
    return out.select("dataset_id", "title", "table_name", "domain",
                      "record_count", F.size("column_names").cast("bigint").alias("columns"), F.size("keywords").cast("bigint").alias("keywords"))


@query("k02_extended_entries", "raw_obs", """SELECT dataset_id, max(attr_cat01) AS title, 'attr_area' AS partition_fields, count(*) FILTER (attr_area IS NULL) AS null_areas, count(DISTINCT attr_area) AS distinct_areas,
 CASE WHEN count(*) FILTER (attr_area IS NULL) > 0 THEN 'failed' ELSE 'success' END AS ingestion_status FROM raw_obs GROUP BY 1""")
def extended_entries(spark, sf):
    """Null and distinct counts of every dataset's columns, its partition and its status from the raw rows."""
    raw = V.raw_obs(spark, sf)
    cells = raw.select("dataset_id", F.explode(F.array(*[F.struct(F.lit(x).alias("column"), F.col(x).alias("v")) for x in ("attr_area", "attr_cat01")])).alias("x"))
    values = cells.groupBy("dataset_id", "x.column", "x.v").agg(F.count("*").alias("n"))
    profile = materialise(values.groupBy("dataset_id", "column").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"), F.count("v").alias("distinct_count")), "profile")
    schema = profile.select("dataset_id", F.col("column").alias("name"), (F.col("column") == "attr_area").alias("is_partition"))
    runs = profile.filter("column = 'attr_area'").select("dataset_id", F.when(F.col("null_count") > 0, "failed").alias("ingestion_status"))
    entries = raw.groupBy("dataset_id").agg(F.max("attr_cat01").alias("title"))
    out = C.extended_entries(entries, schema, profile, runs)
    return out.select("dataset_id", "title", F.concat_ws("|", "partition_fields").alias("partition_fields"),
                      F.try_element_at("null_counts", F.lit("attr_area")).alias("null_areas"),
                      F.try_element_at("distinct_counts", F.lit("attr_area")).alias("distinct_areas"), "ingestion_status")


@query("k01_replace_by_id", "catalog", """SELECT dataset_id, CASE WHEN priority = 3 THEN 'new title' ELSE title END AS title FROM catalog UNION ALL SELECT 'x' || dataset_id, title FROM catalog WHERE priority = 4""")
def replace_by_id(spark, sf):
    c = V.catalog(spark, sf).select("dataset_id", "title", "priority")
    new = c.filter("priority = 3").withColumn("title", F.lit("new title")).unionByName(
        c.filter("priority = 4").withColumn("dataset_id", F.concat(F.lit("x"), "dataset_id")))
    return C.upsert(c, new).select("dataset_id", "title")


@query("k03_update_status", "catalog", """SELECT dataset_id, CASE WHEN priority = 2 THEN 'failed' ELSE ingestion_status END AS ingestion_status,
  CASE WHEN priority = 2 THEN 'late' END AS ingestion_error FROM catalog""")
def update_status(spark, sf):
    c = V.catalog(spark, sf)
    changes = c.filter("priority = 2").select("dataset_id", F.lit("failed").alias("ingestion_status"), F.lit("late").alias("ingestion_error"))
    extra = spark.createDataFrame([("unknown", "failed", "late")], changes.schema)
    old = materialise(c, "catalog")
    return materialise(C.update_columns(old, changes.unionByName(extra)), "catalog").select("dataset_id", "ingestion_status", "ingestion_error")


@query("k15_catalog_statistics", "catalog", """SELECT 'status' AS "group", ingestion_status AS name, count(*)::DOUBLE AS value FROM catalog GROUP BY 2 UNION ALL SELECT 'domain', domain, count(*) FROM catalog GROUP BY 2
 UNION ALL SELECT 'total', 'datasets', count(*) FROM catalog UNION ALL SELECT 'total', 'records', sum(record_count) FROM catalog UNION ALL SELECT 'total', 'bytes', sum(data_size_bytes) FROM catalog
 UNION ALL SELECT 'total', 'mean_duration_seconds', avg(ingestion_duration_seconds) FROM catalog""")
def catalog_statistics(spark, sf):
    return C.statistics(V.catalog(spark, sf))


@query("k16_search_statistics", "catalog", """SELECT count(*) AS total_datasets, count(*) FILTER (ingestion_status = 'success') AS searchable_datasets, avg(len(keywords)) AS avg_keywords_per_dataset FROM catalog""")
def search_statistics(spark, sf):
    return S.search_statistics(V.catalog(spark, sf))


@query("k18_catalog_summary", "catalog", "SELECT domain, count(*) AS datasets, CAST(sum(record_count) AS BIGINT) AS total_records, count(time_range_start) / count(*) AS share_with_time_range FROM catalog GROUP BY 1")
def catalog_summary(spark, sf):
    return C.summary(V.catalog(spark, sf))


_LISTED = """SELECT id, domain, priority, CASE WHEN priority >= 8 THEN 'high' WHEN priority >= 5 THEN 'medium' ELSE 'low' END AS importance, update_frequency FROM (SELECT id,
 CASE WHEN regexp_matches(title, '人口|国勢調査|世帯') THEN 'population' WHEN regexp_matches(title, '労働|雇用|賃金|就業') THEN 'labor'
  WHEN regexp_matches(title, '経済|GDP|景気|物価|消費') THEN 'economy' WHEN regexp_matches(title, '教育|学校|学生|生徒') THEN 'education'
  WHEN regexp_matches(title, '医療|健康|病院|診療') THEN 'health' WHEN regexp_matches(title, '農業|林業|水産|農林') THEN 'agriculture'
  WHEN regexp_matches(title, '建設|建築|住宅|着工') THEN 'construction' WHEN regexp_matches(title, '運輸|交通|輸送|鉄道|自動車') THEN 'transport'
  WHEN regexp_matches(title, '商業|小売|卸売|貿易') THEN 'trade' WHEN regexp_matches(title, '福祉|介護|年金|社会保障') THEN 'social_welfare' ELSE 'generic' END AS domain,
 CAST(least(10, 5 + CASE WHEN regexp_matches(title, '基幹統計|基本集計') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(title, '月次|四半期|月報') THEN 2 ELSE 0 END
  + CASE WHEN updated_date >= '2023-01-01' THEN 1 ELSE 0 END) AS INT) AS priority,
 CASE WHEN regexp_matches(title, '月次|月報') THEN 'monthly' WHEN title LIKE '%四半期%' THEN 'quarterly' WHEN regexp_matches(title, '年次|年報') THEN 'yearly' ELSE 'irregular' END AS update_frequency FROM listing)"""


def classified(spark, sf):
    return C.listing_catalog(V.listing(spark, sf))


@query("k19_listing_catalog", "listing", _LISTED)
def listing_catalog(spark, sf):
    return classified(spark, sf).select("id", "domain", "priority", "importance", "update_frequency")


@query("k20_listing_summary", "listing", f"""SELECT 'domain' AS "group", domain AS name, count(*) AS count FROM ({_LISTED}) GROUP BY 2 UNION ALL
 SELECT 'importance', importance, count(*) FROM ({_LISTED}) GROUP BY 2 UNION ALL SELECT 'update_frequency', update_frequency, count(*) FROM ({_LISTED}) GROUP BY 2""")
def listing_summary(spark, sf):
    return C.listing_summary(classified(spark, sf))


@query("f17_work_batch", "listing", f"SELECT id, priority, domain FROM ({_LISTED}) WHERE importance = 'high' AND domain = 'labor' AND priority >= 9 ORDER BY priority DESC, id LIMIT 25")
def work_batch(spark, sf):
    return C.work_batch(classified(spark, sf), 25, importance="high", domain="labor", priority_min=9).select("id", "priority", "domain")


@query("f21_work_batch_lists", "listing", f"""SELECT l.id, priority, size_category FROM ({_LISTED}) l JOIN (SELECT id, CASE WHEN record_count > 5000 THEN 'large' WHEN record_count > 1000 THEN 'medium' ELSE 'small' END AS size_category
  FROM listing) s USING (id) WHERE priority IN (5, 6, 10) AND size_category IN ('small', 'large') ORDER BY priority DESC, id LIMIT 40""")
def work_batch_lists(spark, sf):
    n = F.col("record_count")
    c = classified(spark, sf).withColumn("size_category", F.when(n > 5000, "large").when(n > 1000, "medium").otherwise("small"))
    return C.work_batch(c, 40, priorities=[5, 6, 10], size_categories=["small", "large"]).select("id", "priority", "size_category")


_DOMAIN_HITS = "h AS (SELECT l.*, d.* FROM listing l JOIN (VALUES " + ", ".join(
    f"({i}, '{d}', '{'|'.join(ws)}')" for i, (d, ws) in enumerate(__import__("statlake.rules", fromlist=["x"]).DOMAIN_SEARCH_KEYWORDS)) + \
    ") d(ds, domain, pattern) ON regexp_matches(l.title, d.pattern))"


@query("k21_select_for_domains", "listing", f"""WITH {_DOMAIN_HITS}, s AS (SELECT domain, id, title, {SELECTION_SQL} AS score FROM h), t AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, id) AS rn FROM s)
 SELECT domain, id, title, score, CAST(max(rn) OVER (PARTITION BY domain) - rn + 1 AS INT) AS priority FROM t WHERE rn <= 3""")
def select_for_domains(spark, sf):
    return C.select_for_domains(V.listing(spark, sf))


@query("k23_candidate_selection", "listing", f"""WITH {_DOMAIN_HITS}, c AS (SELECT id AS dataset_id, domain, ds, {CANDIDATE_SQL} AS priority, seq FROM h QUALIFY row_number() OVER (PARTITION BY domain ORDER BY priority DESC, seq) <= 20),
 s AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY priority DESC, ds, seq) AS rn, first_value((-priority, ds, seq)) OVER (PARTITION BY domain ORDER BY priority DESC, ds, seq) AS lead FROM c),
 a0 AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY ds, rn) AS dup FROM s WHERE rn <= greatest(1, 35 // (SELECT count(DISTINCT domain) FROM c))),
 a AS (SELECT dataset_id, priority, 1 AS stage, row_number() OVER (ORDER BY lead, rn) AS pos FROM a0 WHERE dup = 1 ORDER BY lead, rn LIMIT 35),
 b AS (SELECT dataset_id, priority, 2 AS stage, row_number() OVER (ORDER BY priority DESC, ds, seq) AS pos FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY priority DESC, ds, seq) = 1) WHERE dataset_id NOT IN (SELECT dataset_id FROM a))
 SELECT dataset_id, priority, stage FROM (SELECT * FROM a UNION ALL SELECT * FROM b) ORDER BY stage, pos LIMIT 35""")
def candidate_selection(spark, sf):
    return select_diverse(C.selection_candidates(V.listing(spark, sf), max_records=5000), 35).select("dataset_id", "priority", "stage")


@query("k28_preview", "catalog", "SELECT dataset_id, title FROM catalog WHERE domain = 'labor' AND ingestion_status = 'success' ORDER BY dataset_id LIMIT 1000")
def preview(spark, sf):
    return C.preview(V.catalog(spark, sf), {"domain": "labor", "ingestion_status": "success"}).select("dataset_id", "title")


@query("k34_by_explanation", "catalog", "SELECT dataset_id, title FROM catalog WHERE contains(description, 'tion')")
def by_explanation(spark, sf):
    return S.by_explanation(V.catalog(spark, sf), "tion")


@query("k35_two_step", "catalog", """SELECT dataset_id, title, time_range_start FROM catalog WHERE (contains(title, '労働') OR len(list_filter(keywords, lambda k: contains(k, '労働'))) > 0) AND time_range_start >= '2000'""")
def two_step(spark, sf):
    c = V.catalog(spark, sf)
    return S.two_step(S.light_catalog(c), c, "労働", F.col("time_range_start") >= "2000").select("dataset_id", "title", "time_range_start")


@query("s34_light_catalog", "catalog", "SELECT dataset_id, title, domain, array_to_string(keywords, '|') AS keywords, record_count, time_range_start, time_range_end FROM catalog")
def light_catalog(spark, sf):
    return S.light_catalog(V.catalog(spark, sf)).withColumn("keywords", F.concat_ws("|", "keywords"))


# --- text and vectors ----------------------------------------------------------------

def _search_text():
    return F.concat_ws(" ", "title", F.concat_ws(" ", "keywords"), F.concat_ws(" ", "column_names"))


_GRAMS = """ch AS (SELECT k, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i FROM docs),
 sq AS (SELECT k, i, c, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, lead(c, 3) OVER w AS c3 FROM ch WINDOW w AS (PARTITION BY k ORDER BY i)),"""
_TFIDF_SQL = f"""WITH docs AS (SELECT dataset_id AS k, lower(concat_ws(' ', title, array_to_string(keywords, ' '), array_to_string(column_names, ' '))) AS t FROM catalog), {_GRAMS}
 g AS (SELECT k, c || c1 AS gram FROM sq WHERE c1 IS NOT NULL UNION ALL SELECT k, c || c1 || c2 FROM sq WHERE c2 IS NOT NULL),
 tf AS (SELECT k, gram, count(*) AS tf FROM g GROUP BY ALL), idf AS (SELECT gram, ln((1 + (SELECT count(*) FROM catalog)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1),
 w AS (SELECT k, gram, tf * idf AS w, idf FROM tf JOIN idf USING (gram)),
 q AS (SELECT gram, count(*) * any_value(idf) AS qw FROM (SELECT unnest(['労働', '働力', '力調', '調査', '労働力', '働力調', '力調査']) AS gram) JOIN idf USING (gram) GROUP BY gram),
 r AS (SELECT k AS dataset_id, sum(w * qw) / (sqrt(any_value(l)) * (SELECT sqrt(sum(qw * qw)) FROM q)) AS s FROM w JOIN q USING (gram) JOIN (SELECT k, sum(w * w) AS l FROM w GROUP BY 1) USING (k) GROUP BY 1)"""


def _tfidf(spark, sf, k):
    return TF.tfidf_search(V.catalog(spark, sf), "dataset_id", _search_text(), "労働力調査", k)


_TFIDF_TOP = _TFIDF_SQL + """ SELECT CAST(row_number() OVER (ORDER BY round(s, 9) DESC, dataset_id) AS INT) AS rank, dataset_id, round(s, 6) AS score
 FROM r ORDER BY rank LIMIT 100"""


@query("k24_tfidf_search", "catalog", _TFIDF_TOP)
def tfidf_search(spark, sf):
    path = scratch_path(spark, "index")
    TF.build_index(V.catalog(spark, sf).select("dataset_id", _search_text().alias("text")), "dataset_id", F.col("text"), path)
    hits = TF.search_index(spark, path, "dataset_id", "労働力調査", 100)
    return hits.withColumn("score", F.round("score", 6))


@query("k24_ranked_loads", "catalog", _TFIDF_TOP)
def ranked_loads(spark, sf):
    """Entries ingested are indexed first, all others in a second load; ranked as one index."""
    path, c = scratch_path(spark, "impacts"), V.catalog(spark, sf)
    done = F.col("ingestion_status").eqNullSafe("success")
    for load in (c.filter(done), c.filter(~done)):
        IM.add(load, "dataset_id", _search_text(), path)
    return IM.search(spark, path, "dataset_id", "労働力調査", 100).withColumn("score", F.round("score", 6))


@query("k25_tfidf_keywords", "catalog", f"""WITH docs AS (SELECT dataset_id AS k, regexp_replace(lower(title || ' ' || description), '[\\s\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]{{2,}}', ' ', 'g') AS t FROM catalog), {_GRAMS}
 g AS (SELECT k, c || c1 AS gram FROM sq WHERE c1 IS NOT NULL UNION ALL SELECT k, c || c1 || c2 FROM sq WHERE c2 IS NOT NULL UNION ALL SELECT k, c || c1 || c2 || c3 FROM sq WHERE c3 IS NOT NULL),
 tf AS (SELECT k, gram, count(*) AS tf FROM g GROUP BY ALL), v AS (SELECT gram, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1000),
 w AS (SELECT k, gram, tf * (ln((1 + (SELECT count(*) FROM catalog)) / (1 + df)) + 1) AS w FROM tf JOIN v USING (gram))
 SELECT k AS dataset_id, CAST(row_number() OVER (PARTITION BY k ORDER BY w DESC, gram) AS INT) AS rank, gram, round(w, 6) AS w FROM w QUALIFY rank <= 10""")
def tfidf_keywords(spark, sf):
    text = F.concat_ws(" ", "title", "description")
    return TF.tfidf_keywords(V.catalog(spark, sf), "dataset_id", text).withColumn("w", F.round("w", 6))


@query("k26_vector_search", "", """WITH m AS (SELECT list(a ORDER BY i) AS q FROM (SELECT i, avg(x::DOUBLE) AS a FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1))
 SELECT vec_id, round(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), q), 9) AS score FROM embeddings, m ORDER BY list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), q) DESC, vec_id LIMIT 20""")
def vector_search(spark, sf):
    v = V.table(spark, sf, "embeddings")
    return S.vector_search(v, S.mean_vector(v), 20).withColumn("score", F.round("score", 9))


@query("k27_hybrid_fusion", "catalog", """WITH a AS (SELECT dataset_id, row_number() OVER (ORDER BY record_count DESC, dataset_id) AS rank FROM catalog), b AS (SELECT dataset_id, row_number() OVER (ORDER BY data_size_bytes % 997, dataset_id) AS rank FROM catalog)
 SELECT dataset_id, CAST(sum(s) AS BIGINT) AS score FROM (SELECT dataset_id, 2 * (21 - rank) AS s FROM a WHERE rank <= 20 UNION ALL SELECT dataset_id, 21 - rank FROM b WHERE rank <= 20) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def hybrid_fusion(spark, sf):
    from statlake.operators.ranking import top_per_group
    c = V.catalog(spark, sf).withColumn("g", F.lit(0))
    a = top_per_group(c, ["g"], [F.desc("record_count"), "dataset_id"], 20, "rank")
    b = top_per_group(c, ["g"], [F.asc(F.col("data_size_bytes") % 997), F.asc("dataset_id")], 20, "rank")
    return S.fuse(a, b, "dataset_id", 10)
