"""Registered queries: scalar functions and record mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import scalars as S, text as X, timecode as TC
from statlake.functions.safe import to_date, to_int
from statlake.operators import mapping as M
from statlake.plans import views as V
from statlake.plans.registered import query
from statlake.schemas import DOMAINS

# --- time codes ------------------------------------------------------------------

_TIME_SQL = """
 SELECT attr_id AS stats_data_id, row_seq, attr_time AS time_original,
  CASE style WHEN 9 THEN 1988 + CAST(regexp_extract(attr_time, '[0-9]+') AS INT) ELSE CAST(regexp_extract(attr_time, '[0-9]{4}') AS INT) END AS time_year,
  CASE style WHEN 2 THEN CAST(attr_time[6:7] AS INT) WHEN 3 THEN CAST(attr_time[5:6] AS INT)
   WHEN 4 THEN CAST(attr_time[6:7] AS INT) WHEN 5 THEN CAST(attr_time[5:6] AS INT) END AS time_month,
  CASE style WHEN 1 THEN CAST(attr_time[6:6] AS INT) WHEN 8 THEN CASE WHEN attr_time LIKE '%H1' THEN 1 ELSE 3 END
   WHEN 2 THEN (CAST(attr_time[6:7] AS INT) + 2) // 3 WHEN 3 THEN (CAST(attr_time[5:6] AS INT) + 2) // 3
   WHEN 4 THEN (CAST(attr_time[6:7] AS INT) + 2) // 3 WHEN 5 THEN (CAST(attr_time[5:6] AS INT) + 2) // 3 END AS time_quarter,
  CASE style WHEN 0 THEN 'year' WHEN 1 THEN 'quarter' WHEN 2 THEN 'month' WHEN 3 THEN 'month' WHEN 4 THEN 'day'
   WHEN 5 THEN 'day' WHEN 6 THEN 'fiscal_year' WHEN 7 THEN 'calendar_year' WHEN 8 THEN 'half_year'
   WHEN 9 THEN 'japanese_year' ELSE 'unknown' END AS time_type,
  CASE style WHEN 0 THEN attr_time || '-01-01'
   WHEN 1 THEN attr_time[1:4] || '-' || lpad(CAST(CAST(attr_time[6:6] AS INT) * 3 - 2 AS VARCHAR), 2, '0') || '-01'
   WHEN 2 THEN attr_time || '-01' WHEN 3 THEN attr_time[1:4] || '-' || attr_time[5:6] || '-01' WHEN 4 THEN attr_time
   WHEN 5 THEN attr_time[1:4] || '-' || attr_time[5:6] || '-' || attr_time[7:8]
   WHEN 6 THEN attr_time[3:6] || '-04-01' WHEN 7 THEN attr_time[1:4] || '-01-01'
   WHEN 8 THEN attr_time[1:4] || CASE WHEN attr_time LIKE '%H1' THEN '-01-01' ELSE '-07-01' END
   WHEN 9 THEN CAST(1988 + CAST(regexp_extract(attr_time, '[0-9]+') AS INT) AS VARCHAR) || '-01-01'
   WHEN 10 THEN attr_time[1:4] || '-01-01' END AS time_sort_key
 FROM (SELECT *, (CAST(split_part(attr_id, '-', 1) AS BIGINT) + CAST(split_part(attr_id, '-', 2) AS BIGINT)) % 12 AS style FROM raw_obs)"""


def timed(spark, sf):
    raw = V.raw_obs(spark, sf).select(F.col("attr_id").alias("stats_data_id"), "row_seq", "attr_time")
    return TC.with_time(raw, "attr_time").drop("attr_time")


@query("x01_parse_time", "raw_obs", _TIME_SQL)
def parse_time(spark, sf):
    return timed(spark, sf)


@query("x02_time_fields", "raw_obs", f"""SELECT time_year, time_quarter, time_sort_key, count(*) AS n
 FROM ({_TIME_SQL}) GROUP BY ALL""")
def time_fields(spark, sf):
    return (timed(spark, sf).groupBy("time_year", "time_quarter", "time_sort_key").agg(F.count("*").alias("n")))


for _name, _where, _cond in [
    ("f05_filter_year_quarter", "time_year = 1998 AND time_quarter = 2", lambda: (F.col("time_year") == 1998) & (F.col("time_quarter") == 2)),
    ("f05_filter_time_type", "time_type = 'fiscal_year'", lambda: F.col("time_type") == "fiscal_year"),
    ("f05_filter_original_code", "time_original = '1998Q2'", lambda: F.col("time_original") == "1998Q2"),
    ("f04_between_sort_keys", "time_sort_key BETWEEN '1997-04-01' AND '1998-03-31'",
     lambda: F.col("time_sort_key").between("1997-04-01", "1998-03-31")),
    ("f03_prefix_of_code", "time_original LIKE '1999%'", lambda: F.col("time_original").startswith("1999")),
]:
    def _time_filter(spark, sf, cond=_cond):
        return timed(spark, sf).filter(cond())
    query(_name, "raw_obs", f"SELECT * FROM ({_TIME_SQL}) WHERE {_where}")(_time_filter)


@query("x03_loose_period", "obs", "SELECT stats_data_id, row_seq, year, quarter, month FROM obs")
def loose_period(spark, sf):
    c = F.col("attr_time")
    return V.raw_obs(spark, sf).select(F.col("attr_id").alias("stats_data_id"), "row_seq", TC.loose_year(c).alias("year"),
                                       TC.loose_quarter(F.coalesce(c, F.lit(""))).alias("quarter"), TC.loose_month(c).alias("month"))


@query("x06_parse_value", "obs", "SELECT stats_data_id, row_seq, value FROM obs")
def parse_value(spark, sf):
    return V.raw_obs(spark, sf).select(F.col("attr_id").alias("stats_data_id"), "row_seq", S.parse_value(F.col("value")).alias("value"))


@query("x07_cast_value", "raw_obs", """SELECT attr_id, row_seq,
  CAST(trunc(TRY_CAST(replace(value, ',', '') AS DOUBLE)) AS INT) AS as_int,
  CASE WHEN regexp_matches(replace(value, ',', ''), '^[+-]?[0-9]+$') THEN TRY_CAST(replace(value, ',', '') AS BIGINT) ELSE CAST(trunc(TRY_CAST(replace(value, ',', '') AS DOUBLE)) AS BIGINT) END AS as_bigint,
  TRY_CAST(replace(value, ',', '') AS DOUBLE) AS as_double, lower(value) IN ('true', '1', 'yes') AS as_boolean, value AS as_string
 FROM raw_obs""")
def cast_value(spark, sf):
    v = F.col("value")
    return V.raw_obs(spark, sf).select("attr_id", "row_seq", *[
        S.cast_value(v, t).alias(f"as_{t.lower()}") for t in ("INT", "BIGINT", "DOUBLE", "BOOLEAN", "STRING")])


@query("x08_scalar_type", "raw_obs", """SELECT kind, count(*) AS n FROM (SELECT CASE
  WHEN regexp_matches(v, '^-?[0-9]+$') THEN 'INT' WHEN regexp_matches(v, '^-?[0-9]+\\.[0-9]+$') THEN 'DOUBLE'
  WHEN regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'TIMESTAMP' ELSE 'STRING' END AS kind
 FROM (SELECT unnest([value, attr_time, attr_area, attr_cat03]) AS v FROM raw_obs)) GROUP BY kind""")
def scalar_type(spark, sf):
    v = V.raw_obs(spark, sf).select(F.explode(F.array("value", "attr_time", "attr_area", "attr_cat03")).alias("v"))
    return v.groupBy(S.infer_scalar_type(F.col("v")).alias("kind")).agg(F.count("*").alias("n"))


@query("x09_normalize_name", "", """SELECT doc_id, CASE WHEN w = '' THEN 'column' ELSE w END AS name FROM (
 SELECT doc_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(source || ' ' || lang || '-' || text, '[^\\x00-\\x7F]+', '', 'g'),
  '[^a-zA-Z0-9_]', '_', 'g')), '_+', '_', 'g'), '_') AS w FROM documents)""")
def normalize_name(spark, sf):
    d = V.table(spark, sf, "documents")
    return d.select("doc_id", S.normalize_name(F.concat("source", F.lit(" "), "lang", F.lit("-"), "text")).alias("name"))


@query("x10_normalize_dimension", "dim_items", """SELECT DISTINCT dim_id, lower(CASE WHEN dim_id LIKE 'cat%' THEN 'category_' || dim_id[4:] ELSE dim_id END) AS field_name,
  CASE WHEN dim_id = 'tab' THEN 'indicator' WHEN regexp_matches(dim_id, '^cat(0[1-9]|10)$') THEN 'category_' || dim_id[4:] ELSE dim_id END AS column_name FROM dim_items""")
def normalize_dimension(spark, sf):
    d = V.dim_items(V.raw_obs(spark, sf), V.area_labels(spark, sf)).select("dim_id").distinct()
    return d.select("dim_id", S.normalize_field(F.concat(F.lit("@"), "dim_id")).alias("field_name"),
                    S.normalize_dimension(F.col("dim_id")).alias("column_name"))


# --- classifiers and scores of titles ---------------------------------------------------

_LANDING = """CASE
  WHEN regexp_matches(lower(title), '人口|世帯|出生|死亡|国勢調査|人口動態') THEN 'population'
  WHEN regexp_matches(lower(title), '労働|雇用|賃金|給与|就業|失業|労働力') THEN 'labor'
  WHEN regexp_matches(lower(title), '教育|学校|学生|生徒|児童|教員|大学') THEN 'education'
  WHEN regexp_matches(lower(title), '保健|医療|患者|病院|診療所|疾病|健康') THEN 'health'
  WHEN regexp_matches(lower(title), '農業|林業|漁業|農林|水産|農家|漁獲') THEN 'agriculture'
  WHEN regexp_matches(lower(title), '建設|建築|住宅|着工|土地|不動産') THEN 'construction'
  WHEN regexp_matches(lower(title), '運輸|輸送|交通|通信|自動車|鉄道|航空') THEN 'transport'
  WHEN regexp_matches(lower(title), '商業|小売|卸売|サービス|飲食|宿泊') THEN 'trade'
  WHEN regexp_matches(lower(title), '福祉|介護|保育|年金|社会保障|生活保護') THEN 'social_welfare'
  WHEN regexp_matches(lower(title), '経済|gdp|産業|企業|事業所|家計|消費|景気') THEN 'economy' ELSE 'generic' END AS landing_domain"""
LANDING_SQL = f"SELECT id, {_LANDING} FROM listing"


@query("x11_classify_listing", "listing", f"""SELECT id, {_LANDING},
 CASE WHEN regexp_matches(title, '人口|国勢調査|世帯') THEN 'population' WHEN regexp_matches(title, '労働|雇用|賃金|就業') THEN 'labor'
  WHEN regexp_matches(title, '経済|GDP|景気|物価|消費') THEN 'economy' WHEN regexp_matches(title, '教育|学校|学生|生徒') THEN 'education'
  WHEN regexp_matches(title, '医療|健康|病院|診療') THEN 'health' WHEN regexp_matches(title, '農業|林業|水産|農林') THEN 'agriculture'
  WHEN regexp_matches(title, '建設|建築|住宅|着工') THEN 'construction' WHEN regexp_matches(title, '運輸|交通|輸送|鉄道|自動車') THEN 'transport'
  WHEN regexp_matches(title, '商業|小売|卸売|貿易') THEN 'trade' WHEN regexp_matches(title, '福祉|介護|年金|社会保障') THEN 'social_welfare'
  ELSE 'generic' END AS listing_domain,
 CASE WHEN regexp_matches(k, '人口|国勢調査') THEN 'population' WHEN regexp_matches(k, '労働|雇用|賃金|勤労') THEN 'labor'
  WHEN regexp_matches(k, '経済|gdp|産業連関|景気') THEN 'economy' WHEN regexp_matches(k, '物価') THEN 'price'
  WHEN regexp_matches(k, '家計|消費|支出') THEN 'household' WHEN regexp_matches(k, '学校|教育|児童|生徒') THEN 'education'
  WHEN regexp_matches(k, '住宅|土地|建物') THEN 'housing' ELSE 'other' END AS catalog_domain,
 CASE WHEN regexp_matches(title, '月次|月報') THEN 'monthly' WHEN title LIKE '%四半期%' THEN 'quarterly'
  WHEN regexp_matches(title, '年次|年報') THEN 'yearly' ELSE 'irregular' END AS update_frequency
 FROM (SELECT *, lower(title) || chr(10) || lower(organization) AS k FROM listing)""")
def classify_listing(spark, sf):
    t = F.col("title")
    return V.listing(spark, sf).select(
        "id", S.landing_domain(t).alias("landing_domain"), S.listing_domain(t).alias("listing_domain"),
        S.catalog_domain(t, F.col("organization")).alias("catalog_domain"), S.update_frequency(t).alias("update_frequency"))


_PRIORITY_SQL = """least(10, 5 + CASE WHEN regexp_matches(title, '基幹統計|基本集計') THEN 3 ELSE 0 END
  + CASE WHEN regexp_matches(title, '月次|四半期|月報') THEN 2 ELSE 0 END + CASE WHEN updated_date >= '2023-01-01' THEN 1 ELSE 0 END)"""


@query("x15_listing_priority", "listing", f"""SELECT id, priority,
  CASE WHEN priority >= 8 THEN 'high' WHEN priority >= 5 THEN 'medium' ELSE 'low' END AS importance
 FROM (SELECT *, CAST({_PRIORITY_SQL} AS INT) AS priority FROM listing)""")
def listing_priority(spark, sf):
    p = V.listing(spark, sf).withColumn("priority", S.listing_priority(F.col("title"), F.col("updated_date")))
    return p.select("id", "priority", S.importance(F.col("priority")).alias("importance"))


SELECTION_SQL = """CAST(greatest(coalesce((TRY_CAST(updated_date[1:4] AS INT) - 2020) * 10, 0), 0)
  + CASE WHEN regexp_matches(lower(title), '全国|総合|全体|全て') THEN 20 ELSE 0 END
  + CASE WHEN regexp_matches(title, '月次|月報') THEN 30 WHEN title LIKE '%四半期%' THEN 20 WHEN regexp_matches(title, '年次|年報') THEN 10 ELSE 0 END AS DOUBLE)"""


@query("x16_selection_score", "listing", f"SELECT id, {SELECTION_SQL} AS score FROM listing")
def selection_score(spark, sf):
    return V.listing(spark, sf).select("id", S.selection_score(F.col("title"), F.col("updated_date")).alias("score"))


CANDIDATE_SQL = """CAST(CASE WHEN regexp_matches(lower(title), '年|月|四半期|時系列|推移') OR regexp_matches(lower(description), '年|月|四半期|時系列|推移') THEN 10 ELSE 0 END
  + CASE WHEN record_count BETWEEN 1000 AND 100000 THEN 5 WHEN record_count >= 100 AND record_count < 1000 THEN 3 WHEN record_count > 100000 THEN 2 ELSE 0 END
  - CASE WHEN record_count < 100 THEN 100 ELSE 0 END - CASE WHEN record_count > 5000 THEN 50 ELSE 0 END
  + CASE WHEN length(title) > 10 AND length(description) > 50 THEN 2 ELSE 0 END AS INT)"""


@query("x17_candidate_score", "listing", f"SELECT id, {CANDIDATE_SQL} AS score FROM listing")
def candidate_score(spark, sf):
    return V.listing(spark, sf).select("id", S.candidate_score(
        F.col("title"), F.col("description"), F.col("record_count"), max_records=5000).alias("score"))


# --- tokens -------------------------------------------------------------------------------

@query("x18_tokens", "listing", """SELECT id, array_to_string(list_sort(list_distinct(list_filter(
  string_split_regex(description, '[、。・ \\t\\n\\r\\f\\v\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'), lambda x: length(x) >= 2))), '|') AS tokens FROM listing""")
def tokens(spark, sf):
    return V.listing(spark, sf).select("id", F.concat_ws("|", F.array_sort(X.tokens(F.col("description")))).alias("tokens"))


@query("x19_simple_keywords", "listing", """SELECT id, array_to_string(list_sort(list_filter(list_distinct(
   list_filter(string_split_regex(title, '[、。・ （）()]+'), lambda x: length(x) BETWEEN 2 AND 20 AND NOT regexp_matches(x, '^[A-Z][0-9]+')) || [organization]),
   lambda x: x NOT IN ('について', 'に関する', 'による', 'など', 'その他', '全国', 'に係る', 'における', 'の', 'を', 'が', 'は', 'で', 'と')))[1:20], '|') AS keywords FROM listing""")
def simple_keywords(spark, sf):
    return V.listing(spark, sf).select("id", F.concat_ws("|", X.simple_keywords(
        [F.col("title")], [F.col("organization")])).alias("keywords"))


@query("x20_text_or_object", "", """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '' ELSE event_type END AS title,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events""")
def text_or_object(spark, sf):
    t = F.col("event_type")
    doc = F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"),
                   F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"TITLE":{"$":"'), t, F.lit('"}')))
                   .when(F.col("event_id") % 3 == 1, F.concat(F.lit(',"TITLE":"'), t, F.lit('"'))).otherwise(""), F.lit("}"))
    v = V.table(spark, sf, "events").select("event_id", F.parse_json(doc).alias("v"))
    return v.select("event_id", S.text_of(F.col("v"), "$.TITLE").alias("title"), F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query("x22_builtin_functions", "listing", """SELECT id, CAST(year(TRY_CAST(updated_date AS DATE)) AS INT) AS y,
  TRY_CAST(substring(updated_date, 1, 4) AS INT) AS year_text, lower(organization) AS org_low,
  CASE WHEN updated_date = '' THEN 'none' ELSE 'dated' END AS dated, coalesce(nullif(updated_date, ''), '1970-01-01') AS filled FROM listing""")
def builtin_functions(spark, sf):
    u = F.col("updated_date")
    return V.listing(spark, sf).select(
        "id", F.year(to_date(u)).alias("y"), to_int(F.substring(u, 1, 4)).alias("year_text"),
        F.lower("organization").alias("org_low"), F.when(u == "", "none").otherwise("dated").alias("dated"),
        F.coalesce(F.nullif(u, F.lit("")), F.lit("1970-01-01")).alias("filled"))


@query("x23_iso_timestamp", "registry", """SELECT dataset_id, CAST(epoch(TRY_CAST(fetch_date AS TIMESTAMP)) AS BIGINT) AS fetched,
  CAST(epoch(TRY_CAST(error_message AS TIMESTAMP)) AS BIGINT) AS none FROM registry""")
def iso_timestamp(spark, sf):
    return V.registry(spark, sf).select("dataset_id", F.unix_timestamp(S.iso_timestamp(F.col("fetch_date"))).alias("fetched"),
                                        F.unix_timestamp(S.iso_timestamp(F.col("error_message"))).alias("none"))


@query("x24_error_type", "error_log", """SELECT event_id, kind, kind IN ('api_error', 'network_error', 'timeout_error', 'storage_error') AS retryable,
  least(1.0 * pow(2, retry_count), 20.0) AS delay_seconds FROM (
 SELECT *, CASE WHEN m LIKE '%timeout%' OR c LIKE '%timeout%' THEN 'timeout_error'
  WHEN m LIKE '%connection%' OR m LIKE '%network%' OR m LIKE '%unreachable%' OR c LIKE '%connectionerror%' THEN 'network_error'
  WHEN m LIKE '%api%' OR c LIKE '%api%' THEN 'api_error'
  WHEN regexp_matches(m, 'json|parse|format|invalid') THEN 'data_error'
  WHEN m LIKE '%validation%' OR c LIKE '%validation%' THEN 'validation_error'
  WHEN regexp_matches(m, 's3|storage|bucket') THEN 'storage_error' ELSE 'unknown_error' END AS kind
 FROM (SELECT *, lower(error_message) AS m, lower(coalesce(error_class, '')) AS c FROM error_log))""")
def error_type(spark, sf):
    e = V.error_log(spark, sf).withColumn("kind", S.error_type(F.col("error_message"), F.col("error_class")))
    return e.select("event_id", "kind", S.is_retryable(F.col("kind")).alias("retryable"),
                    S.retry_delay(F.col("retry_count"), 1.0, 20.0).alias("delay_seconds"))


@query("x26_tags_and_names", "catalog", """SELECT dataset_id, array_to_string(['domain:' || domain, 'source:api', 'official'], '|') AS tags,
  'dataset_' || dataset_id AS dynamic_table, domain || '_data' AS domain_table, 'lake/' || domain || '/' AS location,
  'lake/processed/' || domain || '/' || dataset_id || '.json' AS output_path FROM catalog""")
def tags_and_names(spark, sf):
    d, i = F.col("domain"), F.col("dataset_id")
    return V.catalog(spark, sf).select(
        "dataset_id", F.concat_ws("|", S.tags(d, "api", F.size("column_names"))).alias("tags"),
        S.dynamic_table_name(i).alias("dynamic_table"), S.domain_table_name(d).alias("domain_table"),
        S.table_location("lake", d).alias("location"), S.transformed_path("lake", d, i).alias("output_path"))


# --- record mapping -------------------------------------------------------------------------

def domain_rows(spark, sf, domain):
    labels = V.area_labels(spark, sf) if DOMAINS[domain].label_column else None
    return M.map_domain(V.raw_obs(spark, sf), domain, labels)


def _domain_sql(d) -> str:
    period = f"{d.period}, " if d.period else ""
    label = f"{d.label_column}, " if d.label_column else ""
    dims = ", ".join(f"{raw} AS {c}" for c, raw in d.dimensions)
    return f"SELECT dataset_id, stats_data_id, year, {period}region_code, {label}{dims}, value, unit FROM obs"


for _d in DOMAINS.values():
    def _mapped(spark, sf, domain=_d.name):
        return domain_rows(spark, sf, domain)
    query(f"p_map_{_d.name}", "obs", _domain_sql(_d))(_mapped)


@query("p01_map_mixed_domains", "obs", """SELECT domain, dataset_id, stats_data_id, year,
  CASE WHEN domain = 'trade' THEN quarter END AS quarter, CASE WHEN domain IN ('labor', 'transport') THEN month END AS month, region_code,
  CASE WHEN domain = 'labor' THEN cat02 END AS occupation_code, CASE WHEN domain IN ('labor', 'trade') THEN cat03 WHEN domain = 'transport' THEN cat02 END AS indicator,
  CASE WHEN domain = 'generic' THEN cat01 END AS category, value, unit
 FROM (SELECT *, CASE CAST(dataset_id[3:] AS INT) % 4 WHEN 0 THEN 'labor' WHEN 1 THEN 'trade' WHEN 2 THEN 'transport' ELSE 'generic' END AS domain FROM obs)""")
def map_mixed_domains(spark, sf):
    kind = V.pick(F.substring("dataset_id", 3, 9).cast("int") % 4, ["labor", "trade", "transport", "mystery"])
    return M.map_domains(V.raw_obs(spark, sf), kind).select(
        "domain", "dataset_id", "stats_data_id", "year", "quarter", "month", "region_code", "occupation_code", "indicator",
        "category", "value", "unit")


@query("p13_default_values", "obs", """SELECT stats_data_id AS dataset_id, stats_data_id, year, region_code, cat01 AS category, value, unit FROM obs""")
def default_values(spark, sf):
    return M.map_domain(V.raw_obs(spark, sf).drop("dataset_id"), "no such domain", dataset_id=F.lit(""))


DYNAMIC = [
    {"name": "category_01", "type": "STRING", "source_field": "@cat01"}, {"name": "area", "type": "INT", "source_field": "@area"},
    {"name": "time", "type": "STRING", "source_field": "@time"}, {"name": "value", "type": "DOUBLE", "source_field": "$"},
]


@query("p15_dynamic_projection", "raw_obs", """SELECT dataset_id, attr_id AS record_id, attr_cat01 AS category_01, CAST(attr_area AS INT) AS area,
  attr_time AS time, TRY_CAST(replace(value, ',', '') AS DOUBLE) AS value FROM raw_obs""")
def dynamic_projection(spark, sf):
    return M.transform_dynamic(V.raw_obs(spark, sf), M.dynamic_struct(DYNAMIC))


@query("p16_transform_counts", "raw_obs", """SELECT dataset_id, count(*) AS input_records, count(*) FILTER (CAST(dataset_id[3:] AS INT) % 2 = 1 OR attr_area IS NOT NULL) AS output_records,
 count(*) = count(*) FILTER (CAST(dataset_id[3:] AS INT) % 2 = 1 OR attr_area IS NOT NULL) AS success FROM raw_obs GROUP BY 1""")
def transform_counts(spark, sf):
    """Every second dataset loses its rows without a region on the way."""
    raw = V.raw_obs(spark, sf)
    odd = F.substring("dataset_id", 3, 9).cast("int") % 2 == 1
    return M.transform_results(raw, M.map_domain(raw.filter(odd | F.col("attr_area").isNotNull()), "labor"))


@query("p18_unmapped_fields", "raw_obs", """SELECT dataset_id, CASE WHEN CAST(dataset_id[3:] AS INT) % 2 = 0 THEN 'attr_cat03|attr_cat11|attr_cat12|attr_tab' ELSE 'attr_cat02|attr_cat03|attr_cat11|attr_cat12|attr_tab' END AS unmapped,
 CASE WHEN CAST(dataset_id[3:] AS INT) % 3 = 0 THEN 'region_code' ELSE '' END AS critical_missing FROM raw_obs GROUP BY 1""")
def unmapped_fields(spark, sf):
    """Every second dataset has no second category, every third one no areas."""
    d = F.substring("dataset_id", 3, 9).cast("int")
    raw = V.raw_obs(spark, sf).withColumn("attr_cat02", F.when(d % 2 != 0, F.col("attr_cat02"))).withColumn("attr_area", F.when(d % 3 != 0, F.col("attr_area")))
    out = M.unmapped_fields(raw, ["attr_id", "attr_area", "attr_time", "attr_cat01", "attr_unit", "value"],
                            {"value": "value", "year": "attr_time", "region_code": "attr_area"})
    return out.select("dataset_id", F.concat_ws("|", F.array_sort("unmapped")).alias("unmapped"),
                      F.concat_ws("|", "critical_missing").alias("critical_missing"))


@query("p20_code_and_label", "obs", "SELECT stats_data_id, row_seq, nullif(region_code, '') AS attr_area, region_name FROM obs")
def code_and_label(spark, sf):
    out = M.with_label(V.raw_obs(spark, sf), V.area_labels(spark, sf), "area", "region_name")
    return out.select(F.col("attr_id").alias("stats_data_id"), "row_seq", "attr_area", "region_name")


@query("p21_lineage_columns", "obs", """SELECT dataset_id, year, value, TIMESTAMP '2001-12-31 00:00:00' AS ingested_at, 'v1' AS source_version, 'api/data' AS endpoint FROM obs""")
def lineage_columns(spark, sf):
    out = M.with_lineage(domain_rows(spark, sf, "generic"), "v1", "api/data", F.lit("2001-12-31 00:00:00").cast("timestamp"))
    return out.select("dataset_id", "year", "value", "ingested_at", "source_version", "endpoint")


@query("p22_specific_columns", "obs", "SELECT year, region_code, value FROM obs")
def specific_columns(spark, sf):
    return domain_rows(spark, sf, "population").select("year", "region_code", "value")


@query("s09_dimension_filter", "raw_obs", "SELECT attr_id, row_seq, value FROM raw_obs WHERE attr_area = '00003' AND attr_cat01 = '消費支出'")
def dimension_filter(spark, sf):
    return M.dimension_filter(V.raw_obs(spark, sf), {"area": "00003", "cat01": "消費支出"}).select("attr_id", "row_seq", "value")
