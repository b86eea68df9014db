"""The driver's tables in the shapes of a statistics lake, in Spark and in SQL.

Each view exists twice: as a lazy DataFrame over the whole tables and as the
text of a common table expression for the SQL check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlake.functions.timecode import computed_once
from statlake.session import together

# Titles by document number; the given texts are Latin, so rules on Japanese
# words need titles of their own.
TITLES = [
    ("人口推計（令和2年国勢調査基準） 月次 全国", "population"),
    ("世帯数の推移・基本集計 年次", "population"),
    ("経済センサス-活動調査 総合", "economy"),
    ("家計調査 四半期 消費支出", "economy"),
    ("労働力調査 基本集計 月報", "labor"),
    ("賃金構造基本統計調査 年報", "labor"),
    ("学校基本調査 生徒数", "education"),
    ("患者調査 医療 病院", "health"),
    ("農林業センサス 農業 全体", "agriculture"),
    ("建築着工統計 住宅 四半期", "construction"),
    ("自動車輸送統計 運輸 月次", "transport"),
    ("商業統計 小売・卸売 サービス", "trade"),
    ("福祉行政報告例 介護 基幹統計", "social_welfare"),
    ("消費者物価指数 物価 月報", "generic"),
    ("その他の統計", "generic"),
]
INDICATORS = ["GDP（名目）", "雇用者数", "賃金", "失業率", "患者数", "生産量", "着工件数", "輸送量", "売上高", "利用者数"]
ERRORS = ["Connection timeout after 30s", "Network unreachable", "API quota exceeded", "JSON parse error",
          "Validation failed", "S3 access denied", "unexpected end", "invalid format", "connection reset"]
UPDATED = ["2019-05-01", "2021-03-31", "2022-12-31", "2023-01-01", "2024-06-30", ""]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(index: Column, values: list[str]) -> Column:
    """The value at a position of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def pick_sql(index: str, values: list[str]) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


# --- raw observations --------------------------------------------------------------

def _time_and_value() -> tuple[Column, Column]:
    n, ship, whole = F.col("_n"), F.col("_ship"), F.col("_whole")
    y, m, q = F.year(ship), F.month(ship), F.quarter(ship)
    half = F.when(m <= 6, "1").otherwise("2")
    style = n % 12
    time = (F.when(style == 0, F.date_format(ship, "yyyy"))
            .when(style == 1, F.concat(y.cast("string"), F.lit("Q"), q.cast("string")))
            .when(style == 2, F.date_format(ship, "yyyy-MM"))
            .when(style == 3, F.date_format(ship, "yyyyMM"))
            .when(style == 4, F.date_format(ship, "yyyy-MM-dd"))
            .when(style == 5, F.date_format(ship, "yyyyMMdd"))
            .when(style == 6, F.concat(F.lit("FY"), y.cast("string")))
            .when(style == 7, F.concat(y.cast("string"), F.lit("CY")))
            .when(style == 8, F.concat(y.cast("string"), F.lit("H"), half))
            .when(style == 9, F.concat(F.lit("平成"), (y - 1988).cast("string"), F.lit("年")))
            .when(style == 10, F.concat(y.cast("string"), F.lit("000000"))))
    value = (F.when(n % 17 == 0, "-").when(n % 17 == 1, "")
             .when((n % 5 == 0) & (whole >= 1000), F.concat(
                 F.floor(whole / 1000).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")))
             .when(n % 5 == 1, F.concat(whole.cast("string"), F.lit(".5")))
             .otherwise(whole.cast("string")))
    return time, value


def raw_obs(spark: SparkSession, sf: str) -> DataFrame:
    l, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    placed = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")       # so that items are shuffled once
    joined = l.join(placed, l.l_orderkey == placed.o_orderkey)
    n = F.col("l_orderkey") + F.col("l_linenumber")
    whole, ship = F.floor("l_extendedprice").cast("bigint"), F.col("l_shipdate")
    time, value = _time_and_value()
    raw = joined.select(
        F.concat(F.lit("ds"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("dataset_id"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("attr_id"),
        F.concat_ws("-", F.lpad(F.col("l_partkey").cast("string"), 9, "0"),
                    F.lpad(whole.cast("string"), 9, "0"), F.col("l_quantity").cast("int").cast("string")).alias("row_seq"),
        F.concat(F.lit("T"), (n % 3).cast("string")).alias("attr_tab"),
        F.when(F.col("l_returnflag") == "A", "GDP（名目）").when(F.col("l_returnflag") == "N", "GDP（実質）")
        .otherwise("消費支出").alias("attr_cat01"),
        F.when(F.col("l_linestatus") == "O", "学生数").otherwise("輸送量").alias("attr_cat02"),
        pick((F.col("l_partkey") + F.col("l_linenumber")) % 10, INDICATORS).alias("attr_cat03"),
        F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0").alias("attr_cat11"),
        F.when(n % 4 != 0, F.col("l_quantity").cast("int").cast("string")).alias("attr_cat12"),
        F.when(n % 23 != 0, F.lpad(F.col("c_nationkey").cast("string"), 5, "0")).alias("attr_area"),
        pick(n % 3, ["円", "人", "件"]).alias("attr_unit"),
        n.alias("_n"), ship.alias("_ship"), whole.alias("_whole"))
    return computed_once(raw, [time.alias("attr_time"), value.alias("value")], ("_n", "_ship", "_whole"))


_INDICATOR_SQL = pick_sql("(l_partkey + l_linenumber) % 10", INDICATORS)
RAW_OBS_SQL = f"""raw_obs AS (
 SELECT 'ds' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS dataset_id,
  l_orderkey || '-' || l_linenumber AS attr_id,
  lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR), 9, '0')
   || '-' || CAST(CAST(floor(l_quantity) AS INT) AS VARCHAR) AS row_seq,
  'T' || ((l_orderkey + l_linenumber) % 3) AS attr_tab,
  CASE l_returnflag WHEN 'A' THEN 'GDP（名目）' WHEN 'N' THEN 'GDP（実質）' ELSE '消費支出' END AS attr_cat01,
  CASE l_linestatus WHEN 'O' THEN '学生数' ELSE '輸送量' END AS attr_cat02,
  {_INDICATOR_SQL} AS attr_cat03,
  lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS attr_cat11,
  CASE WHEN (l_orderkey + l_linenumber) % 4 <> 0 THEN CAST(CAST(floor(l_quantity) AS INT) AS VARCHAR) END AS attr_cat12,
  CASE WHEN (l_orderkey + l_linenumber) % 23 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS attr_area,
  CASE (l_orderkey + l_linenumber) % 12
   WHEN 0 THEN strftime(l_shipdate, '%Y')
   WHEN 1 THEN strftime(l_shipdate, '%Y') || 'Q' || quarter(l_shipdate)
   WHEN 2 THEN strftime(l_shipdate, '%Y-%m') WHEN 3 THEN strftime(l_shipdate, '%Y%m')
   WHEN 4 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 5 THEN strftime(l_shipdate, '%Y%m%d')
   WHEN 6 THEN 'FY' || year(l_shipdate) WHEN 7 THEN year(l_shipdate) || 'CY'
   WHEN 8 THEN year(l_shipdate) || 'H' || (CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END)
   WHEN 9 THEN '平成' || (year(l_shipdate) - 1988) || '年'
   WHEN 10 THEN year(l_shipdate) || '000000' END AS attr_time,
  {pick_sql("(l_orderkey + l_linenumber) % 3", ["円", "人", "件"])} AS attr_unit,
  CASE WHEN (l_orderkey + l_linenumber) % 17 = 0 THEN '-' WHEN (l_orderkey + l_linenumber) % 17 = 1 THEN ''
   WHEN (l_orderkey + l_linenumber) % 5 = 0 AND l_extendedprice >= 1000
    THEN (CAST(floor(l_extendedprice) AS BIGINT) // 1000) || ',' || lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
   WHEN (l_orderkey + l_linenumber) % 5 = 1 THEN CAST(floor(l_extendedprice) AS BIGINT) || '.5'
   ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS value
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

# Every mapped column of every domain, computed independently for the check.
OBS_SQL = """obs AS (
 SELECT dataset_id, attr_id AS stats_data_id, row_seq,
  CASE WHEN regexp_matches(attr_time, '[0-9]{4}') THEN CAST(regexp_extract(attr_time, '[0-9]{4}') AS INT) ELSE 2020 END AS year,
  CASE WHEN attr_time LIKE '%Q%' THEN CAST(right(attr_time, 1) AS INT) ELSE 0 END AS quarter,
  CASE WHEN attr_time LIKE '____-__%' THEN CAST(substr(attr_time, 6, 2) AS INT)
       WHEN length(attr_time) IN (6, 8, 10) AND attr_time NOT LIKE 'FY%' AND attr_time NOT LIKE '%Q%' AND attr_time NOT LIKE '%C%'
         AND attr_time NOT LIKE '%H%' AND attr_time NOT LIKE '%年'
       THEN CAST(substr(attr_time, 5, 2) AS INT) ELSE 0 END AS month,
  coalesce(attr_area, '') AS region_code, coalesce(n_name, '') AS region_name,
  attr_cat01 AS cat01, attr_cat02 AS cat02, attr_cat03 AS cat03,
  CASE WHEN value IN ('-', '') THEN 0.0 ELSE CAST(replace(value, ',', '') AS DOUBLE) END AS value,
  attr_unit AS unit
 FROM raw_obs LEFT JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 5, '0') = attr_area)"""


def area_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.lit("area").alias("dimension"), F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"),
        F.col("n_name").alias("label"))


# --- catalog ------------------------------------------------------------------------

def listing(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id")
    return table(spark, sf, "documents").select(
        F.concat(F.lit("doc"), F.lpad(d.cast("string"), 7, "0")).alias("id"),
        pick(d % 15, [t for t, _ in TITLES]).alias("title"),
        F.concat(F.lit("省庁 "), F.col("source")).alias("organization"),
        pick(d % 6, UPDATED).alias("updated_date"), F.col("text").alias("description"),
        F.col("n_chars").alias("record_count"), F.col("doc_id").alias("seq"))


LISTING_SQL = f"""listing AS (
 SELECT 'doc' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS id, {pick_sql("doc_id % 15", [t for t, _ in TITLES])} AS title,
  '省庁 ' || source AS organization, {pick_sql("doc_id % 6", UPDATED)} AS updated_date, text AS description,
  n_chars AS record_count, doc_id AS seq FROM documents)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    from statlake.functions.text import tokens
    d = F.col("doc_id")
    id_ = F.concat(F.lit("doc"), F.lpad(d.cast("string"), 7, "0"))
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    start = F.when(d % 5 != 0, (1990 + d % 20).cast("string"))
    base = table(spark, sf, "documents").withColumn("title", pick(d % 15, [t for t, _ in TITLES]))
    base = base.withColumn("domain", pick(d % 15, [x for _, x in TITLES]))
    return base.select(
        id_.alias("dataset_id"), F.concat(F.lit("dataset_"), id_).alias("table_name"), "title",
        F.col("text").alias("description"), "domain",
        F.array_distinct(F.concat(tokens(F.col("title")), F.array("lang", "source"))).alias("keywords"),
        F.when(d % 3 == 0, words("year", "region_code", "value"))
        .when(d % 3 == 1, words("year", "month", "population", "value"))
        .otherwise(words("indicator", "value")).alias("column_names"),
        F.array(F.concat(F.lit("domain:"), F.col("domain")), F.lit("source:api"), F.lit("official")).alias("tags"),
        F.when(d % 4 == 0, F.array().cast("array<string>")).otherwise(words("year")).alias("partition_fields"),
        (F.col("n_chars") * 100).alias("record_count"), (F.col("n_chars") * 7).alias("data_size_bytes"),
        start.alias("time_range_start"), F.when(d % 5 != 0, (2000 + d % 20).cast("string")).alias("time_range_end"),
        F.when(d % 7 == 0, "failed").when(d % 7 == 1, "pending").otherwise("success").alias("ingestion_status"),
        (d % 50 + F.lit(0.5)).alias("ingestion_duration_seconds"),
        F.timestamp_seconds(F.lit(1546300800) + (d % 1500) * 86400).alias("created_at"),
        (d % 10 + 1).cast("int").alias("priority"), d.alias("seq"))


CATALOG_SQL = f"""catalog AS (
 SELECT 'doc' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS dataset_id,
  'dataset_doc' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS table_name, title, text AS description, domain,
  list_filter(string_split_regex(title, '[、。・ ]+'), lambda x: length(x) >= 2) || [lang, source] AS keywords,
  CASE doc_id % 3 WHEN 0 THEN ['year', 'region_code', 'value'] WHEN 1 THEN ['year', 'month', 'population', 'value']
   ELSE ['indicator', 'value'] END AS column_names,
  ['domain:' || domain, 'source:api', 'official'] AS tags,
  CASE WHEN doc_id % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['year'] END AS partition_fields,
  n_chars * 100 AS record_count, n_chars * 7 AS data_size_bytes,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(1990 + doc_id % 20 AS VARCHAR) END AS time_range_start,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(2000 + doc_id % 20 AS VARCHAR) END AS time_range_end,
  CASE doc_id % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'pending' ELSE 'success' END AS ingestion_status,
  CAST(doc_id % 50 AS DOUBLE) + 0.5 AS ingestion_duration_seconds,
  TIMESTAMP '2019-01-01 00:00:00' + to_days(CAST(doc_id % 1500 AS INT)) AS created_at,
  CAST(doc_id % 10 + 1 AS INT) AS priority, doc_id AS seq
 FROM (SELECT *, {pick_sql("doc_id % 15", [t for t, _ in TITLES])} AS title,
   {pick_sql("doc_id % 15", [x for _, x in TITLES])} AS domain FROM documents))"""


# --- registry and logs ------------------------------------------------------------------

REGISTRY_DOMAINS = ["population", "economy", "labor", "education", "health", "agriculture",
                    "construction", "transport", "trade", "social_welfare", "generic"]


def registry(spark: SparkSession, sf: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")

    def stamp(cond, hours):
        at = F.timestamp_seconds(F.unix_timestamp(day) + F.lit(hours) * 3600 + (k % 50) * 60)
        return F.when(cond, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))

    status = (F.when(k % 7 == 0, "failed").when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "P", "processing").otherwise("pending"))
    base = table(spark, sf, "orders").withColumn("status", status)
    s = F.col("status")
    return base.select(
        F.concat(F.lit("ds"), F.lpad(k.cast("string"), 8, "0")).alias("dataset_id"),
        F.concat(F.lit("dataset "), k.cast("string")).alias("dataset_name"),
        pick(k % 11, REGISTRY_DOMAINS).alias("domain"), "status",
        (k % 10 + 1).cast("int").alias("priority"),
        stamp(s != "pending", 0).alias("fetch_date"), stamp(s.isin("completed", "failed"), 1).alias("transformation_date"),
        stamp((s == "completed") | ((s == "failed") & (k % 2 == 0)), 3).alias("validation_date"),
        stamp((s == "completed") & (k % 13 != 0), 7).alias("load_date"),
        F.date_format(day, "yyyy-MM-dd").alias("added_at"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
        F.when(s == "completed", F.floor("o_totalprice").cast("bigint")).alias("record_count"),
        F.when(s == "failed", pick(k % 9, ERRORS)).alias("error_message"), k.alias("seq"))


REGISTRY_SQL = f"""registry AS (
 SELECT 'ds' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS dataset_id, 'dataset ' || o_orderkey AS dataset_name,
  {pick_sql("o_orderkey % 11", REGISTRY_DOMAINS)} AS domain, status, CAST(o_orderkey % 10 + 1 AS INT) AS priority,
  CASE WHEN status <> 'pending' THEN strftime(at0, '%Y-%m-%dT%H:%M:%S') END AS fetch_date,
  CASE WHEN status IN ('completed', 'failed') THEN strftime(at0 + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') END AS transformation_date,
  CASE WHEN status = 'completed' OR (status = 'failed' AND o_orderkey % 2 = 0)
   THEN strftime(at0 + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') END AS validation_date,
  CASE WHEN status = 'completed' AND o_orderkey % 13 <> 0 THEN strftime(at0 + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') END AS load_date,
  strftime(o_orderdate, '%Y-%m-%d') AS added_at, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS updated_at,
  CASE WHEN status = 'completed' THEN CAST(floor(o_totalprice) AS BIGINT) END AS record_count,
  CASE WHEN status = 'failed' THEN {pick_sql("o_orderkey % 9", ERRORS)} END AS error_message, o_orderkey AS seq
 FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 'failed' WHEN o_orderstatus = 'F' THEN 'completed'
    WHEN o_orderstatus = 'P' THEN 'processing' ELSE 'pending' END AS status,
   o_orderdate + to_minutes(CAST(o_orderkey % 50 AS INT)) AS at0 FROM orders))"""

STAGES = {"signup": "fetch", "click": "transform", "view": "validate", "purchase": "load", "error": "fetch"}
STATUSES = {"signup": "pending", "click": "processing", "view": "processing", "purchase": "completed", "error": "failed"}


def _by_type(values: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("event_type"))


def _by_type_sql(values: dict[str, str]) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def error_log(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        e.alias("event_id"), "ts", F.concat(F.lit("ds"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("dataset_id"),
        _by_type(STAGES).alias("stage_name"), pick(e % 9, ERRORS).alias("error_message"),
        F.when(e % 4 != 0, pick(e % 3, ["ConnectionError", "ValueError", "TimeoutError"])).alias("error_class"),
        (e % 6).cast("int").alias("retry_count"))


ERROR_LOG_SQL = f"""error_log AS (
 SELECT event_id, ts, 'ds' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS dataset_id, {_by_type_sql(STAGES)} AS stage_name,
  {pick_sql("event_id % 9", ERRORS)} AS error_message,
  CASE WHEN event_id % 4 <> 0 THEN {pick_sql("event_id % 3", ["ConnectionError", "ValueError", "TimeoutError"])} END AS error_class,
  CAST(event_id % 6 AS INT) AS retry_count FROM events)"""


def status_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "ts", F.concat(F.lit("ds"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("dataset_id"),
        _by_type(STAGES).alias("stage"), _by_type(STATUSES).alias("status"),
        F.when(F.col("event_type") == "error", pick(F.col("event_id") % 9, ERRORS)).alias("error_message"))


STATUS_EVENTS_SQL = f"""status_events AS (
 SELECT event_id, ts, 'ds' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS dataset_id, {_by_type_sql(STAGES)} AS stage,
  {_by_type_sql(STATUSES)} AS status,
  CASE WHEN event_type = 'error' THEN {pick_sql("event_id % 9", ERRORS)} END AS error_message FROM events)"""


def query_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "ts", F.when(F.col("event_type").isin("view", "click"), "catalog_search").otherwise("sql").alias("test_type"),
        F.col("value").alias("latency_ms"), F.floor(F.col("value") * 1000).cast("bigint").alias("bytes_scanned"))


QUERY_LOG_SQL = """query_log AS (
 SELECT event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN 'catalog_search' ELSE 'sql' END AS test_type,
  value AS latency_ms, CAST(floor(value * 1000) AS BIGINT) AS bytes_scanned FROM events)"""

# --- dimension metadata ---------------------------------------------------------------------

DIMENSIONS = [("tab", "表章項目"), ("cat01", "分類1"), ("cat02", "分類2"), ("cat03", "指標"), ("cat11", "品目"), ("cat12", "数量区分"), ("area", "地域"), ("time", "時間軸（年）")]


def dim_items(raw: DataFrame, labels: DataFrame) -> DataFrame:
    """Dimension items of every dataset: what its observations hold, one row per code."""
    fields = [f"attr_{d}" for d, _ in DIMENSIONS]
    near = together(raw.select("dataset_id", *fields), "dataset_id")
    codes = (near.select("dataset_id", F.posexplode(F.array(*fields)).alias("dim_pos", "code")).filter(F.col("code").isNotNull()).distinct()
             .select("dataset_id", "dim_pos", pick(F.col("dim_pos"), [d for d, _ in DIMENSIONS]).alias("dim_id"),
                     pick(F.col("dim_pos"), [n for _, n in DIMENSIONS]).alias("dim_name"), "code"))
    area = labels.select(F.lit("area").alias("dim_id"), "code", "label")
    return (codes.join(area, ["dim_id", "code"], "left")
            .select("dataset_id", "dim_pos", "dim_id", "dim_name", "code",
                    F.coalesce("label", "code").alias("name"),
                    F.when(F.col("dim_id") == "tab", "円").otherwise("").alias("unit"),
                    F.when(F.col("dim_id") == "cat02", "3").otherwise("1").alias("level")))


DIM_ITEMS_SQL = """dim_items AS (
 SELECT DISTINCT d.dataset_id, d.dim_pos, d.dim_id, d.dim_name, d.code,
  CASE WHEN d.dim_id = 'area' THEN coalesce(n_name, d.code) ELSE d.code END AS name,
  CASE WHEN d.dim_id = 'tab' THEN '円' ELSE '' END AS unit, CASE WHEN d.dim_id = 'cat02' THEN '3' ELSE '1' END AS level
 FROM (""" + " UNION ALL ".join(
    f"SELECT dataset_id, {i} AS dim_pos, '{d}' AS dim_id, '{n}' AS dim_name, attr_{d} AS code FROM raw_obs"
    for i, (d, n) in enumerate(DIMENSIONS)) + """) d
 LEFT JOIN nation ON d.dim_id = 'area' AND lpad(CAST(n_nationkey AS VARCHAR), 5, '0') = d.code
 WHERE d.code IS NOT NULL)"""

SQL_VIEWS = {
    "raw_obs": ([], RAW_OBS_SQL), "obs": (["raw_obs"], OBS_SQL), "listing": ([], LISTING_SQL),
    "catalog": ([], CATALOG_SQL), "registry": ([], REGISTRY_SQL), "error_log": ([], ERROR_LOG_SQL),
    "status_events": ([], STATUS_EVENTS_SQL), "query_log": ([], QUERY_LOG_SQL), "dim_items": (["raw_obs"], DIM_ITEMS_SQL),
}


def with_views(names: str, body: str) -> str:
    """Prefix a SELECT with the views it names (blank-separated), dependencies first."""
    order: list[str] = []

    def add(n):
        for dep in SQL_VIEWS[n][0]:
            add(dep)
        if n not in order:
            order.append(n)
    for n in names.split():
        add(n)
    ctes = ",\n".join(SQL_VIEWS[n][1] for n in order)
    body = body.strip()
    if not order:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
