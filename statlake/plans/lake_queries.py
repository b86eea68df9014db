"""Registered queries: schema inference, landed data, sinks and tables, jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from statlake.functions import scalars as S, timecode as TC
from statlake.operators import analytics as A, infer as I, mapping as M, registry as G, search as SE
from statlake.plans import jobs as J, views as V
from statlake.plans.mapping_queries import domain_rows
from statlake.plans.registered import query
from statlake.plans.search_queries import classified
from statlake.session import materialise, scratch_path
from statlake.sources import facts as FA, keyed as KT, landing as L, sinks as W
from statlake.streaming import incremental as U



def fresh(name: str) -> str:
    """Table name of its own, so that repeated runs in one session do not meet."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


# --- schema inference ---------------------------------------------------------------------

_VALUES = """fv AS (SELECT DISTINCT dataset_id, f.field, f.v FROM raw_obs, LATERAL (VALUES ('$', value), ('@id', attr_id), ('@tab', attr_tab), ('@cat01', attr_cat01), ('@cat02', attr_cat02), ('@cat03', attr_cat03), ('@cat11', attr_cat11), ('@cat12', attr_cat12),
   ('@area', attr_area), ('@time', attr_time), ('@unit', attr_unit)) f(field, v) WHERE f.v IS NOT NULL),
 vt AS (SELECT dataset_id, field, count(*) AS distinct_values, count(*) FILTER (k = 'I') AS i, count(*) FILTER (k = 'B') AS b, count(*) FILTER (k = 'D') AS d, count(*) FILTER (k = 'T') AS t FROM (
   SELECT *, CASE WHEN regexp_matches(trim(v), '^-?0[0-9]+$') THEN 'S' WHEN regexp_matches(trim(v), '^-?[0-9]{1,18}$') THEN CASE WHEN CAST(trim(v) AS BIGINT) BETWEEN -2147483648 AND 2147483647 THEN 'I' ELSE 'B' END
     WHEN regexp_matches(trim(v), '^-?[0-9]+\\.[0-9]+$') THEN 'D' WHEN lower(trim(v)) IN ('true', 'false') THEN 'T' ELSE 'S' END AS k FROM fv) GROUP BY ALL),
 ty AS (SELECT dataset_id, field, distinct_values, CASE WHEN i = distinct_values THEN 'INT' WHEN i + b = distinct_values THEN 'BIGINT' WHEN i + b + d = distinct_values THEN 'DOUBLE' WHEN t = distinct_values THEN 'BOOLEAN' ELSE 'STRING' END AS type FROM vt)"""


@query("i02_type_vote", "raw_obs", f"WITH {_VALUES} SELECT dataset_id, field, type FROM ty")
def type_vote(spark, sf):
    return I.voted_types(I.field_values(V.raw_obs(spark, sf), repeated=True))


def data_schema(spark, sf):
    return I.schema_from_data(V.raw_obs(spark, sf))


@query("i01_schema_from_data", "raw_obs", f"""WITH {_VALUES}, c AS (SELECT dataset_id, field, CASE WHEN field = '$' THEN 'value' WHEN field LIKE '@cat%' THEN 'category_' || field[5:] ELSE field[2:] END AS name,
   CASE WHEN field = '$' THEN 'DOUBLE' WHEN field = '@area' THEN 'STRING' ELSE type END AS type, distinct_values, row_number() OVER (PARTITION BY dataset_id ORDER BY field) + 2 AS position FROM ty),
 r AS (SELECT *, CASE WHEN name = 'time' THEN 1 WHEN name = 'area' THEN 2 WHEN distinct_values BETWEEN 10 AND 1000 THEN 3 END AS prio FROM c)
 SELECT dataset_id, CAST(position AS INT) AS position, name, type, true AS nullable, field AS source_field, prio IS NOT NULL AND row_number() OVER (PARTITION BY dataset_id ORDER BY prio NULLS LAST, position) <= 2 AS is_partition FROM r
 UNION ALL SELECT DISTINCT dataset_id, p.i, p.n, 'STRING', false, NULL, false FROM raw_obs, (VALUES (1, 'dataset_id'), (2, 'record_id')) p(i, n)""")
def schema_from_data(spark, sf):
    return data_schema(spark, sf).drop("description")


def items(spark, sf):
    return V.dim_items(V.raw_obs(spark, sf), V.area_labels(spark, sf)).withColumn("item_pos", F.col("code"))


_META_COLS = """m AS (SELECT dataset_id, dim_pos, dim_id, dim_name, bool_and(regexp_matches(code, '^(0|[1-9][0-9]{0,17})$')) AS digits, max(TRY_CAST(code AS BIGINT)) AS top FROM dim_items GROUP BY ALL),
 n AS (SELECT dataset_id, dim_id, count(*) AS items FROM dim_items GROUP BY ALL),
 d AS (SELECT m.*, items, dim_id = 'time' OR (dim_id = 'area' AND items BETWEEN 10 AND 1000) AS cand, row_number() OVER (PARTITION BY dataset_id ORDER BY dim_pos) + 2 AS position FROM m JOIN n USING (dataset_id, dim_id)),
 s AS (SELECT dataset_id, CAST(position AS INT) AS position, CASE WHEN dim_id = 'tab' THEN 'indicator' WHEN regexp_matches(dim_id, '^cat(0[1-9]|10)$') THEN 'category_' || dim_id[4:] ELSE dim_id END AS name,
  CASE WHEN dim_id IN ('time', 'area') THEN 'STRING' WHEN digits THEN CASE WHEN top > 2147483647 THEN 'BIGINT' ELSE 'INT' END ELSE 'STRING' END AS type, '@' || dim_id AS source_field,
  cand AND sum(CASE WHEN cand THEN 1 ELSE 0 END) OVER (PARTITION BY dataset_id ORDER BY dim_pos) <= 2 AS is_partition FROM d
  UNION ALL SELECT dataset_id, CAST(max(position) + 1 AS INT), 'value', 'DOUBLE', '$', false FROM d GROUP BY 1
  UNION ALL SELECT DISTINCT dataset_id, p.i, p.n, 'STRING', NULL, false FROM dim_items, (VALUES (1, 'dataset_id'), (2, 'record_id')) p(i, n))"""


@query("i04_schema_from_metadata", "dim_items", f"WITH {_META_COLS} SELECT * FROM s")
def schema_from_metadata(spark, sf):
    return I.schema_from_metadata(items(spark, sf)).drop("nullable", "description")


@query("i08_schema_checks", "dim_items", f"""WITH {_META_COLS} SELECT dataset_id, count(*) AS column_count, count(*) FILTER (is_partition) AS partition_count,
 CASE WHEN count(*) FILTER (is_partition) = 0 THEN 'no partition columns' ELSE '' END AS issues, count(*) FILTER (is_partition) > 0 AS valid FROM s GROUP BY 1""")
def schema_checks(spark, sf):
    return I.check_schema(I.schema_from_metadata(items(spark, sf))).withColumn("issues", F.concat_ws("|", "issues"))


@query("i07_adaptive_partitions", "obs", """SELECT dataset_id, count(DISTINCT region_code) AS regions, count(DISTINCT year) AS years, CASE WHEN count(DISTINCT region_code) > 100 THEN '' WHEN count(DISTINCT region_code) = 1 THEN 'year'
 WHEN count(DISTINCT region_code) * count(DISTINCT year) <= 100 THEN 'year,region_code' ELSE 'year' END AS partition_by FROM obs GROUP BY 1""")
def adaptive_partitions(spark, sf):
    return I.adaptive_partitions(domain_rows(spark, sf, "generic"))


def metadata_docs(spark, sf):
    """One metadata envelope (JSON text) per dataset, in the landed form: a dimension with one item is a lone object."""
    it = V.dim_items(V.raw_obs(spark, sf), V.area_labels(spark, sf))
    one = F.struct(F.col("code").alias("@code"), F.col("name").alias("@name"), F.col("unit").alias("@unit"), F.col("level").alias("@level"))
    dim = it.groupBy("dataset_id", "dim_pos", "dim_id", "dim_name").agg(F.sort_array(F.collect_list(one)).alias("c"))
    text = F.concat(F.lit('{"@id":"'), "dim_id", F.lit('","@name":"'), "dim_name", F.lit('","CLASS":'),
                    F.when(F.size("c") == 1, F.to_json(F.get("c", F.lit(0)))).otherwise(F.to_json("c")), F.lit("}"))
    docs = dim.select("dataset_id", F.struct("dim_pos", text.alias("t")).alias("d")).groupBy("dataset_id").agg(F.sort_array(F.collect_list("d")).alias("d"))
    objects = F.concat_ws(",", F.transform("d", lambda x: x["t"]))
    return docs.select("dataset_id", F.concat(
        F.lit('{"GET_META_INFO":{"METADATA_INF":{"TABLE_INF":{"@id":"'), "dataset_id", F.lit('","TITLE":{"$":"労働力調査 '), "dataset_id",
        F.lit('"},"STAT_NAME":{"$":"労働力調査"},"GOV_ORG":"総務省","SURVEY_DATE":202001,"STATISTICS_NAME_SPEC":{"TABULATION_CATEGORY":"基本集計"}},"CLASS_INF":{"CLASS_OBJ":['),
        objects, F.lit("]}}}}")).alias("doc"))


@query("i09_dimension_items", "dim_items", "SELECT dataset_id, CAST(dim_pos AS INT) AS dim_pos, dim_id, dim_name, code, name, unit, level FROM dim_items")
def dimension_items(spark, sf):
    return I.dimension_items(metadata_docs(spark, sf)).drop("item_pos")


@query("i09_dimension_summary", "dim_items", """SELECT dataset_id, CAST(dim_pos AS INT) AS dim_pos, dim_id, dim_name, count(*) AS item_count, count(*) FILTER (name <> '') AS named_items, count(*) FILTER (unit <> '') AS items_with_unit
 FROM dim_items GROUP BY ALL""")
def dimension_summary(spark, sf):
    return I.dimension_summary(I.dimension_items(metadata_docs(spark, sf)))


@query("i10_table_info", "raw_obs", """SELECT DISTINCT dataset_id, dataset_id AS id, '労働力調査' AS stat_name, '総務省' AS gov_org, '労働力調査 ' || dataset_id AS title, '202001' AS survey_date, '' AS cycle, '基本集計' AS category FROM raw_obs""")
def table_info(spark, sf):
    return I.table_info(metadata_docs(spark, sf)).select("dataset_id", "id", "stat_name", "gov_org", "title", "survey_date", "cycle",
                                                         F.col("statistics_name_spec.tabulation_category").alias("category"))


_SUMMARY = """y AS (SELECT dataset_id, min(y) AS start_year, max(y) AS end_year, count(*) AS year_count FROM (SELECT dataset_id, TRY_CAST(regexp_extract(code, '^[0-9]{4}') AS INT) AS y FROM dim_items WHERE dim_id = 'time') WHERE y BETWEEN 1900 AND 2100 GROUP BY 1),
 p AS (SELECT dataset_id, count(*) AS n, string_agg(name, '|' ORDER BY code) AS names FROM dim_items WHERE dim_id = 'area' GROUP BY 1),
 t AS (SELECT dataset_id, string_agg(name, '|' ORDER BY dim_pos, code) AS indicators FROM (SELECT * FROM dim_items WHERE dim_id IN ('tab', 'cat01') AND NOT regexp_matches(name, '^[A-Z][0-9]+') QUALIFY row_number() OVER (PARTITION BY dataset_id, dim_id ORDER BY code) <= 5) GROUP BY 1),
 ic AS (SELECT dataset_id, count(*) AS indicator_count FROM dim_items WHERE dim_id = 'cat01' GROUP BY 1)"""


@query("i11_search_summary", "dim_items", f"""WITH {_SUMMARY} SELECT p.dataset_id, n >= 47 AS has_all_prefectures, n AS prefecture_count, CASE WHEN n >= 47 THEN '' ELSE names END AS prefectures, start_year, end_year, year_count, indicators, indicator_count
 FROM p JOIN y USING (dataset_id) JOIN t USING (dataset_id) JOIN ic USING (dataset_id)""")
def search_summary(spark, sf):
    out = I.search_summary(items(spark, sf))
    return out.withColumn("prefectures", F.concat_ws("|", "prefectures")).withColumn("indicators", F.concat_ws("|", "indicators"))


@query("k17_rich_catalog", "dim_items", f"""WITH {_SUMMARY}, s AS (SELECT dataset_id, count(*) AS record_count, min(attr_time) AS a, max(attr_time) AS b FROM raw_obs GROUP BY 1)
 SELECT s.dataset_id, 'dataset_' || s.dataset_id AS table_name, '労働力調査 ' || s.dataset_id AS title, 'labor' AS domain,
  array_to_string(list_sort([s.dataset_id, '労働力調査', '総務省', '基本集計', '表章項目', '分類1', '分類2', '指標', '品目', '数量区分', '地域', '時間軸（年）']), '|') AS keywords, 8 AS dimensions, start_year, end_year, record_count, a AS time_range_start, b AS time_range_end
 FROM s JOIN y USING (dataset_id)""")
def rich_catalog(spark, sf):
    docs = materialise(metadata_docs(spark, sf), "metadata")
    stats = V.raw_obs(spark, sf).groupBy("dataset_id").agg(F.count("*").alias("record_count"), F.min("attr_time").alias("time_range_start"), F.max("attr_time").alias("time_range_end"))
    out = J.build_catalog(I.table_info(docs), I.dimension_items(docs), stats)
    return out.select("dataset_id", "table_name", "title", "domain", F.concat_ws("|", "keywords").alias("keywords"), F.size("dimensions").alias("dimensions"),
                      "start_year", "end_year", "record_count", "time_range_start", "time_range_end")


def _detail(name, sql, run):
    def detail(spark, sf):
        stored = materialise(items(spark, sf), "items")          # summary and items are both read, the summary several times
        return run(I.search_summary(stored), stored)
    query(name, "dim_items", f"WITH {_SUMMARY} {sql}")(detail)


_detail("k29_by_place", "SELECT DISTINCT dataset_id FROM dim_items WHERE dim_id = 'area' AND contains(name, '_1')", lambda s, i: SE.by_place(s, i, "_1"))
_detail("k30_by_year", "SELECT dataset_id FROM y WHERE 1997 BETWEEN start_year AND end_year", lambda s, i: SE.by_year(s, 1997))
_detail("k31_by_year_range", "SELECT dataset_id FROM y WHERE NOT (end_year < 2001 OR start_year > 2005)", lambda s, i: SE.by_year_range(s, 2001, 2005))
_detail("k32_by_indicator", "SELECT DISTINCT dataset_id FROM dim_items WHERE contains(name, '失業')", lambda s, i: SE.by_indicator(s, i, "失業"))
_detail("k33_by_unit", "SELECT DISTINCT dataset_id FROM dim_items WHERE unit = '円'", lambda s, i: SE.by_unit(i, "円"))


@query("k31_by_year_ranges", "dim_items", f"""WITH {_SUMMARY}, r AS (SELECT DISTINCT year(o_orderdate) AS a, year(o_orderdate) + 1 AS b FROM orders)
 SELECT CAST(r.a AS INT) AS range_start, dataset_id, CAST(least(r.b, end_year) - greatest(r.a, start_year) + 1 AS INT) AS shared_years FROM y JOIN r ON NOT (end_year < r.a OR start_year > r.b)""")
def by_year_ranges(spark, sf):
    """Datasets of each of many year ranges: two years from every year in which orders were placed."""
    summary = materialise(I.search_summary(items(spark, sf)).select("dataset_id", "start_year", "end_year"), "year-ranges")
    y = F.year("o_orderdate")
    ranges = V.table(spark, sf, "orders").select(y.alias("start_year"), (y + 1).alias("end_year")).distinct()
    return A.overlapping(ranges, summary, "start_year", "end_year").select(
        F.col("a.start_year").alias("range_start"), F.col("b.dataset_id").alias("dataset_id"), F.col("shared").alias("shared_years"))


# --- landed data -----------------------------------------------------------------------------

_COLS = "dataset_id, attr_id, attr_area, attr_time, attr_cat01, attr_unit, value"


def raw_columns(spark, sf):
    return V.raw_obs(spark, sf).select(*_COLS.split(", "))


_LANDED_FIELDS = {"@id": "attr_id", "@area": "attr_area", "@time": "attr_time", "@cat01": "attr_cat01", "@cat11": "attr_cat11", "@cat12": "attr_cat12",
                  "@unit": "attr_unit", "$": "value"}
_LANDED_SQL = f"SELECT {', '.join(_LANDED_FIELDS.values())} FROM raw_obs"


def landed(spark, sf):
    """Raw rows under their landed names; a field without a value is left out of its record."""
    return V.raw_obs(spark, sf).select("dataset_id", *[F.col(c).alias(f) for f, c in _LANDED_FIELDS.items()])


@query("s01_landed_json", "raw_obs", _LANDED_SQL)
def landed_json(spark, sf):
    path = scratch_path(spark, "landed")
    landed(spark, sf).drop("dataset_id").write.json(path)
    return L.read_raw(spark, path).select(*_LANDED_FIELDS.values())


@query("s01_landed_arrays", "raw_obs", _LANDED_SQL)
def landed_arrays(spark, sf):
    """An array of records for each chunk of a dataset, as a client writes them."""
    path = scratch_path(spark, "landed")
    rows = landed(spark, sf).withColumn("chunk", F.pmod(F.xxhash64("@id"), F.lit(16)))
    one = F.to_json(F.struct(*[F.col(f"`{f}`") for f in _LANDED_FIELDS]))
    arrays = rows.groupBy("dataset_id", "chunk").agg(F.concat_ws(",\n  ", F.collect_list(one)).alias("r"))
    arrays.select(F.concat(F.lit("[\n  "), "r", F.lit("\n]"))).write.text(path)
    return L.read_raw(spark, path).select(*_LANDED_FIELDS.values())


@query("s01_landed_objects", "raw_obs", _LANDED_SQL)
def landed_objects(spark, sf):
    """Lone objects over several lines, and in other files objects that hold braces in a text, one a line."""
    path = scratch_path(spark, "landed")
    rows = landed(spark, sf).drop("dataset_id").withColumn("@note", F.when(F.col("@id").endswith("3"), "a { brace } in a text"))
    braced, record = F.col("@note").isNotNull(), F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    text = F.when(braced, F.to_json(record)).otherwise(F.to_json(record, {"pretty": "true"}))
    rows.select(text.alias("value"), braced.alias("braced")).write.partitionBy("braced").text(path)
    return L.read_raw(spark, path).select(*_LANDED_FIELDS.values())


def envelopes(spark, sf):
    """Data envelopes from events: a list, one object, nothing, or broken text."""
    e, v = F.col("event_id"), F.col("value").cast("decimal(18,2)").cast("string")
    one = F.concat(F.lit('{"@id":"'), e.cast("string"), F.lit('","@time":"'), F.date_format("ts", "yyyyMM"), F.lit('","@cat01":"'), "event_type", F.lit('","$":"'), v, F.lit('"}'))
    value = (F.when(e % 4 == 0, F.concat(F.lit('{"VALUE":['), one, F.lit(","), one, F.lit("]}"))).when(e % 4 == 1, F.concat(F.lit('{"VALUE":'), one, F.lit("}")))
             .otherwise("{}"))
    doc = F.concat(F.lit('{"GET_STATS_DATA":{"STATISTICAL_DATA":{"RESULT_INF":{"TOTAL_NUMBER":2},"DATA_INF":'), value, F.lit("}}}"))
    return V.table(spark, sf, "events").select("event_id", F.when(e % 4 == 3, "{broken").otherwise(doc).alias("doc"))


@query("s02_unwrap_data", "", """SELECT event_id, CAST(event_id AS VARCHAR) AS attr_id, strftime(ts, '%Y%m') AS attr_time, event_type AS attr_cat01, CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS value
 FROM events JOIN (VALUES (0), (0), (1)) c(k) ON event_id % 4 = c.k""")
def unwrap_data(spark, sf):
    return L.unwrap_data(envelopes(spark, sf)).select("event_id", "attr_id", "attr_time", "attr_cat01", "value")


@query("s02_unwrap_failures", "", "SELECT event_id, CASE event_id % 4 WHEN 3 THEN 'not JSON' ELSE 'no VALUE' END AS error FROM events WHERE event_id % 4 >= 2")
def unwrap_failures(spark, sf):
    return L.unwrap_failures(envelopes(spark, sf))


@query("s03_unwrap_listing", "listing", "SELECT id, title, organization, updated_date FROM listing")
def unwrap_listing(spark, sf):
    l = V.listing(spark, sf)
    title = F.when(F.col("seq") % 2 == 0, F.concat(F.lit('{"$":"'), "title", F.lit('"}'))).otherwise(F.concat(F.lit('"'), "title", F.lit('"')))
    row = F.concat(F.lit('{"@id":"'), "id", F.lit('","TITLE":'), title, F.lit(',"GOV_ORG":"'), "organization", F.lit('","UPDATED_DATE":"'), "updated_date", F.lit('"}'))
    doc = F.concat(F.lit('{"GET_STATS_LIST":{"DATALIST_INF":{"TABLE_INF":'), F.when(F.col("seq") % 3 == 0, row).otherwise(F.concat(F.lit("["), row, F.lit("]"))), F.lit("}}}"))
    return L.unwrap_listing(l.select(doc.alias("doc"))).select("id", "title", "organization", "updated_date")


@query("s04_merge_pages", "listing", """WITH p AS (SELECT id, CASE WHEN seq % 10 < 7 THEN seq % 10 ELSE 9 END AS page FROM listing)
 SELECT id, page, coalesce(page > (SELECT min(page) FROM (SELECT page, count(*) AS n FROM p GROUP BY 1) WHERE n < 101), false) AS after_short FROM p""")
def merge_pages(spark, sf):
    p = F.col("seq") % 10
    return L.merge_pages(V.listing(spark, sf).select("id", F.when(p < 7, p).otherwise(F.lit(9)).alias("page")), 101)


def totals(spark, sf):
    return V.registry(spark, sf).filter(F.col("record_count").isNotNull()).select("dataset_id", (F.col("record_count") * 3).alias("total"))


@query("s05_chunk_plan", "registry", """SELECT dataset_id, total, CAST(ceil(total / 100000) AS INT) AS num_chunks, CAST(i AS INT) AS chunk_num, i * 100000 + 1 AS start_position
 FROM (SELECT dataset_id, record_count * 3 AS total FROM registry WHERE record_count IS NOT NULL), LATERAL (SELECT unnest(generate_series(0, CAST(ceil(total / 100000) AS INT) - 1)) AS i)""")
def chunk_plan(spark, sf):
    return L.chunk_plan(totals(spark, sf))


@query("s08_retrieval_plan", "registry", """SELECT dataset_id, total, CASE WHEN total <= 100000 THEN 'single' ELSE 'chunked' END AS retrieval_mode,
 CAST(CASE WHEN total <= 100000 THEN 1 ELSE ceil(total / 100000) END AS INT) AS num_chunks, false AS truncated FROM (SELECT dataset_id, record_count * 3 AS total FROM registry WHERE record_count IS NOT NULL)""")
def retrieval_plan(spark, sf):
    return L.retrieval_plan(totals(spark, sf))


def chunked(spark, sf):
    """Rows with a chunk number, and the chunk table: every seventh chunk of a dataset failed."""
    raw = raw_columns(spark, sf).withColumn("chunk_num", F.pmod(F.length("attr_id") + F.substring("attr_id", -1, 1).cast("int"), F.lit(5)))
    raw = materialise(raw, "chunk-rows")                     # landed chunks are files: totals, audit and merge read them
    counts = raw.groupBy("dataset_id").agg(F.count("*").alias("n"))
    d = F.substring("dataset_id", 3, 9).cast("int")
    chunks = counts.select("dataset_id", (F.col("n") + F.when(d % 5 == 0, 1).otherwise(0)).alias("total"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("chunk_num"))
    return raw, chunks.withColumn("ok", (d + F.col("chunk_num")) % 7 != 0)


_CHUNKED = "ch AS (SELECT *, (length(attr_id) + CAST(right(attr_id, 1) AS INT)) % 5 AS chunk_num FROM raw_obs)"


@query("s06_merge_chunks", "raw_obs", f"WITH {_CHUNKED} SELECT dataset_id, CAST(chunk_num AS INT) AS chunk_num, attr_id, value FROM ch WHERE (CAST(dataset_id[3:] AS INT) + chunk_num) % 7 <> 0")
def merge_chunks(spark, sf):
    raw, chunks = chunked(spark, sf)
    return L.in_chunk_order(L.merge_chunks(raw, chunks), "attr_id").select("dataset_id", "chunk_num", "attr_id", "value")


_COMPLETE = "(SELECT dataset_id FROM raw_obs WHERE CAST(dataset_id[3:] AS INT) % 5 <> 0 AND CAST(dataset_id[3:] AS INT) % 7 IN (1, 2))"


@query("s07_merge_strict", "raw_obs", f"SELECT dataset_id, attr_id, value FROM raw_obs WHERE dataset_id IN {_COMPLETE}")
def merge_strict(spark, sf):
    return L.merge_chunks_strict(*chunked(spark, sf)).select("dataset_id", "attr_id", "value")


@query("s10_split_scan", "raw_obs", "SELECT attr_area, attr_id, value FROM raw_obs WHERE attr_area IN ('00001', '00002', '00003')")
def split_scan(spark, sf):
    return L.split_scan(raw_columns(spark, sf), ["00001", "00002", "00003"]).select("attr_area", "attr_id", "value")


# --- sinks and tables ---------------------------------------------------------------------------

@query("s11_typed_parquet", "obs", "SELECT year, region_code, cat01 AS category, value, unit FROM obs WHERE year >= 1999")
def typed_parquet(spark, sf):
    path = scratch_path(spark, "typed")
    W.write_typed(domain_rows(spark, sf, "generic").withColumn("updated_at", F.lit("now")), path, ["year"], "zstd")
    return spark.read.parquet(path).filter(F.col("year") >= 1999).select("year", "region_code", "category", "value", "unit")


@query("s12_raw_parquet", "raw_obs", "SELECT attr_id, attr_area, value FROM raw_obs")
def raw_parquet(spark, sf):
    path = scratch_path(spark, "raw")
    W.write_raw(raw_columns(spark, sf).select(F.col("attr_id").alias("@id"), F.col("attr_area").alias("@area"), F.col("value").alias("$")), path)
    return spark.read.parquet(path)


@query("s16_domain_table", "obs", "SELECT region_code, cat01 AS industry_code, month, value, year FROM obs WHERE year = 1998")
def domain_table(spark, sf):
    staged = scratch_path(spark, "staged")
    W.write_typed(domain_rows(spark, sf, "labor"), staged)
    table = W.create_domain_table(spark, "labor", scratch_path(spark, "labor_data"), fresh("labor_data"))
    W.load_parquet(spark, staged, table)
    return spark.table(table).filter("year = 1998").select("region_code", "industry_code", "month", "value", "year")


@query("s17_time_partitions", "raw_obs", "SELECT TRY_CAST(attr_time[1:4] AS INT) AS year, count(*) AS n FROM raw_obs GROUP BY 1")
def time_partitions(spark, sf):
    path = scratch_path(spark, "by_year")
    W.write_typed(W.time_partitioned(raw_columns(spark, sf)), path, ["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"))


@query("s18_partition_decision", "raw_obs", """SELECT 'all' AS part, true AS partitioned, TRY_CAST(attr_time[1:4] AS INT) AS year, count(*) AS rows FROM raw_obs GROUP BY 3
 UNION ALL SELECT 'untimed', false, NULL, count(*) FROM raw_obs""")
def partition_decision(spark, sf):
    """All rows, some of them without a year in their time code, and rows without time codes."""
    raw, out = V.raw_obs(spark, sf), []
    for part, rows in (("all", raw), ("untimed", raw.drop("attr_time"))):
        path = scratch_path(spark, "decision")
        ok = W.create_from_raw(rows, path)
        back = spark.read.parquet(path)
        year = F.col("year") if "year" in back.columns else F.lit(None).cast("int")
        out.append(back.groupBy(year.alias("year")).agg(F.lit(part).alias("part"), F.lit(ok).alias("partitioned"), F.count("*").alias("rows")))
    return out[0].unionByName(out[1])


@query("s19_reload", "obs", "SELECT year, count(*) AS n FROM obs WHERE year >= 1999 GROUP BY 1")
def reload_dataset(spark, sf):
    path = scratch_path(spark, "reload")
    rows = domain_rows(spark, sf, "generic")
    W.replace_dataset(rows, path)
    W.replace_dataset(rows.filter(F.col("year") >= 1999), path)
    return spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("n"))


@query("s20_catalog_json", "catalog", "SELECT dataset_id, title, array_to_string(keywords, '|') AS keywords, record_count FROM catalog")
def catalog_json(spark, sf):
    path, c = scratch_path(spark, "catalog"), V.catalog(spark, sf).select("dataset_id", "title", "keywords", "record_count")
    W.write_catalog(c, path)
    return W.read_catalog(spark, path, c.schema).withColumn("keywords", F.concat_ws("|", "keywords"))


@query("s21_flattened_catalog", "catalog", "SELECT dataset_id, array_to_string(keywords, ',') AS keywords, array_to_string(column_names, ',') AS column_names, array_to_string(tags, ',') AS tags FROM catalog")
def flattened_catalog(spark, sf):
    from statlake.operators.catalog import flattened
    return flattened(V.catalog(spark, sf)).select("dataset_id", "keywords", "column_names", "tags")


@query("s22_catalog_csv", "listing", "SELECT id, title, organization FROM listing")
def catalog_csv(spark, sf):
    path = scratch_path(spark, "csv")
    W.write_csv(classified(spark, sf).select("id", "title", "organization"), path)
    return spark.read.option("header", True).option("escape", '"').schema("id string, title string, organization string").csv(path)


@query("s23_error_log_json", "error_log", "SELECT strftime(ts, '%Y-%m-%d') AS date, stage_name, count(*) AS n FROM error_log GROUP BY ALL")
def error_log_json(spark, sf):
    path = scratch_path(spark, "errors")
    W.append_error_log(V.error_log(spark, sf).select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "dataset_id", "stage_name", "error_message"), path)
    return L.read_error_log(spark, path).groupBy("date", "stage_name").agg(F.count("*").alias("n"))


@query("s24_report_json", "obs", "SELECT year, count(*) AS n FROM obs GROUP BY 1")
def report_json(spark, sf):
    path = scratch_path(spark, "report")
    W.write_report(A.group_statistics(domain_rows(spark, sf, "generic"), ["year"], count="n"), path)
    return spark.read.schema("year int, n bigint").json(path)


@query("s26_show_partitions", "obs", "SELECT DISTINCT 'year=' || year AS partition FROM obs")
def show_partitions(spark, sf):
    table = W.create_domain_table(spark, "labor", scratch_path(spark, "shown"), fresh("shown"))
    W.insert_rows(domain_rows(spark, sf, "labor"), table)
    return W.show_partitions(spark, table)


@query("s27_file_inventory", "", "SELECT count(*) AS record_count, true AS sizes_known FROM lineitem")
def file_inventory(spark, sf):
    files = W.file_inventory(V.table(spark, sf, "lineitem"))
    return files.agg(F.sum("record_count").alias("record_count"), F.bool_and(F.col("file_size_in_bytes") > 0).alias("sizes_known"))


@query("s25_schema_documents", "dim_items", f"""WITH {_META_COLS}, t AS (SELECT dataset_id, count(*) AS columns, string_agg(name || ':' || type, ',' ORDER BY position) AS types,
  coalesce(string_agg(name, ',' ORDER BY position) FILTER (is_partition), '') AS partitions FROM s GROUP BY 1)
 SELECT * FROM t WHERE dataset_id IN (SELECT min(dataset_id) FROM dim_items UNION ALL SELECT max(dataset_id) FROM dim_items)""")
def schema_documents(spark, sf):
    """Schemas of the first and the last dataset, stored as documents and read back."""
    rows = materialise(I.schema_from_metadata(items(spark, sf)), "schemas")
    ends = rows.agg(F.min("dataset_id"), F.max("dataset_id")).first()
    path = scratch_path(spark, "schema-documents")
    for dataset_id in dict.fromkeys(ends):
        own = sorted(rows.filter(F.col("dataset_id") == dataset_id).collect(), key=lambda r: r["position"])        # one row a column
        struct = M.dynamic_struct([r.asDict() for r in own])
        text = W.schema_to_text(struct, [r["name"] for r in own if r["is_partition"]], {"dataset_id": dataset_id})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
    back = [W.schema_from_text(r[0]) for r in spark.read.text(path).collect()]
    return spark.createDataFrame([(info["dataset_id"], len(struct.fields), ",".join(f"{f.name}:{f.metadata['type']}" for f in struct.fields), ",".join(parts))
                                  for struct, parts, info in back], "dataset_id string, columns long, types string, partitions string")


@query("p19_column_mapping", "dim_items", f"""WITH {_META_COLS} SELECT source_field, name FROM s WHERE dataset_id = (SELECT min(dataset_id) FROM dim_items) AND source_field IS NOT NULL""")
def column_mapping(spark, sf):
    """Source fields and columns of the first dataset's dynamic schema."""
    rows = materialise(I.schema_from_metadata(items(spark, sf)), "schemas")
    struct = I.to_struct(rows.filter(F.col("dataset_id") == rows.agg(F.min("dataset_id")).scalar()))
    return spark.createDataFrame(sorted(M.column_mapping(struct).items()), "source_field string, name string")


@query("s28_load_history", "obs", f"""SELECT CASE d % 3 WHEN 0 THEN 'labor' WHEN 1 THEN 'trade' ELSE 'generic' END AS domain, CAST(count(*) AS BIGINT) AS record_count, min(year) AS first_year, max(year) AS last_year,
  count(DISTINCT year) AS partitions, strftime(CASE d % 3 WHEN 0 THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2002-01-02' END, '%Y-%m-%d') AS committed
 FROM (SELECT o.*, CAST(o.dataset_id[3:] AS INT) AS d FROM obs o JOIN (SELECT dataset_id FROM obs GROUP BY 1 HAVING count(*) FILTER (region_code = '') / count(*) <= 0.05) g ON o.dataset_id = g.dataset_id)
 WHERE d % 4 <> 0 GROUP BY d % 3""")
def load_history(spark, sf):
    """History of two real loads: the labor datasets on one day, all others on the next."""
    raw, registry = V.raw_obs(spark, sf), landed_registry(spark, sf)
    lake, audit = scratch_path(spark, "lake"), scratch_path(spark, "audit")
    for day, part in (("2002-01-01", F.col("domain") == "labor"), ("2002-01-02", F.col("domain") != "labor")):
        J.ingest(raw, registry.filter(part), lake, 0.05, audit_path=audit, at=F.lit(day).cast("timestamp"))
    return W.load_history(spark, audit).withColumn("committed", F.date_format("committed_at", "yyyy-MM-dd")).drop("committed_at")


@query("s32_load_metadata", "obs", "SELECT 'generic' AS domain, count(*) AS record_count, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS partitions FROM obs")
def load_metadata(spark, sf):
    return W.load_metadata(domain_rows(spark, sf, "generic"), "generic", F.current_timestamp()).drop("committed_at")


@query("s29_evolve", "catalog", "SELECT dataset_id, record_count::DOUBLE AS records, priority::BIGINT AS priority, CAST(NULL AS VARCHAR) AS note FROM catalog")
def evolve(spark, sf):
    """A column added in place; renames and types by a rewrite into a new table, which is read back."""
    c = V.catalog(spark, sf).select("dataset_id", "record_count", "priority")
    table, changed = fresh("evolve"), fresh("evolved")
    spark.sql(W.ddl(table, c.schema, scratch_path(spark, "evolve")))
    W.insert_rows(c, table)
    W.add_column(spark, table, "note", "string", "remark")
    rows = W.evolve(spark.table(table), {"record_count": "records"}, {"record_count": "double", "priority": "bigint"})
    spark.sql(W.ddl(changed, rows.schema, scratch_path(spark, "evolved")))
    W.insert_rows(rows, changed)
    return spark.table(changed)


@query("s31_register_inventory", "registry", "SELECT dataset_id, ingestion_status FROM (SELECT dataset_id, status AS ingestion_status FROM registry WHERE fetch_date IS NOT NULL)")
def register_inventory(spark, sf):
    table = W.create_inventory_table(spark, scratch_path(spark, "inventory"), fresh("inventory"))
    r = V.registry(spark, sf).select("dataset_id", "dataset_name", "domain", F.col("status").alias("ingestion_status"),
                                     S.iso_timestamp(F.col("fetch_date")).alias("ingestion_timestamp"), S.dynamic_table_name(F.col("dataset_id")).alias("table_name"))
    W.register_datasets(r, table)
    return spark.table(table).select("dataset_id", "ingestion_status")


@query("s33_refresh_catalog", "catalog", "SELECT dataset_id, priority + 1 AS priority FROM catalog")
def refresh_catalog(spark, sf):
    c = V.catalog(spark, sf).select("dataset_id", "priority")
    table = fresh("catalog")
    spark.sql(W.ddl(table, c.schema, scratch_path(spark, "catalog_v1")))
    W.insert_rows(c, table)
    W.refresh_table(spark.table(table).withColumn("priority", F.col("priority") + 1), table, scratch_path(spark, "catalog_v2"))
    return spark.table(table)


@query("s30_update_rows", "catalog", """SELECT dataset_id, CASE WHEN priority = 3 THEN 'failed' ELSE ingestion_status END AS ingestion_status, CASE WHEN priority = 4 THEN title || ' (2)' ELSE title END AS title,
 CASE WHEN priority = 3 THEN priority + 10 ELSE priority END AS priority FROM catalog WHERE priority <> 5
 UNION ALL SELECT 'new-' || dataset_id, ingestion_status, title, priority FROM catalog WHERE priority = 6""")
def update_rows(spark, sf):
    """A stored table after an update, an upsert of known and new keys, and a removal; read back from the table."""
    c, table = V.catalog(spark, sf).select("dataset_id", "ingestion_status", "title", "priority"), fresh("keyed_catalog")
    KT.create(c, "dataset_id", table, scratch_path(spark, "keyed"))
    KT.update(c.filter("priority = 3").select("dataset_id", F.lit("failed").alias("ingestion_status"), (F.col("priority") + 10).alias("priority")), table)
    again = c.filter("priority = 4").withColumn("title", F.concat("title", F.lit(" (2)")))
    KT.upsert(again.unionByName(c.filter("priority = 6").withColumn("dataset_id", F.concat(F.lit("new-"), "dataset_id"))), table)
    KT.remove(c.filter("priority = 5").select("dataset_id"), table)
    return KT.read(spark, table)


# --- stored facts ------------------------------------------------------------------------------

def stored_facts(spark, sf, domain):
    return FA.create(domain_rows(spark, sf, domain), domain, fresh(f"facts_{domain}"), scratch_path(spark, "facts"))


@query("f01_stored_facts", "obs", "SELECT year, region_code, cat01 AS category, value FROM obs WHERE year >= 1998 AND region_code = '00013'")
def stored_year_and_region(spark, sf):
    rows = stored_facts(spark, sf, "population").rows(spark)
    return rows.filter((F.col("year") >= 1998) & (F.col("region_code") == "00013")).select("year", "region_code", "category", "value")


@query("a02_stored_totals", "obs", """SELECT year, region_code, count(*) AS record_count, sum(value) AS total_value, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value
 FROM obs GROUP BY 1, 2 ORDER BY year DESC, region_code LIMIT 100""")
def stored_region_year(spark, sf):
    """Facts in two loads: the first years, and then all later ones with a part of the first year once more."""
    rows = materialise(domain_rows(spark, sf, "population"), "mapped")
    late = (F.col("year") > 1995) | (F.col("region_code") == "00003")
    tables = FA.create(rows.filter(~late), "population", fresh("facts"), scratch_path(spark, "facts"))
    FA.append(rows.filter(late), tables)
    return FA.region_year_statistics(spark, tables)


@query("a14_stored_facts", "obs", "SELECT region_code, cat01 AS school_type, count(DISTINCT dataset_id) AS facility_count FROM obs WHERE year = 1998 GROUP BY 1, 2")
def stored_datasets_by_region(spark, sf):
    return A.distinct_count(stored_facts(spark, sf, "education").rows(spark), ["region_code", "school_type"], "dataset_id", "facility_count", F.col("year") == 1998)


@query("a15_stored_totals", "obs", "SELECT year, count(*) AS records, sum(value) AS total FROM obs GROUP BY 1")
def stored_years(spark, sf):
    """Totals of all years after a second load that touches some of them."""
    rows = materialise(domain_rows(spark, sf, "economy"), "mapped")
    late = (F.col("year") > 1996) | (F.col("region_code") == "00003")
    tables = FA.create(rows.filter(~late), "economy", fresh("facts"), scratch_path(spark, "facts"))
    FA.append(rows.filter((F.col("year") > 1996)), tables)
    FA.append(rows.filter(late & (F.col("year") <= 1996)), tables)
    return tables.by_region(spark).groupBy("year").agg(F.sum("records").alias("records"), F.sum("total").alias("total"))


@query("a26_stored_totals", "obs", "SELECT region_code, sum(value) AS total_value FROM obs WHERE year = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def stored_top_regions(spark, sf):
    return FA.top_regions(spark, stored_facts(spark, sf, "population"), 1998)


@query("j01_stored_totals", "obs", """SELECT year, region_code, population, gdp FROM (SELECT year, region_code, sum(value) AS population FROM obs GROUP BY 1, 2)
 JOIN (SELECT year, region_code, sum(value) AS gdp FROM obs GROUP BY 1, 2) USING (year, region_code) WHERE year >= 1996""")
def stored_join(spark, sf):
    return FA.joined_totals(spark, {"population": stored_facts(spark, sf, "population"), "gdp": stored_facts(spark, sf, "economy")}, F.col("year") >= 1996)


# --- increments and jobs -----------------------------------------------------------------------------

@query("f20_updated_since", "registry", "SELECT dataset_id FROM registry WHERE load_date IS NULL OR seq % 3 = 0")
def updated_since(spark, sf):
    r = V.registry(spark, sf)
    listed = r.select("dataset_id", F.when(F.col("seq") % 3 == 0, "2010-01-01").otherwise("1990-01-01").alias("updated_at"))
    return U.updated_since(listed, r.select("dataset_id", F.col("load_date").alias("last_ingested"))).select("dataset_id")


@query("u03_new_or_changed", "catalog", """SELECT dataset_id, CASE WHEN priority = 3 THEN 'changed' ELSE title END AS title FROM catalog WHERE priority IN (3, 4)""")
def new_or_changed(spark, sf):
    c = V.catalog(spark, sf).select("dataset_id", "title", "priority")
    fetched = c.withColumn("title", F.when(F.col("priority") == 3, "changed").otherwise(F.col("title")))
    stored = c.filter("priority <> 4")
    return U.new_or_changed(fetched.drop("priority"), stored.drop("priority"), ["dataset_id"])


@query("u03_stream_landing", "raw_obs", """SELECT attr_id, CASE WHEN right(attr_id, 1) = '1' THEN value || '0' ELSE value END AS value, CASE WHEN right(attr_id, 1) = '2' THEN attr_id END AS attr_cat15
 FROM (SELECT attr_id, min(value) AS value FROM raw_obs GROUP BY 1)""")
def stream_landing(spark, sf):
    """Three batches: half the records, all of them with some changed and some with a field more, and a part once again."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "streamed", "stream-state"))
    rows = materialise(V.raw_obs(spark, sf).groupBy(F.col("attr_id").alias("@id")).agg(F.min("value").alias("$")), "records")
    rows.filter(F.length("@id") % 2 == 0).write.json(landing)
    U.stream_landing(spark, landing, out, checkpoint, ["@id"])
    changed = rows.withColumn("$", F.when(F.col("@id").endswith("1"), F.concat("$", F.lit("0"))).otherwise(F.col("$")))
    changed = changed.withColumn("@cat15", F.when(F.col("@id").endswith("2"), F.col("@id")))
    for part in (changed, changed.filter(F.col("@id").endswith("1"))):
        part.write.mode("append").json(landing)
        U.stream_landing(spark, landing, out, checkpoint, ["@id"])
    return U.stored_records(spark, out).select("attr_id", "value", "attr_cat15")


@query("u03_stream_versions", "raw_obs", """SELECT version, count(*) AS records FROM (SELECT CASE WHEN length(attr_id) % 2 = 0 AND (right(attr_id, 1) = '2' OR right(attr_id, 1) = '1' AND value IS NOT NULL) THEN 2 ELSE 1 END AS top,
  unnest(range(1, top + 1)) AS version FROM (SELECT attr_id, min(value) AS value FROM raw_obs GROUP BY 1)) GROUP BY 1""")
def stream_versions(spark, sf):
    """Versions stored: one for a record met first, one more where its content is another, none for the same again."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "streamed", "stream-state"))
    rows = materialise(V.raw_obs(spark, sf).groupBy(F.col("attr_id").alias("@id")).agg(F.min("value").alias("$")), "records")
    rows.filter(F.length("@id") % 2 == 0).write.json(landing)
    U.stream_landing(spark, landing, out, checkpoint, ["@id"])
    last = F.substring("@id", -1, 1)
    rows.withColumn("$", F.when(last.isin("1", "2"), F.concat("$", F.lit("0"))).otherwise(F.col("$"))).withColumn("@cat15", F.when(last == "2", F.col("@id"))).write.mode("append").json(landing)
    U.stream_landing(spark, landing, out, checkpoint, ["@id"])
    return U.stored_versions(spark, out).groupBy("version").agg(F.count("*").alias("records"))


def landed_registry(spark, sf, raw=None):
    """Registry of the landed datasets, stored as registries are: domain by number, every fourth one loaded already."""
    d = F.substring("dataset_id", 3, 9).cast("int")
    ids = (V.raw_obs(spark, sf) if raw is None else raw).select("dataset_id").distinct()
    stamp = F.when(d % 4 == 0, "2001-01-01T00:00:00")
    rows = ids.select("dataset_id", V.pick(d % 3, ["labor", "trade", "generic"]).alias("domain"), F.when(d % 4 == 0, "completed").otherwise("pending").alias("status"),
                      (d % 10 + 1).alias("priority"), d.alias("seq"), stamp.alias("fetch_date"), stamp.alias("transformation_date"), stamp.alias("validation_date"), stamp.alias("load_date"))
    return materialise(rows, "registry")


_LANDED = """CASE CAST(dataset_id[3:] AS INT) % 3 WHEN 0 THEN 'labor' WHEN 1 THEN 'trade' ELSE 'generic' END"""


@query("e01_ingest", "obs", f"""SELECT dataset_id, {_LANDED} AS domain, CASE WHEN count(*) FILTER (region_code = '') / count(*) <= 0.05 THEN 'success' ELSE 'failed' END AS status,
 CASE WHEN count(*) FILTER (region_code = '') / count(*) <= 0.05 THEN count(*) ELSE 0 END AS records FROM obs WHERE CAST(dataset_id[3:] AS INT) % 4 <> 0 GROUP BY dataset_id""")
def ingest(spark, sf):
    return J.ingest(V.raw_obs(spark, sf), landed_registry(spark, sf), scratch_path(spark, "lake"), 0.05).drop("start_stage", "error_message")


_AT = "2002-02-02T00:00:00"
_BLANK = "count(*) FILTER (region_code = '') / count(*) <= 0.05"


@query("e01_ingest_resumed", "obs", f"""SELECT dataset_id, CASE WHEN loaded OR good THEN 'completed' ELSE 'failed' END AS status, CASE WHEN loaded THEN '2001-01-01T00:00:00' ELSE '{_AT}' END AS transformation_date,
 CASE WHEN loaded THEN '2001-01-01T00:00:00' WHEN good THEN '{_AT}' END AS load_date, CASE WHEN NOT loaded AND NOT good THEN 'validate' END AS resumed_at, CASE WHEN NOT loaded AND good THEN n ELSE 0 END AS stored
 FROM (SELECT dataset_id, CAST(dataset_id[3:] AS INT) % 4 = 0 AS loaded, {_BLANK} AS good, count(*) AS n FROM obs GROUP BY 1)""")
def ingest_resumed(spark, sf):
    """Registry and stored rows after three runs: one, the same again as after a crash, and one on the stamped registry."""
    path, staged = scratch_path(spark, "lake"), scratch_path(spark, "stage")
    raw = materialise(V.raw_obs(spark, sf), "landed")
    before = landed_registry(spark, sf, raw)
    J.ingest(raw, before, path, 0.05, staged)
    first, after = J.run_selected(before, raw, before, path, 0.05, F.lit(_AT), staged)
    second, last = J.run_selected(after, raw, after, path, 0.05, F.lit("2003-03-03T00:00:00"), staged)
    stored = spark.read.parquet(path).groupBy("dataset_id").agg(F.count("*").alias("stored"))
    resumed = second.select("dataset_id", F.col("start_stage").alias("resumed_at"))
    out = last.join(resumed, "dataset_id", "left").join(stored, "dataset_id", "left")
    return out.select("dataset_id", "status", "transformation_date", "load_date", "resumed_at", F.coalesce("stored", F.lit(0)).alias("stored"))


@query("e02_ingest_complete", "raw_obs", """SELECT 'X1' AS dataset_id, count(*) AS total, count(*) > 0 AND false AS passed, CAST(0 AS BIGINT) AS stored FROM raw_obs
 UNION ALL SELECT 'X2', count(DISTINCT coalesce(attr_area, '')), true, count(DISTINCT coalesce(attr_area, '')) FROM raw_obs""")
def ingest_complete(spark, sf):
    """A dataset with repeated keys stays out of its table, one with a row per region goes in."""
    raw, names = raw_columns(spark, sf).drop("dataset_id"), ["@id", "@area", "@time", "@cat01", "@unit", "$"]
    regions = raw.groupBy(F.coalesce("attr_area", F.lit("")).alias("@area")).agg(F.min("attr_id").alias("@id")).select(
        "@id", "@area", F.lit("2000").alias("@time"), F.lit("c").alias("@cat01"), F.lit("u").alias("@unit"), F.lit("1").alias("$"))
    out = []
    for dataset_id, rows in (("X1", raw.toDF(*names)), ("X2", regions)):
        path, name = scratch_path(spark, "landed"), fresh("population")
        rows.write.json(path)
        gate = J.ingest_complete(spark, path, "population", dataset_id, scratch_path(spark, "population"), name, fields=[])
        stored = spark.table(name).groupBy("dataset_id").agg(F.count("*").alias("stored"))
        out.append(gate.join(stored, "dataset_id", "left").select("dataset_id", "total", "passed", F.coalesce("stored", F.lit(0)).alias("stored")))
    return out[0].unionByName(out[1])


def dynamic_listing(spark, sf):
    return V.raw_obs(spark, sf).select("dataset_id").distinct().select(
        "dataset_id", F.concat(F.lit("労働力調査 "), "dataset_id").alias("title"), F.lit("月次の就業者数").alias("description"))


@query("e03_ingest_dynamic", "raw_obs", """SELECT attr_id AS record_id, attr_time AS time, attr_area AS area, attr_cat01 AS category_01, attr_cat11 AS cat11, CAST(attr_cat12 AS INT) AS cat12,
 TRY_CAST(replace(value, ',', '') AS DOUBLE) AS value FROM raw_obs WHERE dataset_id = 'ds00001'""")
def ingest_dynamic(spark, sf):
    out, _ = J.ingest_dynamic(V.raw_obs(spark, sf), items(spark, sf), "ds00001", scratch_path(spark, "dynamic"), fresh("dataset_ds00001"))
    return out.select("record_id", "time", "area", "category_01", "cat11", "cat12", "value")


@query("e03_ingest_records", "raw_obs", """SELECT attr_id AS record_id, attr_time AS time, attr_cat11 AS category_11, CAST(attr_cat12 AS INT) AS category_12, 'n' || attr_cat11 AS note,
 TRY_CAST(replace(value, ',', '') AS DOUBLE) AS value FROM raw_obs WHERE dataset_id = 'ds00001'""")
def ingest_records(spark, sf):
    """Landed records without metadata, one field of a name of its own; the schema comes from the data."""
    path, rows = scratch_path(spark, "landed"), landed(spark, sf).filter("dataset_id = 'ds00001'").drop("dataset_id")
    rows.withColumn("note", F.concat(F.lit("n"), "@cat11")).write.json(path)
    records = L.read_records(spark, path).withColumn("dataset_id", F.lit("ds00001"))
    out, _ = J.ingest_dynamic(records, None, "ds00001", scratch_path(spark, "dynamic"), fresh("dataset_ds00001"))
    return out.select("record_id", "time", "category_11", "category_12", "note", "value")


@query("e03_catalog_entry", "raw_obs", """SELECT dataset_id, 'dataset_' || dataset_id AS table_name, '労働力調査 ' || dataset_id AS title, 'labor' AS domain, count(*) AS record_count,
 'area|cat11|cat12|category_01|category_02|category_03|dataset_id|indicator|record_id|time|value' AS column_names, min(attr_time) AS time_range_start, max(attr_time) AS time_range_end
 FROM raw_obs WHERE dataset_id = 'ds00001' GROUP BY 1""")
def dynamic_catalog_entry(spark, sf):
    _, entry = J.ingest_dynamic(V.raw_obs(spark, sf), items(spark, sf), "ds00001", scratch_path(spark, "dynamic"), fresh("dataset_ds00001"),
                                listing=dynamic_listing(spark, sf))
    return entry.select("dataset_id", "table_name", "title", "domain", "record_count", F.array_join(F.array_sort("column_names"), "|").alias("column_names"),
                        "time_range_start", "time_range_end")


@query("e04_priority_build", "raw_obs", f"""SELECT dataset_id, count(*) + CASE WHEN CAST(dataset_id[3:] AS INT) % 5 = 0 THEN 1 ELSE 0 END AS total, count(*) AS received, dataset_id IN {_COMPLETE} AS complete,
 CASE WHEN dataset_id IN {_COMPLETE} THEN count(*) ELSE 0 END AS stored, CASE WHEN dataset_id IN {_COMPLETE} THEN count(DISTINCT TRY_CAST(attr_time[1:4] AS INT)) ELSE 0 END AS years FROM raw_obs GROUP BY 1""")
def priority_build(spark, sf):
    """The audit beside what the build has stored."""
    path = scratch_path(spark, "priority")
    audit = J.priority_build(*chunked(spark, sf), path)
    stored = spark.read.parquet(path).groupBy("dataset_id").agg(F.count("*").alias("stored"), F.countDistinct("year").alias("years"))
    return audit.join(stored, "dataset_id", "left").select("dataset_id", F.col("total").cast("bigint").alias("total"), "received", "complete",
                                                           F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce("years", F.lit(0)).alias("years"))


_BATCH = f"""ds AS (SELECT dataset_id, CAST(dataset_id[3:] AS INT) AS d, {_BLANK} AS good, count(*) AS n FROM obs GROUP BY dataset_id),
 b AS (SELECT * FROM ds WHERE d % 4 <> 0 AND d % 10 + 1 >= 6 ORDER BY d % 10 DESC, d LIMIT 8)"""


@query("e06_run_batch", "obs", f"""WITH {_BATCH} SELECT ds.dataset_id, CASE WHEN ds.d % 4 = 0 THEN 'completed' WHEN b.d IS NULL THEN 'pending' WHEN ds.good THEN 'completed' ELSE 'failed' END AS status,
 CASE WHEN ds.d % 4 = 0 THEN '2001-01-01T00:00:00' WHEN b.d IS NOT NULL AND ds.good THEN '{_AT}' END AS load_date, CASE WHEN b.d IS NOT NULL AND ds.good THEN ds.n ELSE 0 END AS stored
 FROM ds LEFT JOIN b ON ds.dataset_id = b.dataset_id""")
def run_batch(spark, sf):
    r, path = landed_registry(spark, sf), scratch_path(spark, "batch")
    _, after = J.run_batch(r, V.raw_obs(spark, sf), r, path, 8, 0.05, F.lit(_AT), priority_min=6)
    stored = spark.read.parquet(path).groupBy("dataset_id").agg(F.count("*").alias("stored"))
    return after.join(stored, "dataset_id", "left").select("dataset_id", "status", "load_date", F.coalesce("stored", F.lit(0)).alias("stored"))


@query("e07_priority_ingest", "obs", f"""WITH {_BATCH} SELECT dataset_id, CASE WHEN good THEN 'completed' ELSE 'failed' END AS status, CASE WHEN good THEN '{_AT}' END AS load_date, CASE WHEN good THEN n ELSE 0 END AS stored FROM b""")
def priority_ingest(spark, sf):
    path = scratch_path(spark, "batch")
    results, after = J.run_priority_batch(V.raw_obs(spark, sf), landed_registry(spark, sf), path, 8, 6, 0.05, F.lit(_AT))
    stored = spark.read.parquet(path).groupBy("dataset_id").agg(F.count("*").alias("stored"))
    out = after.join(results.select("dataset_id"), "dataset_id", "left_semi").join(stored, "dataset_id", "left")
    return out.select("dataset_id", "status", "load_date", F.coalesce("stored", F.lit(0)).alias("stored"))


@query("e07_priority_batch", "registry", "SELECT dataset_id, priority, 'processing' AS status FROM registry WHERE status = 'pending' AND priority >= 4 ORDER BY priority DESC, seq LIMIT 5")
def priority_batch(spark, sf):
    return J.priority_batch(V.registry(spark, sf), 5, 4).select("dataset_id", "priority", "status")
