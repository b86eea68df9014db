"""Registered queries: aggregates, joins, filters and sorts over domain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import analytics as A, bitmaps as B
from statlake.plans import views as V
from statlake.plans.mapping_queries import domain_rows
from statlake.plans.registered import query
from statlake.session import materialise, scratch_path

Y = 1996      # first year of the reports below


def r2(x: str, d: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38, 10)), {d}) AS DOUBLE)"


@query("a01_basic_statistics", "obs", """SELECT count(*) AS record_count, count(DISTINCT dataset_id) AS unique_datasets, count(DISTINCT year) AS unique_years,
 count(DISTINCT region_code) AS unique_regions, sum(value) AS total_value, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
 min(year) AS earliest_year, max(year) AS latest_year FROM obs""")
def basic(spark, sf):
    return A.basic_statistics(domain_rows(spark, sf, "generic"))


def bitmapped(spark, sf):
    """Bitmaps of two loads: years up to 1996, and all later ones."""
    path, rows = scratch_path(spark, "bitmaps"), materialise(domain_rows(spark, sf, "generic"), "mapped")
    for load, part in (("first", F.col("year") <= 1996), ("second", F.col("year") > 1996)):
        B.append(rows.filter(part), ["dataset_id", "region_code", "category", "stats_data_id"], "year", load, path)
    return path


@query("a01_bitmap_counts", "obs", """SELECT v.* FROM (SELECT count(DISTINCT dataset_id) AS a, count(DISTINCT region_code) AS b, count(DISTINCT cat01) AS c, count(DISTINCT stats_data_id) AS d FROM obs),
 LATERAL (VALUES ('dataset_id', a), ('region_code', b), ('category', c), ('stats_data_id', d)) v("column", "distinct")""")
def bitmap_counts(spark, sf):
    return B.distinct_counts(spark, bitmapped(spark, sf))


@query("a14_bitmap_counts_by_year", "obs", """SELECT CAST(year AS VARCHAR) AS "group", v.* FROM (SELECT year, count(DISTINCT dataset_id) AS a, count(DISTINCT region_code) AS b, count(DISTINCT cat01) AS c, count(DISTINCT stats_data_id) AS d FROM obs GROUP BY 1),
 LATERAL (VALUES ('dataset_id', a), ('region_code', b), ('category', c), ('stats_data_id', d)) v("column", "distinct")""")
def bitmap_counts_by_year(spark, sf):
    return B.distinct_counts(spark, bitmapped(spark, sf), by_group=True)


@query("a02_region_year_statistics", "obs", """SELECT year, region_code, count(*) AS record_count, sum(value) AS total_value, avg(value) AS avg_value,
 min(value) AS min_value, max(value) AS max_value FROM obs GROUP BY 1, 2 ORDER BY year DESC, region_code LIMIT 100""")
def region_year(spark, sf):
    return A.region_year_statistics(domain_rows(spark, sf, "population"))


@query("a03_custom_sql", "obs", "SELECT category, year, sum(value) AS total FROM (SELECT *, cat01 AS category FROM obs) GROUP BY ALL")
def custom(spark, sf):
    return A.custom_sql(spark, {"population": domain_rows(spark, sf, "population")},
                        "SELECT category, year, sum(value) AS total FROM population GROUP BY category, year")


# (name, domain, keys, like column, like text, statistics, SQL columns, SQL aggregates)
_REPORTS = [
    ("a04_region_name_totals", "population", ["year", "region_name"], None, None, dict(total="total_population"),
     "year, region_name", "sum(value) AS total_population"),
    ("a07_gdp_by_quarter", "economy", ["year", "quarter", "indicator", "unit"], "indicator", "GDP", dict(total="total_value"),
     "year, quarter, cat01 AS indicator, unit", "sum(value) AS total_value"),
    ("a07_sales_by_quarter", "trade", ["year", "quarter", "industry_code", "unit"], "indicator", "売上", dict(total="total_sales"),
     "year, quarter, cat01 AS industry_code, unit", "sum(value) AS total_sales"),
    ("a08_employees_by_month", "labor", ["year", "month", "indicator", "unit"], "indicator", "雇用", dict(total="total_employees"),
     "year, month, cat03 AS indicator, unit", "sum(value) AS total_employees"),
    ("a08_starts_by_month", "construction", ["year", "month", "building_type"], "indicator", "着工", dict(total="total_starts"),
     "year, month, cat01 AS building_type", "sum(value) AS total_starts"),
    ("a08_transport_by_month", "transport", ["year", "month", "transport_mode", "unit"], "indicator", "輸送", dict(total="total_transport"),
     "year, month, cat01 AS transport_mode, unit", "sum(value) AS total_transport"),
    ("a09_seasonal_transport", "transport", ["month", "transport_mode"], None, None, dict(average="avg_monthly_transport"),
     "month, cat01 AS transport_mode", f"{r2('avg(value)')} AS avg_monthly_transport"),
    ("a10_wages_by_industry", "labor", ["industry_code"], "indicator", "賃金",
     dict(average="avg_wage", minimum="min_wage", maximum="max_wage", count="data_points", digits=0),
     "cat01 AS industry_code", f"{r2('avg(value)', 0)} AS avg_wage, {r2('min(value)', 0)} AS min_wage, {r2('max(value)', 0)} AS max_wage, count(*) AS data_points"),
    ("a11_unemployment_by_occupation", "labor", ["year", "occupation_code", "indicator"], "indicator", "失業", dict(average="avg_unemployment_rate"),
     "year, cat02 AS occupation_code, cat03 AS indicator", f"{r2('avg(value)')} AS avg_unemployment_rate"),
    ("a11_disease_averages", "health", ["year", "disease_code", "indicator"], None, None, dict(average="avg_value", count="data_points"),
     "year, cat02 AS disease_code, cat03 AS indicator", f"{r2('avg(value)')} AS avg_value, count(*) AS data_points"),
    ("a11_business_averages", "trade", ["year", "business_type", "indicator"], None, None, dict(average="avg_value", count="data_points"),
     "year, cat02 AS business_type, cat03 AS indicator", f"{r2('avg(value)')} AS avg_value, count(*) AS data_points"),
    ("a12_students_by_school", "education", ["year", "school_type"], "category", "学生", dict(total="total_students"),
     "year, cat01 AS school_type", "sum(value) AS total_students"),
    ("a12_patients_by_facility", "health", ["year", "facility_type", "indicator"], "indicator", "患者", dict(total="total_patients"),
     "year, cat01 AS facility_type, cat03 AS indicator", "sum(value) AS total_patients"),
    ("a12_production_by_sector", "agriculture", ["year", "sector", "indicator", "unit"], "indicator", "生産", dict(total="total_production"),
     "year, cat01 AS sector, cat03 AS indicator, unit", "sum(value) AS total_production"),
    ("a12_users_by_service", "social_welfare", ["year", "facility_type", "service_type"], "indicator", "利用者", dict(total="total_users"),
     "year, cat01 AS facility_type, cat02 AS service_type", "sum(value) AS total_users"),
    ("a13_product_statistics", "agriculture", ["year", "product_code"], None, None, dict(average="avg_production", total="total_production"),
     "year, cat02 AS product_code", f"{r2('avg(value)')} AS avg_production, sum(value) AS total_production"),
    ("a13_structure_statistics", "construction", ["year", "structure_type", "indicator"], None, None, dict(average="avg_value", total="total_value"),
     "year, cat02 AS structure_type, cat03 AS indicator", f"{r2('avg(value)')} AS avg_value, sum(value) AS total_value"),
    ("a13_service_statistics", "social_welfare", ["year", "service_type", "indicator"], None, None, dict(average="avg_value", total="total_value"),
     "year, cat02 AS service_type, cat03 AS indicator", f"{r2('avg(value)')} AS avg_value, sum(value) AS total_value"),
]
_LIKE_SQL = {("economy", "indicator"): "cat01", ("transport", "indicator"): "cat02", ("education", "category"): "cat02"}
for _name, _domain, _keys, _col, _word, _stats, _cols, _aggs in _REPORTS:
    def _report(spark, sf, domain=_domain, keys=_keys, col=_col, word=_word, stats=_stats):
        where = F.col("year") >= Y
        if col:
            where = where & F.col(col).contains(word)
        return A.group_statistics(domain_rows(spark, sf, domain), keys, where=where, **stats)
    _like = f" AND {_LIKE_SQL.get((_domain, _col), 'cat03')} LIKE '%{_word}%'" if _col else ""
    query(_name, "obs", f"SELECT {_cols}, {_aggs} FROM obs WHERE year >= {Y}{_like} GROUP BY ALL")(_report)


@query("a05_category_distribution", "obs", f"""SELECT year, cat01 AS category, sum(value) AS total, {r2('avg(value)')} AS average, min(value) AS minimum, max(value) AS maximum
 FROM obs WHERE year = 1998 GROUP BY 1, 2""")
def category_distribution(spark, sf):
    return A.group_statistics(domain_rows(spark, sf, "population"), ["year", "category"], where=F.col("year") == 1998,
                              total="total", average="average", minimum="minimum", maximum="maximum", order=[F.desc("total")])


@query("a06_indicator_dispersion", "obs", f"""SELECT region_code, cat01 AS indicator, {r2('avg(value)')} AS avg_value, round(stddev_samp(value), 2) AS stddev_value,
 count(*) AS data_points FROM obs WHERE year >= {Y} GROUP BY 1, 2 HAVING count(*) >= 700""")
def indicator_dispersion(spark, sf):
    return A.group_statistics(domain_rows(spark, sf, "economy"), ["region_code", "indicator"], where=F.col("year") >= Y,
                              average="avg_value", deviation="stddev_value", count="data_points", min_count=700)


@query("a14_datasets_by_region", "obs", """SELECT region_code, cat01 AS school_type, count(DISTINCT dataset_id) AS facility_count
 FROM obs WHERE year = 1998 GROUP BY 1, 2""")
def datasets_by_region(spark, sf):
    return A.distinct_count(domain_rows(spark, sf, "education"), ["region_code", "school_type"], "dataset_id", "facility_count",
                            F.col("year") == 1998)


@query("a15_rows_per_partition", "obs", "SELECT year, count(*) AS record_count FROM obs GROUP BY 1")
def rows_per_partition(spark, sf):
    return A.group_statistics(domain_rows(spark, sf, "population"), ["year"], count="record_count", order=[F.desc("year")])


def _catalog_report(name, sql, keys, *aggs):
    def run(spark, sf):
        return V.catalog(spark, sf).groupBy(*[k() for k in keys]).agg(*[a() for a in aggs])
    query(name, "catalog", sql)(run)


_domain = lambda: F.col("domain")
_catalog_report("a16_catalog_by_domain", "SELECT domain, count(*) AS dataset_count, CAST(sum(record_count) AS BIGINT) AS total_records FROM catalog GROUP BY 1",
                [_domain], lambda: F.count("*").alias("dataset_count"), lambda: F.sum("record_count").alias("total_records"))
_catalog_report("a17_catalog_by_creation_year", "SELECT CAST(year(created_at) AS INT) AS year, domain, count(*) AS dataset_count FROM catalog GROUP BY 1, 2",
                [lambda: F.year("created_at").alias("year"), _domain], lambda: F.count("*").alias("dataset_count"))
_catalog_report("a18_missing_time_by_domain", """SELECT domain, count(*) AS total, CAST(sum(CASE WHEN time_range_start IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_time,
 avg(record_count) AS avg_records FROM catalog GROUP BY 1""", [_domain], lambda: F.count("*").alias("total"),
                lambda: F.count_if(F.col("time_range_start").isNull()).alias("missing_time"), lambda: F.avg("record_count").alias("avg_records"))
_catalog_report("a23_catalog_by_priority", "SELECT domain, priority, count(*) AS count, avg(record_count) AS avg_records FROM catalog GROUP BY 1, 2",
                [_domain, lambda: F.col("priority")], lambda: F.count("*").alias("count"), lambda: F.avg("record_count").alias("avg_records"))
_catalog_report("a24_mean_records_by_domain", "SELECT domain, avg(record_count) AS avg_records FROM catalog GROUP BY 1",
                [_domain], lambda: F.avg("record_count").alias("avg_records"))


@query("a19_time_range", "obs", "SELECT 'year' AS field, CAST(min(year) AS VARCHAR) AS start, CAST(max(year) AS VARCHAR) AS \"end\" FROM obs")
def time_range(spark, sf):
    return A.time_range(domain_rows(spark, sf, "health"))


@query("a20_row_count", "obs", "SELECT count(*) AS count FROM obs")
def row_count(spark, sf):
    return domain_rows(spark, sf, "health").agg(F.count("*").alias("count"))


@query("a22_column_profile", "obs", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({e}) AS null_count, count(DISTINCT {e}) AS distinct_count, count(*) AS row_count FROM {t}"
    for c, e, t in [("attr_area", "attr_area", "raw_obs"), ("attr_time", "attr_time", "raw_obs"), ("attr_cat03", "attr_cat03", "raw_obs"),
                    ("attr_id", "attr_id", "raw_obs"), ("value", "value", "raw_obs")]))
def column_profile(spark, sf):
    return A.column_profile(V.raw_obs(spark, sf), ["attr_area", "attr_time", "attr_cat03", "attr_id", "value"])


@query("a25_duplicate_ids", "raw_obs", "SELECT attr_id, count(*) AS count FROM raw_obs GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return V.raw_obs(spark, sf).groupBy("attr_id").agg(F.count("*").alias("count")).filter("count > 1")


@query("a26_top_regions", "obs", "SELECT region_code, sum(value) AS total_value FROM obs WHERE year = 1998 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_regions(spark, sf):
    return A.top_regions(domain_rows(spark, sf, "population"), 1998)


# --- joins -----------------------------------------------------------------------------

def _totals(spark, sf, domain, name):
    return A.key_totals(domain_rows(spark, sf, domain), ["year", "region_code"], name)


_T = "(SELECT year, region_code, sum(value) AS {0} FROM obs GROUP BY 1, 2)"


@query("j01_inner_join", "obs", f"SELECT year, region_code, population, gdp FROM {_T.format('population')} JOIN {_T.format('gdp')} USING (year, region_code) WHERE year = 1998")
def inner_join(spark, sf):
    p, e = _totals(spark, sf, "population", "population"), _totals(spark, sf, "economy", "gdp")
    return A.join_on_keys([p.filter(F.col("year") == 1998), e], ["year", "region_code"])


@query("j02_left_join_statistics", "obs", f"""SELECT p.year, p.region_code, p.region_name, sum(p.value) AS population, avg(e.value) AS avg_economic_indicator
 FROM obs p LEFT JOIN (SELECT * FROM obs WHERE year <> 1999) e ON p.region_code = e.region_code AND p.year = e.year WHERE p.year >= {Y} GROUP BY 1, 2, 3""")
def left_join_statistics(spark, sf):
    p = domain_rows(spark, sf, "population").filter(F.col("year") >= Y)
    e = domain_rows(spark, sf, "economy").filter(F.col("year") != 1999)
    return A.related_statistics(p, e, ["year", "region_code"], ["year", "region_code", "region_name"], how="left",
                                left_total="population", right_average="avg_economic_indicator")


@query("j03_join_then_aggregate", "obs", """SELECT p.year, count(DISTINCT p.region_code) AS region_count, sum(p.value) AS total_population, avg(e.value) AS avg_gdp
 FROM obs p JOIN obs e ON p.year = e.year AND p.region_code = e.region_code GROUP BY 1""")
def join_then_aggregate(spark, sf):
    return A.related_statistics(domain_rows(spark, sf, "population"), domain_rows(spark, sf, "economy"), ["year", "region_code"], ["year"],
                                distinct={"region_code": "region_count"}, left_total="total_population", right_average="avg_gdp")


@query("j04_three_way_join", "obs", f"""SELECT year, region_code, population, gdp, labor_force FROM {_T.format('population')} JOIN {_T.format('gdp')} USING (year, region_code)
 JOIN {_T.format('labor_force')} USING (year, region_code) WHERE year >= {Y}""")
def three_way_join(spark, sf):
    parts = [_totals(spark, sf, d, n).filter(F.col("year") >= Y) for d, n in
             [("population", "population"), ("economy", "gdp"), ("labor", "labor_force")]]
    return A.join_on_keys(parts, ["year", "region_code"])


@query("j05_inventory_counts", "obs", """SELECT 'ds' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS dataset_id, s_name AS dataset_name, o.year, count(*) AS record_count
 FROM supplier JOIN obs o ON 'population_data' = CASE s_nationkey % 2 WHEN 0 THEN 'population_data' ELSE 'economy_data' END GROUP BY ALL""")
def inventory_counts(spark, sf):
    s = V.table(spark, sf, "supplier").select(
        F.concat(F.lit("ds"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("dataset_id"), F.col("s_name").alias("dataset_name"),
        F.when(F.col("s_nationkey") % 2 == 0, "population_data").otherwise("economy_data").alias("table_name"))
    return A.inventory_counts(s, {"population_data": domain_rows(spark, sf, "population")}, ["year"]).drop("table_name")


_GROWTH = """WITH t AS (SELECT year, {k}, sum(value) AS v FROM obs GROUP BY ALL) SELECT c.year, {ck}, c.v AS {v}, p.v AS {b},
 CAST(round(CAST((c.v - p.v) / nullif(p.v, 0) * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS growth_rate_percent
 FROM t c LEFT JOIN t p ON c.{j} = p.{j} AND c.year = p.year + 1 WHERE c.year >= 1996"""


@query("j06_population_growth", "obs", _GROWTH.format(k="region_code, region_name", ck="c.region_code, c.region_name", v="current_population", b="previous_population", j="region_code"))
def population_growth(spark, sf):
    return A.growth(domain_rows(spark, sf, "population"), ["region_code"], "current_population", "previous_population", Y, ["region_name"])


@query("j06_economic_growth", "obs", _GROWTH.format(k="cat01 AS indicator", ck="c.indicator", v="annual_value", b="previous_year_value", j="indicator"))
def economic_growth(spark, sf):
    return A.growth(domain_rows(spark, sf, "economy"), ["indicator"], "annual_value", "previous_year_value", Y)


@query("j07_filtered_left_join", "obs", f"""SELECT l.year, l.region_code, avg(l.value) AS avg_employment, avg(ed.value) AS avg_education_metric
 FROM obs l LEFT JOIN obs ed ON l.region_code = ed.region_code AND l.year = ed.year
 WHERE l.year >= {Y} AND l.cat03 LIKE '%雇用%' AND ed.cat02 LIKE '%学生%' GROUP BY 1, 2""")
def filtered_left_join(spark, sf):
    left = domain_rows(spark, sf, "labor").filter((F.col("year") >= Y) & F.col("indicator").contains("雇用"))
    right = domain_rows(spark, sf, "education").filter(F.col("category").contains("学生"))
    return A.related_statistics(left, right, ["year", "region_code"], ["year", "region_code"],
                                left_average="avg_employment", right_average="avg_education_metric")


@query("j10_catalog_relationships", "catalog", """SELECT c.title, r.related_title FROM catalog c JOIN (
 SELECT 'doc' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS dataset_id, 'quality ' || quality AS related_title FROM labels) r USING (dataset_id)""")
def catalog_relationships(spark, sf):
    related = V.table(spark, sf, "labels").select(
        F.concat(F.lit("doc"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("dataset_id"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("related_title"))
    return V.catalog(spark, sf).select("dataset_id", "title").join(related, "dataset_id").select("title", "related_title")


def grained(spark, sf):
    from statlake.functions import timecode as TC
    t = F.col("attr_time")
    return V.raw_obs(spark, sf).select(
        "dataset_id", TC.loose_year(t).alias("year"), TC.loose_quarter(F.coalesce(t, F.lit(""))).alias("quarter"),
        TC.loose_month(t).alias("month"), F.coalesce("attr_area", F.lit("")).alias("region_code"))


@query("j11_join_compatibility", "obs", """WITH p AS (SELECT dataset_id, min(year) AS a, max(year) AS b,
  CASE WHEN max(month) > 0 THEN 'month' WHEN max(quarter) > 0 THEN 'quarter' ELSE 'year' END AS g FROM obs GROUP BY 1),
 s AS (SELECT o.dataset_id, count(DISTINCT o.region_code) AS n FROM obs o WHERE o.region_code IN (SELECT region_code FROM obs WHERE dataset_id = 'ds00001') GROUP BY 1)
 SELECT p.dataset_id, CAST(greatest(least(p.b, m.b) - greatest(p.a, m.a) + 1, 0) AS INT) AS overlap_years, coalesce(s.n, 0) AS shared_regions, p.g = m.g AS same_granularity,
  'year,region_code' AS join_keys, CASE WHEN p.g = m.g THEN 'inner' ELSE 'left' END AS join_type
 FROM p JOIN p m ON m.dataset_id = 'ds00001' AND p.dataset_id <> 'ds00001' LEFT JOIN s ON s.dataset_id = p.dataset_id""")
def join_compatibility(spark, sf):
    return A.join_compatibility(grained(spark, sf), "ds00001")


@query("j11_joinable_pairs", "obs", """WITH p AS (SELECT dataset_id, min(year) AS a, max(year) AS b,
  CASE WHEN max(month) > 0 THEN 'month' WHEN max(quarter) > 0 THEN 'quarter' ELSE 'year' END AS g FROM obs GROUP BY 1),
 r AS (SELECT DISTINCT dataset_id, region_code FROM obs), s AS (SELECT x.dataset_id AS da, y.dataset_id AS db, count(*) AS n FROM r x JOIN r y ON x.region_code = y.region_code AND x.dataset_id < y.dataset_id GROUP BY 1, 2)
 SELECT p.dataset_id AS dataset_a, m.dataset_id AS dataset_b, CAST(least(p.b, m.b) - greatest(p.a, m.a) + 1 AS INT) AS overlap_years, coalesce(s.n, 0) AS shared_regions, p.g = m.g AS same_granularity,
  CASE WHEN s.n > 0 THEN 'year,region_code' ELSE 'year' END AS join_keys, CASE WHEN s.n > 0 THEN CASE WHEN p.g = m.g THEN 'inner' ELSE 'left' END ELSE 'none' END AS join_type
 FROM p JOIN p m ON p.dataset_id < m.dataset_id AND least(p.b, m.b) - greatest(p.a, m.a) + 1 >= 3 LEFT JOIN s ON s.da = p.dataset_id AND s.db = m.dataset_id""")
def joinable_pairs(spark, sf):
    return A.joinable_pairs(grained(spark, sf), 3)


@query("j12_fetch_and_join", "obs", """SELECT year, region_code, sum(value) FILTER (dataset_id = 'ds00001') AS ds00001, sum(value) FILTER (dataset_id = 'ds00002') AS ds00002
 FROM obs GROUP BY 1, 2 HAVING count(*) FILTER (dataset_id = 'ds00001') > 0 AND count(*) FILTER (dataset_id = 'ds00002') > 0""")
def fetch_and_join(spark, sf):
    return A.fetch_and_join(domain_rows(spark, sf, "generic"), ["ds00001", "ds00002"], ["year", "region_code"])


# --- filters, sorts, set operations ---------------------------------------------------------

@query("f01_year_and_region", "obs", "SELECT year, region_code, cat01 AS category, value FROM obs WHERE year >= 1998 AND region_code = '00013'")
def year_and_region(spark, sf):
    return (domain_rows(spark, sf, "population").filter((F.col("year") >= 1998) & (F.col("region_code") == "00013"))
            .select("year", "region_code", "category", "value"))


@query("f02_substring", "obs", "SELECT stats_data_id, cat03 AS indicator, value FROM obs WHERE cat03 LIKE '%失業%'")
def substring(spark, sf):
    return domain_rows(spark, sf, "labor").filter(F.col("indicator").contains("失業")).select("stats_data_id", "indicator", "value")


@query("f06_in_list", "catalog", """SELECT dataset_id, record_count, domain FROM catalog WHERE record_count > 100000 AND time_range_start >= '1995'
 AND domain IN ('labor', 'economy') ORDER BY record_count DESC, dataset_id LIMIT 100""")
def in_list(spark, sf):
    c = V.catalog(spark, sf).filter((F.col("record_count") > 100000) & (F.col("time_range_start") >= "1995") & F.col("domain").isin("labor", "economy"))
    return c.orderBy(F.desc("record_count"), "dataset_id").limit(100).select("dataset_id", "record_count", "domain")


@query("f07_array_membership", "catalog", """SELECT dataset_id FROM catalog WHERE len(list_filter(keywords, lambda k: lower(k) LIKE '%gdp%' OR lower(k) LIKE '%労働%')) > 0
 OR lower(title) LIKE '%物価%'""")
def array_membership(spark, sf):
    hit = F.exists("keywords", lambda k: F.lower(k).contains("gdp") | F.lower(k).contains("労働"))
    return V.catalog(spark, sf).filter(hit | F.lower("title").contains("物価")).select("dataset_id")


@query("f08_null_counts", "raw_obs", "SELECT count(*) - count(attr_area) AS attr_area, count(*) - count(attr_time) AS attr_time, count(*) - count(value) AS value FROM raw_obs")
def null_counts(spark, sf):
    return V.raw_obs(spark, sf).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("attr_area", "attr_time", "value")])


@query("f09_having", "obs", "SELECT region_code, count(*) AS n FROM obs GROUP BY 1 HAVING count(*) >= 2300")
def having(spark, sf):
    return A.group_statistics(domain_rows(spark, sf, "generic"), ["region_code"], count="n", min_count=2300)


@query("o01_two_key_sort", "obs", "SELECT year, region_code, value, stats_data_id FROM obs ORDER BY year DESC, value DESC, stats_data_id LIMIT 100")
def two_key_sort(spark, sf):
    return (domain_rows(spark, sf, "population").select("year", "region_code", "value", "stats_data_id")
            .orderBy(F.desc("year"), F.desc("value"), "stats_data_id").limit(100))


@query("o02_sample_rows", "obs", f"SELECT year, region_code, stats_data_id, value FROM obs WHERE year >= {Y} ORDER BY stats_data_id, year, region_code, value LIMIT 1000")
def sample_rows(spark, sf):
    rows = domain_rows(spark, sf, "population").filter(F.col("year") >= Y).select("year", "region_code", "stats_data_id", "value")
    return rows.orderBy("stats_data_id", "year", "region_code", "value").limit(1000)


_UNION = ["population", "economy", "labor", "education", "health", "agriculture", "construction", "transport", "trade", "social_welfare", "generic"]


@query("u01_domain_counts", "obs", " UNION ALL ".join(f"SELECT '{d}' AS domain, count(*) AS record_count FROM obs WHERE year >= {1990 + i}" for i, d in enumerate(_UNION)))
def domain_counts(spark, sf):
    return A.domain_counts({d: domain_rows(spark, sf, d).filter(F.col("year") >= 1990 + i) for i, d in enumerate(_UNION)})


@query("u04_common_table", "obs", """WITH big AS (SELECT year, region_code, sum(value) AS s FROM obs GROUP BY 1, 2)
 SELECT year, count(*) AS regions, max(s) AS largest FROM big GROUP BY 1""")
def common_table(spark, sf):
    big = A.key_totals(domain_rows(spark, sf, "population"), ["year", "region_code"], "s")
    return big.groupBy("year").agg(F.count("*").alias("regions"), F.max("s").alias("largest"))
