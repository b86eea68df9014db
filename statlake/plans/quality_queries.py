"""Registered queries: quality checks, ranked selections, exact percentiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import scalars as S
from statlake.operators import profile as PR, quality as Q, ranking as R
from statlake.plans import views as V
from statlake.plans.analytics_queries import grained
from statlake.plans.mapping_queries import CANDIDATE_SQL, SELECTION_SQL, domain_rows
from statlake.plans.registered import query
from statlake.schemas import DOMAINS, get_schema
from statlake.session import materialise, scratch_path
from statlake.sources import sinks as W

KEYS = ["dataset_id", "attr_area", "attr_time", "attr_cat01"]


@query("q01_required_columns", "raw_obs", "SELECT dataset_id, count(*) AS rows, 'attr_cat04' AS missing FROM raw_obs GROUP BY 1")
def required_columns(spark, sf):
    raw = V.raw_obs(spark, sf)
    missing = Q.missing_columns(raw, ["dataset_id", "attr_time", "attr_cat04", "value"])
    return raw.groupBy("dataset_id").agg(F.count("*").alias("rows")).withColumn("missing", F.lit(",".join(missing)))


@query("q02_null_check", "raw_obs", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} IN ('', 'null')) AS null_count, count(*) AS total FROM raw_obs"
    for c in ("attr_area", "attr_time", "value")))
def null_check(spark, sf):
    return Q.null_check(V.raw_obs(spark, sf), ["attr_area", "attr_time", "value", "no_such_column"])


@query("q03_range_check", "raw_obs", """SELECT reason, count(*) AS rows FROM (SELECT CASE WHEN v < 2000 THEN 'below_minimum' WHEN v > 60000.5 THEN 'above_maximum' END AS reason
 FROM (SELECT TRY_CAST(value AS DOUBLE) AS v FROM raw_obs)) WHERE reason IS NOT NULL GROUP BY 1""")
def range_check(spark, sf):
    return Q.range_check(V.raw_obs(spark, sf), "value", 2000, 60000.5)


@query("q03_out_of_range_rows", "raw_obs", """SELECT attr_id, row_seq, value, 'above_maximum' AS reason FROM raw_obs WHERE TRY_CAST(value AS DOUBLE) > 90000""")
def out_of_range(spark, sf):
    return Q.out_of_range(V.raw_obs(spark, sf), "value", high=90000).select("attr_id", "row_seq", "value", "reason")


@query("q04_duplicate_keys", "raw_obs", """SELECT count(*) AS duplicate_keys, CAST(sum(n) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM raw_obs
 GROUP BY dataset_id, attr_area, attr_time, attr_cat01 HAVING count(*) > 1)""")
def duplicate_summary(spark, sf):
    return Q.duplicate_summary(V.raw_obs(spark, sf), KEYS)


@query("q04_duplicate_key_rows", "raw_obs", """SELECT dataset_id, attr_area, attr_time, attr_cat01, count(*) AS rows FROM raw_obs GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return Q.duplicate_keys(V.raw_obs(spark, sf), KEYS)


_RULES_SQL = """SELECT attr_id, row_seq, concat_ws('|', CASE WHEN coalesce(attr_area, '') = '' THEN 'no_area' END, CASE WHEN TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NULL THEN 'no_number' END,
  CASE WHEN attr_time IS NULL THEN 'no_time' END) AS reasons FROM raw_obs"""


def _rules():
    return [("no_area", F.col("attr_area").isNotNull()), ("no_number", S.cast_value(F.col("value"), "DOUBLE").isNotNull()),
            ("no_time", F.col("attr_time").isNotNull())]


@query("q05_quarantined", "raw_obs", f"SELECT * FROM ({_RULES_SQL}) WHERE reasons <> ''")
def quarantined(spark, sf):
    bad = Q.quarantine(V.raw_obs(spark, sf), _rules())[1]
    return bad.select("attr_id", "row_seq", F.concat_ws("|", "reasons").alias("reasons"))


@query("q05_valid", "raw_obs", f"SELECT attr_id, row_seq FROM ({_RULES_SQL}) WHERE reasons = ''")
def valid(spark, sf):
    return Q.quarantine(V.raw_obs(spark, sf), _rules())[0].select("attr_id", "row_seq")


def half_typed(spark, sf):
    """Domain rows before typing, with blanks and text left in."""
    return V.raw_obs(spark, sf).select(
        "dataset_id", F.col("attr_id").alias("stats_data_id"), "row_seq", F.substring("attr_time", 1, 4).alias("year"),
        F.col("attr_area").alias("region_code"), F.col("attr_cat01").alias("category"), "value", F.col("attr_unit").alias("unit"))


_FIELDS_SQL = """SELECT dataset_id, stats_data_id, row_seq, concat_ws('|', CASE WHEN year IS NULL THEN 'year' END, CASE WHEN region_code IS NULL THEN 'region_code' END) AS missing,
  concat_ws('|', CASE WHEN NOT regexp_matches(year, '^[0-9]+$') THEN 'year' END, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN 'value' END) AS mistyped
 FROM (SELECT dataset_id, attr_id AS stats_data_id, row_seq, attr_time[1:4] AS year, attr_area AS region_code, value FROM raw_obs)"""


@query("q06_field_errors", "raw_obs", _FIELDS_SQL)
def field_errors(spark, sf):
    df = half_typed(spark, sf)
    return df.select("dataset_id", "stats_data_id", "row_seq", F.concat_ws("|", Q.missing_fields(df, "generic")).alias("missing"),
                     F.concat_ws("|", Q.type_errors(df, "generic")).alias("mistyped"))


@query("q08_dataset_gate", "raw_obs", f"""SELECT dataset_id, count(*) AS total, count(*) FILTER (missing <> '' OR mistyped <> '') AS failed,
 count(*) FILTER (missing <> '' OR mistyped <> '') / count(*) AS failure_rate, count(*) FILTER (missing <> '' OR mistyped <> '') / count(*) <= 0.45 AS passed FROM ({_FIELDS_SQL}) GROUP BY 1""")
def dataset_gate(spark, sf):
    return Q.dataset_gate(half_typed(spark, sf), "generic", 0.45)


@query("q09_quality_gate", "obs", """SELECT dataset_id, CAST(sum(n) AS BIGINT) AS total, CAST(0 AS BIGINT) AS null_dataset_id, CAST(0 AS BIGINT) AS null_year, CAST(0 AS BIGINT) AS null_value,
 count(*) FILTER (n > 1) AS duplicate_keys, count(*) FILTER (n > 1) = 0 AS passed FROM (SELECT dataset_id, year, region_code, count(*) AS n FROM obs GROUP BY ALL) GROUP BY 1""")
def quality_gate(spark, sf):
    return Q.quality_gate(domain_rows(spark, sf, "population"))


def _expected(spark, sf):
    n = F.count("*")
    return (V.table(spark, sf, "lineitem").groupBy(F.concat(F.lit("ds"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("dataset_id"))
            .agg((n + F.min("l_suppkey") % 2).alias("expected")))


_COUNTS_SQL = """SELECT dataset_id, 'row_count' AS check_type, CASE WHEN CAST(dataset_id[3:] AS INT) % 2 = 0 THEN 'passed' ELSE 'failed' END AS status,
 CAST(count(*) + CAST(dataset_id[3:] AS INT) % 2 AS VARCHAR) AS expected, CAST(count(*) AS VARCHAR) AS actual, CAST(-(CAST(dataset_id[3:] AS INT) % 2) AS VARCHAR) AS difference
 FROM obs GROUP BY dataset_id"""


@query("q10_row_counts", "obs", _COUNTS_SQL)
def row_counts(spark, sf):
    return Q.reconcile_counts(domain_rows(spark, sf, "generic"), _expected(spark, sf))


def _expected_schema(spark, sf):
    want = [("dataset_id", "string"), ("stats_data_id", "string"), ("year", "bigint"), ("region_code", "string"), ("category", "string"),
            ("value", "double"), ("note", "string")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in want])
    ids = V.raw_obs(spark, sf).select("dataset_id").distinct()
    return ids.select("dataset_id", F.explode(rows).alias("c")).select("dataset_id", "c.*")


@query("q11_schema", "obs", """SELECT dataset_id, v.* FROM (SELECT DISTINCT dataset_id FROM obs), (VALUES ('year', 'type_mismatch'), ('unit', 'extra'), ('note', 'missing')) v("column", issue)""")
def schema_check(spark, sf):
    want = _expected_schema(spark, sf)
    actual = get_schema("generic")
    have = want.select("dataset_id").distinct().select("dataset_id", F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in actual.fields])).alias("c"))
    return Q.reconcile_schema(have.select("dataset_id", "c.*"), want).select("dataset_id", "column", "issue")


_NULLS_SQL = """SELECT dataset_id, 'null_value' AS check_type, CASE WHEN count(*) = count(attr_area) THEN 'passed' ELSE 'failed' END AS status, CAST(count(*) AS VARCHAR) AS expected,
 CAST(count(attr_area) AS VARCHAR) AS actual, CAST(count(*) - count(attr_area) AS VARCHAR) AS difference FROM raw_obs GROUP BY 1"""


@query("q12_null_values", "raw_obs", _NULLS_SQL)
def null_values(spark, sf):
    return Q.reconcile_nulls(V.raw_obs(spark, sf), ["attr_area", "value"])


_PART_SQL = """SELECT dataset_id, 'partition' AS check_type, 'passed' AS status, 'year' AS expected, CAST(count(DISTINCT year) AS VARCHAR) AS actual, '0' AS difference FROM obs GROUP BY 1"""


@query("q13_partitions", "raw_obs", """WITH y AS (SELECT dataset_id, CASE WHEN CAST(dataset_id[3:] AS INT) % 2 = 0 OR regexp_matches(attr_time[1:4], '^[0-9]{4}$') THEN coalesce(TRY_CAST(regexp_extract(attr_time, '^[0-9]{4}') AS INT), 2020) END AS year FROM raw_obs)
 SELECT dataset_id, 'partition' AS check_type, CASE WHEN count(*) = count(year) THEN 'passed' ELSE 'failed' END AS status, 'year' AS expected, CAST(count(DISTINCT year) AS VARCHAR) AS actual,
  CASE WHEN count(*) = count(year) THEN '0' ELSE '1' END AS difference FROM y GROUP BY 1""")
def partitions(spark, sf):
    """Years from the first four characters; every second dataset has a default where there are none."""
    rows, even = W.time_partitioned(V.raw_obs(spark, sf)), F.substring("dataset_id", 3, 9).cast("int") % 2 == 0
    return Q.partition_check(rows.withColumn("year", F.when(even, F.coalesce("year", F.lit(2020))).otherwise(F.col("year"))))


def _full(spark, sf):
    return Q.full_check(domain_rows(spark, sf, "generic"), _expected(spark, sf), _expected_schema(spark, sf), ["region_code", "value"])


_FULL_SQL = f"""{_COUNTS_SQL} UNION ALL SELECT DISTINCT dataset_id, 'schema', 'failed', NULL, NULL, '3' FROM obs
 UNION ALL SELECT dataset_id, 'null_value', 'passed', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), '0' FROM obs GROUP BY dataset_id UNION ALL {_PART_SQL}"""


@query("q14_full_check", "obs", _FULL_SQL)
def full_check(spark, sf):
    return _full(spark, sf)


def profiled(spark, sf):
    """Profiles of three loads of generic rows: the early years, the later ones without an area, the rest."""
    path, rows = scratch_path(spark, "profile"), materialise(domain_rows(spark, sf, "generic"), "mapped")
    early, plain = F.col("year") <= 1995, F.col("region_code") == ""
    for load, part in (("first", early), ("second", ~early & plain), ("third", ~early & ~plain)):
        PR.append(rows.filter(part), load, path)
    return PR.read(spark, path)


@query("q14_profile_check", "obs", _FULL_SQL)
def profile_check(spark, sf):
    return PR.full_check(profiled(spark, sf), _expected(spark, sf), _expected_schema(spark, sf), ["region_code", "value"])


@query("a20_profile_counts", "obs", """SELECT dataset_id, count(*) AS rows, count(DISTINCT year) AS parts, CAST(min(year) AS VARCHAR) AS first_part, CAST(max(year) AS VARCHAR) AS last_part, false AS null_part FROM obs GROUP BY 1""")
def profile_counts(spark, sf):
    return PR.datasets(profiled(spark, sf)).drop("loads")


@query("a22_profile_columns", "obs", """SELECT dataset_id, c.* FROM (SELECT dataset_id, count(*) AS n FROM obs GROUP BY 1), LATERAL (VALUES ('dataset_id', 'string', n, CAST(0 AS BIGINT)), ('stats_data_id', 'string', n, 0), ('year', 'int', n, 0),
 ('region_code', 'string', n, 0), ('category', 'string', n, 0), ('value', 'double', n, 0), ('unit', 'string', n, 0)) c("column", type, filled, nulls)""")
def profile_columns(spark, sf):
    return PR.columns(profiled(spark, sf))


@query("q15_validation_report", "obs", f"""SELECT t.check_type, count(DISTINCT dataset_id) AS datasets, count(*) AS checks, count(*) FILTER (status = 'passed') AS passed,
 count(*) FILTER (status = 'failed') AS failed, CAST(0 AS BIGINT) AS errors, count(*) FILTER (status = 'passed') / count(*) * 100 AS pass_rate
 FROM ({_FULL_SQL}) r JOIN (VALUES ('all'), ('row_count'), ('schema'), ('null_value'), ('partition')) t(check_type) ON t.check_type IN ('all', r.check_type) GROUP BY 1""")
def validation_report(spark, sf):
    return Q.validation_report(_full(spark, sf))


@query("q16_completeness", "obs", """SELECT dataset_id, count(*) + CAST(dataset_id[3:] AS INT) % 2 AS expected, count(*) AS actual, CAST(dataset_id[3:] AS INT) % 2 = 0 AS complete
 FROM obs GROUP BY dataset_id""")
def completeness(spark, sf):
    r = Q.reconcile_counts(domain_rows(spark, sf, "generic"), _expected(spark, sf))
    return r.select("dataset_id", F.col("expected").cast("bigint").alias("expected"), F.col("actual").cast("bigint").alias("actual"),
                    (F.col("status") == "passed").alias("complete"))


@query("u02_column_sets", "raw_obs", """WITH a AS (SELECT DISTINCT dataset_id, f.c AS "column" FROM raw_obs, LATERAL (VALUES ('attr_area', attr_area), ('attr_cat02', attr_cat02), ('attr_cat03', attr_cat03)) f(c, v) WHERE f.v IS NOT NULL),
 e AS (SELECT DISTINCT dataset_id, c AS "column" FROM raw_obs, (VALUES ('attr_area'), ('attr_cat01')) x(c))
 SELECT dataset_id, "column", 'both' AS side FROM (FROM a INTERSECT FROM e) UNION ALL SELECT dataset_id, "column", 'extra' FROM (FROM a EXCEPT FROM e) UNION ALL SELECT dataset_id, "column", 'missing' FROM (FROM e EXCEPT FROM a)""")
def column_sets(spark, sf):
    """Columns with a value in each dataset against the wanted ones."""
    raw = V.raw_obs(spark, sf)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in ("attr_area", "attr_cat02", "attr_cat03")]))
    actual = raw.select("dataset_id", cells.alias("x")).filter("x.v IS NOT NULL").select("dataset_id", "x.column")
    wanted = raw.select("dataset_id", F.explode(F.array(F.lit("attr_area"), F.lit("attr_cat01"))).alias("column"))
    return Q.column_sets(actual, wanted)


@query("q17_quality_score", "obs", """WITH d AS (SELECT dataset_id, list_sort(list(value)) AS v, count(*) AS n, count(DISTINCT year) AS y, min(year) AS a, max(year) AS b FROM obs GROUP BY 1),
 f AS (SELECT *, v[CAST(ceil(n * 0.25) AS INT)] AS q1, v[CAST(ceil(n * 0.75) AS INT)] AS q3 FROM d),
 s AS (SELECT dataset_id, 1.0::DOUBLE AS completeness, y / (b - a + 1) AS continuity, greatest(0.0, 1.0 - greatest(2021 - b, 0) / 10.0)::DOUBLE AS timeliness,
  len(list_filter(v, lambda x: x < q1 - (q3 - q1) * 1.5 OR x > q3 + (q3 - q1) * 1.5)) / n AS outlier_share FROM f)
 SELECT *, round((completeness + continuity + timeliness + 1 - outlier_share) * 25, 2) AS score FROM s""")
def quality_score(spark, sf):
    return Q.quality_score(domain_rows(spark, sf, "generic"), 2021)


_POINTS = "SELECT dataset_id, count(DISTINCT (year, quarter, month)) AS time_points, 'monthly' AS frequency, count(DISTINCT year) = max(year) - min(year) + 1 AS is_continuous FROM obs GROUP BY 1"


@query("q18_timeseries_suitability", "obs", f"SELECT * FROM ({_POINTS}) WHERE time_points >= 100")
def timeseries_suitability(spark, sf):
    return Q.timeseries_suitability(grained(spark, sf), 100, "monthly")


@query("q18_correlation_candidates", "obs", """SELECT dataset_id, count(DISTINCT year) AS overlap_years FROM obs WHERE cat03 LIKE '%失業%'
 AND year IN (SELECT year FROM obs WHERE cat03 LIKE '%GDP%') GROUP BY 1 HAVING count(DISTINCT year) >= 7""")
def correlation_candidates(spark, sf):
    return Q.correlation_candidates(domain_rows(spark, sf, "labor"), "GDP", "失業", 7)


# --- ranked selections -----------------------------------------------------------------

@query("w01_repeated_rows", "obs", """SELECT dataset_id, year, region_code, category, row_seq, stats_data_id FROM (SELECT *, cat01 AS category,
 row_number() OVER (PARTITION BY dataset_id, year, region_code, cat01 ORDER BY row_seq, stats_data_id) AS rn FROM obs) WHERE rn > 1""")
def repeated_rows(spark, sf):
    from statlake.functions.timecode import loose_year
    raw = V.raw_obs(spark, sf).select("dataset_id", loose_year(F.col("attr_time")).alias("year"), F.coalesce("attr_area", F.lit("")).alias("region_code"),
                                      F.col("attr_cat01").alias("category"), "row_seq", F.col("attr_id").alias("stats_data_id"))
    return Q.domain_duplicates(raw, "population", ["row_seq", "stats_data_id"])


@query("w02_first_per_key", "catalog", """SELECT dataset_id, title, seq FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY priority, seq) AS rn FROM catalog) WHERE rn = 1""")
def first_per_key(spark, sf):
    return R.first_of(V.catalog(spark, sf), ["title"], ["priority", "seq"], ["title", "dataset_id", "seq"])


@query("w03_merge_ranked", "catalog", """SELECT dataset_id, CAST(0 AS INT) AS source, -record_count AS rank FROM catalog WHERE domain = 'labor'
 UNION ALL SELECT dataset_id, 1, seq FROM catalog WHERE priority >= 9 AND domain <> 'labor'""")
def merge_ranked(spark, sf):
    c = V.catalog(spark, sf)
    a = c.filter(F.col("domain") == "labor").select((-F.col("record_count")).alias("rank"), "dataset_id")
    b = c.filter(F.col("priority") >= 9).select(F.col("seq").alias("rank"), "dataset_id")
    return R.merge_ranked(a, b, "dataset_id", "rank").select("dataset_id", "source", "rank")


def candidates(spark, sf):
    l = V.listing(spark, sf)
    domain = S.landing_domain(F.col("title"))
    seq = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(DOMAINS) for x in (d, i)]), F.col("domain"))
    return l.withColumn("domain", domain).select(
        F.col("id").alias("dataset_id"), "domain", seq.alias("domain_seq"),
        S.candidate_score(F.col("title"), F.col("description"), F.col("record_count"), max_records=5000).alias("priority"), "seq")


_DOMAIN_ORDER = list(DOMAINS)
_CAND_SQL = f"""c AS (SELECT id AS dataset_id, domain, {V.pick_sql('domain', []).replace('CASE domain  END', 'list_position([' + ', '.join(f"'{d}'" for d in _DOMAIN_ORDER) + '], domain)')} AS ds,
 {CANDIDATE_SQL} AS priority, seq FROM (SELECT *, {V.pick_sql('seq % 15', [d for _, d in V.TITLES])} AS domain FROM listing))"""


@query("w04_diverse_selection", "listing", f"""WITH {_CAND_SQL},
 s AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY priority DESC, ds, seq) AS rn, first_value((-priority, ds, seq)) OVER (PARTITION BY domain ORDER BY priority DESC, ds, seq) AS lead FROM c),
 a AS (SELECT dataset_id, domain, priority, 1 AS stage, row_number() OVER (ORDER BY lead, rn) AS pos FROM s WHERE rn <= greatest(1, 50 // (SELECT count(DISTINCT domain) FROM c)) ORDER BY lead, rn LIMIT 50),
 b AS (SELECT dataset_id, domain, priority, 2 AS stage, row_number() OVER (ORDER BY priority DESC, ds, seq) AS pos FROM c WHERE dataset_id NOT IN (SELECT dataset_id FROM a))
 SELECT dataset_id, domain, priority, stage FROM (SELECT * FROM a UNION ALL SELECT * FROM b) ORDER BY stage, pos LIMIT 50""")
def diverse_selection(spark, sf):
    c = candidates(spark, sf).withColumn("domain", V.pick(F.col("seq") % 15, [d for _, d in V.TITLES]))
    seq = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(DOMAINS) for x in (d, i)]), F.col("domain"))
    return R.select_diverse(c.withColumn("domain_seq", seq), 50)


@query("w05_top_per_domain", "listing", f"""SELECT id, domain, score, CAST(least(count(*) OVER (PARTITION BY domain), 3) - rn + 1 AS INT) AS priority FROM (
 SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, id) AS rn FROM (SELECT id, {SELECTION_SQL} AS score, {V.pick_sql('seq % 15', [d for _, d in V.TITLES])} AS domain FROM listing)) QUALIFY rn <= 3""")
def top_per_domain(spark, sf):
    l = V.listing(spark, sf).select("id", V.pick(F.col("seq") % 15, [d for _, d in V.TITLES]).alias("domain"),
                                    S.selection_score(F.col("title"), F.col("updated_date")).alias("score"))
    return R.top_with_priority(l, "domain", [F.desc("score"), "id"], 3).select("id", "domain", "score", "priority")


@query("w06_status_transitions", "status_events", """SELECT dataset_id, from_status, status AS to_status, ts AS timestamp, error_message, event_id FROM (
 SELECT *, lag(status) OVER (PARTITION BY dataset_id ORDER BY ts, event_id) AS from_status FROM status_events) WHERE from_status IS NULL OR from_status <> status""")
def status_transitions(spark, sf):
    return R.status_transitions(V.status_events(spark, sf))


@query("a21_exact_percentiles", "query_log", " UNION ALL ".join(
    f"SELECT test_type, {p}::DOUBLE AS point, quantile_cont(latency_ms, {p}) AS value FROM query_log GROUP BY 1" for p in (0.5, 0.95, 0.99)))
def exact_percentiles(spark, sf):
    return R.exact_percentiles(V.query_log(spark, sf), "test_type", "latency_ms", [0.5, 0.95, 0.99])
