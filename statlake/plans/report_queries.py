"""Registered queries: registry, progress, alerts, reports, costs, latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import catalog as C, registry as G, reports as P
from statlake.plans import views as V
from statlake.plans.registered import query

AS_OF = "2001-12-31"


def as_of():
    return F.lit(f"{AS_OF} 00:00:00").cast("timestamp")


_COUNTS = """count(*) AS total_datasets, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed,
 count(*) FILTER (status = 'processing') AS in_progress, count(*) FILTER (status = 'pending') AS pending"""
_AGE = f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(CAST(coalesce(load_date, updated_at) AS TIMESTAMP))) / 86400000000.0"


@query("m01_add_datasets", "registry", """SELECT 'new' || c_custkey AS dataset_id, 'Dataset new' || c_custkey AS dataset_name, CASE c_custkey % 3 WHEN 0 THEN 'labor' ELSE 'generic' END AS domain,
 CAST(CASE WHEN c_custkey % 12 BETWEEN 1 AND 10 THEN c_custkey % 12 ELSE 5 END AS INT) AS priority, 'pending' AS status FROM customer WHERE c_custkey % 2 = 1""")
def add_datasets(spark, sf):
    k = F.col("c_custkey")
    new = V.table(spark, sf, "customer").select(
        F.when(k % 2 == 1, F.concat(F.lit("new"), k.cast("string"))).otherwise(F.concat(F.lit("ds"), F.lpad(k.cast("string"), 8, "0"))).alias("dataset_id"),
        F.lit("").alias("dataset_name"), F.when(k % 3 == 0, "labor").otherwise("mystery").alias("domain"), (k % 12).cast("int").alias("priority"))
    return G.added(V.registry(spark, sf), new.unionAll(new))


@query("m02_latest_status", "status_events", """SELECT dataset_id, status, ts AS updated_at, error_message, events FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY ts DESC, event_id DESC) AS rn,
 count(*) OVER (PARTITION BY dataset_id) AS events FROM status_events) WHERE rn = 1""")
def latest_status(spark, sf):
    return G.latest_status(V.status_events(spark, sf))


@query("m03_stage_stamps", "status_events", """SELECT dataset_id, max(ts) FILTER (stage = 'fetch') AS fetch_date, max(ts) FILTER (stage = 'transform') AS transform_date,
 max(ts) FILTER (stage = 'validate') AS validate_date, max(ts) FILTER (stage = 'load') AS load_date FROM status_events GROUP BY 1""")
def stage_stamps(spark, sf):
    return G.stage_stamps(V.status_events(spark, sf))


@query("m04_remove_datasets", "registry", "SELECT dataset_id, status FROM registry WHERE status <> 'failed'")
def remove_datasets(spark, sf):
    r = V.registry(spark, sf)
    return G.remove(r, G.failed_datasets(r)).select("dataset_id", "status")


@query("m05_bulk_add_count", "", "SELECT count(*) AS added FROM customer WHERE c_custkey % 2 = 1")
def bulk_add_count(spark, sf):
    return add_datasets(spark, sf).agg(F.count("*").alias("added"))


@query("m06_registry_statistics", "registry", """SELECT 'status' AS "group", status AS name, count(*) AS count FROM registry GROUP BY 2 UNION ALL SELECT 'domain', domain, count(*) FROM registry GROUP BY 2""")
def registry_statistics(spark, sf):
    return G.statistics(V.registry(spark, sf))


@query("m07_progress", "registry", f"SELECT {_COUNTS}, count(*) FILTER (status = 'completed') / count(*) AS completion_rate FROM registry")
def progress(spark, sf):
    return G.progress(V.registry(spark, sf))


@query("m07_progress_percent", "registry", """SELECT count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed,
 count(*) FILTER (status NOT IN ('completed', 'failed')) AS pending, count(*) FILTER (status = 'completed') / count(*) * 100 AS progress_percentage FROM registry""")
def progress_percent(spark, sf):
    return G.progress_percent(V.registry(spark, sf))


_DOMAIN_STATS = f"""SELECT domain, {_COUNTS}, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records, avg({_AGE}) AS average_freshness_days,
 count(*) FILTER (status = 'completed') / count(*) * 100 AS completion_rate FROM registry GROUP BY 1"""


@query("m08_domain_statistics", "registry", _DOMAIN_STATS.replace(f"avg({_AGE})", f"round(avg({_AGE}), 6)"))
def domain_statistics(spark, sf):
    return G.domain_statistics(V.registry(spark, sf), as_of()).withColumn("average_freshness_days", F.round("average_freshness_days", 6))


@query("m09_freshness", "registry", f"SELECT dataset_id, {_AGE} AS days FROM registry")
def freshness(spark, sf):
    return V.registry(spark, sf).select("dataset_id", G.freshness_days(as_of()).alias("days"))


_ALERTS = f"""SELECT dataset_id, dataset_name, domain, CAST(trunc({_AGE}) AS INT) AS days_since_update, coalesce(load_date, updated_at) AS last_update,
 CASE WHEN {_AGE} >= 90 THEN 'very_stale' ELSE 'stale' END AS alert_type FROM registry WHERE status = 'completed' AND {_AGE} >= 30"""


@query("m10_freshness_alerts", "registry", _ALERTS)
def freshness_alerts(spark, sf):
    return G.freshness_alerts(V.registry(spark, sf), as_of())


@query("m11_count_alerts", "registry", "SELECT domain, count(*) AS current_count, 1364 AS minimum_required FROM registry GROUP BY 1 HAVING count(*) < 1364")
def count_alerts(spark, sf):
    return G.count_alerts(V.registry(spark, sf), 1364)


def _r(x, d):
    return f"CAST(round(CAST({x} AS DECIMAL(38, 10)), {d}) AS DOUBLE)"


@query("m12_dashboard", "registry", f"""WITH p AS (SELECT {_COUNTS} FROM registry), d AS ({_DOMAIN_STATS}), a AS ({_ALERTS})
 SELECT 'progress' AS section, 'all' AS name, metric, value FROM (SELECT total_datasets::DOUBLE AS total_datasets, completed::DOUBLE AS completed, failed::DOUBLE AS failed, in_progress::DOUBLE AS in_progress,
   pending::DOUBLE AS pending, {_r('completed / total_datasets', 2)} AS completion_rate FROM p) UNPIVOT (value FOR metric IN (total_datasets, completed, failed, in_progress, pending, completion_rate))
 UNION ALL SELECT 'domain', domain, metric, value FROM (SELECT domain, total_datasets::DOUBLE AS total, completed::DOUBLE AS completed, failed::DOUBLE AS failed, {_r('completion_rate', 2)} AS completion_rate,
   total_records::DOUBLE AS total_records, {_r('average_freshness_days', 1)} AS average_freshness_days FROM d) UNPIVOT (value FOR metric IN (total, completed, failed, completion_rate, total_records, average_freshness_days))
 UNION ALL SELECT 'freshness_alert', alert_type, 'count', count(*)::DOUBLE FROM a GROUP BY 2
 UNION ALL SELECT 'count_alert', domain, 'current_count', total_datasets::DOUBLE FROM d WHERE total_datasets < 3""")
def dashboard(spark, sf):
    return G.dashboard(V.registry(spark, sf), as_of())


_STAGE = """CASE WHEN load_date IS NOT NULL OR validation_date IS NOT NULL THEN 'load' WHEN transformation_date IS NOT NULL THEN 'validate' WHEN fetch_date IS NOT NULL THEN 'transform' ELSE 'fetch' END"""


@query("m13_resume_stage", "registry", f"SELECT dataset_id, {_STAGE} AS stage FROM registry")
def resume_stage(spark, sf):
    return V.registry(spark, sf).select("dataset_id", G.start_stage().alias("stage"))


@query("m14_stage_dashboard", "registry", f"""SELECT 'status' AS "group", status AS name, count(*) AS count FROM registry GROUP BY 2 UNION ALL SELECT 'stage', {_STAGE}, count(*) FROM registry GROUP BY 2""")
def stage_dashboard(spark, sf):
    return G.stage_dashboard(V.registry(spark, sf))


def _sec(a, b):
    return f"(epoch(CAST({b} AS TIMESTAMP)) - epoch(CAST({a} AS TIMESTAMP)))"


@query("m15_final_report", "registry", f"""SELECT total_datasets, success_count, failed_count, total_seconds, success_count / total_datasets AS success_rate, total_seconds / total_datasets AS mean_seconds FROM (
 SELECT count(*) AS total_datasets, count(*) FILTER (status = 'completed') AS success_count, count(*) FILTER (status = 'failed') AS failed_count,
  CAST(sum({_sec('fetch_date', 'coalesce(load_date, validation_date, transformation_date)')}) AS BIGINT) AS total_seconds FROM registry)""")
def final_report(spark, sf):
    return G.final_report(V.registry(spark, sf))


@query("m15_errors_by_message", "registry", "SELECT error_message, count(*) AS datasets FROM registry WHERE error_message IS NOT NULL GROUP BY 1")
def errors_by_message(spark, sf):
    return G.errors_by_message(V.registry(spark, sf))


@query("m16_failed_datasets", "registry", "SELECT dataset_id FROM registry WHERE status = 'failed'")
def failed_datasets(spark, sf):
    return G.failed_datasets(V.registry(spark, sf))


@query("m17_lake_summary", "registry", """SELECT domain, count(*) AS datasets, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS records, CAST(coalesce(sum(record_count), 0) * 1024 AS BIGINT) AS estimated_bytes FROM registry GROUP BY 1""")
def lake_summary(spark, sf):
    return P.lake_summary(V.registry(spark, sf))


_TIMES = f"""coalesce(avg({_sec('fetch_date', 'transformation_date')}), 0.0) AS fetch, coalesce(avg({_sec('transformation_date', 'validation_date')}), 0.0) AS transform,
 coalesce(avg({_sec('validation_date', 'load_date')}), 0.0) AS validate, coalesce(avg({_sec('fetch_date', 'load_date')}), 0.0) AS total, 0.0::DOUBLE AS load"""


@query("m18_processing_times", "registry", f"SELECT {_TIMES} FROM registry")
def processing_times(spark, sf):
    return P.processing_times(V.registry(spark, sf))


@query("m19_success_rates", "registry", "SELECT domain, count(*) FILTER (status = 'completed') / count(*) * 100 AS success_rate FROM registry GROUP BY 1")
def success_rates(spark, sf):
    return P.success_rates(V.registry(spark, sf))


_QUALITY = """count(*) FILTER (status = 'completed') AS total_validated, count(*) FILTER (status = 'completed') / count(*) * 100 AS validation_pass_rate,
 sum(record_count) FILTER (status = 'completed') / count(*) FILTER (status = 'completed') AS average_record_count"""


@query("m20_quality_metrics", "registry", f"SELECT {_QUALITY} FROM registry")
def quality_metrics(spark, sf):
    return P.quality_metrics(V.registry(spark, sf))


@query("m21_ingestion_report", "registry", f"""SELECT 'counts' AS section, name, value FROM (SELECT count(*)::DOUBLE AS total_datasets, (count(*) FILTER (status = 'completed'))::DOUBLE AS successful_datasets,
   (count(*) FILTER (status = 'failed'))::DOUBLE AS failed_datasets FROM registry) UNPIVOT (value FOR name IN (total_datasets, successful_datasets, failed_datasets))
 UNION ALL SELECT 'seconds', name, value FROM (SELECT {_TIMES} FROM registry) UNPIVOT (value FOR name IN ("fetch", "transform", "validate", "total", "load"))
 UNION ALL SELECT 'success_rate', domain, count(*) FILTER (status = 'completed') / count(*) * 100 FROM registry GROUP BY 2
 UNION ALL SELECT 'quality', name, value FROM (SELECT * REPLACE (total_validated::DOUBLE AS total_validated) FROM (SELECT {_QUALITY} FROM registry)) UNPIVOT (value FOR name IN (total_validated, validation_pass_rate, average_record_count))""")
def ingestion_report(spark, sf):
    return P.ingestion_report(V.registry(spark, sf))


@query("m22_domain_reports", "registry", f"""SELECT domain, count(*) AS total_datasets, CAST(coalesce(sum(record_count), 0) AS BIGINT) AS total_records, coalesce(avg({_sec('fetch_date', 'load_date')}), 0.0) AS average_processing_time,
 count(*) FILTER (status = 'completed') / count(*) * 100 AS data_quality_score FROM registry GROUP BY 1""")
def domain_reports(spark, sf):
    return P.domain_reports(V.registry(spark, sf))


_LOG = "(SELECT *, coalesce(error_class, 'unknown') AS error_type FROM error_log)"


@query("m23_error_summary", "error_log", f"""SELECT 'total' AS "group", 'errors' AS name, count(*) AS count FROM error_log UNION ALL SELECT 'stage_name', stage_name, count(*) FROM error_log GROUP BY 2
 UNION ALL SELECT 'dataset_id', dataset_id, count(*) FROM error_log GROUP BY 2 UNION ALL SELECT 'error_type', error_type, count(*) FROM {_LOG} GROUP BY 2""")
def error_summary(spark, sf):
    return P.error_summary(V.error_log(spark, sf).withColumnRenamed("error_class", "error_type"))


@query("m23_recent_errors", "error_log", "SELECT event_id, ts, dataset_id, error_message FROM error_log ORDER BY ts DESC, event_id DESC LIMIT 10")
def recent_errors(spark, sf):
    return P.recent_errors(V.error_log(spark, sf)).select("event_id", "ts", "dataset_id", "error_message")


@query("f19_filter_errors", "error_log", "SELECT event_id, error_message FROM error_log WHERE dataset_id = 'ds000017' AND stage_name = 'fetch'")
def filter_errors(spark, sf):
    return P.filter_errors(V.error_log(spark, sf), "ds000017", "fetch").select("event_id", "error_message")


@query("m24_retained_failures", "raw_obs", """SELECT dataset_id, 'lake/raw/' || dataset_id AS raw_path, 'lake/processed/' || dataset_id AS transformed_path, failed || ' of ' || total || ' rows failed' AS reason FROM (
 SELECT dataset_id, count(*) AS total, count(*) FILTER (attr_area IS NULL OR attr_time IS NULL OR NOT regexp_matches(attr_time[1:4], '^[0-9]+$') OR TRY_CAST(value AS DOUBLE) IS NULL) AS failed FROM raw_obs GROUP BY 1)
 WHERE failed / total > 0.45""")
def retained_failures(spark, sf):
    from statlake.plans.quality_queries import dataset_gate
    return P.retained_failures(dataset_gate(spark, sf), "lake/raw", "lake/processed")


def runs(spark, sf):
    s = F.col("status")
    return V.registry(spark, sf).select(
        "dataset_id", F.when(s == "completed", "success").when(s == "failed", "failed").otherwise("skipped").alias("status"),
        F.coalesce("record_count", F.lit(0)).alias("records"), (F.col("seq") % 100).cast("double").alias("seconds"))


@query("m25_run_summary", "registry", """SELECT count(*) AS total, count(*) FILTER (status = 'completed') AS successful, count(*) FILTER (status = 'failed') AS failed,
 count(*) FILTER (status NOT IN ('completed', 'failed')) AS skipped, CAST(sum(record_count) AS BIGINT) AS total_records, sum((seq % 100)::DOUBLE) AS total_seconds FROM registry""")
def run_summary(spark, sf):
    return P.run_summary(runs(spark, sf))


@query("m26_inventory_summary", "registry", """SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing') AS processing,
 count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed FROM registry""")
def inventory_summary(spark, sf):
    return G.inventory_summary(V.registry(spark, sf))


def current_costs(spark, sf):
    files = V.catalog(spark, sf).select((F.col("data_size_bytes") * 1000).alias("bytes"))
    log = V.query_log(spark, sf).select((F.col("bytes_scanned") * 1000).alias("bytes_scanned"))
    return P.costs(files, log, 12.5)


_COSTS = """SELECT s AS stored_bytes, b AS scanned_bytes, s / 1073741824.0::DOUBLE * 0.025::DOUBLE AS storage_cost, b / 1099511627776.0::DOUBLE * 5.0::DOUBLE AS compute_cost, (12.5::DOUBLE * 0.114::DOUBLE) AS transfer_cost
 FROM (SELECT CAST(sum(data_size_bytes * 1000) AS BIGINT) AS s FROM catalog), (SELECT CAST(sum(bytes_scanned * 1000) AS BIGINT) AS b FROM query_log)"""


@query("m27_costs", "catalog query_log", _COSTS)
def costs(spark, sf):
    return current_costs(spark, sf)


_PROJECTED = f"""SELECT *, monthly_total * 12 AS annual_total FROM (SELECT *, monthly_storage + monthly_compute + monthly_transfer AS monthly_total FROM (
 SELECT scale, storage_cost * (scale / 100.0::DOUBLE) AS monthly_storage, compute_cost * (scale / 100.0::DOUBLE) * CASE WHEN scale >= 1000 THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS monthly_compute,
  transfer_cost * (scale / 100.0::DOUBLE) AS monthly_transfer FROM ({_COSTS}), (VALUES (100), (1000), (10000)) v(scale)))"""


@query("m28_cost_projection", "catalog query_log", _PROJECTED)
def cost_projection(spark, sf):
    return P.project_costs(current_costs(spark, sf), 100, [100, 1000, 10000])


@query("m29_budget", "catalog query_log", f"SELECT 50.0::DOUBLE AS budget, monthly_total AS actual, 50.0::DOUBLE - monthly_total AS difference, monthly_total / 50.0::DOUBLE * 100 AS percentage FROM ({_PROJECTED})")
def budget(spark, sf):
    return P.compare_budget(cost_projection(spark, sf), "monthly_total", 50.0)


@query("m30_scalability", "query_log catalog", """WITH c AS (SELECT count(*) AS n, sum(data_size_bytes) / 1e9::DOUBLE AS gb, sum(ingestion_duration_seconds) / 60 AS minutes FROM catalog WHERE ingestion_status = 'success')
 SELECT scale, gb * (scale / n) AS data_size_gb, minutes * (scale / n) / 60 AS ingestion_time_hours, p * (1 + 0.1::DOUBLE * log2(scale / n + 1)) AS search_latency_ms
 FROM c, (SELECT quantile_cont(latency_ms, 0.95) AS p FROM query_log WHERE test_type = 'catalog_search'), (VALUES (1000), (10000)) v(scale)""")
def scalability(spark, sf):
    """From what the catalog's ingested datasets took, and the measured search latency."""
    loaded = V.catalog(spark, sf).filter("ingestion_status = 'success'").agg(
        F.count("*").alias("datasets"), (F.sum("data_size_bytes") / 1e9).alias("size_gb"), (F.sum("ingestion_duration_seconds") / 60).alias("minutes"))
    p95 = P.latency_report(V.query_log(spark, sf)).filter("test_type = 'catalog_search'").select("p95").scalar()
    return P.scalability(loaded.withColumn("p95_ms", p95), [1000, 10000])


@query("m31_latency_report", "query_log", """SELECT test_type, count(latency_ms) AS samples, round(avg(latency_ms), 9) AS avg, min(latency_ms) AS min, max(latency_ms) AS max, quantile_cont(latency_ms, 0.5) AS p50,
 quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99, CASE WHEN quantile_cont(latency_ms, 0.95) <= CASE test_type WHEN 'sql' THEN 5000 ELSE 100 END THEN 'pass' ELSE 'fail' END AS result FROM query_log GROUP BY 1""")
def latency_report(spark, sf):
    return P.latency_report(V.query_log(spark, sf)).withColumn("avg", F.round("avg", 9))


@query("m32_run_metrics", "registry", """SELECT dataset_id, coalesce(record_count, 0) AS records, (seq % 100)::DOUBLE AS seconds, coalesce(record_count, 0) / nullif((seq % 100)::DOUBLE, 0) AS throughput,
 coalesce(record_count, 0) * 1024 AS bytes FROM registry""")
def run_metrics(spark, sf):
    return P.run_metrics(runs(spark, sf))


# --- registry and inventory filters ------------------------------------------------------------

@query("f13_query_registry", "registry", "SELECT dataset_id, added_at FROM registry WHERE domain = 'labor' AND status = 'completed' AND added_at >= '1996-01-01' AND added_at <= '1998-06-30'")
def query_registry(spark, sf):
    return G.query_registry(V.registry(spark, sf), "labor", "completed", ("1996-01-01", "1998-06-30")).select("dataset_id", "added_at")


@query("f14_inventory_listing", "registry", "SELECT dataset_id, priority FROM registry WHERE status = 'pending' AND domain = 'trade'")
def inventory_listing(spark, sf):
    return C.simple_filter(V.registry(spark, sf), status="pending", domain="trade").select("dataset_id", "priority")


@query("f15_point_lookup", "registry", "SELECT dataset_id, dataset_name, status FROM registry WHERE dataset_id = 'ds00000042'")
def point_lookup(spark, sf):
    return C.simple_filter(V.registry(spark, sf), dataset_id="ds00000042").limit(1).select("dataset_id", "dataset_name", "status")


@query("f16_catalog_lists", "catalog", "SELECT dataset_id, ingestion_status, domain FROM catalog WHERE ingestion_status = 'failed' OR domain = 'health' OR time_range_start IS NOT NULL")
def catalog_lists(spark, sf):
    c = V.catalog(spark, sf)
    wanted = (F.col("ingestion_status") == "failed") | (F.col("domain") == "health") | F.col("time_range_start").isNotNull()
    return c.filter(wanted).select("dataset_id", "ingestion_status", "domain")


@query("f18_run_selection", "registry", "SELECT dataset_id FROM registry WHERE status = 'failed'")
def run_selection(spark, sf):
    r = V.registry(spark, sf)
    return C.run_selection(r, ["labor"], G.failed_datasets(r)).select("dataset_id")


@query("o04_next_dataset", "registry", "SELECT dataset_id, priority FROM registry WHERE status = 'pending' AND priority >= 3 ORDER BY priority DESC, seq LIMIT 1")
def next_dataset(spark, sf):
    return G.next_dataset(V.registry(spark, sf), 3).select("dataset_id", "priority")
