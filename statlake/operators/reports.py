"""Reports over registry, error log, query log and run results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake import rules
from statlake.functions import scalars as S
from statlake.functions.safe import to_timestamp
from statlake.operators.ranking import exact_percentiles



def _seconds(start: str, end: str) -> Column:
    return F.unix_timestamp(to_timestamp(F.col(end))) - F.unix_timestamp(to_timestamp(F.col(start)))


def lake_summary(registry: DataFrame) -> DataFrame:
    """Datasets, records and estimated bytes per domain."""
    n = F.coalesce(F.sum("record_count"), F.lit(0))
    return registry.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain")).agg(
        F.count("*").alias("datasets"), n.alias("records"), (n * rules.BYTES_PER_RECORD).alias("estimated_bytes")).orderBy("domain")


def processing_times(registry: DataFrame) -> DataFrame:
    """Mean seconds per stage, each measured to the next stage's stamp; nothing follows the load."""
    spans = {"fetch": _seconds("fetch_date", "transformation_date"), "transform": _seconds("transformation_date", "validation_date"),
             "validate": _seconds("validation_date", "load_date"), "total": _seconds("fetch_date", "load_date")}
    out = registry.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(k) for k, v in spans.items()])
    return out.withColumn("load", F.lit(0.0))


def success_rates(registry: DataFrame) -> DataFrame:
    return registry.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain")).agg(
        (F.count_if(F.col("status") == "completed") / F.count("*") * 100).alias("success_rate"))


def quality_metrics(registry: DataFrame) -> DataFrame:
    done = F.col("status") == "completed"
    n = F.count_if(done)
    return registry.agg(
        n.alias("total_validated"), F.coalesce(F.try_divide(n, F.count("*")) * 100, F.lit(0.0)).alias("validation_pass_rate"),
        F.coalesce(F.try_divide(F.sum(F.when(done, F.coalesce("record_count", F.lit(0)))), n), F.lit(0.0)).alias("average_record_count"))


def ingestion_report(registry: DataFrame) -> DataFrame:
    """(section, name, value) rows: counts, stage seconds, success rates, quality metrics."""
    def long(df, section):
        rows = F.array(*[F.struct(F.lit(section).alias("section"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns])
        return df.select(F.inline(rows))
    counts = registry.agg(F.count("*").alias("total_datasets"), F.count_if(F.col("status") == "completed").alias("successful_datasets"),
                          F.count_if(F.col("status") == "failed").alias("failed_datasets"))
    rates = success_rates(registry).select(F.lit("success_rate").alias("section"), F.col("domain").alias("name"), F.col("success_rate").alias("value"))
    return (long(counts, "counts").unionByName(long(processing_times(registry), "seconds")).unionByName(rates)
            .unionByName(long(quality_metrics(registry), "quality")))


def domain_reports(registry: DataFrame) -> DataFrame:
    """Per domain: datasets, records, mean total seconds, quality score 0..100."""
    return registry.groupBy("domain").agg(
        F.count("*").alias("total_datasets"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.avg(_seconds("fetch_date", "load_date")), F.lit(0.0)).alias("average_processing_time"),
        (F.count_if(F.col("status") == "completed") / F.count("*") * 100).alias("data_quality_score"))


# --- errors --------------------------------------------------------------------------

def error_summary(log: DataFrame) -> DataFrame:
    """Error counts by stage, dataset and type, and in total, as (group, name, count) rows.

    The log is reduced to one row per (stage, dataset, type) before it is regrouped.
    """
    def known(c):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c)
    cols = ["stage_name", "dataset_id", "error_type"]
    cells = log.groupBy(*[known(c) for c in cols]).agg(F.count("*").alias("n"))
    rows = F.array(F.struct(F.lit("total").alias("group"), F.lit("errors").alias("name")),
                   *[F.struct(F.lit(c).alias("group"), F.col(c).alias("name")) for c in cols])
    return cells.select(F.explode(rows).alias("x"), "n").groupBy("x.group", "x.name").agg(F.sum("n").alias("count"))


def recent_errors(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def filter_errors(log: DataFrame, dataset_id: str | None = None, stage: str | None = None) -> DataFrame:
    from statlake.operators.catalog import simple_filter
    return simple_filter(log, dataset_id=dataset_id, stage_name=stage)


def retained_failures(gate: DataFrame, raw_root: str, transformed_root: str) -> DataFrame:
    """Audit rows for datasets that failed their gate: where their data stays, and why."""
    failed = gate.filter(~F.col("passed"))
    return failed.select("dataset_id", F.concat(F.lit(raw_root.rstrip("/") + "/"), "dataset_id").alias("raw_path"),
                         F.concat(F.lit(transformed_root.rstrip("/") + "/"), "dataset_id").alias("transformed_path"),
                         F.format_string("%d of %d rows failed", "failed", "total").alias("reason"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Success, failed and skipped datasets, their records and seconds, of a run-result table."""
    s = F.col("status")
    return runs.agg(F.count("*").alias("total"), F.count_if(s == "success").alias("successful"), F.count_if(s == "failed").alias("failed"),
                    F.count_if(s == "skipped").alias("skipped"), F.coalesce(F.sum(F.when(s == "success", F.col("records"))), F.lit(0)).alias("total_records"),
                    F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"))


def run_metrics(runs: DataFrame) -> DataFrame:
    return runs.select("dataset_id", "records", "seconds", F.try_divide("records", "seconds").alias("throughput"),
                       (F.col("records") * rules.BYTES_PER_RECORD).alias("bytes"))


# --- cost ------------------------------------------------------------------------------

def costs(files: DataFrame, queries: DataFrame, transfer_gb: float = 0.0) -> DataFrame:
    """Monthly storage, scan and transfer cost from a file inventory (bytes) and a query log (bytes_scanned)."""
    stored = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("stored_bytes"))
    scanned = queries.agg(F.coalesce(F.sum("bytes_scanned"), F.lit(0)).alias("b")).scalar()
    out = stored.withColumn("scanned_bytes", scanned)
    return out.select("stored_bytes", "scanned_bytes", (F.col("stored_bytes") / 1024 ** 3 * rules.STORAGE_USD_PER_GB).alias("storage_cost"),
                      (F.col("scanned_bytes") / 1024 ** 4 * rules.SCAN_USD_PER_TB).alias("compute_cost"),
                      F.lit(transfer_gb * rules.TRANSFER_USD_PER_GB).alias("transfer_cost"))


def project_costs(current: DataFrame, datasets: int, scales: list[int]) -> DataFrame:
    """Monthly and yearly cost at other numbers of datasets; compute gets 10 % cheaper from 1000 on."""
    if datasets == 0:
        raise ValueError("cannot project from zero datasets")
    at = current.select("*", F.explode(F.array(*[F.lit(s) for s in scales])).alias("scale"))
    factor = F.col("scale") / F.lit(float(datasets))
    storage, transfer = F.col("storage_cost") * factor, F.col("transfer_cost") * factor
    compute = F.col("compute_cost") * factor * F.when(F.col("scale") >= 1000, 0.9).otherwise(1.0)
    total = storage + compute + transfer
    return at.select("scale", storage.alias("monthly_storage"), compute.alias("monthly_compute"), transfer.alias("monthly_transfer"),
                     total.alias("monthly_total"), (total * 12).alias("annual_total"))


def compare_budget(cost: DataFrame, column: str, budget: float | None) -> DataFrame:
    actual = F.col(column)
    if budget is None:
        return cost.select(F.lit(0.0).alias("budget"), actual.alias("actual"), F.lit(0.0).alias("difference"), F.lit(0.0).alias("percentage"))
    percent = actual / budget * 100 if budget > 0 else F.lit(0.0)
    return cost.select(F.lit(float(budget)).alias("budget"), actual.alias("actual"), (F.lit(budget) - actual).alias("difference"), percent.alias("percentage"))


# --- latency ------------------------------------------------------------------------------

def latency_report(log: DataFrame, targets: dict[str, float] = rules.LATENCY_TARGETS_MS) -> DataFrame:
    """Per test type: p50, p95, p99 (exact), mean, extremes, and pass or fail of p95 against its target."""
    points = exact_percentiles(log, "test_type", "latency_ms", [0.5, 0.95, 0.99])
    p = points.groupBy("test_type").agg(*[F.max(F.when(F.col("point") == q, F.col("value"))).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)])
    base = log.groupBy("test_type").agg(F.count("latency_ms").alias("samples"), F.avg("latency_ms").alias("avg"),
                                        F.min("latency_ms").alias("min"), F.max("latency_ms").alias("max"))
    target = F.try_element_at(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]), F.col("test_type"))
    return base.join(p, "test_type").withColumn("result", F.when(F.col("p95") <= target, "pass").otherwise("fail"))


def scalability(current: DataFrame, scales: list[int]) -> DataFrame:
    """Size and hours grow linearly, p95 latency with the logarithm of the scale.

    ``current`` is one row: datasets, size_gb, minutes, p95_ms.
    """
    at = current.select("*", F.explode(F.array(*[F.lit(s) for s in scales])).alias("scale"))
    factor = F.coalesce(F.try_divide("scale", "datasets"), F.col("scale") / 100.0)
    return at.select("scale", (F.col("size_gb") * factor).alias("data_size_gb"), (F.col("minutes") * factor / 60).alias("ingestion_time_hours"),
                     (F.col("p95_ms") * (1 + 0.1 * F.log2(factor + 1))).alias("search_latency_ms"))


def with_error_type(log: DataFrame) -> DataFrame:
    return log.withColumn("error_type", S.error_type(F.col("error_message"), F.col("error_class")))
