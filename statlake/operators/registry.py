"""Dataset registry as a table: additions, status events, stage stamps, progress, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake import rules
from statlake.functions.safe import to_timestamp
from statlake.schemas import DOMAINS, REGISTRY_STATUSES

STAGES = ["fetch", "transform", "validate", "load"]


def clean_additions(rows: DataFrame) -> DataFrame:
    """Default priority 5 outside 1..10, generic for unknown domains, a name from the id."""
    ok = F.coalesce(F.col("priority").between(1, 10), F.lit(False))
    return rows.select(
        "dataset_id", F.coalesce(F.nullif("dataset_name", F.lit("")), F.concat(F.lit("Dataset "), "dataset_id")).alias("dataset_name"),
        F.when(F.col("domain").isin(list(DOMAINS)), F.col("domain")).otherwise("generic").alias("domain"),
        F.when(ok, F.col("priority")).otherwise(5).alias("priority"), F.lit("pending").alias("status"))


def added(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """What an addition really adds: one row per id not registered yet."""
    new = clean_additions(rows).groupBy("dataset_id").agg(F.min(F.struct("dataset_name", "domain", "priority", "status")).alias("r"))
    return new.select("dataset_id", "r.*").join(registry.select("dataset_id"), "dataset_id", "left_anti")


def remove(registry: DataFrame, ids: DataFrame) -> DataFrame:
    return registry.join(ids.select("dataset_id"), "dataset_id", "left_anti")


def latest_status(events: DataFrame) -> DataFrame:
    """Current status of every dataset from its events; unknown statuses are ignored."""
    known = events.filter(F.col("status").isin(REGISTRY_STATUSES))
    last = known.groupBy("dataset_id").agg(F.max(F.struct("ts", "event_id", "status", "error_message")).alias("r"), F.count("*").alias("events"))
    return last.select("dataset_id", "r.status", F.col("r.ts").alias("updated_at"), F.col("r.error_message").alias("error_message"), "events")


def stage_stamps(events: DataFrame) -> DataFrame:
    """Last completion time of each stage, one column per stage."""
    return events.groupBy("dataset_id").agg(*[F.max(F.when(F.col("stage") == s, F.col("ts"))).alias(f"{s}_date") for s in STAGES])


def statistics(registry: DataFrame) -> DataFrame:
    """Counts by status and by domain from one grouping."""
    cells = registry.groupBy("status", "domain").agg(F.count("*").alias("n"))
    rows = F.array(F.struct(F.lit("status").alias("group"), F.col("status").alias("name")),
                   F.struct(F.lit("domain").alias("group"), F.col("domain").alias("name")))
    return cells.select(F.explode(rows).alias("x"), "n").groupBy("x.group", "x.name").agg(F.sum("n").alias("count"))


def _counts() -> list[Column]:
    s = F.col("status")
    return [F.count("*").alias("total_datasets"), F.count_if(s == "completed").alias("completed"), F.count_if(s == "failed").alias("failed"),
            F.count_if(s.isin("processing", "in_progress")).alias("in_progress"), F.count_if(s == "pending").alias("pending")]


def progress(registry: DataFrame) -> DataFrame:
    """Counts per status and the completion rate, 0..1."""
    out = registry.agg(*_counts())
    return out.withColumn("completion_rate", F.coalesce(F.try_divide("completed", "total_datasets"), F.lit(0.0)))


def progress_percent(registry: DataFrame) -> DataFrame:
    c = progress(registry)
    return c.select(F.col("total_datasets").alias("total"), "completed", "failed",
                    (F.col("total_datasets") - F.col("completed") - F.col("failed")).alias("pending"),
                    (F.col("completion_rate") * 100).alias("progress_percentage"))


def freshness_days(as_of: Column) -> Column:
    """Days since the load date, else the update date; null for unreadable text."""
    at = to_timestamp(F.coalesce(F.nullif("load_date", F.lit("")), F.col("updated_at")))
    return (F.unix_micros(as_of) - F.unix_micros(at)) / 86400e6


def domain_statistics(registry: DataFrame, as_of: Column) -> DataFrame:
    """Per domain: counts, records, completion in percent, mean age in days."""
    return (registry.withColumn("_age", freshness_days(as_of)).groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain"))
            .agg(*_counts(), F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
                 F.coalesce(F.avg("_age"), F.lit(0.0)).alias("average_freshness_days"))
            .withColumn("completion_rate", F.col("completed") / F.col("total_datasets") * 100))


def freshness_alerts(registry: DataFrame, as_of: Column, stale: int = rules.STALE_DAYS, very_stale: int = rules.VERY_STALE_DAYS) -> DataFrame:
    done = registry.filter(F.col("status") == "completed").withColumn("_age", freshness_days(as_of))
    kind = F.when(F.col("_age") >= very_stale, "very_stale").when(F.col("_age") >= stale, "stale")
    return (done.withColumn("alert_type", kind).filter(F.col("alert_type").isNotNull())
            .select("dataset_id", "dataset_name", "domain", F.col("_age").cast("int").alias("days_since_update"),
                    F.coalesce("load_date", "updated_at").alias("last_update"), "alert_type"))


def count_alerts(registry: DataFrame, minimum: int = rules.MIN_DATASETS_PER_DOMAIN) -> DataFrame:
    counts = registry.groupBy("domain").agg(F.count("*").alias("current_count"))
    return counts.filter(F.col("current_count") < minimum).withColumn("minimum_required", F.lit(minimum))


def dashboard(registry: DataFrame, as_of: Column) -> DataFrame:
    """(section, name, metric, value) rows: progress, domains, and alert counts."""
    def long(df, section, name, metrics):
        rows = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics])
        return df.select(F.lit(section).alias("section"), name.alias("name"), F.inline(rows))
    c = F.col
    p = long(progress(registry), "progress", F.lit("all"), [
        (m, c(m)) for m in ("total_datasets", "completed", "failed", "in_progress", "pending")] + [
        ("completion_rate", F.round("completion_rate", 2))])
    d = long(domain_statistics(registry, as_of), "domain", c("domain"), [
        ("total", c("total_datasets")), ("completed", c("completed")), ("failed", c("failed")),
        ("completion_rate", F.round("completion_rate", 2)), ("total_records", c("total_records")),
        ("average_freshness_days", F.round("average_freshness_days", 1))])
    a = long(freshness_alerts(registry, as_of).groupBy("alert_type").agg(F.count("*").alias("n")), "freshness_alert", c("alert_type"), [("count", c("n"))])
    b = long(count_alerts(registry), "count_alert", c("domain"), [("current_count", c("current_count"))])
    return p.unionByName(d).unionByName(a).unionByName(b)


def start_stage() -> Column:
    """Stage to resume at, from the stamps of the completed stages."""
    return (F.when(F.col("load_date").isNotNull(), "load").when(F.col("validation_date").isNotNull(), "load")
            .when(F.col("transformation_date").isNotNull(), "validate").when(F.col("fetch_date").isNotNull(), "transform")
            .otherwise("fetch"))


def stage_dashboard(registry: DataFrame) -> DataFrame:
    """Counts by status and by the stage a dataset is in."""
    cells = registry.groupBy("status", start_stage().alias("stage")).agg(F.count("*").alias("n"))
    rows = F.array(F.struct(F.lit("status").alias("group"), F.col("status").alias("name")),
                   F.struct(F.lit("stage").alias("group"), F.col("stage").alias("name")))
    return cells.select(F.explode(rows).alias("x"), "n").groupBy("x.group", "x.name").agg(F.sum("n").alias("count"))


def final_report(registry: DataFrame) -> DataFrame:
    """Success rate (0..1) and total and mean seconds of the datasets with a start and an end."""
    span = (F.unix_timestamp(to_timestamp(F.coalesce("load_date", "validation_date", "transformation_date")))
            - F.unix_timestamp(to_timestamp(F.col("fetch_date"))))
    out = registry.agg(F.count("*").alias("total_datasets"), F.count_if(F.col("status") == "completed").alias("success_count"),
                       F.count_if(F.col("status") == "failed").alias("failed_count"), F.coalesce(F.sum(span), F.lit(0)).alias("total_seconds"))
    return out.select("*", F.coalesce(F.try_divide("success_count", "total_datasets"), F.lit(0.0)).alias("success_rate"),
                      F.coalesce(F.try_divide("total_seconds", "total_datasets"), F.lit(0.0)).alias("mean_seconds"))


def errors_by_message(registry: DataFrame) -> DataFrame:
    failed = registry.filter(F.col("error_message").isNotNull())
    return failed.groupBy("error_message").agg(F.count("*").alias("datasets"))


def failed_datasets(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("status") == "failed").select("dataset_id")


def added_between(registry: DataFrame, start: str | None = None, end: str | None = None) -> Column:
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("added_at") >= start)
    if end is not None:
        cond = cond & (F.col("added_at") <= end)
    return cond


def query_registry(registry: DataFrame, domain: str | None = None, status: str | None = None,
                   date_range: tuple[str, str] | None = None) -> DataFrame:
    from statlake.operators.catalog import simple_filter
    out = simple_filter(registry, domain=domain, status=status)
    return out.filter(added_between(out, *date_range)) if date_range else out


def next_dataset(registry: DataFrame, threshold: int = 0) -> DataFrame:
    """Pending dataset with the highest priority, the earliest registered on ties."""
    ok = (F.col("status") == "pending") & (F.col("priority") >= threshold)
    return registry.filter(ok).orderBy(F.desc("priority"), "seq").limit(1)


def inventory_summary(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in REGISTRY_STATUSES])
