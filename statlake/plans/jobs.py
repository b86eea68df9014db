"""End-to-end jobs: each is one plan over all datasets it is given."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from statlake.functions import scalars as S, text as X
from statlake.operators import catalog as C, infer as I, mapping as M, quality as Q, registry as G
from statlake.session import materialise, scratch_path, together
from statlake.sources import landing as L, sinks as W

MOST_LISTED = 1000                      # datasets of a batch that are named in a filter


def open_work(registry: DataFrame) -> DataFrame:
    """Datasets with a stage left to run, and the stage to resume at."""
    return registry.filter(F.col("load_date").isNull()).withColumn("start_stage", G.start_stage())


def ingest(raw: DataFrame, registry: DataFrame, path: str, threshold: float = 0.1, stage_path: str | None = None,
           audit_path: str | None = None, at: Column | None = None) -> DataFrame:
    """Map, check and store every open dataset that has landed; returns one result row per dataset.

    Rows are mapped once into a staging folder and summed up per dataset: number, failing
    rows, and a content sum. Gate and load decide from that summary; rows are read again only
    for the write. Datasets above the failure threshold stay in staging. With a ``stage_path``
    kept between runs, a dataset whose transformation is stamped resumes from its staged rows
    and is not mapped again. A run can be repeated: of a dataset only its newest staged rows
    count, and one with rows in the lake gets no second copy; it fails if these are not the
    staged ones, in number or in content. With an ``audit_path`` the load adds a row per
    domain to its history, stamped ``at`` (now by default).
    """
    spark = raw.sparkSession
    work = materialise(open_work(registry).select("dataset_id", "domain", "start_stage"), "work")
    unmapped = F.lit(stage_path is None) | F.col("start_stage").isin("fetch", "transform")
    to_map = raw.join(work.filter(unmapped).select("dataset_id", "domain"), "dataset_id")
    rows, newest = stage_rows(M.map_domains(to_map, F.col("domain")), stage_path or scratch_path(spark, "staged"))
    newest = newest.join(work.select("dataset_id"), "dataset_id", "left_semi")
    lake = W.read_if_there(spark, path, rows.drop("run").schema).join(work.select("dataset_id"), "dataset_id", "left_semi")
    stored = lake.groupBy("dataset_id").agg(F.count("*").alias("stored"), content_sum(lake.columns).alias("stored_content"))
    rate = F.coalesce(F.try_divide("failed", "total"), F.lit(0.0))
    gate = materialise(newest.withColumn("passed", rate <= threshold).join(stored, "dataset_id", "left"), "gate")
    new = gate.filter(F.col("passed") & F.col("stored").isNull()).select("dataset_id", "run")
    chosen = rows.join(new, ["dataset_id", "run"], "left_semi").drop("run")
    W.write_typed(chosen, path, ["domain", "year"], mode="append")
    if audit_path:
        W.append_load_audits(chosen, audit_path, F.current_timestamp() if at is None else at)
    done = work.join(gate, "dataset_id", "left")
    same = F.col("stored").isNull() | ((F.col("stored") == F.col("total")) & F.col("stored_content").eqNullSafe(F.col("content")))
    loaded = F.col("passed") & same
    return done.select(
        "dataset_id", "domain", F.when(loaded, "success").when(F.col("total").isNull(), "skipped").otherwise("failed").alias("status"),
        F.when(loaded, F.col("total")).otherwise(0).alias("records"), "start_stage",
        F.when(loaded | F.col("total").isNull(), "").when(F.col("passed"), "load: other rows are stored already")
        .otherwise("validation: too many rows fail").alias("error_message"))


def content_sum(columns: list[str]) -> Column:
    """Sum of row hashes: equal for equal rows in any order, and repeated rows count."""
    return F.sum(F.xxhash64(*[F.col(c) for c in sorted(columns)]).cast("decimal(38,0)"))


def stage_rows(mapped: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Add a run to the staging folder. Returns all staged rows with their ``run``, and of every dataset the summary of its newest run.

    The summary is written beside the rows (dataset_id, run, total, failed, content), so later runs need not read those again.
    """
    spark, run = mapped.sparkSession, f"{time.time_ns():020d}"
    schema = T.StructType([*mapped.schema.fields, T.StructField("run", T.StringType())])
    near = together(mapped, "dataset_id")             # so that a dataset's sums are made in the task that reads its rows
    near.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{path}/rows")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    own = rows.filter(F.col("run") == run).groupBy("dataset_id").agg(F.lit(run).alias("run"), *gate_counts(), content_sum(mapped.columns).alias("content"))
    own.write.mode("append").parquet(f"{path}/summaries")
    summaries = spark.read.schema(own.schema).parquet(f"{path}/summaries")
    rest = [c for c in own.columns if c not in ("dataset_id", "run")]
    newest = summaries.groupBy("dataset_id").agg(F.max(F.struct("run", *rest)).alias("s")).select("dataset_id", "s.*")
    return rows, newest


def record_results(registry: DataFrame, results: DataFrame, at: Column) -> DataFrame:
    """Registry after a run: status, error and the stamps of the stages each dataset has passed.

    Skipped datasets keep their row. Store the result in a new folder and read that from then on.
    """
    ran, ok = F.col("status") != "skipped", F.col("status") == "success"
    mapped = ran & F.col("start_stage").isin("fetch", "transform")
    return C.update_columns(registry, results.select(
        "dataset_id", F.when(ok, "completed").when(ran, "failed").alias("status"), F.when(ran, F.col("error_message")).alias("error_message"),
        F.when(mapped, at).alias("fetch_date"), F.when(mapped, at).alias("transformation_date"),
        F.when(ok, at).alias("validation_date"), F.when(ok, at).alias("load_date")))


def gate_counts() -> list[Column]:
    """Rows, and rows that fail on the columns every domain has: a blank region, or no value or year."""
    bad = Q.is_blank(F.col("region_code")) | F.col("value").isNull() | F.col("year").isNull()
    return [F.count("*").alias("total"), F.count_if(bad).alias("failed")]


def ingest_complete(spark: SparkSession, raw_path: str, domain: str, dataset_id: str, path: str, table: str,
                    fields: list[str] | None = None) -> DataFrame:
    """One landed dataset to its domain table if its quality gate lets it pass; returns the gate.

    ``fields`` spares the survey of field names; a domain table takes its own ones only.
    """
    rows = materialise(M.map_domain(L.read_raw(spark, raw_path, fields), domain, dataset_id=F.lit(dataset_id)), "mapped")
    gate = materialise(Q.quality_gate(rows), "gate")
    W.create_domain_table(spark, domain, path, table)
    W.insert_rows(rows.join(gate.filter("passed").select("dataset_id"), "dataset_id", "left_semi"), table)
    return gate


def ingest_dynamic(raw: DataFrame, items: DataFrame | None, dataset_id: str, path: str, table: str, domain: str = "generic",
                   max_partitions: int = 100, listing: DataFrame | None = None, source: str = "api") -> tuple[DataFrame, DataFrame]:
    """One dataset under a schema of its own: from metadata if there is any, else from data. Returns the stored rows and the catalog entry.

    Raw rows come as columns or as records with any fields. Of the schema's partition columns,
    the leading ones are used that make at most ``max_partitions`` partitions. The entry is made
    from what is stored, and from the dataset's row of ``listing`` (dataset_id, title, description).
    """
    spark = raw.sparkSession
    own = raw.filter(F.col("dataset_id") == dataset_id)
    rows = []
    if items is not None:
        rows = I.schema_from_metadata(items.filter(F.col("dataset_id") == dataset_id)).collect()
    rows = rows or I.schema_from_data(own).collect()
    rows.sort(key=lambda r: r["position"])      # one row per column of one dataset
    struct = M.dynamic_struct([r.asDict() for r in rows])
    parts = [r["name"] for r in rows if r["is_partition"]]
    typed = M.transform_dynamic(own, struct, dataset_id)
    parts = affordable_partitions(typed, parts, max_partitions)
    W.create_dynamic_table(spark, dataset_id, struct, path, parts, domain, table)
    W.insert_rows(typed, table)
    stored = spark.table(table)
    return stored, dynamic_entry(stored, [r["name"] for r in rows], dataset_id, listing, source)


def dynamic_entry(stored: DataFrame, columns: list[str], dataset_id: str, listing: DataFrame | None = None, source: str = "api") -> DataFrame:
    """Catalog entry of one stored dataset, built like those of registered ones."""
    time = F.col("time").cast("string") if "time" in stored.columns else F.lit(None).cast("string")
    stats = stored.agg(F.count("*").alias("record_count"), F.min(time).alias("time_range_start"), F.max(time).alias("time_range_end"))
    stats = stats.select(F.lit(dataset_id).alias("dataset_id"), "*")
    known = stored.sparkSession.createDataFrame([(dataset_id, columns)], "dataset_id string, column_names array<string>")
    if listing is None:
        listing = known.select("dataset_id", F.col("dataset_id").alias("title"), F.lit("").alias("description"))
    return C.catalog_entries(listing.filter(F.col("dataset_id") == dataset_id), stats, known, source)


def affordable_partitions(rows: DataFrame, columns: list[str], limit: int) -> list[str]:
    """Leading partition columns that together make at most ``limit`` partitions."""
    if not columns:
        return columns
    counts = rows.agg(*[F.countDistinct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns[:i + 1]]).alias(f"c{i}")
                        for i in range(len(columns))]).first()
    return columns[:sum(n <= limit for n in counts)]


def priority_build(chunk_rows: DataFrame, chunks: DataFrame, path: str) -> DataFrame:
    """Complete datasets to a year-partitioned lake folder; returns the completeness audit.

    The audit is computed once and decides what is written.
    """
    audit = materialise(L.completeness_audit(chunk_rows, chunks), "audit")
    rows = chunk_rows.join(audit.filter("complete").select("dataset_id"), "dataset_id", "left_semi")
    W.write_typed(W.time_partitioned(rows), path, ["year"], mode="append")
    return audit


def build_catalog(info: DataFrame, items: DataFrame, stats: DataFrame, search_keywords: DataFrame | None = None) -> DataFrame:
    """Rich catalog entries: descriptive fields, dimensions, search summary, statistics, keywords, domain.

    ``info`` comes from landed metadata (one row per dataset), ``stats`` holds
    dataset_id, record_count, time_range_start, time_range_end.
    """
    items = materialise(items, "items")              # parsed once for all that is made of them
    dims = I.dimension_summary(items).groupBy("dataset_id").agg(
        F.array_sort(F.collect_list(F.struct("dim_pos", "dim_id", "dim_name", "item_count"))).alias("dimensions"))
    j = info.join(dims, "dataset_id", "left").join(I.search_summary(items), "dataset_id", "left").join(stats, "dataset_id", "left")
    if search_keywords is not None:
        j = j.join(search_keywords, "dataset_id", "left")
    else:
        j = j.withColumn("search_keyword", F.lit(""))
    word = F.coalesce("search_keyword", F.lit(""))
    names = F.transform(F.coalesce("dimensions", F.array().cast("array<struct<dim_pos:int,dim_id:string,dim_name:string,item_count:bigint>>")), lambda d: d["dim_name"])
    spec = F.col("statistics_name_spec")
    whole = [F.col("gov_org"), *[spec[f] for f in ("tabulation_category", "tabulation_sub_category1", "tabulation_sub_category2", "tabulation_sub_category3")]]
    return j.select(
        "dataset_id", S.dynamic_table_name(F.col("dataset_id")).alias("table_name"), "title", "stat_name", "gov_org", "explanation",
        S.catalog_domain(F.col("title"), word).alias("domain"),
        X.simple_keywords([F.col("stat_name"), F.col("title"), F.col("main_category"), F.col("sub_category"), word], whole, names).alias("keywords"),
        "dimensions", "has_all_prefectures", "prefecture_count", "prefectures", "start_year", "end_year", "year_count", "indicators", "indicator_count",
        "record_count", "time_range_start", "time_range_end")


def run_selected(batch: DataFrame, raw: DataFrame, registry: DataFrame, path: str, threshold: float, at: Column,
                 stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Chosen datasets through ``ingest``; returns results and the stored registry after the run."""
    chosen = registry.join(batch.select("dataset_id"), "dataset_id", "left_semi")
    results = materialise(ingest(raw, chosen, path, threshold, stage_path), "results")
    return results, materialise(record_results(registry, results, at), "registry")


def run_batch(listing: DataFrame, raw: DataFrame, registry: DataFrame, path: str, n: int, threshold: float = 0.1, at: Column | None = None,
              stage_path: str | None = None, **wanted) -> tuple[DataFrame, DataFrame]:
    """Next datasets of the listing through ``ingest``; returns results and the stored registry after the batch."""
    batch = materialise(C.work_batch(listing, n, key="dataset_id", **wanted).select("dataset_id"), "batch")
    return run_selected(batch, of_batch(raw, batch, n), registry, path, threshold, now() if at is None else at, stage_path)


def priority_batch(registry: DataFrame, n: int = 5, threshold: int = 0) -> DataFrame:
    """Next pending datasets at or above a priority, marked as processing."""
    ok = (F.col("status") == "pending") & (F.col("priority") >= threshold)
    return registry.filter(ok).orderBy(F.desc("priority"), "seq").limit(n).withColumn("status", F.lit("processing"))


def run_priority_batch(raw: DataFrame, registry: DataFrame, path: str, n: int = 5, priority: int = 0, threshold: float = 0.1,
                       at: Column | None = None, stage_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Next pending datasets by priority through ``ingest``; returns results and the stored registry."""
    batch = materialise(priority_batch(registry, n, priority).select("dataset_id"), "batch")
    return run_selected(batch, of_batch(raw, batch, n), registry, path, threshold, now() if at is None else at, stage_path)


def of_batch(raw: DataFrame, batch: DataFrame, n: int) -> DataFrame:
    """Raw rows of a batch of at most ``n`` datasets. Ids of a small batch become a filter, which reaches the files and comes before joins."""
    if n > MOST_LISTED:
        return raw
    return raw.filter(F.col("dataset_id").isin([r[0] for r in batch.select("dataset_id").collect()]))        # at most MOST_LISTED ids


def now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
