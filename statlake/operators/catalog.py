"""Dataset catalog: entries, upserts, listings, summaries and dataset selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from statlake import rules
from statlake.functions import scalars as S, text as X
from statlake.operators.ranking import first_of, top_per_group, top_with_priority



def catalog_entries(listing: DataFrame, stats: DataFrame, columns: DataFrame, source: str) -> DataFrame:
    """Entries from listing rows, per-dataset statistics and column lists."""
    j = listing.join(stats, "dataset_id", "left").join(columns, "dataset_id", "left")
    domain = S.landing_domain(F.col("title"))
    names = F.coalesce("column_names", F.array().cast("array<string>"))
    return j.select(
        "dataset_id", S.dynamic_table_name(F.col("dataset_id")).alias("table_name"), "title", "description", domain.alias("domain"),
        X.catalog_keywords(F.col("title"), F.col("description")).alias("keywords"), names.alias("column_names"),
        S.tags(domain, source, F.size(names)).alias("tags"), F.coalesce("record_count", F.lit(0)).alias("record_count"),
        "time_range_start", "time_range_end")


def extended_entries(entries: DataFrame, schema: DataFrame, profile: DataFrame, runs: DataFrame) -> DataFrame:
    """Entries with partitions, null and distinct counts per column, and the last run's status.

    Column maps are bounded by the number of columns of a dataset.
    """
    parts = schema.filter("is_partition").groupBy("dataset_id").agg(F.array_sort(F.collect_list("name")).alias("partition_fields"))
    maps = profile.groupBy("dataset_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "null_count")))).alias("null_counts"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "distinct_count")))).alias("distinct_counts"))
    out = reduce(lambda a, b: a.join(b, "dataset_id", "left"), [entries, parts, maps, runs])
    return out.withColumn("ingestion_status", F.coalesce("ingestion_status", F.lit("success")))


def upsert(old: DataFrame, new: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Rows of ``new`` replace or extend ``old`` by key. Write the result to a new path and swap."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def update_columns(table: DataFrame, changes: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Set columns of existing rows where a change row gives a value; unknown keys are ignored."""
    cols = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = table.join(new, key, "left")
    return j.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in cols else F.col(c) for c in table.columns],
                    *[F.col(f"_new_{c}").alias(c) for c in cols if c not in table.columns])


def update_status(catalog: DataFrame, changes: DataFrame) -> DataFrame:
    return update_columns(catalog, changes)


def store_schema(catalog: DataFrame, columns: DataFrame) -> DataFrame:
    """Set column names and partition fields from a schema table (dataset_id, position, name, is_partition)."""
    w = columns.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct("position", "name", "is_partition"))).alias("c"))
    change = w.select("dataset_id", F.transform("c", lambda x: x["name"]).alias("column_names"),
                      F.transform(F.filter("c", lambda x: x["is_partition"]), lambda x: x["name"]).alias("partition_fields"))
    return update_columns(catalog, change)


def statistics(catalog: DataFrame) -> DataFrame:
    """Counts by status and domain and overall sums, as (group, name, value) rows from one scan."""
    cells = catalog.groupBy("ingestion_status", "domain").agg(
        F.count("*").alias("n"), F.sum("record_count").alias("records"), F.sum("data_size_bytes").alias("bytes"),
        F.sum(F.when(F.col("ingestion_duration_seconds") > 0, F.col("ingestion_duration_seconds"))).alias("secs"),
        F.count_if(F.col("ingestion_duration_seconds") > 0).alias("timed"))
    by = [cells.groupBy(F.col(c).alias("name")).agg(F.sum("n").cast("double").alias("value")).select(F.lit(g).alias("group"), "name", "value")
          for g, c in (("status", "ingestion_status"), ("domain", "domain"))]
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("records").alias("r"), F.sum("bytes").alias("b"),
                      F.try_divide(F.sum("secs"), F.sum("timed")).alias("d"))
    rows = F.array(*[F.struct(F.lit("total").alias("group"), F.lit(n).alias("name"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value"))
                     for n, c in (("datasets", "n"), ("records", "r"), ("bytes", "b"), ("mean_duration_seconds", "d"))])
    return reduce(DataFrame.unionByName, [*by, total.select(F.inline(rows))])


def summary(catalog: DataFrame) -> DataFrame:
    """Per domain: datasets, records and share with a time range."""
    ranged = F.col("time_range_start").isNotNull()
    return catalog.groupBy("domain").agg(F.count("*").alias("datasets"), F.sum("record_count").alias("total_records"),
                                         (F.count_if(ranged) / F.count("*")).alias("share_with_time_range"))


def listing_catalog(listing: DataFrame) -> DataFrame:
    """Every listing row with domain, priority, importance and update frequency; best first."""
    t = F.col("title")
    out = listing.withColumn("priority", S.listing_priority(t, F.col("updated_date")))
    return (out.withColumn("domain", S.listing_domain(t)).withColumn("importance", S.importance(F.col("priority")))
            .withColumn("update_frequency", S.update_frequency(t)).withColumn("status", F.lit("pending"))
            .orderBy(F.desc("priority"), "id"))


def listing_summary(classified: DataFrame) -> DataFrame:
    """Counts by domain, importance and frequency as (group, name, count) rows from one grouping."""
    cells = classified.groupBy("domain", "importance", "update_frequency").agg(F.count("*").alias("n"))
    rows = F.array(*[F.struct(F.lit(c).alias("group"), F.col(c).alias("name")) for c in ("domain", "importance", "update_frequency")])
    return (cells.select(F.explode(rows).alias("x"), "n").groupBy("x.group", "x.name").agg(F.sum("n").alias("count")))


def datasets_by_domain_words(listing: DataFrame, words=rules.DOMAIN_SEARCH_KEYWORDS) -> DataFrame:
    """Listing rows under every domain one of whose words is in the title; each (domain, id) once."""
    hits = F.array_compact(F.array(*[F.when(S.has_any(F.col("title"), ws), F.struct(F.lit(i).alias("domain_seq"), F.lit(d).alias("domain")))
                                     for i, (d, ws) in enumerate(words)]))
    return listing.select("*", F.inline(hits))


def select_for_domains(listing: DataFrame, n: int = 3) -> DataFrame:
    """Top datasets of every domain in one job, with descending priority numbers."""
    hits = datasets_by_domain_words(listing).withColumn("score", S.selection_score(F.col("title"), F.col("updated_date")))
    return top_with_priority(hits, "domain", [F.desc("score"), F.asc("id")], n).select("domain", "id", "title", "score", "priority")


def selection_candidates(listing: DataFrame, per_domain: int = 20, **criteria) -> DataFrame:
    """The listing rows of every domain with the highest candidate scores, all rows being scored."""
    score = S.candidate_score(F.col("title"), F.col("description"), F.col("record_count"), **criteria)
    hits = datasets_by_domain_words(listing).select(F.col("id").alias("dataset_id"), "domain", "domain_seq", score.alias("priority"), "seq")
    return top_per_group(hits, ["domain"], [F.desc("priority"), F.asc("seq")], per_domain).select(*hits.columns)


def preview(table: DataFrame, filters: dict[str, object], limit: int = 1000, order: str = "dataset_id") -> DataFrame:
    """First rows that fit; ordered, so that a preview can be repeated."""
    conds = [F.col(k) == v for k, v in filters.items()]
    return table.filter(reduce(lambda a, b: a & b, conds, F.lit(True))).orderBy(order).limit(limit)


def english_synonyms(keywords: DataFrame) -> DataFrame:
    """(dataset_id, keyword) rows with the English word of known keywords."""
    known = F.create_map(*[F.lit(x) for kv in rules.ENGLISH_KEYWORDS.items() for x in kv])
    return keywords.withColumn("english", F.try_element_at(known, F.col("keyword"))).filter(F.col("english").isNotNull())


def simple_filter(df: DataFrame, **equal) -> DataFrame:
    """Optional equality filters: arguments that are None do not filter."""
    conds = [F.col(k) == v for k, v in equal.items() if v is not None]
    return df.filter(reduce(lambda a, b: a & b, conds, F.lit(True)))


def work_batch(catalog: DataFrame, n: int, *, importance: str | None = None, domain: str | None = None, priority_min: int | None = None,
               priorities: list[int] | None = None, size_categories: list[str] | None = None, status: str = "pending",
               key: str = "id") -> DataFrame:
    """Next ``n`` datasets to work on, highest priority first."""
    cond = F.col("status") == status
    if importance is not None:
        cond = cond & (F.col("importance") == importance)
    if domain is not None:
        cond = cond & (F.col("domain") == domain)
    if priority_min is not None:
        cond = cond & (F.col("priority") >= priority_min)
    if priorities is not None:
        cond = cond & F.col("priority").isin(priorities)
    if size_categories is not None:
        cond = cond & F.col("size_category").isin(size_categories)
    return catalog.filter(cond).orderBy(F.desc("priority"), key).limit(n)


def run_selection(registry: DataFrame, domains: list[str] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Datasets of a run: by id list, else by domains, else all."""
    if ids is not None:
        return registry.join(ids.select("dataset_id"), "dataset_id", "left_semi")
    return registry.filter(F.col("domain").isin(domains)) if domains else registry


def flattened(catalog: DataFrame) -> DataFrame:
    """Arrays joined with commas, for table exports and CSV."""
    return catalog.select(*[F.concat_ws(",", f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
                            for f in catalog.schema.fields])


def deduplicated(catalog: DataFrame) -> DataFrame:
    return first_of(catalog, ["dataset_id"], ["seq"], catalog.columns)


def keyword_column(listing: DataFrame, out: str = "keywords") -> DataFrame:
    none = F.lit(None).cast("string")
    return listing.withColumn(out, X.extract_keywords(none, F.col("title"), F.col("title"), none, none, F.col("organization")))
