"""Stored domain facts: year partitions, and totals per year and region that joins read without a shuffle.

A domain has two tables. ``facts`` holds its rows by year, so filters and joins on the year
open the folders they need. ``totals`` holds one row per year, region and label, bucketed by
region: groupings and joins on year and region find both sides dealt alike. A row of totals
stands for all its facts, so a region with most of the facts is one row like any other.
A load appends facts and rewrites the totals of its own years only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlake.schemas import get_domain
from statlake.sources.sinks import spread_for

BUCKETS = 16
KEYS = ["year", "region_code"]


@dataclass(frozen=True)
class FactTables:
    facts: str
    totals: str
    labels: tuple[str, ...]         # columns that go with a region

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.facts)

    def by_region(self, spark: SparkSession) -> DataFrame:
        """(year, region_code, labels, records, n, total, low, high); ``n`` counts values that are not null."""
        return spark.table(self.totals)


def session_settings(spark: SparkSession) -> None:
    """Sides bucketed by region alone may meet on year and region as they lie."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def create(rows: DataFrame, domain: str, name: str, path: str, buckets: int = BUCKETS) -> FactTables:
    """Store the first rows of a domain as tables ``name`` and ``name_totals`` under ``path``."""
    label = get_domain(domain).label_column
    tables = FactTables(name, f"{name}_totals", (label,) if label else ())
    spread_for(rows, ["year"]).write.partitionBy("year").format("parquet").option("path", f"{path}/facts").saveAsTable(tables.facts)
    spark = rows.sparkSession
    (_totals(tables.rows(spark), tables).write.partitionBy("year").bucketBy(buckets, "region_code").sortBy("region_code")
     .format("parquet").option("path", f"{path}/totals").saveAsTable(tables.totals))
    return tables


def _totals(facts: DataFrame, tables: FactTables) -> DataFrame:
    v = F.col("value")
    out = facts.groupBy(*KEYS, *tables.labels).agg(F.count("*").alias("records"), F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"))
    return out.select("region_code", *tables.labels, "records", "n", "total", "low", "high", "year")


def append(rows: DataFrame, tables: FactTables) -> list[int]:
    """Add rows to the facts and rewrite the totals of their years; returns these years."""
    spark = rows.sparkSession
    years = sorted(r[0] for r in rows.select("year").distinct().collect() if r[0] is not None)          # one number a partition
    facts = spark.table(tables.facts)
    spread_for(rows.select(*facts.columns), ["year"]).write.insertInto(tables.facts)
    new = _totals(spark.table(tables.facts).filter(F.col("year").isin(years)), tables)
    mode, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(mode, "dynamic")                    # a table takes it from the session only
    try:
        new.write.insertInto(tables.totals, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(tables.totals)
    return years


def region_year_statistics(spark: SparkSession, tables: FactTables, limit: int = 100) -> DataFrame:
    """The newest ``limit`` rows of yearly regional statistics, from totals alone."""
    n, s = F.sum("n"), F.sum("total")
    return (tables.by_region(spark).groupBy(*KEYS)
            .agg(F.sum("records").alias("record_count"), s.alias("total_value"), F.try_divide(s, n).alias("avg_value"), F.min("low").alias("min_value"), F.max("high").alias("max_value"))
            .orderBy(F.desc("year"), "region_code").limit(limit))


def top_regions(spark: SparkSession, tables: FactTables, year: int, n: int = 10) -> DataFrame:
    rows = tables.by_region(spark).filter(F.col("year") == year)
    return rows.groupBy("region_code").agg(F.sum("total").alias("total_value")).orderBy(F.desc("total_value"), "region_code").limit(n)


def joined_totals(spark: SparkSession, sides: dict[str, FactTables], where: Column | None = None, how: str = "inner") -> DataFrame:
    """Totals of several domains side by side on year and region; ``where`` is a condition on the year, applied to every side."""
    session_settings(spark)
    out = None
    for name, tables in sides.items():
        rows = tables.by_region(spark) if where is None else tables.by_region(spark).filter(where)
        side = rows.groupBy(*KEYS).agg(F.sum("total").alias(name))
        out = side if out is None else out.join(side, KEYS, how)
    return out
