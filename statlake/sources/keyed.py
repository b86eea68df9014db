"""Metadata tables by key: rows are kept in buckets of the key, and a change rewrites the buckets it touches.

A change writes new files of its buckets beside the old ones and then points these
partitions of the table at them. Other partitions keep their files, readers see a bucket
before or after the change, and what was there before stays until it is cleaned up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from statlake.operators import catalog as C
from statlake.sources.sinks import ddl

BUCKETS = 32
BUCKET = "key_bucket"


def _with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def create(rows: DataFrame, key: str, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Store rows as a table with one partition a bucket of the key."""
    spark = rows.sparkSession
    spark.sql(ddl(table, _with_bucket(rows, key, buckets).schema, f"{path}/start", [BUCKET], properties={"key": key, "buckets": str(buckets), "versions": path}))
    _point(spark, table, path, _write(_with_bucket(rows, key, buckets), path))


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(BUCKET)


def _properties(spark: SparkSession, table: str) -> tuple[str, int, str]:
    rows = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return rows["key"], int(rows["buckets"]), rows["versions"]


def _write(rows: DataFrame, path: str) -> str:
    version = f"{path}/version-{uuid.uuid4().hex}"
    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(version)
    return version


def _point(spark: SparkSession, table: str, path: str, version: str) -> list[int]:
    """Let each bucket of a new version be the table's; returns the buckets."""
    own = sorted(r[0] for r in spark.read.parquet(version).select(BUCKET).distinct().collect())        # at most the number of buckets
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for b in own:
        place = f"'{version}/{BUCKET}={b}'"
        if f"{BUCKET}={b}" in there:
            spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET}={b}) SET LOCATION {place}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({BUCKET}={b}) LOCATION {place}")
    spark.catalog.refreshTable(table)
    return own


def _change(changes: DataFrame, table: str, merge) -> list[int]:
    spark = changes.sparkSession
    key, buckets, path = _properties(spark, table)
    changes = _with_bucket(changes, key, buckets)
    touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
    old = spark.table(table).filter(F.col(BUCKET).isin(touched))
    new = merge(old, changes.drop(BUCKET), key)
    if not touched:
        return []
    columns = spark.table(table).columns
    return _point(spark, table, path, _write(_with_bucket(new.drop(BUCKET), key, buckets).select(*columns), path))


def update(changes: DataFrame, table: str) -> list[int]:
    """Set columns of rows whose key a change names; unknown keys are ignored. Returns the rewritten buckets."""
    return _change(changes, table, lambda old, new, key: C.update_columns(old, new, key))


def upsert(rows: DataFrame, table: str) -> list[int]:
    """Replace rows of equal key and add the others. Returns the rewritten buckets."""
    return _change(rows, table, lambda old, new, key: C.upsert(old.drop(BUCKET), new, key))


def remove(keys: DataFrame, table: str) -> list[int]:
    """Drop rows by key (a table of keys). Returns the rewritten buckets; one left without rows is dropped from the table."""
    spark = keys.sparkSession
    key, buckets, path = _properties(spark, table)
    own = _with_bucket(keys.select(key).distinct(), key, buckets)
    touched = [r[0] for r in own.select(BUCKET).distinct().collect()]
    rest = spark.table(table).filter(F.col(BUCKET).isin(touched)).join(own.select(key), key, "left_anti").select(*spark.table(table).columns)
    if not touched:
        return []
    left = [] if rest.isEmpty() else _point(spark, table, path, _write(rest, path))
    for b in sorted(set(touched) - set(left)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET}={b})")
    spark.catalog.refreshTable(table)
    return sorted(touched)
