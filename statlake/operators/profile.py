"""Mergeable dataset profiles: what a load has brought, in rows that add up over loads.

A profile has one row per load, dataset and partition value: its rows, its filled values
by column, and its column types. Checks, counts and ranges read profiles, never the data:
after each load only that load is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from statlake.operators import quality as Q
from statlake.sources.sinks import read_if_there


def of_load(rows: DataFrame, load: str, partition: str = "year") -> DataFrame:
    """Profile rows of one load, from one pass over it."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    cells = rows.groupBy("dataset_id", F.col(partition).cast("string").alias("part")).agg(
        F.count("*").alias("rows"), *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(kinds)])
    filled = F.map_from_arrays(F.array(*[F.lit(c) for c in kinds]), F.array(*[F.col(f"n{i}") for i in range(len(kinds))]))
    types = F.map_from_arrays(F.array(*[F.lit(c) for c in kinds]), F.array(*[F.lit(t) for t in kinds.values()]))
    return cells.select(F.lit(load).alias("load"), "dataset_id", "part", "rows", filled.alias("filled"), types.alias("types"))


SCHEMA = "load string, dataset_id string, part string, rows bigint, filled map<string,bigint>, types map<string,string>"


def append(rows: DataFrame, load: str, path: str, partition: str = "year") -> None:
    of_load(rows, load, partition).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_if_there(spark, path, spark.createDataFrame([], SCHEMA).schema)


def datasets(profile: DataFrame) -> DataFrame:
    """(dataset_id, rows, loads, parts, first_part, last_part, null_part) of all loads together."""
    return profile.groupBy("dataset_id").agg(
        F.sum("rows").alias("rows"), F.countDistinct("load").alias("loads"), F.countDistinct("part").alias("parts"),
        F.min("part").alias("first_part"), F.max("part").alias("last_part"), F.max(F.col("part").isNull()).alias("null_part"))


def partitions(profile: DataFrame) -> DataFrame:
    """Rows per partition value over all datasets."""
    return profile.groupBy("part").agg(F.sum("rows").alias("rows"))


def columns(profile: DataFrame) -> DataFrame:
    """(dataset_id, column, type, filled, nulls); a column that came with a later load is null in rows before."""
    rows = profile.groupBy("dataset_id").agg(F.sum("rows").alias("rows"))
    each = profile.select("dataset_id", "types", F.explode("filled").alias("column", "filled"))
    each = each.groupBy("dataset_id", "column").agg(F.max(F.element_at("types", F.col("column"))).alias("type"), F.sum("filled").alias("filled"))
    return each.join(rows, "dataset_id").select("dataset_id", "column", "type", "filled", (F.col("rows") - F.col("filled")).alias("nulls"))


def full_check(profile: DataFrame, expected: DataFrame, expected_schema: DataFrame, required: list[str], partition: str = "year") -> DataFrame:
    """Row counts, schema, nulls and partitions of every dataset, in the form of ``quality.full_check``."""
    known = datasets(profile)
    counts = known.select("dataset_id", F.col("rows").alias("actual"))
    j = expected.join(counts, "dataset_id", "full").select("dataset_id", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))
    count_check = Q.result_rows(j.withColumn("difference", F.col("actual") - F.col("expected")), "row_count", F.col("difference") == 0)
    own = columns(profile)
    wanted = expected_schema.select("dataset_id").distinct()
    issues = Q.reconcile_schema(own.select("dataset_id", "column", "type"), expected_schema).groupBy("dataset_id").agg(F.count("*").alias("difference"))
    schema_check = Q.result_rows(wanted.join(issues, "dataset_id", "left").fillna(0, ["difference"]), "schema", F.col("difference") == 0)
    nulls = own.filter(F.col("column").isin(required)).groupBy("dataset_id").agg(F.sum("nulls").alias("difference"), F.count("*").alias("found"))
    absent = len(set(required)) - F.coalesce("found", F.lit(0))                # a required column that no load has is null in every row
    n = known.join(nulls, "dataset_id", "left").select("dataset_id", F.col("rows").alias("expected"),
                                                        (F.coalesce("difference", F.lit(0)) + absent * F.col("rows")).alias("difference"))
    null_check = Q.result_rows(n.withColumn("actual", F.col("expected") - F.col("difference")), "null_value", F.col("difference") == 0)
    p = known.select("dataset_id", F.lit(partition).alias("expected"), F.col("parts").alias("actual"), F.col("null_part").cast("int").alias("difference"))
    part_check = Q.result_rows(p, "partition", (F.col("actual") > 0) & (F.col("difference") == 0))
    return reduce(DataFrame.unionByName, [count_check, schema_check, null_check, part_check])
