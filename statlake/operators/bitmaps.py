"""Exact distinct counts that merge: codes are numbered once, and each load keeps a bitmap of the numbers it has.

Numbers come from a stored dictionary that only grows, so bitmaps of different loads and
years can be put together by "or". A load reads itself and the dictionary; what earlier
loads have counted is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from statlake.session import materialise
from statlake.sources.sinks import read_if_there, write_typed

_DICTIONARY = "column string, code string, nr bigint"
_BITMAPS = "load string, group string, column string, bucket bigint, bits binary"


def _pairs(rows: DataFrame, columns: list[str], *keep) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("code")) for c in columns]))
    return rows.select(*keep, each.alias("p")).select(*[k if isinstance(k, str) else "group" for k in keep], "p.*").filter(F.col("code").isNotNull())


def extend_dictionary(rows: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Number the codes that are new, after those that have a number; returns the whole dictionary."""
    return _extend(_pairs(rows, columns), path)


def _extend(pairs: DataFrame, path: str) -> DataFrame:
    spark = pairs.sparkSession
    schema = spark.createDataFrame([], _DICTIONARY).schema
    known = read_if_there(spark, path, schema)
    new = pairs.select("column", "code").distinct().join(known.select("column", "code"), ["column", "code"], "left_anti")
    # Numbers run through blocks, so no task orders all codes; rows are written with their place in the block.
    cut = materialise(materialise(new, "unnumbered").repartitionByRange("column", "code").sortWithinPartitions("column", "code")
                      .withColumn("_block", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "range-blocks")
    sizes = cut.groupBy("column", "_block").agg(F.count("*").alias("n"), F.min("_place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("column").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    top = known.groupBy("column").agg(F.max("nr").alias("top"))
    starts = sizes.join(top, "column", "left").select("column", "_block", (F.coalesce(before, F.lit(0)) + F.coalesce("top", F.lit(0)) - F.col("first") + 1).alias("start"))
    numbered = cut.join(starts, ["column", "_block"]).select("column", "code", (F.col("start") + F.col("_place")).cast("bigint").alias("nr"))
    materialise(numbered, "new-codes").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append(rows: DataFrame, columns: list[str], group: str, load: str, path: str) -> None:
    """Add a load's bitmaps, one per value of ``group``, column and range of 32768 numbers."""
    spark = rows.sparkSession
    own = materialise(_pairs(rows, columns, F.col(group).cast("string").alias("group")).distinct(), "load-codes")
    numbers = _extend(own, f"{path}/dictionary")
    numbered = own.join(numbers, ["column", "code"])
    bits = numbered.groupBy("group", "column", F.bitmap_bucket_number("nr").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("nr")).alias("bits"))
    write_typed(bits.select(F.lit(load).alias("load"), "group", "column", "bucket", "bits"), f"{path}/bitmaps", ["load"], mode="append")


def distinct_counts(spark: SparkSession, path: str, by_group: bool = False) -> DataFrame:
    """(column, distinct) over all loads, or per ``group`` as well."""
    keys = ["group", "column"] if by_group else ["column"]
    stored = read_if_there(spark, f"{path}/bitmaps", spark.createDataFrame([], _BITMAPS).schema)
    whole = stored.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("distinct"))
