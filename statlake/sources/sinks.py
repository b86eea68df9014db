"""Writers and tables on partitioned Parquet."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from statlake.functions.safe import to_int
from statlake.operators.mapping import rename_raw
from statlake.schemas import INVENTORY_REQUIRED, INVENTORY_SCHEMA, PARTITION_COLUMNS, get_schema

CODECS = ("snappy", "zstd", "gzip")
ROWS_PER_FILE = 5_000_000


def spread_for(df: DataFrame, partition_columns: list[str]) -> DataFrame:
    """Group rows by partition value before a write, so that each value makes few files.

    ``rebalance`` lets the adaptive engine cut a value with most of the rows
    into advisory-size tasks and merge small ones, by measured sizes.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_columns]) if partition_columns else df


def write_typed(df: DataFrame, path: str, partition_by: list[str] | None = None, codec: str = "snappy",
                mode: str = "errorifexists") -> None:
    """Parquet without the bookkeeping column; integers, doubles and text keep their type."""
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec}")
    parts = partition_by or []
    out = spread_for(df.drop("updated_at"), parts)
    writer = out.write.mode(mode).option("compression", codec).option("maxRecordsPerFile", ROWS_PER_FILE)
    writer = writer.option("partitionOverwriteMode", "static")      # an overwrite replaces the whole folder
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def write_raw(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rename_raw(df).write.mode(mode).parquet(path)


def time_partitioned(df: DataFrame) -> DataFrame:
    """Add ``year`` from the first four characters of the time code; null where they are no number."""
    return df.withColumn("year", to_int(F.substring("attr_time", 1, 4)))


def create_from_raw(df: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write raw rows partitioned by year where they have time codes at all; rows whose code gives no year share the null partition."""
    timed = "attr_time" in df.columns
    if timed:                                    # a code of fewer than four characters gives no year
        df = time_partitioned(df).withColumn("year", F.when(F.length("attr_time") >= 4, F.col("year")))
    write_typed(df, path, PARTITION_COLUMNS if timed else None, mode=mode)
    return timed


# --- tables ---------------------------------------------------------------------------------

def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def ddl(table: str, schema: T.StructType, path: str, partition_by: list[str] | None = None,
        comments: dict[str, str] | None = None, properties: dict[str, str] | None = None) -> str:
    """CREATE TABLE text for a schema; field descriptions become comments."""
    comments = comments or {}
    cols = []
    for f in schema.fields:
        note = comments.get(f.name) or f.metadata.get("description")
        cols.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{_quote(note)}'" if note else ""))
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    props = f" TBLPROPERTIES ({', '.join(f'{_quote(k)!r} = {_quote(v)!r}' for k, v in properties.items())})" if properties else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(cols)}) USING parquet{parts} LOCATION '{_quote(path)}'{props}"


def create_domain_table(spark: SparkSession, domain: str, path: str, table: str | None = None) -> str:
    table = table or f"{domain}_data"
    spark.sql(ddl(table, get_schema(domain), path, PARTITION_COLUMNS, properties={"domain": domain}))
    return table


def create_inventory_table(spark: SparkSession, path: str, table: str = "dataset_inventory") -> str:
    spark.sql(ddl(table, INVENTORY_SCHEMA, path, properties={"description": "dataset inventory"}))
    return table


def create_dynamic_table(spark: SparkSession, dataset_id: str, schema: T.StructType, path: str, partition_by: list[str],
                         domain: str, table: str | None = None) -> str:
    table = table or "dataset_" + dataset_id.replace("-", "_")
    spark.sql(ddl(table, schema, path, partition_by, properties={"dataset_id": dataset_id, "domain": domain}))
    return table


def insert_rows(df: DataFrame, table: str) -> None:
    """Append with the table's columns in the table's order; new partitions become visible."""
    target = df.sparkSession.table(table).schema
    parts = [c.name for c in df.sparkSession.catalog.listColumns(table) if c.isPartition]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    spread_for(rows, parts).write.insertInto(table)


def load_parquet(spark: SparkSession, path: str, table: str) -> None:
    """Append staged Parquet files to a table."""
    insert_rows(spark.read.parquet(path), table)


def replace_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Drop-and-reload of one dataset's own folder."""
    write_typed(df, path, partition_by, mode="overwrite")


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that occur in ``df``."""
    (spread_for(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a Parquet folder; none where the folder has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def register_datasets(rows: DataFrame, table: str) -> DataFrame:
    """Insert inventory rows whose required fields are filled; returns the rejected rows."""
    ok = F.lit(True)
    for c in INVENTORY_REQUIRED:
        ok = ok & F.col(c).isNotNull()
    full = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in INVENTORY_SCHEMA.fields])
    insert_rows(full.filter(ok), table)
    return rows.filter(~ok)


def refresh_table(df: DataFrame, table: str, new_path: str) -> None:
    """Full refresh: write beside the old data, then point the table at the new folder."""
    df.write.parquet(new_path)
    df.sparkSession.sql(f"ALTER TABLE {table} SET LOCATION '{_quote(new_path)}'")
    df.sparkSession.catalog.refreshTable(table)


def add_column(spark: SparkSession, table: str, name: str, type_name: str, comment: str = "") -> None:
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {type_name} COMMENT '{_quote(comment)}')")


def evolve(df: DataFrame, rename: dict[str, str] | None = None, cast: dict[str, str] | None = None) -> DataFrame:
    """Renames and compatible type changes as a projection over existing files."""
    rename, cast = rename or {}, cast or {}
    return df.select(*[(F.col(c).cast(cast[c]) if c in cast else F.col(c)).alias(rename.get(c, c)) for c in df.columns])


def show_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def load_metadata(df: DataFrame, domain: str, loaded_at: Column) -> DataFrame:
    """Audit row of a load: records, first and last partition, time."""
    return df.agg(F.count("*").alias("record_count"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
                  F.countDistinct("year").alias("partitions")).select(F.lit(domain).alias("domain"), "*", loaded_at.alias("committed_at"))


def append_audit(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def append_load_audits(rows: DataFrame, path: str, loaded_at: Column) -> None:
    """One audit row a domain of what a load has written."""
    append_audit(rows.groupBy("domain").agg(F.count("*").alias("record_count"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
                                            F.countDistinct("year").alias("partitions")).select("*", loaded_at.alias("committed_at")), path)


def load_history(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    return spark.read.parquet(path).orderBy(F.desc("committed_at"), "domain").limit(n)


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a scan with their size and record count."""
    m = df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes"))
    return m.groupBy("file_path", "file_size_in_bytes").agg(F.count("*").alias("record_count"))


# --- documents --------------------------------------------------------------------------------

def write_catalog(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def append_error_log(df: DataFrame, path: str) -> None:
    """JSON lines per day."""
    df.withColumn("date", F.substring("timestamp", 1, 10)).write.mode("append").partitionBy("date").json(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def schema_to_text(schema: T.StructType, partition_by: list[str], info: dict) -> str:
    return json.dumps({"schema": json.loads(schema.json()), "partition_columns": partition_by, "metadata": info}, ensure_ascii=False)


def schema_from_text(text: str) -> tuple[T.StructType, list[str], dict]:
    d = json.loads(text)
    return T.StructType.fromJson(d["schema"]), d["partition_columns"], d["metadata"]
