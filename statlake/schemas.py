"""Domain fact tables, registry and inventory schemas.

A domain is declared once: its period column, and which raw dimension feeds
which column. Schema, mapping and primary key all follow from that declaration.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Domain:
    name: str
    period: str | None                   # "quarter", "month" or None
    dimensions: tuple[tuple[str, str], ...]   # (column, raw attribute)
    key_dimensions: int                  # leading dimensions that belong to the key
    label_column: str | None = None      # column filled from the area labels

    @property
    def primary_key(self) -> list[str]:
        period = [self.period] if self.period else []
        dims = [c for c, _ in self.dimensions[: self.key_dimensions]]
        return ["dataset_id", "year", *period, "region_code", *dims]

    def struct(self) -> T.StructType:
        fields = [("dataset_id", T.StringType()), ("stats_data_id", T.StringType()),
                  ("year", T.IntegerType())]
        if self.period:
            fields.append((self.period, T.IntegerType()))
        fields.append(("region_code", T.StringType()))
        if self.label_column:
            fields.append((self.label_column, T.StringType()))
        fields += [(c, T.StringType()) for c, _ in self.dimensions]
        fields += [("value", T.DoubleType()), ("unit", T.StringType())]
        return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The eleven domain tables, all partitioned by year.
DOMAINS = {d.name: d for d in [
    Domain("population", None, (("category", "cat01"),), 1, "region_name"),
    Domain("economy", "quarter", (("indicator", "cat01"),), 1),
    Domain("labor", "month", (("industry_code", "cat01"), ("occupation_code", "cat02"), ("indicator", "cat03")), 1),
    Domain("education", None, (("school_type", "cat01"), ("category", "cat02")), 1),
    Domain("health", None, (("facility_type", "cat01"), ("disease_code", "cat02"), ("indicator", "cat03")), 1),
    Domain("agriculture", None, (("sector", "cat01"), ("product_code", "cat02"), ("indicator", "cat03")), 1),
    Domain("construction", "month", (("building_type", "cat01"), ("structure_type", "cat02"), ("indicator", "cat03")), 1),
    Domain("transport", "month", (("transport_mode", "cat01"), ("indicator", "cat02")), 1),
    Domain("trade", "quarter", (("industry_code", "cat01"), ("business_type", "cat02"), ("indicator", "cat03")), 1),
    Domain("social_welfare", None, (("facility_type", "cat01"), ("service_type", "cat02"), ("indicator", "cat03")), 1),
    Domain("generic", None, (("category", "cat01"),), 1),
]}
PARTITION_COLUMNS = ["year"]


def get_domain(name: str) -> Domain:
    """Unknown names fall back to the generic domain."""
    return DOMAINS.get(name, DOMAINS["generic"])


def get_schema(name: str) -> T.StructType:
    return get_domain(name).struct()


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

# Raw observation as landed, before renaming (all text).
RAW_FIELDS = ["@id", "@tab", *[f"@cat{i:02d}" for i in range(1, 11)], "@area", "@time", "@unit", "$"]
RAW_SCHEMA = T.StructType([T.StructField(f, _S, True) for f in RAW_FIELDS])

# Type names of dynamic schemas and of the columnar file writer.
SPARK_TYPES = {
    "STRING": _S, "INT": T.IntegerType(), "BIGINT": _L, "DOUBLE": _D,
    "TIMESTAMP": T.TimestampType(), "BOOLEAN": T.BooleanType(),
    "string": _S, "bigint": _L, "double": _D, "int": T.IntegerType(),
    "float": T.FloatType(), "boolean": T.BooleanType(), "DATE": T.DateType(),
}


def spark_type(name: str) -> T.DataType:
    return SPARK_TYPES.get(name, _S)


_DATE, _TS = T.DateType(), T.TimestampType()
INVENTORY_SCHEMA = T.StructType([
    T.StructField("dataset_id", _S), T.StructField("dataset_name", _S), T.StructField("domain", _S),
    T.StructField("organization", _S), T.StructField("survey_date", _DATE), T.StructField("open_date", _DATE),
    T.StructField("total_records", _L), T.StructField("ingestion_status", _S),
    T.StructField("ingestion_timestamp", _TS), T.StructField("table_name", _S),
    T.StructField("raw_location", _S), T.StructField("parquet_location", _S),
    T.StructField("table_location", _S), T.StructField("error_message", _S),
    T.StructField("created_at", _TS), T.StructField("updated_at", _TS),
])
INVENTORY_REQUIRED = ["dataset_id", "dataset_name", "domain", "ingestion_status", "ingestion_timestamp", "table_name"]

HISTORY_TYPE = T.StructType([
    T.StructField("from_status", _S), T.StructField("to_status", _S),
    T.StructField("timestamp", T.TimestampType()), T.StructField("error_message", _S),
])

REGISTRY_STATUSES = ["pending", "processing", "completed", "failed"]
