"""Raw observations to typed domain tables and dynamic schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from statlake.functions import scalars as S, timecode as TC
from statlake.functions.timecode import computed_once
from statlake.schemas import DOMAINS, get_domain, spark_type

CRITICAL_COLUMNS = ["value", "year", "region_code"]


def rename_raw(df: DataFrame) -> DataFrame:
    """``@x`` becomes ``attr_x`` and ``$`` becomes ``value``."""
    return df.toDF(*["value" if c == "$" else "attr_" + c[1:] if c.startswith("@") else c for c in df.columns])


def source_column(df: DataFrame, field: str) -> Column:
    """A landed field by its own name, from the ``record`` map or from its renamed column; null where there is none."""
    if "record" in df.columns:
        return F.element_at("record", F.lit(field))
    name = "value" if field == "$" else "attr_" + field[1:] if field.startswith("@") else field
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _attr(df: DataFrame, name: str) -> Column:
    """Attribute text; a missing attribute or column is the empty text, not null."""
    col = f"attr_{name}"
    return F.coalesce(F.col(col), F.lit("")) if col in df.columns else F.lit("")


def domain_columns(df: DataFrame, domain: str, dataset_id: Column | None = None) -> list[Column]:
    d = get_domain(domain)
    time = F.col("attr_time") if "attr_time" in df.columns else F.lit(None).cast("string")
    own = F.nullif(dataset_id, F.lit("")) if dataset_id is not None else F.lit(None).cast("string")
    cols = [F.coalesce(own, _attr(df, "id")).alias("dataset_id"), _attr(df, "id").alias("stats_data_id"),
            TC.loose_year(time).alias("year")]
    if d.period:
        period = TC.loose_quarter(time) if d.period == "quarter" else TC.loose_month(time)
        cols.append(period.alias(d.period))
    cols.append(_attr(df, "area").alias("region_code"))
    if d.label_column:
        label = F.col(d.label_column) if d.label_column in df.columns else F.lit("")
        cols.append(F.coalesce(label, F.lit("")).alias(d.label_column))
    cols += [_attr(df, raw).alias(c) for c, raw in d.dimensions]
    return cols + [S.parse_value(F.col("value")).alias("value"), _attr(df, "unit").alias("unit")]


def map_domain(raw: DataFrame, domain: str, labels: DataFrame | None = None,
               dataset_id: Column | None = None) -> DataFrame:
    """Typed domain rows. Unknown domains use the generic table.

    ``labels`` (dimension, code, label) fills the label column of the domain.
    """
    d = get_domain(domain)
    if d.label_column and labels is not None:
        raw = with_label(raw, labels, "area", d.label_column)
    extra = [F.col("dataset_id")] if dataset_id is None and "dataset_id" in raw.columns else []
    return raw.select(*domain_columns(raw, domain, extra[0] if extra else dataset_id))


def map_domains(raw: DataFrame, domain: Column) -> DataFrame:
    """Rows of many datasets and domains in one pass, in the union of all domain columns.

    Columns a row's domain does not have stay null, so one scan feeds every table.
    """
    known, time = F.when(domain.isin(list(DOMAINS)), domain).otherwise("generic"), F.col("attr_time")
    # Inside a condition common parts would be computed again and again, so periods are computed for every row.
    base = computed_once(raw, [known.alias("_domain"), TC.loose_quarter(time).alias("_quarter"), TC.loose_month(time).alias("_month")])
    kind = F.col("_domain")

    def of(names):
        return kind.isin(sorted(names))
    sources: dict[str, dict[str, list[str]]] = {}
    for d in DOMAINS.values():
        for column, attr in d.dimensions:
            sources.setdefault(column, {}).setdefault(attr, []).append(d.name)
    dims = []
    for column, attrs in sources.items():
        case = None
        for attr, names in attrs.items():
            case = F.when(of(names), _attr(raw, attr)) if case is None else case.when(of(names), _attr(raw, attr))
        dims.append(case.alias(column))
    periods = {p: [d.name for d in DOMAINS.values() if d.period == p] for p in ("quarter", "month")}
    return base.select(
        kind.alias("domain"), F.coalesce(F.nullif(F.col("dataset_id"), F.lit("")), _attr(raw, "id")).alias("dataset_id"),
        _attr(raw, "id").alias("stats_data_id"), TC.loose_year(time).alias("year"),
        F.when(of(periods["quarter"]), F.col("_quarter")).alias("quarter"),
        F.when(of(periods["month"]), F.col("_month")).alias("month"),
        _attr(raw, "area").alias("region_code"), *dims,
        S.parse_value(F.col("value")).alias("value"), _attr(raw, "unit").alias("unit"))


def with_label(raw: DataFrame, labels: DataFrame, dimension: str, out: str, code_column: str | None = None) -> DataFrame:
    """Add the label of a code and keep the code; codes without a label get the empty text.

    The label side is small for most dimensions but not bounded, so no hint is
    given: the planner broadcasts it by measured size and splits hot codes otherwise.
    """
    code = code_column or f"attr_{dimension}"
    one = labels.filter(F.col("dimension") == dimension).groupBy("code").agg(F.min("label").alias(out))
    joined = raw.join(one.withColumnRenamed("code", "_code"), F.col(code) == F.col("_code"), "left").drop("_code")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))


def transform_dynamic(raw: DataFrame, schema: T.StructType, dataset_id: str | None = None) -> DataFrame:
    """Project raw rows, or records with any fields, into a dynamic schema whose fields name their source field."""
    own = F.lit(dataset_id) if dataset_id is not None else F.col("dataset_id")
    cols = [own.alias("dataset_id"), F.coalesce(source_column(raw, "@id"), F.lit("")).alias("record_id")]
    for f in schema.fields:
        source = f.metadata.get("source_field")
        if f.name in ("dataset_id", "record_id") or not source:
            continue
        c = source_column(raw, source)
        cols.append(S.cast_value(c, f.metadata.get("type", "STRING")).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def dynamic_struct(columns: list[dict]) -> T.StructType:
    """StructType from column rows (name, type, nullable, description, source_field)."""
    fields = []
    for c in columns:
        meta = {k: c[k] for k in ("source_field", "description", "type") if c.get(k)}
        kind = "STRING" if c["type"] == "TIMESTAMP" else c["type"]
        fields.append(T.StructField(c["name"], spark_type(kind), c.get("nullable", True), meta))
    return T.StructType(fields)


def column_mapping(schema: T.StructType) -> dict[str, str]:
    return {f.metadata["source_field"]: f.name for f in schema.fields if "source_field" in f.metadata}


def transform_results(raw: DataFrame, mapped: DataFrame) -> DataFrame:
    """Input and output row counts of every dataset, from two pre-aggregated sides."""
    a = raw.groupBy("dataset_id").agg(F.count("*").alias("input_records"))
    b = mapped.groupBy("dataset_id").agg(F.count("*").alias("output_records"))
    return (a.join(b, "dataset_id", "left")
            .select("dataset_id", "input_records", F.coalesce("output_records", F.lit(0)).alias("output_records"),
                    (F.col("input_records") == F.coalesce("output_records", F.lit(0))).alias("success")))


def unmapped_fields(raw: DataFrame, mapped: list[str], source_of: dict[str, str]) -> DataFrame:
    """Per dataset: raw fields with a value that no target column uses, and critical targets left empty."""
    attrs = [c for c in raw.columns if c.startswith("attr_") or c == "value"]
    seen = raw.groupBy("dataset_id").agg(*[F.count(c).alias(c) for c in attrs])
    present = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in attrs]))
    used = F.array(*[F.lit(m) for m in mapped])
    critical = F.array_compact(F.array(*[
        F.when(~F.array_contains(present, source_of[t]), F.lit(t)) for t in CRITICAL_COLUMNS]))
    return seen.select("dataset_id", F.array_sort(F.array_except(present, used)).alias("unmapped"),
                       critical.alias("critical_missing"))


def with_lineage(df: DataFrame, source_version: str, endpoint: str, at: Column | None = None) -> DataFrame:
    return df.select("*", (at if at is not None else F.current_timestamp()).alias("ingested_at"),
                     F.lit(source_version).alias("source_version"), F.lit(endpoint).alias("endpoint"))


def dimension_filter(df: DataFrame, filters: dict[str, str]) -> DataFrame:
    """Equality filters on raw dimensions; keys are attribute names such as ``area`` or ``cat01``."""
    conds = [F.col(f"attr_{k.removeprefix('@')}") == F.lit(v) for k, v in filters.items()]
    return df.filter(reduce(lambda a, b: a & b, conds, F.lit(True)))


def split_dimension(columns: list[str]) -> str | None:
    """Dimension by which a large dataset is cut: area, else time, else the first one."""
    dims = [c for c in columns if c.startswith("attr_") and c not in ("attr_id", "attr_unit")]
    for c in ("attr_area", "attr_time"):
        if c in dims:
            return c
    return dims[0] if dims else None
