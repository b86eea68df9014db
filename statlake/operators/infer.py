"""Schemas from data or from dimension metadata, for many datasets in one job.

A schema is a table: one row per column, so thousands of datasets are inferred
by the same grouped plan. ``to_struct`` turns one dataset's rows into a StructType.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from statlake import rules
from statlake.functions import scalars as S
from statlake.functions.safe import digits_to_int
from statlake.operators.ranking import top_per_group
from statlake.session import materialise, together

COLUMNS = ["dataset_id", "position", "name", "type", "nullable", "source_field", "description", "is_partition"]
INT_MAX = 2147483647
PARTITION_FIELDS = 2


def field_values(raw: DataFrame, repeated: bool = False) -> DataFrame:
    """(dataset_id, field, v): the distinct non-null values of all records.

    Records come as columns, or as a ``record`` map with whatever fields they have. Values may
    stay ``repeated`` where only types are wanted: these are the same, the rows of a dataset meet once
    and no value is shuffled by itself.
    """
    if repeated:
        raw = together(raw, "dataset_id")
    if "record" in raw.columns:
        pairs = F.transform(F.map_entries("record"), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("v")))
    else:
        attrs = [c for c in raw.columns if c.startswith("attr_") or c == "value"]
        pairs = F.array(*[F.struct(F.lit("$" if c == "value" else "@" + c[5:]).alias("field"), F.col(c).alias("v")) for c in attrs])
    values = raw.select("dataset_id", F.explode(pairs).alias("p")).select("dataset_id", "p.*").filter(F.col("v").isNotNull())
    return values if repeated else values.distinct()


def is_code(text: Column) -> Column:
    """Digits that a number would not give back: a leading zero is part of a code."""
    return text.rlike("^-?0[0-9]+$")


def value_class(v: Column) -> Column:
    """Narrowest type that holds the text; codes with a leading zero and integers beyond 18 digits stay text."""
    t = F.trim(v)
    number = F.when(t.rlike("^-?[0-9]{1,18}$") & ~is_code(t), t).cast("bigint")
    return (F.when(number.isNotNull(), F.when(number.between(-INT_MAX - 1, INT_MAX), "INT").otherwise("BIGINT"))
            .when(t.rlike(r"^-?[0-9]+[.][0-9]+$"), "DOUBLE")
            .when(F.lower(t).isin("true", "false"), "BOOLEAN").otherwise("STRING"))


def field_types(values: DataFrame) -> DataFrame:
    """(dataset_id, field, type, distinct): the narrowest type that holds every value of a field, so none is lost on load."""
    kind = values.withColumn("kind", value_class(F.col("v")))
    k = F.col("kind")
    c = kind.groupBy("dataset_id", "field").agg(F.count("*").alias("distinct"), *[F.count_if(k == t).alias(t) for t in ("INT", "BIGINT", "DOUBLE", "BOOLEAN")])
    n = F.col("distinct")
    fits = (F.when(F.col("INT") == n, "INT").when(F.col("INT") + F.col("BIGINT") == n, "BIGINT")
            .when(F.col("INT") + F.col("BIGINT") + F.col("DOUBLE") == n, "DOUBLE").when(F.col("BOOLEAN") == n, "BOOLEAN"))
    return c.select("dataset_id", "field", fits.otherwise("STRING").alias("type"), "distinct")


def voted_types(values: DataFrame) -> DataFrame:
    return field_types(values).select("dataset_id", "field", "type")


_LEADING = ((1, "dataset_id", "データセットID"), (2, "record_id", "レコードID"))


def _leading() -> list[Column]:
    """The two columns every dynamic schema starts with."""
    return [F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.lit("STRING").alias("type"), F.lit(False).alias("nullable"),
                     F.lit(None).cast("string").alias("source_field"), F.lit(d).alias("description"), F.lit(False).alias("is_partition"))
            for i, n, d in _LEADING]


def with_leading(columns: DataFrame) -> DataFrame:
    """The first column of each dataset (position 3) brings the leading ones along, so nothing is evaluated twice."""
    own = F.struct(*COLUMNS[1:])
    rows = F.when(F.col("position") == 3, F.array(*_leading(), own)).otherwise(F.array(own))
    return columns.select("dataset_id", F.inline(rows)).select(*COLUMNS)


def schema_from_data(raw: DataFrame, area_as_text: bool = True) -> DataFrame:
    """One column per field, typed over all values. Area codes are text unless ``area_as_text`` is off.

    Fields whose names fall together are numbered from the second on. Distinct values are counted
    for datasets whose time and area fields do not make both partition columns; for others the
    numbers decide nothing.
    """
    cols = voted_types(field_values(raw, repeated=True))
    by_field = Window.partitionBy("dataset_id").orderBy("field")
    name = F.when(F.col("field") == "$", "value").otherwise(S.normalize_field(F.col("field")))
    cols = cols.withColumn("_name", F.when(name == "", "column").otherwise(name)).withColumn("position", F.row_number().over(by_field) + 2)
    same = F.row_number().over(Window.partitionBy("dataset_id", "_name").orderBy(F.col("field") != "$", "field"))
    same = same + F.col("_name").isin(*[n for _, n, _ in _LEADING]).cast("int")
    cols = cols.withColumn("_same", same).withColumn("name", F.when(F.col("_same") > 1, F.concat_ws("_", "_name", "_same")).otherwise(F.col("_name")))
    named = F.when(F.col("name").isin("year", "time", "date"), 1).when(F.col("name").isin("area", "region_code", "prefecture"), 2)
    cols = _with_distinct(materialise(cols.withColumn("_named", named), "named-columns"), raw)
    rank = F.coalesce("_named", F.when(F.col("distinct").between(10, 1000), 3))
    chosen = F.row_number().over(Window.partitionBy("dataset_id").orderBy(F.asc_nulls_last("_rank"), "position"))
    cols = cols.withColumn("_rank", rank).withColumn("_order", chosen)
    kind = F.when(F.col("field") == "$", "DOUBLE")
    if area_as_text:
        kind = kind.when(F.col("field") == "@area", "STRING")
    return with_leading(cols.select(
        "dataset_id", "position", "name", kind.otherwise(F.col("type")).alias("type"),
        F.lit(True).alias("nullable"), F.col("field").alias("source_field"), S.field_description(F.col("field")).alias("description"),
        (F.col("_rank").isNotNull() & (F.col("_order") <= PARTITION_FIELDS)).alias("is_partition")))


def _with_distinct(cols: DataFrame, raw: DataFrame) -> DataFrame:
    """Add the distinct values of fields (``distinct``) in datasets with fewer than two ranked names (``_named``); null elsewhere."""
    few = materialise(cols.groupBy(F.col("dataset_id").alias("_id")).agg(F.count("_named").alias("n")).filter(f"n < {PARTITION_FIELDS}").select("_id"), "unranked")
    if few.isEmpty():
        return cols.withColumn("distinct", F.lit(None).cast("long"))
    own = raw.join(few, F.col("dataset_id").eqNullSafe(F.col("_id")), "left_semi")
    counts = field_values(own).groupBy(F.col("dataset_id").alias("_id"), F.col("field").alias("_field")).agg(F.count("*").alias("distinct"))
    return cols.join(counts, F.col("dataset_id").eqNullSafe(F.col("_id")) & (F.col("field") == F.col("_field")), "left").drop("_id", "_field")


def schema_from_metadata(items: DataFrame, area_as_text: bool = True) -> DataFrame:
    """One column per dimension and the value. Items: dataset_id, dim_pos, dim_id, dim_name, item_pos, code.

    A type holds every code of its dimension, and codes with leading zeros stay text. Area
    codes are text anyway; without ``area_as_text`` they are typed like other codes.
    """
    keys = ["dataset_id", "dim_pos", "dim_id", "dim_name"]
    code = F.coalesce("code", F.lit(""))
    largest = F.max(F.when(code.rlike("^[0-9]+$"), code).cast("double"))
    dims = items.groupBy(*keys).agg(F.bool_and((code == "") | (code.rlike("^[0-9]{1,18}$") & ~is_code(code))).alias("digits"), largest.alias("top"),
                                    F.count("*").alias("items"))
    text = F.col("dim_id") == "time"
    if area_as_text:
        text = text | (F.col("dim_id") == "area")
    kind = (F.when(text, "STRING").when(F.col("digits"), F.when(F.col("top") > INT_MAX, "BIGINT").otherwise("INT")).otherwise("STRING"))
    candidate = (F.col("dim_id") == "time") | ((F.col("dim_id") == "area") & F.col("items").between(10, 1000))
    w = Window.partitionBy("dataset_id").orderBy("dim_pos")
    dims = dims.withColumn("_c", candidate).withColumn("_k", F.sum(F.col("_c").cast("int")).over(w)).withColumn("position", F.row_number().over(w) + 2)
    dims = dims.withColumn("_last", F.lead("position").over(w).isNull())
    cols = dims.select("dataset_id", "_last", "position", S.normalize_dimension(F.col("dim_id")).alias("name"), kind.alias("type"), F.lit(True).alias("nullable"),
                       F.concat(F.lit("@"), "dim_id").alias("source_field"), F.col("dim_name").alias("description"),
                       (F.col("_c") & (F.col("_k") <= 2)).alias("is_partition"))
    value = F.struct((F.col("position") + 1).alias("position"), F.lit("value").alias("name"), F.lit("DOUBLE").alias("type"), F.lit(True).alias("nullable"),
                     F.lit("$").alias("source_field"), F.lit("統計値").alias("description"), F.lit(False).alias("is_partition"))
    own = F.struct(*COLUMNS[1:])                 # the last dimension brings the value along, so items are read once
    return with_leading(cols.select("dataset_id", F.inline(F.when(F.col("_last"), F.array(own, value)).otherwise(F.array(own)))))


def preferred_schema(from_metadata: DataFrame, from_data: DataFrame) -> DataFrame:
    """Metadata schemas where there are any, schemas from data for the other datasets."""
    known = from_metadata.select("dataset_id").distinct()
    return from_metadata.unionByName(from_data.join(known, "dataset_id", "left_anti"))


def to_struct(schema_rows: DataFrame) -> T.StructType:
    """StructType of one dataset; reads its schema rows (one per column) to the driver."""
    from statlake.operators.mapping import dynamic_struct
    rows = schema_rows.orderBy("position").collect()
    if len({r["dataset_id"] for r in rows}) > 1:
        raise ValueError("rows of more than one dataset")
    return dynamic_struct([r.asDict() for r in rows])


def adaptive_partitions(facts: DataFrame) -> DataFrame:
    """Partition columns by number of regions and years: none, year, or year and region."""
    cells = facts.groupBy("dataset_id", "year", "region_code").agg(F.count("*").alias("n"))
    c = cells.groupBy("dataset_id").agg(F.countDistinct("region_code").alias("regions"), F.countDistinct("year").alias("years"))
    choice = (F.when(F.col("regions") > 100, "").when(F.col("regions") == 1, "year")
              .when(F.col("regions") * F.col("years") <= 100, "year,region_code").otherwise("year"))
    return c.withColumn("partition_by", choice)


def check_schema(schema: DataFrame) -> DataFrame:
    """Per dataset: column and partition counts and the list of issues."""
    def has(name):
        return F.count_if(F.col("name") == name) > 0
    c = schema.groupBy("dataset_id").agg(
        F.count("*").alias("column_count"), F.count_if("is_partition").alias("partition_count"),
        *[has(n).alias(f"_{n}") for n in ("dataset_id", "record_id", "value")])
    issues = F.array_compact(F.array(
        *[F.when(~F.col(f"_{n}"), F.lit(f"missing {n}")) for n in ("dataset_id", "record_id", "value")],
        F.when(F.col("partition_count") == 0, F.lit("no partition columns")), F.when(F.col("column_count") < 3, F.lit("too few columns"))))
    return c.select("dataset_id", "column_count", "partition_count", issues.alias("issues"), (F.size(issues) == 0).alias("valid"))


# --- landed metadata ------------------------------------------------------------------------

_ITEM = "struct<`@code`:string,`@name`:string,`@unit`:string,`@level`:string>"


def list_or_one(v: Column, path: str, element: str) -> Column:
    """Array at a path of a VARIANT, where a lone object counts as one element."""
    one = F.try_variant_get(v, path, element)
    return F.coalesce(F.try_variant_get(v, path, f"array<{element}>"), F.when(one.isNotNull(), F.array(one)))


def dimension_items(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Item rows of landed metadata (``doc`` holds the JSON text): one row per dimension item.

    Either list level may be a single object.
    """
    root = "$.GET_META_INFO.METADATA_INF"
    v = docs.select("*", F.try_parse_json(doc).alias("_v"))
    one = F.try_variant_get("_v", f"{root}.CLASS_INF.CLASS_OBJ", "variant")
    objects = F.coalesce(F.try_variant_get("_v", f"{root}.CLASS_INF.CLASS_OBJ", "array<variant>"),
                         F.when(one.isNotNull(), F.array(one)))
    keep = [c for c in docs.columns if c != doc]
    dims = v.select(*keep, F.posexplode(objects).alias("dim_pos", "_o"))
    got = dims.select(*keep, "dim_pos", F.try_variant_get("_o", '$["@id"]', "string").alias("dim_id"),
                      F.coalesce(F.try_variant_get("_o", '$["@name"]', "string"), F.lit("")).alias("dim_name"),
                      F.posexplode_outer(list_or_one(F.col("_o"), "$.CLASS", _ITEM)).alias("item_pos", "_i"))
    return got.select(*keep, "dim_pos", "dim_id", "dim_name", "item_pos", *[
        F.coalesce(F.col("_i")[f"@{k}"], F.lit("")).alias(k) for k in ("code", "name", "unit", "level")])


def dimension_summary(items: DataFrame) -> DataFrame:
    """Per dimension: id, name, number of items, and how many have a name or a unit."""
    return items.groupBy("dataset_id", "dim_pos", "dim_id", "dim_name").agg(
        F.count("item_pos").alias("item_count"), F.count_if(F.col("name") != "").alias("named_items"), F.count_if(F.col("unit") != "").alias("items_with_unit"))


def table_info(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Descriptive fields of landed metadata; text may be plain or under ``$``."""
    root = "$.GET_META_INFO.METADATA_INF.TABLE_INF"
    v = docs.withColumn("_v", F.try_parse_json(doc))
    texts = {"stat_name": "STAT_NAME", "gov_org": "GOV_ORG", "statistics_name": "STATISTICS_NAME", "title": "TITLE", "cycle": "CYCLE",
             "survey_date": "SURVEY_DATE", "open_date": "OPEN_DATE", "updated_date": "UPDATED_DATE",
             "main_category": "MAIN_CATEGORY", "sub_category": "SUB_CATEGORY"}

    def plain(path):
        return F.coalesce(F.try_variant_get("_v", f"{root}.{path}", "string"), F.lit(""))
    explanation = F.coalesce(F.try_variant_get("_v", f"{root}.STATISTICS_NAME_SPEC.TABULATION_CATEGORY_EXPLANATION", "string"),
                             F.try_variant_get("_v", f"{root}.DESCRIPTION.TABULATION_CATEGORY_EXPLANATION", "string"))
    return v.select(
        *[c for c in docs.columns if c != doc], F.coalesce(F.try_variant_get("_v", f'{root}["@id"]', "string"), F.lit("")).alias("id"),
        *[S.text_of(F.col("_v"), f"{root}.{p}").alias(n) for n, p in texts.items()], explanation.alias("explanation"),
        F.struct(*[plain(f"STATISTICS_NAME_SPEC.{p}").alias(p.lower()) for p in (
            "TABULATION_CATEGORY", "TABULATION_SUB_CATEGORY1", "TABULATION_SUB_CATEGORY2", "TABULATION_SUB_CATEGORY3")]).alias("statistics_name_spec"),
        F.struct(*[plain(f"TITLE_SPEC.{p}").alias(p.lower()) for p in ("TABLE_NAME", "TABLE_EXPLANATION")]).alias("title_spec"))


def search_summary(items: DataFrame) -> DataFrame:
    """Per dataset: prefecture coverage, year range and leading indicators, from its dimension items.

    Lists are bounded: fewer than 47 prefectures, five indicators for each of three dimensions.
    """
    is_area = (F.col("dim_id") == "area") | S.has_any(F.col("dim_name"), rules.AREA_DIMENSION_WORDS)
    is_time = ~is_area & ((F.col("dim_id") == "time") | S.has_any(F.col("dim_name"), rules.TIME_DIMENSION_WORDS))
    is_topic = ~is_area & ~is_time & F.col("dim_id").isin("tab", "cat01", "cat02")
    role = F.when(is_area, "area").when(is_time, "time").when(is_topic, "topic")
    rows = items.withColumn("role", role).filter(F.col("role").isNotNull())
    year = digits_to_int(F.regexp_extract("code", "^([0-9]{4})", 1))
    good = F.col("level").isin("", "1", "2") & (F.col("name") != "") & ~S.has_any(F.col("name"), rules.TOTAL_ITEM_WORDS) & ~F.col("name").rlike("^[A-Z][0-9]+")
    counts = rows.groupBy("dataset_id", "role", "dim_pos").agg(
        F.count("*").alias("items"), F.min(F.when(year.between(1900, 2100), year)).alias("a"), F.max(F.when(year.between(1900, 2100), year)).alias("b"),
        F.count_if(year.between(1900, 2100)).alias("years"), F.count_if(good).alias("good"))

    def last(role, col, extra=None):
        cond = (F.col("role") == role) if extra is None else (F.col("role") == role) & extra
        return F.max_by(F.when(cond, F.col(col)), F.when(cond, F.col("dim_pos")))
    base = counts.groupBy("dataset_id").agg(
        last("area", "items").alias("prefecture_count"), last("time", "a", F.col("years") > 0).alias("start_year"),
        last("time", "b", F.col("years") > 0).alias("end_year"), last("time", "years", F.col("years") > 0).alias("year_count"),
        last("topic", "items", F.col("good") > 0).alias("indicator_count"))
    leading = top_per_group(rows.filter((F.col("role") == "topic") & good), ["dataset_id", "dim_pos"], [F.asc("item_pos")], 5)
    words = leading.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct("dim_pos", "item_pos", "name"))).alias("w"))
    places = top_per_group(rows.filter(F.col("role") == "area"), ["dataset_id", "dim_pos"], [F.asc("item_pos")], rules.ALL_PREFECTURES)
    names = places.groupBy("dataset_id").agg(F.array_sort(F.collect_list(F.struct("dim_pos", "item_pos", "name"))).alias("p"))
    full = F.coalesce(F.col("prefecture_count") >= rules.ALL_PREFECTURES, F.lit(False))
    j = base.join(words, "dataset_id", "left").join(names, "dataset_id", "left")
    empty = F.array().cast("array<string>")
    return j.select("dataset_id", full.alias("has_all_prefectures"), "prefecture_count",
                    F.when(full, empty).otherwise(F.coalesce(F.transform("p", lambda x: x["name"]), empty)).alias("prefectures"),
                    "start_year", "end_year", "year_count", F.coalesce(F.transform("w", lambda x: x["name"]), empty).alias("indicators"), "indicator_count")
