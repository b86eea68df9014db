"""Data-quality checks: one pass per check, counts by map-side aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from statlake.functions.safe import to_double
from statlake.operators.ranking import exact_percentiles
from statlake.schemas import get_domain, get_schema

RESULT = ["dataset_id", "check_type", "status", "expected", "actual", "difference"]


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """A schema question, answered from the plan without running anything."""
    return [c for c in required if c not in df.columns]


def is_blank(c: Column) -> Column:
    """Null, the empty text, or the text ``null``."""
    text = c.cast("string")
    return F.coalesce(text.isin("", "null"), F.lit(True))


def null_check(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Blank count per column (and group), one row per column."""
    present = [c for c in columns if c in df.columns]
    counts = df.groupBy(*(by or [])).agg(F.count("*").alias("total"), *[F.count_if(is_blank(F.col(c))).alias(c) for c in present])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in present]))
    return counts.select(*(by or []), "total", pairs.alias("p")).select(*(by or []), "p.column", "p.null_count", "total")


def out_of_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows outside the range, with the reason; values that are no numbers are left out."""
    n = to_double(F.col(column).cast("string"))
    reason = F.lit(None).cast("string")
    if high is not None:
        reason = F.when(n > high, F.lit("above_maximum"))
    if low is not None:
        reason = F.when(n < low, F.lit("below_minimum")).otherwise(reason)
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def range_check(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return out_of_range(df, column, low, high).groupBy("reason").agg(F.count("*").alias("rows"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_rows"))


def repeated_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row of a key after its first one, first by the given order (unique within a key).

    The first row per key is a map-side minimum. Joining it back keeps hot keys
    splittable, where a row number would sort each whole key in one task.
    """
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n")).filter(F.col("_n") > 1)
    right = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return (df.join(right, same).filter(F.struct(*order) > F.col("_first"))
            .drop("_first", *[f"_k_{k}" for k in keys]))


def domain_duplicates(df: DataFrame, domain: str, order: list[str]) -> DataFrame:
    return repeated_rows(df, get_domain(domain).primary_key, order)


def quarantine(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Split rows by per-row rules: (valid, invalid with the names of the broken rules).

    A rule whose condition is null counts as broken. Input = valid + invalid.
    """
    marked = mark(df, rules)
    bad = F.size("reasons") > 0
    return marked.filter(~bad).drop("reasons"), marked.filter(bad)


def mark(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("reasons", F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])))


def missing_fields(df: DataFrame, domain: str) -> Column:
    """Names of the domain's columns that are null in a row."""
    return F.array_compact(F.array(*[
        F.when(F.col(f.name).isNull(), F.lit(f.name)) if f.name in df.columns else F.lit(f.name)
        for f in get_schema(domain).fields]))


def type_errors(df: DataFrame, domain: str) -> Column:
    """Names of columns whose text does not read as the domain's type."""
    def wrong(f):
        text = F.col(f.name).cast("string")
        if isinstance(f.dataType, T.IntegerType):
            bad = ~text.rlike("^[+-]?[0-9]{1,10}$")
        elif isinstance(f.dataType, T.DoubleType):
            bad = to_double(text).isNull()
        else:
            bad = F.lit(False)
        return F.when(text.isNotNull() & bad, F.lit(f.name))
    return F.array_compact(F.array(*[wrong(f) for f in get_schema(domain).fields if f.name in df.columns]))


def dataset_gate(df: DataFrame, domain: str, threshold: float = 0.1) -> DataFrame:
    """Per dataset: share of rows with a missing or mistyped field, and whether it passes."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie between 0 and 1")
    failed = (F.size(missing_fields(df, domain)) > 0) | (F.size(type_errors(df, domain)) > 0)
    counts = df.groupBy("dataset_id").agg(F.count("*").alias("total"), F.count_if(failed).alias("failed"))
    rate = F.coalesce(F.try_divide("failed", "total"), F.lit(0.0))
    return counts.select("dataset_id", "total", "failed", rate.alias("failure_rate"), (rate <= threshold).alias("passed"))


def quality_gate(df: DataFrame, check_duplicates: bool = True) -> DataFrame:
    """Per dataset: blanks in the key columns and repeated (dataset, year, region) keys."""
    required = ["dataset_id", "year", "value"]
    if missing_columns(df, required):
        raise ValueError(f"missing columns: {missing_columns(df, required)}")
    cells = df.groupBy("dataset_id", "year", "region_code").agg(
        F.count("*").alias("n"), *[F.count_if(is_blank(F.col(c))).alias(f"null_{c}") for c in required])
    repeated = F.count_if(F.col("n") > 1) if check_duplicates else F.lit(0)
    out = cells.groupBy("dataset_id").agg(
        F.sum("n").alias("total"), *[F.sum(f"null_{c}").alias(f"null_{c}") for c in required], repeated.alias("duplicate_keys"))
    clean = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in required])
    return out.withColumn("passed", clean & (F.col("duplicate_keys") == 0))


# --- reconciliation of a loaded lake with what was expected ---------------------------------

def reconcile_counts(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (dataset_id, expected) against loaded row counts; a dataset may be absent on one side."""
    actual = df.groupBy("dataset_id").agg(F.count("*").alias("actual"))
    j = expected.join(actual, "dataset_id", "full").select(
        "dataset_id", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual"))
    return result_rows(j.withColumn("difference", F.col("actual") - F.col("expected")), "row_count",
                   F.col("difference") == 0)


def result_rows(df: DataFrame, check: str, ok: Column) -> DataFrame:
    return df.select("dataset_id", F.lit(check).alias("check_type"), F.when(ok, "passed").otherwise("failed").alias("status"),
                     *[F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in RESULT[3:]])


def schema_rows(spark, dataset_id: str, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([(dataset_id, f.name, f.dataType.simpleString()) for f in schema.fields],
                                 "dataset_id string, column string, type string")


def reconcile_schema(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(dataset_id, column, type) rows against each other: missing, extra or type_mismatch."""
    a, e = actual.withColumnRenamed("type", "actual_type"), expected.withColumnRenamed("type", "expected_type")
    j = e.join(a, ["dataset_id", "column"], "full")
    issue = (F.when(F.col("actual_type").isNull(), "missing").when(F.col("expected_type").isNull(), "extra")
             .when(F.col("actual_type") != F.col("expected_type"), "type_mismatch"))
    return j.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def column_sets(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(dataset_id, column) rows of two sides: each once, as ``both``, ``missing`` (expected only) or ``extra``."""
    sides = actual.select("dataset_id", "column", F.lit(True).alias("a")).unionByName(expected.select("dataset_id", "column", F.lit(False).alias("a")))
    one = sides.groupBy("dataset_id", "column").agg(F.bool_or("a").alias("has"), F.bool_and("a").alias("only"))
    return one.select("dataset_id", "column", F.when(F.col("only"), "extra").when(F.col("has"), "both").otherwise("missing").alias("side"))


def reconcile_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.groupBy("dataset_id").agg(F.count("*").alias("expected"), *[F.count(c).alias(c) for c in columns])
    total = reduce(lambda a, b: a + b, [F.col("expected") - F.col(c) for c in columns])
    return result_rows(counts.withColumn("difference", total).withColumn("actual", F.col("expected") - total),
                   "null_value", F.col("difference") == 0)


def partition_check(df: DataFrame, column: str = "year") -> DataFrame:
    """Per dataset: number of distinct partition values; none or a null value fails."""
    cells = df.groupBy("dataset_id", column).agg(F.count("*").alias("n"))
    out = cells.groupBy("dataset_id").agg(F.count(column).alias("actual"), F.count_if(F.col(column).isNull()).alias("difference"))
    return result_rows(out.withColumn("expected", F.lit(column)), "partition", (F.col("actual") > 0) & (F.col("difference") == 0))


def full_check(df: DataFrame, expected: DataFrame, expected_schema: DataFrame, columns: list[str],
               partition: str = "year") -> DataFrame:
    """All four checks, one result row per dataset and check."""
    wanted = expected_schema.select("dataset_id").distinct()
    actual = wanted.select("dataset_id", F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields])).alias("c")
    ).select("dataset_id", "c.*")
    issues = reconcile_schema(actual, expected_schema).groupBy("dataset_id").agg(F.count("*").alias("difference"))
    schema = result_rows(wanted.join(issues, "dataset_id", "left").fillna(0, ["difference"]), "schema", F.col("difference") == 0)
    parts = [reconcile_counts(df, expected), schema, reconcile_nulls(df, columns), partition_check(df, partition)]
    return reduce(DataFrame.unionByName, parts)


def validation_report(results: DataFrame) -> DataFrame:
    """Per check type, and one ``all`` row: datasets, passed, failed, errors, pass rate in percent."""
    cells = results.groupBy("check_type", "dataset_id", "status").agg(F.count("*").alias("n"))
    both = cells.select(F.explode(F.array(F.lit("all"), "check_type")).alias("check_type"), "dataset_id", "status", "n")

    def total(status):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0))
    return both.groupBy("check_type").agg(
        F.countDistinct("dataset_id").alias("datasets"), F.sum("n").alias("checks"), total("passed").alias("passed"),
        total("failed").alias("failed"), total("error").alias("errors"),
        (total("passed") / F.sum("n") * 100).alias("pass_rate"))


# --- quality score ------------------------------------------------------------------------------

def quality_score(facts: DataFrame, as_of_year: int) -> DataFrame:
    """Completeness, continuity of the year series, timeliness and outlier share per dataset, and a 0..100 score.

    Outliers lie beyond 1.5 interquartile ranges of the exact quartiles; every row is tested against them.
    """
    v = F.col("value")
    shape = facts.groupBy("dataset_id").agg(
        F.count("*").alias("records"), F.count("value").alias("filled"),
        F.countDistinct("year").alias("years"), F.min("year").alias("a"), F.max("year").alias("b"))
    quartiles = exact_percentiles(facts, "dataset_id", "value", [0.25, 0.75], interpolate=False)
    q = [F.max(F.when(F.col("point") == x, F.col("value"))) for x in (0.25, 0.75)]
    fence = quartiles.groupBy("dataset_id").agg((q[0] - (q[1] - q[0]) * 1.5).alias("lo"), (q[1] + (q[1] - q[0]) * 1.5).alias("hi"))
    outside = (facts.join(fence, "dataset_id").groupBy("dataset_id")
               .agg(F.count_if((v < F.col("lo")) | (v > F.col("hi"))).alias("outliers")))
    j = shape.join(outside, "dataset_id", "left").withColumn("outliers", F.coalesce("outliers", F.lit(0)))
    completeness = F.col("filled") / F.col("records")
    continuity = F.col("years") / (F.col("b") - F.col("a") + 1)
    timeliness = F.greatest(F.lit(0.0), F.lit(1.0) - F.greatest(F.lit(as_of_year) - F.col("b"), F.lit(0)) / 10.0)
    outlier = F.col("outliers") / F.col("records")
    return j.select("dataset_id", completeness.alias("completeness"), continuity.alias("continuity"), timeliness.alias("timeliness"),
                    outlier.alias("outlier_share"),
                    F.round((completeness + continuity + timeliness + (1 - outlier)) * 25, 2).alias("score"))


def timeseries_suitability(facts: DataFrame, min_time_points: int = 20, frequency: str = "any") -> DataFrame:
    """Datasets with enough time points of the wanted frequency, and whether their years are continuous."""
    points = facts.groupBy("dataset_id", "year", "quarter", "month").agg(F.count("*").alias("n"))
    kind = F.when(F.max("month") > 0, "monthly").when(F.max("quarter") > 0, "quarterly").otherwise("annual")
    out = points.groupBy("dataset_id").agg(
        F.count("*").alias("time_points"), kind.alias("frequency"),
        (F.countDistinct("year") == F.max("year") - F.min("year") + 1).alias("is_continuous"))
    ok = F.col("time_points") >= min_time_points
    return out.filter(ok if frequency == "any" else ok & (F.col("frequency") == frequency))


def correlation_candidates(facts: DataFrame, first: str, second: str, min_overlap: int = 10) -> DataFrame:
    """Datasets of the second indicator that share enough years with the first indicator's series.

    The first side is one row per year, so no pairs of datasets are formed.
    """
    def rows(word):
        return facts.filter(F.col("indicator").contains(word))
    base = rows(first).groupBy("year").agg(F.count("*").alias("_n")).select("year")
    other = rows(second).groupBy("dataset_id", "year").agg(F.count("*").alias("_n")).select("dataset_id", "year")
    return (other.join(base, "year").groupBy("dataset_id").agg(F.count("*").alias("overlap_years"))
            .filter(F.col("overlap_years") >= min_overlap))
