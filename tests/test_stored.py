"""Stored facts and keyed metadata tables: plans, files and results."""

import uuid

import pytest
from pyspark.sql import functions as F

from statlake.operators import analytics as A
from statlake.plans.mapping_queries import domain_rows
from statlake.sources import facts as FA, keyed as KT


def name(stem):
    return f"{stem}_{uuid.uuid4().hex[:8]}"


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    return {d: FA.create(domain_rows(spark, sf, d), d, name(d), str(tmp_path_factory.mktemp(d))) for d in ("population", "economy", "education")}


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final(plan):
    return plan.split("Initial Plan")[0]


def test_year_conditions_reach_the_partitions(spark, stored):
    p, e, s = (stored[d].rows(spark) for d in ("population", "economy", "education"))
    year = F.col("year")
    for df in (A.group_statistics(p, ["year", "category"], where=year == 1998, total="t"), A.top_regions(p, 1998),
               A.distinct_count(s, ["region_code"], "dataset_id", "n", year == 1998), p.filter((year >= 1998) & (F.col("region_code") == "00013")),
               A.related_statistics(p.filter(year >= 1996), e.filter(year != 1999), ["year", "region_code"], ["year"], how="left", left_total="t"),
               FA.top_regions(spark, stored["population"], 1998)):
        scans = [x for x in plan_of(df).splitlines() if "FileScan" in x]
        assert scans and all("PartitionFilters: [isnotnull(year" in x for x in scans)


def test_joins_of_totals_shuffle_nothing(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = FA.joined_totals(spark, {"population": stored["population"], "gdp": stored["economy"]}, F.col("year") >= 1996)
        plan = final(plan_of(joined))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 16 out of 16" in plan


def test_years_of_a_small_side_prune_partitions_at_run_time(spark, stored, tmp_path):
    years = spark.createDataFrame([(y, "even" if y % 2 == 0 else "odd") for y in range(1990, 2000)], "year int, kind string")
    years.write.parquet(str(tmp_path / "years"))
    df = stored["population"].rows(spark).join(spark.read.parquet(str(tmp_path / "years")).filter("kind = 'even'"), "year").groupBy("year").count()
    assert "dynamicpruning" in plan_of(df)


def test_a_load_rewrites_the_totals_of_its_years_only(spark, sf, tmp_path):
    rows = domain_rows(spark, sf, "economy")
    tables = FA.create(rows.filter("year < 1998"), "economy", name("economy"), str(tmp_path))
    before = {f.name for f in (tmp_path / "totals").glob("year=*/*.parquet")}
    assert FA.append(rows.filter("year = 1999 AND month IS NULL" if "month" in rows.columns else "year = 1999"), tables) == [1999]
    after = {f.name for f in (tmp_path / "totals").glob("year=*/*.parquet")}
    assert before < after
    got = {(r["year"], r["region_code"]): (r["records"], round(r["total"], 6)) for r in tables.by_region(spark).collect()}
    want = rows.filter("year < 1998 OR year = 1999").groupBy("year", "region_code").agg(F.count("*").alias("n"), F.sum("value").alias("s")).collect()
    assert got == {(r["year"], r["region_code"]): (r["n"], round(r["s"], 6)) for r in want}


def contents(spark, table):
    return sorted((tuple(r) for r in KT.read(spark, table).collect()), key=repr)


def test_changes_rewrite_touched_buckets_only(spark, tmp_path):
    table, rows = name("keyed"), [(f"d{i}", "pending", i) for i in range(200)]
    KT.create(spark.createDataFrame(rows, "id string, status string, n int"), "id", table, str(tmp_path), buckets=8)
    assert contents(spark, table) == sorted(rows, key=repr)

    def files():
        return {r["b"]: r["f"] for r in spark.table(table).groupBy(F.col(KT.BUCKET).alias("b")).agg(F.sort_array(F.collect_set(F.col("_metadata.file_path"))).alias("f")).collect()}
    before = files()
    touched = KT.update(spark.createDataFrame([("d3", "failed"), ("unknown", "failed")], "id string, status string"), table)
    after = files()
    assert 1 <= len(touched) <= 2 and all((before[b] == after[b]) == (b not in touched) for b in before)
    want = [(i, "failed" if i == "d3" else s, n) for i, s, n in rows]
    assert contents(spark, table) == sorted(want, key=repr)
    KT.upsert(spark.createDataFrame([("d4", "new", 0), ("d900", "new", None)], "id string, status string, n int"), table)
    want = [("d4", "new", 0) if r[0] == "d4" else r for r in want] + [("d900", "new", None)]
    assert contents(spark, table) == sorted(want, key=repr)
    KT.remove(spark.createDataFrame([("d900",), ("d5",), ("none",)], "id string"), table)
    want = [r for r in want if r[0] not in ("d900", "d5")]
    assert contents(spark, table) == sorted(want, key=repr)


def test_no_change_and_emptied_buckets(spark, tmp_path):
    table = name("keyed")
    KT.create(spark.createDataFrame([("a", 1)], "id string, n int"), "id", table, str(tmp_path), buckets=4)
    assert KT.update(spark.createDataFrame([], "id string, n int"), table) == []
    KT.remove(spark.createDataFrame([("a",)], "id string"), table)
    assert contents(spark, table) == []
    KT.upsert(spark.createDataFrame([("a", 2)], "id string, n int"), table)
    assert contents(spark, table) == [("a", 2)]


def test_reopened_datasets_with_other_values_are_reported(spark, sf, tmp_path):
    from statlake.plans import jobs as J, views as V
    raw = V.raw_obs(spark, sf).filter(F.col("attr_area").isNotNull()).withColumn("attr_area", F.coalesce("attr_area", F.lit("x")))
    ids = raw.select("dataset_id").distinct()
    registry = ids.select("dataset_id", F.lit("labor").alias("domain"), *[F.lit(None).cast("string").alias(c) for c in (
        "fetch_date", "transformation_date", "validation_date", "load_date")])
    first = J.ingest(raw, registry, str(tmp_path / "lake"))
    assert {r["status"] for r in first.collect()} == {"success"}
    again = J.ingest(raw, registry, str(tmp_path / "lake"))
    assert {(r["status"], r["error_message"]) for r in again.collect()} == {("success", "")}
    changed = raw.withColumn("value", F.when((F.col("dataset_id") == "ds00003") & F.col("attr_id").endswith("1"), "17").otherwise(F.col("value")))
    revised = {r["dataset_id"]: (r["status"], r["records"], r["error_message"]) for r in J.ingest(changed, registry, str(tmp_path / "lake")).collect()}
    assert revised.pop("ds00003") == ("failed", 0, "load: other rows are stored already") and {v[0] for v in revised.values()} == {"success"}
    assert spark.read.parquet(str(tmp_path / "lake")).count() == raw.count()


def test_profiles_add_up_over_loads_with_other_columns(spark, tmp_path):
    from statlake.operators import profile as PR, quality as Q
    path = str(tmp_path / "profile")
    one = spark.createDataFrame([("a", 2000, "r", 1.0), ("a", 2001, None, 2.0), ("b", None, "r", None)], "dataset_id string, year int, region_code string, value double")
    two = spark.createDataFrame([("a", 2001, "r", 1.0, "n"), ("c", 1999, "r", 3.0, None)], "dataset_id string, year int, region_code string, value double, note string")
    PR.append(one, "1", path)
    PR.append(two, "2", path)
    profile = PR.read(spark, path)
    both = one.unionByName(two, allowMissingColumns=True)
    expected = spark.createDataFrame([("a", 3), ("b", 1), ("d", 1)], "dataset_id string, expected long")
    schema = spark.createDataFrame([(d, c, t) for d in "abc" for c, t in both.dtypes], "dataset_id string, column string, type string")
    got = PR.full_check(profile, expected, schema, ["region_code", "value"])
    want = Q.full_check(both, expected, schema, ["region_code", "value"])
    # Only what a data set has brought counts as its schema: the note column is missing in "b".
    differ = {tuple(r) for r in got.collect()} ^ {tuple(r) for r in want.collect()}
    assert {r[:3] for r in differ} == {("b", "schema", "failed"), ("b", "schema", "passed")}
    assert {tuple(r) for r in PR.columns(profile).filter("dataset_id = 'a'").select("column", "filled", "nulls").collect()} == {
        ("dataset_id", 3, 0), ("year", 3, 0), ("region_code", 2, 1), ("value", 3, 0), ("note", 1, 2)}
    assert {r["part"]: r["rows"] for r in PR.partitions(profile).collect()} == {"2000": 1, "2001": 2, None: 1, "1999": 1}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [load" in plan and "Relation [dataset_id" not in plan             # of files, profiles alone
    assert PR.datasets(PR.read(spark, str(tmp_path / "none"))).count() == 0


def test_bitmaps_of_loads_count_exactly(spark, tmp_path):
    from statlake.operators import bitmaps as B
    path = str(tmp_path / "bitmaps")

    def load(name, year, ids):
        B.append(spark.createDataFrame([(year, f"c{i}" if i is not None else None, f"x{(i or 0) % 3}") for i in ids], "year int, code string, kind string"), ["code", "kind"], "year", name, path)
    load("1", 2000, [*range(40_000), None, 5, 5])
    files = {f.name for f in (tmp_path / "bitmaps" / "bitmaps").glob("load=*/*.parquet")}
    load("2", 2001, range(39_990, 40_010))
    load("3", 2001, range(40_005, 40_020))
    assert files < {f.name for f in (tmp_path / "bitmaps" / "bitmaps").glob("load=*/*.parquet")}
    assert {tuple(r) for r in B.distinct_counts(spark, path).collect()} == {("code", 40_020), ("kind", 3)}
    by_year = {(r["group"], r["column"]): r["distinct"] for r in B.distinct_counts(spark, path, by_group=True).collect()}
    assert by_year == {("2000", "code"): 40_000, ("2000", "kind"): 3, ("2001", "code"): 30, ("2001", "kind"): 3}
    numbers = spark.read.parquet(f"{path}/dictionary").filter("column = 'code'")
    assert numbers.agg(F.countDistinct("nr"), F.max("nr")).first() == (40_020, 40_020)
