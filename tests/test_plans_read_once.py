"""Plans that read or shuffle their input once, where they did so several times."""

import pytest
from pyspark.sql import functions as F

from statlake.operators import bitmaps as B, infer as I, profile as PR, search as SE
from statlake.plans import all_queries, jobs as J, lake_queries as LQ, views as V

QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_meet_customers_before_items(spark, sf):
    joins = V.raw_obs(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert joins.index("l_orderkey") < joins.index("o_custkey") and "Join Inner, (o_custkey" in joins.split("l_orderkey", 1)[1]


def test_registry_and_chunks_are_stored(spark, sf):
    assert "Join" not in plan(LQ.landed_registry(spark, sf))
    raw, chunks = LQ.chunked(spark, sf)
    assert "Join" not in plan(raw) and "Join" not in plan(chunks)


def test_ids_of_a_small_batch_reach_the_files(spark, sf):
    raw, batch = V.raw_obs(spark, sf), spark.createDataFrame([("ds00001",), ("ds00003",)], "dataset_id string")
    few = J.of_batch(raw, batch, 8)
    want = raw.join(batch, "dataset_id").groupBy("dataset_id").count().collect()
    assert sorted(map(tuple, few.groupBy("dataset_id").count().collect())) == sorted(map(tuple, want))
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.index("ds00001")           # the condition stands below the join
    assert J.of_batch(raw, batch, J.MOST_LISTED + 1) is raw
    assert J.of_batch(raw, batch.limit(0), 8).count() == 0


@pytest.mark.parametrize("name, module, function, place", [
    ("q14_profile_check", PR, "append", 0), ("a01_bitmap_counts", B, "append", 0), ("k32_by_indicator", SE, "by_indicator", 1), ("k17_rich_catalog", I, "search_summary", 0)])
def test_shared_rows_are_stored_before_they_are_used_again(spark, sf, monkeypatch, name, module, function, place):
    seen, real = [], getattr(module, function)
    monkeypatch.setattr(module, function, lambda *a, **k: (seen.append(plan(a[place])), real(*a, **k))[1])
    QUERIES[name](spark, sf)
    assert seen and not any("Join" in p or "parse_json" in p for p in seen)


def test_a_load_of_bitmaps_expands_its_rows_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(y, f"c{i % 40}", f"d{i}") for i in range(200) for y in (1, 2)], "year int, a string, b string")
    seen, real = [], B._pairs
    monkeypatch.setattr(B, "_pairs", lambda *a: (seen.append(1), real(*a))[1])
    for load, part in (("x", F.col("b") < "d5"), ("y", F.col("b") >= "d5")):
        B.append(rows.filter(part), ["a", "b"], "year", load, str(tmp_path / "bits"))
    assert len(seen) == 2
    assert {tuple(r) for r in B.distinct_counts(spark, str(tmp_path / "bits")).collect()} == {("a", 40), ("b", 200)}
    numbers = [(r["column"], r["nr"]) for r in spark.read.parquet(str(tmp_path / "bits" / "dictionary")).collect()]
    assert sorted(numbers) == [("a", i) for i in range(1, 41)] + [("b", i) for i in range(1, 201)]


def test_types_of_repeated_values(spark):
    """Types need no distinct values: values are not shuffled by themselves, also where they come as records."""
    rows = [("d", str(i % 3), "x" if i == 700 else "1") for i in range(1000)] + [("e", None, "2.5")]
    df = spark.createDataFrame(rows, "dataset_id string, attr_a string, value string")
    for raw in (df, df.select("dataset_id", F.create_map(F.lit("@a"), "attr_a", F.lit("$"), "value").alias("record"))):
        got = I.voted_types(I.field_values(raw, repeated=True))
        assert plan(got).count("Exchange") == 2                 # rows by dataset, and counts
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, I.voted_types(I.field_values(raw)).collect())) == [
            ("d", "$", "STRING"), ("d", "@a", "INT"), ("e", "$", "DOUBLE")]


def test_schema_reads_items_once(spark, sf):
    items = LQ.items(spark, sf).filter("dataset_id < 'ds00005'")
    assert "Union" not in plan(I.schema_from_metadata(items))
    last = I.schema_from_metadata(items).filter("name = 'value'")
    assert last.count() == items.select("dataset_id").distinct().count() and last.filter("position <> 11").isEmpty()


def test_distinct_values_are_counted_where_they_decide(spark, monkeypatch):
    """Partition columns by plain Python; datasets with time and area fields have no values counted."""
    rows = [("full", str(i), "000%d" % (i % 3), str(2000 + i % 2), str(i % 40), str(i)) for i in range(80)]
    rows += [("timed", str(i % 9), None, "2001", str(i % 40), str(i % 1001)) for i in range(1100)]
    rows += [("bare", str(i % 10), None, None, str(i % 1001), str(i % 1000)) for i in range(1100)]
    df = spark.createDataFrame(rows, "dataset_id string, attr_id string, attr_area string, attr_time string, attr_cat01 string, value string")
    seen, real = [], I.field_values
    monkeypatch.setattr(I, "field_values", lambda raw, repeated=False: (seen.append((repeated, {r[0] for r in raw.select("dataset_id").distinct().collect()})), real(raw, repeated))[1])
    got = {(r["dataset_id"], r["name"]) for r in I.schema_from_data(df).collect() if r["is_partition"]}
    assert got == {("full", "time"), ("full", "area"), ("timed", "time"), ("timed", "category_01"), ("bare", "id"), ("bare", "value")}
    assert seen == [(True, {"full", "timed", "bare"}), (False, {"timed", "bare"})]
    seen.clear()
    I.schema_from_data(df.filter("dataset_id = 'full'")).collect()
    assert [x for x, _ in seen] == [True]
