"""Operators against brute force on small, skewed fixtures."""

import random
import re
import statistics
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from statlake.operators import (analytics as A, catalog as C, infer as I, mapping as M, quality as Q, ranking as R, registry as G,
                                search as SE, tfidf as TF)
from statlake.functions import scalars as SC
from statlake.schemas import DOMAINS, get_domain, get_schema

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def raw(spark, rows):
    return spark.createDataFrame(rows, "attr_id string, attr_time string, attr_area string, attr_cat01 string, value string, attr_unit string")


def test_domain_mapping(spark):
    df = raw(spark, [("0003458339", "2020", "01000", "total", "5250000", "人"), ("x", None, None, None, "-", None)])
    a, b = M.map_domain(df, "population").orderBy("dataset_id").collect()
    assert (a["dataset_id"], a["year"], a["value"], a["category"], a["region_name"]) == ("0003458339", 2020, 5250000.0, "total", "")
    assert (b["year"], b["region_code"], b["value"], b["unit"]) == (2020, "", 0.0, "")
    for d in DOMAINS:
        assert [f.name for f in get_schema(d).fields] == M.map_domain(df, d).columns
    assert get_domain("nothing").name == "generic" and M.map_domain(df, "labor").first()["occupation_code"] == ""
    assert M.map_domain(df, "economy", dataset_id=F.lit("E1")).first()["dataset_id"] == "E1"


def test_dynamic_schema_round_trip(spark):
    from statlake.sources.sinks import schema_from_text, schema_to_text
    s = M.dynamic_struct([{"name": "area", "type": "INT", "source_field": "@area", "description": "地域コード"},
                          {"name": "value", "type": "DOUBLE", "source_field": "$"}])
    back, parts, info = schema_from_text(schema_to_text(s, ["area"], {"title": "x"}))
    assert back == s and parts == ["area"] and info == {"title": "x"}
    assert M.column_mapping(back) == {"@area": "area", "$": "value"}


def skewed(spark, n=2000, keys=20, seed=1):
    """One key holds a third of the rows."""
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(keys)}", i, rnd.randrange(100), float(rnd.randrange(1000))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, i int, g int, v double").repartition(7)


def test_repeated_rows(spark):
    rows, df = skewed(spark)
    df = df.withColumn("k", F.when(F.col("k") != "k3", F.col("k")))
    seen, want = set(), set()
    for k, i, g, _ in sorted(rows, key=lambda r: r[1]):
        key = (None if k == "k3" else k, g)
        if key in seen:
            want.add(i)
        seen.add(key)
    assert {r["i"] for r in Q.repeated_rows(df, ["k", "g"], ["i"]).collect()} == want


def test_quality_checks(spark):
    df = spark.createDataFrame([(2020, "Tokyo", 100.0), (None, "Osaka", 200.0), (2022, None, 150.0), (2022, "", -50.0), (2023, "null", 500.0)],
                               "year int, region string, value double")
    nulls = {r["column"]: r["null_count"] for r in Q.null_check(df, ["year", "region"]).collect()}
    assert nulls == {"year": 1, "region": 3}
    bad = {r["value"]: r["reason"] for r in Q.out_of_range(df, "value", 0, 400).collect()}
    assert bad == {-50.0: "below_minimum", 500.0: "above_maximum"}
    ok, no = Q.quarantine(df, [("year", F.col("year").isNotNull()), ("positive", F.col("value") > 0)])
    assert ok.count() + no.count() == df.count() and {tuple(r["reasons"]) for r in no.collect()} == {("year",), ("positive",)}
    assert Q.missing_columns(df, ["year", "x"]) == ["x"]
    with pytest.raises(ValueError):
        Q.dataset_gate(df, "generic", 1.5)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=40))
def test_duplicates_found_equal_duplicates_made(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    counts = {p: pairs.count(p) for p in set(pairs)}
    r = Q.duplicate_summary(df, ["a", "b"]).first()
    assert r["duplicate_keys"] == sum(c > 1 for c in counts.values())
    assert r["duplicate_rows"] == sum(c for c in counts.values() if c > 1)


def test_top_per_group_limits_before_the_shuffle(spark):
    rows, df = skewed(spark)
    out = R.top_per_group(df, ["k"], [F.desc("v"), F.asc("i")], 3)
    want = {}
    for k, i, _, v in sorted(rows, key=lambda r: (-r[3], r[1])):
        want.setdefault(k, []).append(i)
    assert sorted(r["i"] for r in out.collect()) == sorted(i for v in want.values() for i in v[:3])
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [60, 600, 1500])
def test_top_per_group_in_pieces(spark, n):
    rows, df = skewed(spark, 6000)
    out = R.top_per_group(df, ["k"], [F.desc("v"), F.asc("i")], n)
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 4
    want = {}
    for k, i, _, v in sorted(rows, key=lambda r: (-r[3], r[1])):
        want.setdefault(k, []).append(i)
    assert sorted(r["i"] for r in out.collect()) == sorted(i for v in want.values() for i in v[:n])
    assert out.columns == ["k", "i", "g", "v", "rn"]


def test_lag_by_blocks(spark):
    rows, df = skewed(spark, 1500)
    out = R.lag_by_blocks(df, "k", ["g", "i"], "v", "prev", 7)
    got = {r["i"]: r["prev"] for r in out.collect()}
    last, want = {}, {}
    for k, i, _, v in sorted(rows, key=lambda r: (r[2], r[1])):
        want[i] = last.get(k)
        last[k] = v
    assert got == want


@pytest.mark.parametrize("blocks", [None, 1, 50])
def test_exact_percentiles(spark, blocks):
    rows, df = skewed(spark, 3000)
    points = [0.0, 0.5, 0.95, 0.99, 1.0]
    got = {(r["k"], r["point"]): r["value"] for r in R.exact_percentiles(df, "k", "v", points, blocks).collect()}
    by = {}
    for k, _, _, v in rows:
        by.setdefault(k, []).append(v)
    for k, vs in by.items():
        for p in points:
            assert got[(k, p)] == pytest.approx(np.percentile(vs, p * 100)), (k, p)


def test_known_percentiles(spark):
    df = spark.createDataFrame([("t", v) for v in (10.0, 20.0, 30.0, 45.0)], "k string, v double")
    got = [r["value"] for r in R.exact_percentiles(df, "k", "v", [0.5, 0.95, 0.99]).orderBy("point").collect()]
    assert got == pytest.approx([25.0, 42.75, 44.55])


def test_percentile_blocks_stay_small(spark):
    """A task of the ranking holds one block: its share of the values, not of the group."""
    df = spark.range(200000).select(F.lit("one").alias("k"), F.col("id").cast("double").alias("v"))
    got = R.exact_percentiles(df, "k", "v", [0.25, 0.999], 40)
    assert {r["point"]: r["value"] for r in got.collect()} == pytest.approx({0.25: 49999.75, 0.999: 199799.001})
    cut = df.groupBy("k", "v").count().repartitionByRange(40, "k", "v")
    assert cut.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 3 * 200000 / 40


def test_select_diverse(spark):
    rows = [("a1", "x", 0, 9, 1), ("a2", "x", 0, 8, 2), ("a3", "x", 0, 7, 3), ("b1", "y", 1, 5, 4), ("c1", "z", 2, 6, 5), ("a1", "z", 2, 9, 1)]
    df = spark.createDataFrame(rows, "dataset_id string, domain string, domain_seq int, priority int, seq int")
    out = [r["dataset_id"] for r in R.select_diverse(df, 4).collect()]
    assert out[0] == "a1" and set(out) == {"a1", "b1", "a2", "c1"} or len(out) == 4 and len(set(out)) == 4


def test_join_statistics_equal_the_literal_join(spark):
    rnd = random.Random(3)
    make = lambda n, ks: [(rnd.choice(ks), float(rnd.randrange(50))) for _ in range(n)]
    left = spark.createDataFrame(make(200, ["a", "b", "c", "hot", "hot"]), "k string, value double")
    right = spark.createDataFrame(make(150, ["b", "c", "d", "hot", "hot"]), "k string, value double")
    for how in ("inner", "left"):
        got = A.related_statistics(left, right, ["k"], ["k"], how=how, left_total="s", left_average="m", right_average="t")
        want = left.join(right.withColumnRenamed("value", "w"), "k", how).groupBy("k").agg(
            F.sum("value").alias("s"), F.avg("value").alias("m"), F.avg("w").alias("t"))
        assert {r["k"]: (r["s"], round(r["m"], 9), r["t"] and round(r["t"], 9)) for r in got.collect()} == \
            {r["k"]: (r["s"], round(r["m"], 9), r["t"] and round(r["t"], 9)) for r in want.collect()}


def test_growth_skips_gaps_and_zero(spark):
    df = spark.createDataFrame([(2020, "a", 100.0), (2021, "a", 150.0), (2023, "a", 10.0), (2020, "z", 0.0), (2021, "z", 5.0)],
                               "year int, region_code string, value double")
    got = {(r["region_code"], r["year"]): r["growth_rate_percent"] for r in A.growth(df, ["region_code"], "v", "p", 2021).collect()}
    assert got == {("a", 2021): 50.0, ("a", 2023): None, ("z", 2021): None}


def catalog(spark):
    rows = [("pop001", "人口統計データ2020", "都道府県別の人口統計", "population", ["人口", "統計"], ["year", "prefecture", "population"], 50000, "2020", "2020", 1),
            ("labor001", "労働力調査2021", "雇用と失業に関する統計", "labor", ["労働", "雇用"], ["year", "employment_status", "count"], 30000, "2021", "2021", 2),
            ("econ001", "GDP統計", "国内総生産の推移", "economy", ["GDP", "経済"], ["year", "gdp"], 100000, "2000", None, 3)]
    return (spark.createDataFrame(rows, "dataset_id string, title string, description string, domain string, keywords array<string>, column_names array<string>, "
                                        "record_count bigint, time_range_start string, time_range_end string, seq bigint")
            .withColumn("tags", F.array(F.concat(F.lit("domain:"), "domain"))).withColumn("partition_fields", F.array(F.lit("year")))
            .withColumn("ingestion_status", F.lit("success")))


def test_search_invariants(spark):
    queries = ["人口", "労働", "経済", "教育", "医療", "統計", "データ", "調査", "世帯", "雇用"]
    c = catalog(spark)
    rows = SE.search(c, queries).collect()
    for q in queries:
        hits = sorted((r for r in rows if r["query"] == q), key=lambda r: r["rank"])
        assert [h["rank"] for h in hits] == list(range(1, len(hits) + 1))
        assert all(a["score"] >= b["score"] for a, b in zip(hits, hits[1:]))
        assert len({h["dataset_id"] for h in hits}) == len(hits)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, SE.search(c, queries).collect()))
    top = {r["query"]: r["dataset_id"] for r in rows if r["rank"] == 1}
    assert top["人口"] == "pop001" and top["労働"] == "labor001" and top["経済"] == "econ001"
    only = SE.search(c, ["統計"], domain="labor", min_records=1000).collect()
    assert {r["dataset_id"] for r in only} == {"labor001"}
    many = [f"語{i}" for i in range(SE.QUERY_BATCH)] + ["人口"]
    assert {(r["query_id"], r["dataset_id"]) for r in SE.search(c, many).collect()} == {(SE.QUERY_BATCH, "pop001")}


def test_filters_and_suggestions(spark):
    c = catalog(spark)
    ids = lambda **f: {r["dataset_id"] for r in c.filter(SE.catalog_filters(**f)).collect()}
    assert ids(start="2020") == {"pop001", "labor001"} and ids(end="2020") == {"pop001"}
    assert ids(tags=["domain:labor"]) == {"labor001"} and ids(min_records=0) == {"pop001", "labor001", "econ001"}
    s = {r["query"]: r["suggestions"] for r in SE.suggestions(c, ["人口", "謎"]).collect()}
    assert s["人口"] == ["世帯", "国勢調査", "人口動態", "人口推計"] and s["謎"] == ["population関連データ", "labor関連データ", "economy関連データ"]
    empty = SE.suggestions(c.filter("false"), ["謎"]).first()
    assert empty["suggestions"] == ["人口統計", "労働統計", "経済統計", "教育統計"]


def test_tfidf_against_plain_python(spark):
    docs = {"a": "人口統計 人口", "b": "労働力調査", "c": "人口動態 調査", "d": "x"}
    df = spark.createDataFrame(list(docs.items()), "k string, t string")

    def grams(t):
        return [t[i:i + n] for n in (2, 3) for i in range(len(t) - n + 1)]
    idf = {}
    for g in {g for t in docs.values() for g in grams(t)}:
        idf[g] = np.log((1 + 4) / (1 + sum(g in grams(t) for t in docs.values()))) + 1

    def vec(t):
        v = {g: grams(t).count(g) * idf[g] for g in set(grams(t)) if g in idf}
        n = np.sqrt(sum(x * x for x in v.values())) or 1
        return {g: x / n for g, x in v.items()}
    q = vec("人口調査")
    want = {k: sum(x * q.get(g, 0) for g, x in vec(t).items()) for k, t in docs.items()}
    got = {r["k"]: r["score"] for r in TF.tfidf_search(df, "k", F.col("t"), "人口調査", 10).collect()}
    assert got == pytest.approx({k: v for k, v in want.items() if v > 0})


def test_keywords_shuffle_texts_not_ngrams(spark):
    """Keywords against plain Python, with a key in two rows, empty and null texts; no n-gram of a document is exchanged."""
    rng = random.Random(5)
    docs = [(i % 57, "".join(rng.choices("abc日本 \n", k=rng.randint(0, 60)))) for i in range(60)] + [(98, ""), (99, None)]
    df = spark.createDataFrame(docs, "k long, t string")
    got = TF.tfidf_keywords(df, "k", F.col("t"), 3, (2, 3, 4), 20)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    tf = {}
    for k, t in docs:
        t = re.sub(r"\s\s+", " ", (t or "").lower())
        tf.setdefault(k, Counter()).update(t[i:i + n] for n in (2, 3, 4) for i in range(len(t) - n + 1))
    total, held = Counter(), Counter()
    for c in tf.values():
        total.update(c)
        held.update(c.keys())
    idf = {g: np.log((1 + len(docs)) / (1 + held[g])) + 1 for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:20]}
    want = [(k, r, g) for k, c in tf.items() for r, (_, g) in enumerate(sorted((-n * idf[g], g) for g, n in c.items() if g in idf)[:3], 1)]
    assert sorted((r["k"], r["rank"], r["gram"]) for r in got.collect()) == sorted(want)


def test_vector_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert [r["vec_id"] for r in SE.vector_search(df, [0.0, 1.0], 2).collect()] == [3, 2]
    assert SE.vector_search(df, SE.mean_vector(df), 1).first()["score"] == pytest.approx(2 * 2.5 / 3)


def test_type_vote(spark):
    def vote(values):
        df = spark.createDataFrame([("d", i, v, "2020") for i, v in enumerate(values)], "dataset_id string, i int, value string, attr_time string")
        return {r["field"]: r["type"] for r in I.voted_types(I.field_values(df)).collect()}["$"]
    assert vote(["1"] * 9 + ["x"]) == "STRING" and vote(["1"] * 8 + ["2.5"] * 2) == "DOUBLE"
    assert vote(["1", "99999999999"]) == "BIGINT" and vote(["1.5"] * 10) == "DOUBLE" and vote(["true", "FALSE"]) == "BOOLEAN"
    assert vote(["0", "1"]) == "INT" and vote(["1"] * 5000 + ["x"]) == "STRING" and vote([None, "x"]) == "STRING" and vote(["1" * 25]) == "STRING"


def test_late_values_are_not_lost(spark):
    rows = [("d", str(i), "100" if i < 200 else "A100", "01000", "2020", str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "dataset_id string, attr_id string, attr_cat01 string, attr_area string, attr_time string, value string")
    schema = {r["name"]: r for r in I.schema_from_data(df).collect()}
    assert schema["category_01"]["type"] == schema["area"]["type"] == "STRING"
    out = M.transform_dynamic(df, I.to_struct(I.schema_from_data(df)), "d")
    assert out.filter("category_01 IS NULL").count() == 0 and {r.area for r in out.collect()} == {"01000"}
    items = spark.createDataFrame([("d", 0, "cat01", "c", i, str(i) if i < 10 else "X") for i in range(11)],
                                  "dataset_id string, dim_pos int, dim_id string, dim_name string, item_pos int, code string")
    assert {r["name"]: r["type"] for r in I.schema_from_metadata(items).collect()}["category_01"] == "STRING"


def test_wide_integers_are_exact(spark):
    df = spark.createDataFrame([(t,) for t in ("1234567890123456789", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "12.9", "1e3")], "t string")
    got = [r[0] for r in df.select(SC.cast_value(F.col("t"), "BIGINT")).collect()]
    assert got == [1234567890123456789, 2 ** 63 - 1, -2 ** 63, None, 12, 1000]


def test_schema_from_metadata(spark):
    rows = [("d", 0, "tab", "表章項目", 0, "A1101"), ("d", 1, "cat01", "分類", 0, "000"), ("d", 2, "area", "地域", 0, "00000"), ("d", 3, "time", "時間", 0, "2020")]
    items = spark.createDataFrame(rows, "dataset_id string, dim_pos int, dim_id string, dim_name string, item_pos int, code string")
    s = I.schema_from_metadata(items)
    got = [(r["name"], r["type"], r["is_partition"]) for r in s.orderBy("position").collect()]
    assert got == [("dataset_id", "STRING", False), ("record_id", "STRING", False), ("indicator", "STRING", False), ("category_01", "INT", False),
                   ("area", "STRING", False), ("time", "STRING", True), ("value", "DOUBLE", False)]
    assert I.check_schema(s).first()["valid"] is True
    assert {r["name"]: r["type"] for r in I.schema_from_metadata(items, area_as_text=False).collect()}["area"] == "INT"
    assert [f.name for f in I.to_struct(s).fields][-1] == "value"


def test_registry_additions_and_alerts(spark):
    reg = spark.createDataFrame([("a", "A", "labor", "completed", "2020-01-01T00:00:00", None), ("b", "B", "labor", "completed", None, "2020-03-02T02:24:00"),
                                 ("c", "C", "trade", "completed", "bad", None), ("d", "D", "trade", "pending", "2019-01-01", None)],
                                "dataset_id string, dataset_name string, domain string, status string, load_date string, updated_at string")
    as_of = F.lit("2020-03-31 00:00:00").cast("timestamp")
    assert {r["dataset_id"]: (r["days_since_update"], r["alert_type"]) for r in G.freshness_alerts(reg, as_of).collect()} == {"a": (90, "very_stale")}
    as_of = F.lit("2020-04-01 02:24:00").cast("timestamp")
    assert {r["dataset_id"]: r["alert_type"] for r in G.freshness_alerts(reg, as_of).collect()} == {"a": "very_stale", "b": "stale"}
    new = spark.createDataFrame([("a", "", "labor", 3), ("n", "", "odd", 99), ("n", "", "odd", 99)], "dataset_id string, dataset_name string, domain string, priority int")
    assert [tuple(r) for r in G.added(reg, new).collect()] == [("n", "Dataset n", "generic", 5, "pending")]
    assert {r["domain"] for r in G.count_alerts(reg).collect()} == {"labor", "trade"}


def test_diverse_catalog_updates(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "dataset_id string, n int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "dataset_id string, n int")
    assert {tuple(r) for r in C.upsert(old, new).collect()} == {("a", 1), ("b", 9), ("c", 3)}
    assert {tuple(r) for r in C.update_columns(old, new).collect()} == {("a", 1), ("b", 9)}


@SLOW
@given(st.lists(st.floats(0, 1000, allow_nan=False), min_size=1, max_size=30))
def test_latency_metrics_are_ordered(spark, values):
    from statlake.operators.reports import latency_report
    df = spark.createDataFrame([("sql", float(v)) for v in values], "test_type string, latency_ms double")
    r = latency_report(df).first()
    assert r["p50"] <= r["p95"] + 1e-9 and r["p95"] <= r["p99"] + 1e-9
    assert r["min"] - 1e-9 <= r["avg"] <= r["max"] + 1e-9 and r["p50"] == pytest.approx(statistics.median(values))


def test_overlapping_intervals_equal_brute_force(spark):
    import random
    rng = random.Random(2)
    rows = [(i, a, a + rng.randint(-1, 30)) for i, a in enumerate(rng.choices(range(-40, 60), k=120))] + [(500, None, 4), (501, 4, None), (502, 7, 7), (502, 7, 7)]
    df = spark.createDataFrame(rows, "id int, s int, e int")
    for least, width in ((1, 4), (3, 4), (5, 1), (2, 50)):
        pairs = A.overlapping(df, df, "s", "e", least, width)
        assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in pairs._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in pairs.select("a.id", F.col("b.id").alias("j"), "shared").collect())
        full = [r for r in rows if None not in r]
        want = sorted((a[0], b[0], n) for a in full for b in full if (n := min(a[2], b[2]) - max(a[1], b[1]) + 1) >= least)
        assert got == want


@pytest.mark.parametrize("regions", [3, 70, 1200])
def test_joinable_pairs_meet_in_pieces(spark, monkeypatch, regions):
    """All datasets share years, so one bin holds them all: its pairs are spread over tasks, and each comes once."""
    monkeypatch.setattr(A, "PAIR_ROWS", 10)
    cells = {f"d{d:02d}": (2000 + d % 3, 2006 + d % 5, {(d * 7 + k) * 13 % regions for k in range(d % 9)}) for d in range(60)}
    rows = [(k, y, 0, 0, f"r{r}") for k, (first, last, own) in cells.items() for y in (first, last) for r in own] + [(k, y, 0, 0, None) for k, v in cells.items() for y in v[:2]]
    pairs = A.joinable_pairs(spark.createDataFrame(rows, "dataset_id string, year int, quarter int, month int, region_code string"), 2)
    busy = pairs.select(F.spark_partition_id().alias("p")).distinct().count()
    got = sorted((r["dataset_a"], r["dataset_b"], r["overlap_years"], r["shared_regions"]) for r in pairs.collect())
    want = sorted((a, b, n, len(x[2] & y[2])) for a, x in cells.items() for b, y in cells.items() if a < b and (n := min(x[1], y[1]) - max(x[0], y[0]) + 1) >= 2)
    assert got == want and busy > 4


def test_joinable_pairs_read_facts_once(spark):
    regions = [f"r{i:03d}" for i in range(150)]
    rows = [(f"d{d}", 2000 + d % 4 + y, 1 if d % 2 else 0, 0, regions[(d * 7 + k) % 150]) for d in range(12) for y in range(4) for k in range(d * 10 + 1)]
    facts = spark.createDataFrame(rows, "dataset_id string, year int, quarter int, month int, region_code string")
    pairs = A.joinable_pairs(facts, 2)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "NestedLoop" not in plan                # the facts went into the written cells
    got = {(r["dataset_a"], r["dataset_b"]): (r["overlap_years"], r["shared_regions"]) for r in pairs.collect()}
    own = {}
    for d, y, _, _, r in rows:
        a = own.setdefault(d, (set(), set()))
        a[0].add(y)
        a[1].add(r)
    want = {}
    for a in own:
        for b in own:
            n = min(max(own[a][0]), max(own[b][0])) - max(min(own[a][0]), min(own[b][0])) + 1
            if a < b and n >= 2:
                want[a, b] = (n, len(own[a][1] & own[b][1]))
    assert got == want


def test_lag_over_range_blocks_with_one_key_and_one_day(spark):
    import random
    from statlake.operators import ranking as R
    rng = random.Random(6)
    rows = [("d", 86400 * 10 + i // 3, i, rng.choice(["a", "b", None])) for i in range(4000)] + [("e", 1, 1, "a"), ("f", 1, 1, None), ("f", 2, 2, "b"), (None, 1, 1, "x"), (None, 2, 2, "y")]
    df = spark.createDataFrame(rows, "k string, t int, id int, status string").repartition(5)
    out = R.lag_by_blocks(df, "k", ["t", "id"], "status", "prev", blocks=16)
    want, last = {}, {}
    for k, t, i, s in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        want[k, i] = last.get(k)
        last[k] = s
    assert {(r["k"], r["id"]): r["prev"] for r in out.collect()} == want
    sizes = sorted(r["count"] for r in R.range_blocks(df, ["k", "t", "id"], 16).groupBy("_block").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
