"""Landed files, sinks, tables, streaming and jobs on local folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from statlake.operators import infer as I
from statlake.sources import landing as L, sinks as W
from statlake.streaming import incremental as U


def test_raw_json_array_and_object(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"@id": "1", "$": "5", "@time": "2020"}, {"@id": "2", "$": "6"}], indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"@id": "3", "$": "7"}, indent=1))
    rows = L.read_raw(spark, str(tmp_path)).orderBy("attr_id").collect()
    assert [(r["attr_id"], r["value"], r["attr_time"]) for r in rows] == [("1", "5", "2020"), ("2", "6", None), ("3", "7", None)]


def envelope(value):
    return json.dumps({"GET_STATS_DATA": {"STATISTICAL_DATA": {"DATA_INF": value}}})


def test_data_envelopes(spark, tmp_path):
    docs = {"list": envelope({"VALUE": [{"@id": "1", "$": "1"}, {"@id": "2", "$": 2}]}), "one": envelope({"VALUE": {"@id": "3", "$": "3"}}),
            "none": envelope({}), "broken": "{"}
    for k, v in docs.items():
        (tmp_path / f"{k}.json").write_text(v)
    df = L.read_documents(spark, str(tmp_path))
    assert sorted((r["attr_id"], r["value"]) for r in L.unwrap_data(df).collect()) == [("1", "1"), ("2", "2"), ("3", "3")]
    assert sorted(r["error"] for r in L.unwrap_failures(df).collect()) == ["no VALUE", "not JSON"]


def test_listing_envelope_and_metadata(spark):
    doc = json.dumps({"GET_STATS_LIST": {"DATALIST_INF": {"TABLE_INF": [
        {"@id": "1", "TITLE": {"$": "人口", "@no": "1"}, "GOV_ORG": "総務省", "UPDATED_DATE": "2023-01-01"}, {"@id": "2", "TITLE": "労働", "GOV_ORG": {"$": "厚労省"}}]}}})
    rows = L.unwrap_listing(spark.createDataFrame([(doc,)], "doc string")).orderBy("id").collect()
    assert [(r["title"], r["organization"], r["updated_date"]) for r in rows] == [("人口", "総務省", "2023-01-01"), ("労働", "厚労省", "")]
    meta = json.dumps({"GET_META_INFO": {"METADATA_INF": {"TABLE_INF": {"@id": "9", "TITLE": {"$": "t"}, "SURVEY_DATE": 202001, "TITLE_SPEC": {"TABLE_NAME": "n"}},
                                                          "CLASS_INF": {"CLASS_OBJ": [{"@id": "tab", "@name": "表", "CLASS": {"@code": "A", "@name": "人口", "@unit": "人"}},
                                                                                      {"@id": "time", "@name": "時間", "CLASS": [{"@code": "2020"}, {"@code": "2021"}]}]}}}})
    df = spark.createDataFrame([("9", meta)], "dataset_id string, doc string")
    got = [(r["dim_id"], r["item_pos"], r["code"], r["unit"]) for r in I.dimension_items(df).orderBy("dim_pos", "item_pos").collect()]
    assert got == [("tab", 0, "A", "人"), ("time", 0, "2020", ""), ("time", 1, "2021", "")]
    info = I.table_info(df).first()
    assert (info["title"], info["survey_date"], info["stat_name"], info["title_spec"]["table_name"]) == ("t", "202001", "", "n")
    single = json.dumps({"GET_META_INFO": {"METADATA_INF": {"CLASS_INF": {"CLASS_OBJ": {"@id": "area", "CLASS": [{"@code": "1"}]}}}}})
    assert I.dimension_items(spark.createDataFrame([("8", single)], "dataset_id string, doc string")).count() == 1


def test_search_summary(spark):
    rows = [("d", 0, "area", "地域", i, f"{i:05d}", f"県{i}", "1") for i in range(47)]
    rows += [("d", 1, "time", "時間軸", 0, "2018000000", "2018年", ""), ("d", 1, "time", "時間軸", 1, "2020000000", "2020年", "")]
    rows += [("d", 2, "tab", "表章", 0, "1", "総数", "1"), ("d", 2, "tab", "表章", 1, "2", "人口", "1"), ("d", 2, "tab", "表章", 2, "3", "F1101 x", "1"), ("d", 2, "tab", "表章", 3, "4", "内訳", "3")]
    items = spark.createDataFrame(rows, "dataset_id string, dim_pos int, dim_id string, dim_name string, item_pos int, code string, name string, level string")
    r = I.search_summary(items).first()
    assert r["has_all_prefectures"] and r["prefectures"] == [] and (r["start_year"], r["end_year"], r["year_count"]) == (2018, 2020, 2)
    assert r["indicators"] == ["人口"] and r["indicator_count"] == 4


def test_partition_pruning_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") % 5 + 2018).cast("int").alias("year"), F.col("id").cast("string").alias("region_code"), F.col("id").cast("double").alias("value"))
    W.write_typed(df, path, ["year"])
    q = spark.read.parquet(path).filter((F.col("year") == 2020) & (F.col("value") > 10)).select("region_code")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(value), GreaterThan(value" in plan
    assert "ReadSchema: struct<region_code:string,value:double>" in plan
    with pytest.raises(ValueError):
        W.write_typed(df, path, codec="lzo")


def test_tables(spark, tmp_path):
    table = W.create_domain_table(spark, "population", str(tmp_path / "pop"), "pop_table")
    row = spark.createDataFrame([("d", "s", 2020, "01", "北海道", "c", 1.0, "人"), ("d", "s", 2021, "01", "北海道", "c", 2.0, "人")],
                                "dataset_id string, stats_data_id string, year int, region_code string, region_name string, category string, value double, unit string")
    W.insert_rows(row, table)
    W.insert_rows(row.filter("year = 2021"), table)
    assert spark.table(table).count() == 3
    assert sorted(r[0] for r in W.show_partitions(spark, table).collect()) == ["year=2020", "year=2021"]
    assert "pop_table" in {r["tableName"] for r in W.show_tables(spark).collect()}
    assert "region_name" in {r["col_name"] for r in W.describe(spark, table).collect()}
    assert "COMMENT '地域''" not in W.ddl("x", row.schema, "/p", ["year"], {"region_code": "it's"}) and "it\\'s" in W.ddl("x", row.schema, "/p", ["year"], {"region_code": "it's"})
    spark.sql(f"DROP TABLE {table}")


def test_chunk_plan(spark):
    df = spark.createDataFrame([("a", 100000), ("b", 250001), ("c", 5000000), ("z", 0)], "dataset_id string, total bigint")
    plan = {}
    for r in L.chunk_plan(df).collect():
        plan.setdefault(r["dataset_id"], []).append(r["start_position"])
    assert sorted(plan["a"]) == [1] and sorted(plan["b"]) == [1, 100001, 200001] and len(plan["c"]) == 50 and "z" not in plan
    modes = {r["dataset_id"]: (r["retrieval_mode"], r["num_chunks"], r["truncated"]) for r in L.retrieval_plan(df).collect()}
    assert modes["a"] == ("single", 1, False) and modes["b"] == ("chunked", 3, False) and modes["c"] == ("chunked", 50, False)


def test_new_or_changed(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("n", None)], "k string, v string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("n", None)], "k string, v string")
    assert {tuple(r) for r in U.new_or_changed(new, old, ["k"]).collect()} == {("b", "3"), ("c", "4")}


def land(folder, name, records, at, **dump):
    path = folder / name
    path.write_text(json.dumps(records, **dump))
    os.utime(path, (at, at))


def streamed(spark, out):
    return sorted(((r["attr_id"], r["value"]) for r in U.stored_records(spark, out).collect()), key=str)


def test_stream_keeps_the_newest_version_of_each_key(spark, tmp_path):
    landing, out, state = (tmp_path / n for n in ("landing", "out", "state"))
    landing.mkdir()

    def run():
        U.stream_landing(spark, str(landing), str(out), str(state), ["@id"])
    land(landing, "a.json", [{"@id": "1", "$": "5"}, {"@id": "2", "$": "5"}], 1000)
    run()
    land(landing, "c.json", [{"@id": "2", "$": "6"}, {"@id": "1", "$": "5"}], 3000, indent=2)
    land(landing, "b.json", {"@id": "2", "$": "0", "@new": "x"}, 2000)
    run()
    assert streamed(spark, str(out)) == [("1", "5"), ("2", "6")]
    run()
    land(landing, "d.json", [{"$": "5", "@id": "2"}, {"@id": "3", "$": "7"}, {"@id": None, "$": "8"}], 4000)       # back to an earlier content
    (landing / "e.json").write_text('{"@id":"9 } {"')
    run()
    assert streamed(spark, str(out)) == [("1", "5"), ("2", "5"), ("3", "7"), (None, "8")]
    versions = {(r["key"], r["version"]) for r in U.stored_versions(spark, str(out)).filter("key NOT LIKE '!%'").collect()}
    assert versions == {('["1"]', 1), ('["2"]', 1), ('["2"]', 2), ('["2"]', 3), ('["3"]', 1), ("[null]", 1)}
    assert U.stored_failures(spark, str(out)).count() == 2


def test_stream_reads_nothing_of_what_is_stored(spark, tmp_path):
    """Ten batches over the same keys; before the last, all stored files are made unreadable, and it still tells changed keys from others."""
    landing, out, state = (tmp_path / n for n in ("landing", "out", "state"))
    landing.mkdir()
    for batch in range(10):
        land(landing, f"{batch}.json", [{"@id": str(i), "$": str(batch if i < 5 else 0)} for i in range(50)], 1000 + batch)
        if batch == 9:
            before = {f: f.read_bytes() for f in out.glob("*.parquet")}
            for f in before:
                f.write_bytes(b"")
        U.stream_landing(spark, str(landing), str(out), str(state), ["@id"])
    for f, content in before.items():
        f.write_bytes(content)
    new = [f for f in out.glob("*.parquet") if f not in before]
    assert spark.read.parquet(*map(str, new)).count() == 5
    assert streamed(spark, str(out)) == sorted(((str(i), "9" if i < 5 else "0") for i in range(50)), key=str)


def test_stream_handles_many_keys_in_a_call(spark, tmp_path, monkeypatch):
    """Keys of a group share a call and a row of state; each has its own version."""
    landing, out, state = (tmp_path / n for n in ("landing", "out", "state"))
    landing.mkdir()
    monkeypatch.setattr(U, "KEY_GROUPS", 3)
    monkeypatch.setattr(U, "_changed", counted := _counting(str(tmp_path / "calls"), U._changed))
    for batch in range(3):
        land(landing, f"{batch}.json", [{"@id": str(i), "$": str(batch if i % 4 == 0 else 0)} for i in range(200)], 1000 + batch)
        U.stream_landing(spark, str(landing), str(out), str(state), ["@id"])
    assert len((tmp_path / "calls").read_text()) <= 9 and counted
    got = {r["key"]: r["n"] for r in U.stored_versions(spark, str(out)).groupBy("key").agg(F.max("version").alias("n")).collect()}
    assert got == {f'["{i}"]': 3 if i % 4 == 0 else 1 for i in range(200)}
    assert U.stored_versions(spark, str(out)).count() == 150 + 50 * 3


def _counting(path, call):
    def counted(group, pieces, state):
        with open(path, "a") as f:
            f.write("x")
        yield from call(group, pieces, state)
    return counted


def test_partition_decision(spark, tmp_path):
    ok = spark.createDataFrame([("1", "2020", "5"), ("2", "2021Q1", "6")], "attr_id string, attr_time string, value string")
    assert W.create_from_raw(ok.unionAll(spark.createDataFrame([("3", "99", "1"), ("4", None, "2")], ok.schema)), str(tmp_path / "y")) is True
    assert W.create_from_raw(ok.drop("attr_time"), str(tmp_path / "n")) is False
    assert {r["year"]: r["n"] for r in spark.read.parquet(str(tmp_path / "y")).groupBy("year").agg(F.count("*").alias("n")).collect()} == {2020: 1, 2021: 1, None: 2}
    assert "year" not in spark.read.parquet(str(tmp_path / "n")).columns


def test_reload_replaces_the_folder_and_partitions_can_be_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("a", 2020, 1.0), ("b", 2021, 2.0)], "k string, year int, value double")
    W.replace_dataset(df, path, ["year"])
    W.replace_partitions(df.filter("year = 2021").withColumn("value", F.lit(9.0)), path, ["year"])
    assert {(r["k"], r["value"]) for r in spark.read.parquet(path).collect()} == {("a", 1.0), ("b", 9.0)}
    W.replace_dataset(df.filter("year = 2020"), path, ["year"])
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["a"]


def test_ingest_twice_appends_open_work_only(spark, tmp_path):
    from statlake.plans import jobs as J
    raw = spark.createDataFrame([("d1", "1", "2020", "01", "5"), ("d2", "2", "2021", "", "6"), ("d3", "3", "2021", "02", "7")],
                                "dataset_id string, attr_id string, attr_time string, attr_area string, value string")
    reg = spark.createDataFrame([("d1", "labor", None), ("d2", "trade", None), ("d3", "generic", "2020-01-01"), ("d4", "labor", None)],
                                "dataset_id string, domain string, load_date string")
    for c in ("fetch_date", "transformation_date", "validation_date"):
        reg = reg.withColumn(c, F.lit(None).cast("string"))
    path = str(tmp_path / "lake")
    out = {r["dataset_id"]: r["status"] for r in J.ingest(raw, reg, path, 0.1).collect()}
    assert out == {"d1": "success", "d2": "failed", "d4": "skipped"}
    J.ingest(raw, reg.filter("dataset_id = 'd2'"), path, 1.0)
    rows = {(r["dataset_id"], r["domain"], r["year"]) for r in spark.read.parquet(path).collect()}
    assert rows == {("d1", "labor", 2020), ("d2", "trade", 2021)}


def landed_file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


RECORDS = [{"@id": str(i), "@cat11": f"{i:03d}", "$": f"{i}.5", **({"備考": "x"} if i % 7 == 0 else {})} for i in range(3000)]
FORMS = {
    "lines": "\n".join(json.dumps(r) for r in RECORDS), "array": json.dumps(RECORDS), "pretty": json.dumps(RECORDS, indent=2, ensure_ascii=False),
    "objects": "\n".join(json.dumps(r, indent=1) for r in RECORDS), "marked": "﻿" + json.dumps(RECORDS),
    "line_arrays": "\n".join(json.dumps(RECORDS[i:i + 100]) for i in range(0, 3000, 100)),
}


@pytest.mark.parametrize("form", FORMS)
def test_all_fields_of_all_forms_arrive_and_files_split(spark, tmp_path, form):
    path = landed_file(tmp_path, "a.json", FORMS[form])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = L.read_raw(spark, path)
        assert rows.rdd.getNumPartitions() > 3
        assert rows.columns[-2:] == ["attr_cat11", "備考"]
        got = sorted((r["attr_id"], r["attr_cat11"], r["value"], r["備考"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted((r["@id"], r["@cat11"], r["$"], r.get("備考")) for r in RECORDS)
    assert L.read_failures(spark, path).count() == 0


ODD = [{"@id": "1", "@name": "a } in { text"}, {"@id": "2", "$": {"nested": "}"}}, {"@id": "3"}, {"@id": "4", "$": None, "n": 1.5, "t": True}]


@pytest.mark.parametrize("text", [json.dumps(ODD), json.dumps(ODD, indent=1), "\n".join(map(json.dumps, ODD)), "\n".join(json.dumps(x, indent=2) for x in ODD)])
def test_braces_in_texts_and_nested_values(spark, tmp_path, text):
    path = landed_file(tmp_path, "a.json", text)
    landed_file(tmp_path, "b.json", json.dumps([{"@id": "5", "@cat15": "007"}]))
    rows = {r["attr_id"]: r for r in L.read_raw(spark, str(tmp_path)).collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5"] and rows["5"]["attr_cat15"] == "007"
    assert rows["1"]["attr_name"] == "a } in { text" and json.loads(rows["2"]["value"]) == {"nested": "}"}
    assert rows["4"]["value"] is None and rows["4"]["n"] == "1.5" and rows["4"]["t"] == "true"
    assert L.read_failures(spark, path).count() == 0


def test_broken_lines_are_reported_and_others_kept(spark, tmp_path):
    path = landed_file(tmp_path, "a.json", '{"@id":"1"}\n{"@id":"2\n{"@id":"3"}\n')
    assert sorted(r["attr_id"] for r in L.read_raw(spark, path).collect()) == ["1", "3"]
    assert [r["piece"] for r in L.read_failures(spark, path).collect()] == ['{"@id":"2']
    empty = landed_file(tmp_path, "empty.json", "[]")
    assert L.read_raw(spark, empty).count() == 0


def test_known_fields_spare_the_survey(spark, tmp_path):
    path = landed_file(tmp_path, "a.json", FORMS["array"])
    assert L.read_raw(spark, path, fields=["@cat11"]).agg(F.max("attr_cat11")).first()[0] == "999"


def test_codes_with_leading_zeros_stay_text_and_names_do_not_meet(spark):
    rows = [("d", {"@cat11": "007", "@CAT11": "1", "@record_id": "9", "value": "2", "$": "1", "備考": "true"}), ("d", {"@cat11": "12", "@area": "01000"})]
    schema = {r["source_field"]: (r["name"], r["type"]) for r in I.schema_from_data(spark.createDataFrame(rows, "dataset_id string, record map<string,string>")).collect()}
    assert schema["@cat11"] == ("category_11", "STRING") and schema["@CAT11"] == ("cat11", "INT") and schema["@record_id"] == ("record_id_2", "INT")
    assert schema["$"] == ("value", "DOUBLE") and schema["value"] == ("value_2", "INT") and schema["備考"] == ("備考", "BOOLEAN")
    values = spark.createDataFrame([(v,) for v in ("0", "-0", "00", "007", "-07", "10", "0.5")], "v string")
    assert [r[0] for r in values.select(I.value_class(F.col("v"))).collect()] == ["INT", "INT", "STRING", "STRING", "STRING", "INT", "DOUBLE"]


def test_records_with_braces_read_by_lines(spark, tmp_path):
    """Braces in texts and nested values, one record or more a line: nothing is read whole. Files with line breaks in such records still are."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[\n {"@id": "1", "n": "a { brace } {}"},\n {"@id": "2"}, {"@id": "3", "n": {"b": "}"}}\n]\n', encoding="utf-8")
    (tmp_path / "in" / "b.json").write_text('{"@id": "4",\n "n": "}{"}\n{"@id": "5"}\n', encoding="utf-8")
    (tmp_path / "in" / "c.json").write_text('{\n  "@id" : "6",\n  "$" : "x"\n}', encoding="utf-8")
    _, odd = L._survey(L._pieces(spark, f"{tmp_path}/in"))
    _, hard = L._survey(L._lines(spark, odd))
    assert [p[-6:] for p in odd] == ["a.json", "b.json"] and [p[-6:] for p in hard] == ["b.json"]
    got = sorted((r["attr_id"], r["n"], r["value"]) for r in L.read_raw(spark, f"{tmp_path}/in").select("attr_id", "n", "value").collect())
    assert got == [("1", "a { brace } {}", None), ("2", None, None), ("3", '{"b":"}"}', None), ("4", "}{", None), ("5", None, None), ("6", None, "x")]
    assert L.read_failures(spark, f"{tmp_path}/in").count() == 0
