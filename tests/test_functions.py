"""Scalar and text functions on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from statlake.functions import scalars as S, text as X, timecode as TC

TIMES = [
    ("2020", 2020, None, None, "year", "2020-01-01"), ("2020Q3", 2020, None, 3, "quarter", "2020-07-01"),
    ("2020-q3", 2020, None, 3, "quarter", "2020-07-01"), ("2020-12", 2020, 12, 4, "month", "2020-12-01"),
    ("202012", 2020, 12, 4, "month", "2020-12-01"), ("2020-01-15", 2020, 1, 1, "day", "2020-01-15"),
    ("20200115", 2020, 1, 1, "day", "2020-01-15"), ("2020-02-31", 2020, 2, 1, "day", "2020-02-31"),
    ("FY2020", 2020, None, None, "fiscal_year", "2020-04-01"), ("2020FY", 2020, None, None, "fiscal_year", "2020-04-01"),
    ("fy2020fy", 2020, None, None, "fiscal_year", "2020-04-01"), ("CY2020", 2020, None, None, "calendar_year", "2020-01-01"),
    ("2020CY", 2020, None, None, "calendar_year", "2020-01-01"), ("2020H1", 2020, None, 1, "half_year", "2020-01-01"),
    ("2020H2", 2020, None, 3, "half_year", "2020-07-01"), ("令和2年", 2020, None, None, "japanese_year", "2020-01-01"),
    ("平成30", 2018, None, None, "japanese_year", "2018-01-01"), ("令和元年", None, None, None, "unknown", "令和元年"),
    ("202013", 2020, None, None, "unknown", "2020-01-01"), ("2016000000", 2016, None, None, "unknown", "2016-01-01"),
    ("2020Q5", 2020, None, None, "unknown", "2020-01-01"), ("2020H3", 2020, None, None, "unknown", "2020-01-01"),
    ("2020W01", 2020, None, None, "unknown", "2020-01-01"), ("2020年度", 2020, None, None, "unknown", "2020-01-01"),
    ("abc", None, None, None, "unknown", "abc"), ("　2020　", 2020, None, None, "year", "2020-01-01"),
    ("２０２０", 2020, None, None, "year", "2020-01-01"), ("2020-13-01", 2020, None, None, "unknown", "2020-01-01"),
]


def test_time_codes(spark):
    df = spark.createDataFrame([(t[0],) for t in TIMES], "code string")
    got = {r["code"]: tuple(r)[2:] for r in TC.with_time(df, "code").collect()}
    for code, *want in TIMES:
        assert got[code] == tuple(want), code


def test_empty_time_codes(spark):
    rows = TC.with_time(spark.createDataFrame([("",), (None,)], "code string"), "code").collect()
    assert all(tuple(r)[1:] == (None, None, None, None, "unknown", None) for r in rows)


@pytest.mark.parametrize("code,year,quarter,month", [
    ("2020Q1", 2020, 1, 0), ("2020-q4", 2020, 4, 0), ("2020-07", 2020, 0, 7), ("20200715", 2020, 0, 7), ("202007", 2020, 0, 7),
    ("20201345", 2020, 0, 13), ("2016000000", 2016, 0, 0), ("令和2年", 2020, 0, 0), ("", 2020, 0, 0), (None, 2020, 0, 0)])
def test_loose_period(spark, code, year, quarter, month):
    c = F.col("c")
    r = spark.createDataFrame([(code,)], "c string").select(
        TC.loose_year(c), TC.loose_quarter(F.coalesce(c, F.lit(""))), TC.loose_month(c)).first()
    assert tuple(r) == (year, quarter, month)


def test_parse_value(spark):
    texts = ["5250000", "1,234.5", " 12 ", "-", "", None, "1e3", ".5", "5.", "1.0d", "1f", "1_000", "x", "-7", "１２"]
    want = [5250000.0, 1234.5, 12.0, 0.0, 0.0, 0.0, 1000.0, 0.5, 5.0, 0.0, 0.0, 1000.0, 0.0, -7.0, 12.0]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = [r[1] for r in df.select("i", S.parse_value(F.col("v"))).orderBy("i").collect()]
    assert got == want
    special = spark.createDataFrame([("nan",), ("-inf",)], "v string").select(S.parse_value(F.col("v")).alias("x")).collect()
    assert math.isnan(special[0]["x"]) and special[1]["x"] == -math.inf


def test_cast_value(spark):
    df = spark.createDataFrame([("12.7",), ("-12.7",), ("1,234",), ("x",), (None,), ("99999999999",), ("YES",)], "v string")
    v = F.col("v")
    rows = df.select(*[S.cast_value(v, t).alias(t) for t in ("INT", "BIGINT", "DOUBLE", "BOOLEAN", "STRING")]).collect()
    assert [r["INT"] for r in rows] == [12, -12, 1234, None, None, None, None]
    assert [r["BIGINT"] for r in rows] == [12, -12, 1234, None, None, 99999999999, None]
    assert [r["DOUBLE"] for r in rows][:3] == [12.7, -12.7, 1234.0]
    assert [r["BOOLEAN"] for r in rows] == [False, False, False, False, None, False, True]


def test_names(spark):
    df = spark.createDataFrame([("人口 Total (2020)",), ("人口",), ("__A--b__",)], "v string")
    assert [r[0] for r in df.select(S.normalize_name(F.col("v"))).collect()] == ["total_2020", "column", "a_b"]
    df = spark.createDataFrame([("@cat01",), ("@Area",), ("tab",), ("cat10",), ("cat11",)], "v string")
    assert [r[0] for r in df.select(S.normalize_field(F.col("v"))).collect()] == ["category_01", "area", "tab", "category_10", "category_11"]
    assert [r[0] for r in df.select(S.normalize_dimension(F.col("v"))).collect()] == ["@cat01", "@Area", "indicator", "category_10", "cat11"]


@pytest.mark.parametrize("title,domain", [
    ("人口推計（令和2年国勢調査基準）", "population"), ("世帯数の推移", "population"), ("経済センサス-活動調査", "economy"), ("家計調査", "economy"),
    ("労働力調査", "labor"), ("賃金構造基本統計調査", "labor"), ("学校基本調査", "education"), ("患者調査", "health"), ("農林業センサス", "agriculture"),
    ("建築着工統計", "construction"), ("自動車輸送統計", "transport"), ("商業統計", "trade"), ("福祉行政報告例", "social_welfare"),
    ("GDP統計", "economy"), ("その他の統計", "generic"), ("", "generic")])
def test_landing_domain(spark, title, domain):
    assert spark.range(1).select(S.landing_domain(F.lit(title))).first()[0] == domain


def test_priority_and_errors(spark):
    one = spark.range(1)
    assert one.select(S.listing_priority(F.lit("基幹統計 月次"), F.lit("2023-01-01"))).first()[0] == 10
    assert one.select(S.listing_priority(F.lit("その他"), F.lit(""))).first()[0] == 5
    kinds = [("Read timeout on connection", "", "timeout_error"), ("x", "ConnectionError", "network_error"), ("API limit", "", "api_error"),
             ("bad JSON", "", "data_error"), ("Validation", "", "validation_error"), ("bucket gone", "", "storage_error"), ("?", "", "unknown_error")]
    for m, c, want in kinds:
        assert one.select(S.error_type(F.lit(m), F.lit(c))).first()[0] == want
    assert [one.select(S.retry_delay(F.lit(n), 1.0, 10.0)).first()[0] for n in (0, 1, 3, 9)] == [1.0, 2.0, 8.0, 10.0]


def test_keywords(spark):
    df = spark.createDataFrame([("国勢調査", "国勢調査 人口等基本集計", "全国，都道府県，市区町村別の人口，世帯数等", "人口・世帯", "人口", "総務省")],
                               "a string, b string, c string, d string, e string, f string")
    words = df.select(X.extract_keywords(*[F.col(x) for x in "abcdef"])).first()[0]
    assert words[0] in ("国勢調査", "人口") and "population" in words and "総務省" in words and len(words) <= 15
    assert "全国" not in words
    assert df.select(X.expand_query(F.lit("人口 統計"))).first()[0] == ["人口 統計", "人口", "統計", "世帯", "国勢調査", "population"]
    q = df.select(X.keyword_quality(F.lit("人口 統計"), F.array(F.lit("人口"), F.lit("別")))).first()[0]
    assert (q["coverage"], q["relevance"], q["diversity"]) == (0.5, 0.5, 0.06)


def test_char_ngrams(spark):
    df = spark.createDataFrame([("人口x",), ("a",), ("",), ("a😀b\n",)], "t string")
    got = [sorted(r[0]) for r in df.select(X.char_ngrams(F.col("t"), (2, 3))).collect()]
    assert got == [["人口", "人口x", "口x"], [], [], sorted(["a😀", "😀b", "b\n", "a😀b", "😀b\n"])]
