"""Ranked n-gram index against the scores of all documents."""

import random
import re

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from statlake.operators import impacts as I, tfidf as TF


@pytest.fixture(scope="module")
def loads(spark):
    rng = random.Random(8)
    words = ["人口", "労働力", "調査", "abc", "Economy", "𠮷野", "zz", "price index"]
    texts = [" ".join(rng.choices(words, [9, 1, 9, 5, 5, 1, 3, 2], k=rng.randint(1, 12))) for _ in range(240)]
    texts[:40] = ["労働力調査"] * 6 + ["労働力 調査"] * 4 + ["", None, "x", "人口 " * 9_000] + texts[14:40]
    rows = [(f"d{i:03d}", t) for i, t in enumerate(texts)] + [(None, "労働力調査")]
    rng.shuffle(rows)
    return [spark.createDataFrame(part, "k string, t string") for part in (rows[:150], rows[150:230], rows[230:])]


@pytest.fixture(scope="module")
def index(loads, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("impacts"))
    assert [I.add(df, "k", F.col("t"), path) for df in loads] == [0, 1, 2]
    return path


def brute(df, query, k):
    hits = TF.tfidf_search(df.filter("k IS NOT NULL"), "k", F.col("t"), query, 10_000)
    return hits.select("k", F.round("score", 9).alias("score")).orderBy(F.desc("score"), "k").limit(k)


def same(got, want):
    assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert [r["k"] for r in got] == [r["k"] for r in want]
    assert [r["score"] for r in got] == pytest.approx([r["score"] for r in want], abs=2e-9)


@pytest.mark.parametrize("query, k", [("労働力調査", 5), ("労働力調査", 300), ("Price Index", 3), ("人口", 1), ("𠮷野 economy", 20)])
def test_loads_rank_as_one_index(spark, loads, index, query, k):
    all_docs = loads[0].unionByName(loads[1]).unionByName(loads[2])
    same(I.search(spark, index, "k", query, k).collect(), brute(all_docs, query, k).collect())


def test_document_added_later_is_found(spark, tmp_path):
    path, df = str(tmp_path / "i"), lambda *rows: spark.createDataFrame(rows, "k string, t string")
    with pytest.raises(ValueError):
        I.search(spark, path, "k", "労働")
    first = df(*[(f"a{i}", "人口 " * (i % 7 + 1)) for i in range(30)])
    I.add(first, "k", F.col("t"), path)
    assert I.search(spark, path, "k", "労働力").collect() == []
    assert I.search(spark, path, "k", "").collect() == []
    I.add(df(("late", "労働力")), "k", F.col("t"), path)
    assert [tuple(r) for r in I.search(spark, path, "k", "労働力").collect()] == [(1, "late", 1.0)]
    I.add(df(("late", None)).limit(0), "k", F.col("t"), path)                    # an empty load changes nothing
    assert [tuple(r) for r in I.search(spark, path, "k", "労働力").collect()] == [(1, "late", 1.0)]


def test_failed_load_does_not_count(spark, tmp_path):
    path, df = str(tmp_path / "i"), spark.createDataFrame([("a", "労働力"), ("b", "人口")], "k string, t string")
    I.add(df, "k", F.col("t"), path)
    df.write.parquet(f"{path}/totals/version=1")                                 # left by a load that ended early
    assert len(I.state(spark, path)) == 1
    assert I.search(spark, path, "k", "労働力").first()["k"] == "a"
    assert I.add(df.withColumn("k", F.concat("k", F.lit("2"))), "k", F.col("t"), path) == 1
    assert [r["k"] for r in I.search(spark, path, "k", "労働力").collect()] == ["a", "a2"]


def test_weak_bands_are_not_read():
    listed = {"ab": [(0, 10, 0.5), (3, 100, 0.2), (9, 10_000, 0.05)], "bc": [(1, 20, 0.4), (8, 5_000, 0.1)]}
    first = I.first_depths(listed, 12)
    assert first == {"ab": 2, "bc": 1}
    assert I.rest_of(listed, first) == {"ab": 0.05, "bc": 0.1}
    assert I.depths_for(listed, first, 0.3) == first                             # nothing unread reaches the bound
    assert I.depths_for(listed, first, 0.12) == {"ab": 2, "bc": 2}               # the cheaper of two ways
    assert I.depths_for(listed, first, 0.0) == {"ab": 3, "bc": 2}                # too few seen: all bands


def test_search_reads_strong_bands_only(spark, tmp_path, monkeypatch):
    path, long = str(tmp_path / "i"), "".join(chr(0x4E00 + i) for i in range(400))
    rows = [(f"s{i:02d}", "労働力調査") for i in range(20)] + [(f"w{i:03d}", f"{long[i:]} 労働 {i}") for i in range(300)]
    I.add(spark.createDataFrame(rows, "k string, t string"), "k", F.col("t"), path)
    depths, plain = [], I.depths_for
    monkeypatch.setattr(I, "depths_for", lambda listed, *rest: depths.append((listed, plain(listed, *rest))) or depths[-1][1])
    assert [r["k"] for r in I.search(spark, path, "k", "労働力調査", 5).collect()] == ["s00", "s01", "s02", "s03", "s04"]
    listed, depth = depths[0]
    assert depth["労働"] < len(listed["労働"]) and sum(r for _, r, _ in listed["労働"][:depth["労働"]]) == 20


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_loads_are_not_sent_through_the_driver(spark, tmp_path, monkeypatch, most):
    """Files of repeated n-grams are small, their rows are not: only the vocabulary and candidates are sent, and those by their rows."""
    plans, real, path = [], DataFrameWriter.parquet, str(tmp_path / "i")
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen(self._df), real(self, *a, **k))[1])
    monkeypatch.setattr(I, "MOST_SENT", most, raising=False)
    docs = spark.range(400).select(F.format_string("d%04d", "id").alias("k"), F.concat(F.lit("労働力調査 "), F.repeat(F.lit("人口 "), (F.col("id") % 3).cast("int"))).alias("t"))
    for part in (docs.filter("id < 300"), docs.filter("id >= 300")):
        I.add(part, "k", F.col("t"), path)
    hits = I.search(spark, path, "k", "労働力調査", 150)
    seen(hits)
    joins = [j for p in plans for j in re.findall(r"(?:Broadcast|Shuffled|SortMerge)\w*Join[^,]*", p)]
    assert {re.sub(r"#\d+L?", "", j) for j in joins} == ({"BroadcastHashJoin [gram]", "BroadcastHashJoin [segment"} if most else {"SortMergeJoin [gram]", "SortMergeJoin [segment"})
    same(hits.collect(), brute(docs, "労働力調査", 150).collect())
