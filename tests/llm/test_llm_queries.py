"""Registered queries of the subpackage against their SQL, and the pipeline end to end."""

import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from statlake.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    df = queries.QUERIES[name](spark, sf)
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(norm(v) for v in r) for r in cur.fetchall()), key=repr)


def test_all_are_registered():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns, now = docs.columns, docs
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
        if name != "sharding":
            assert now.columns == columns
        now = spark.createDataFrame(now.toArrow())
        ids[name] = [r.doc_id for r in now.select("doc_id").collect()]
    clean = {i for i, r in labels.items() if not r.toxic}
    assert len(clean - set(ids["toxicity"])) <= 0.02 * len(clean)
    assert len(set(ids["near_duplicates"])) == len(ids["near_duplicates"]) < len(ids["toxicity"])
    assert set(ids["decontamination"]) < set(ids["near_duplicates"])
    assert max(ids["mixing"].count(i) for i in ids["mixing"]) == 2
    assert sorted(ids["sharding"]) == sorted(ids["mixing"])
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, run.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, now.select("doc_id", "shard", "slot").collect()))


CLASHING = ["bad", "k_id", "k_content", "row", "hit", "root", "fp", "node", "kept", "size", "bucket", "block", "score", "key", "m_id", "shard", "slot"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_clashing_columns(spark, sf, stage):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    more = run(spark, docs.withColumns({c: F.lit("clash") for c in CLASHING}), sf)
    assert stage == "sharding" or more.columns == [*docs.columns, *CLASHING]
    plain = run(spark, docs, sf)
    assert sorted(r.doc_id for r in more.select("doc_id").collect()) == sorted(r.doc_id for r in plain.select("doc_id").collect())


def test_pipeline_of_no_documents(spark, sf):
    now = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
        assert now.count() == 0
