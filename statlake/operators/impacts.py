"""Ranked n-gram index: postings in bands of falling impact, loads added as segments, exact cosine top k.

A posting's impact is its count over the length of its document's vector. Bands of impact
are folders, and the largest impact of every (n-gram, band) is kept beside them. A search
reads the strongest bands, takes the k-th best of the scores seen there as a bound, and goes
on only as deep as a document found in no band read could still pass it. What is left is
scored exactly from the stored counts of those documents.

Every load is a segment: its counts, postings and band maxima are written once. Document
frequencies are summed over segments, so the weights of earlier segments move with each load;
the range by which they moved is kept for each segment and widens its bounds. Results are those
of an index over all documents. A load reads its own documents and the vocabularies, no earlier
postings. It counts once its row of the state is written; a load that failed is written over by
the next one.

Defined results: rows without a key take no part; a null or empty text counts as a document
without n-grams; a key loaded twice is two documents; scores equal in nine places rank by key;
documents that share no n-gram with the query are no hits.
"""

from __future__ import annotations

from collections import Counter
from math import sqrt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from statlake.operators.tfidf import gram_counts
from statlake.session import materialise
from statlake.sources.sinks import write_typed

#: Two bands halve the impact; the last one holds all that is weaker.
BANDS = 40
PARTS = 64
STATE = "segment int, documents long, low double, high double, key_type string"
#: Rows of a side that every task gets; a larger one is shuffled. Not the planner's choice: files of repeated values are a
#: hundredth of their rows' memory, so that it sends whole loads through the driver.
MOST_SENT = 1 << 18
#: Room for rounding when a bound is compared with a score of nine places.
SLACK = 1e-8


def state(spark: SparkSession, path: str) -> list[Row]:
    """(segment, documents, low, high, key_type) of every segment as of the last load; its weights moved by a factor in [low, high]."""
    try:
        rows = spark.read.schema(f"{STATE}, version int").parquet(f"{path}/state").collect()      # one row a segment and load
    except AnalysisException:                     # nothing loaded yet
        return []
    last = max(r["version"] for r in rows)
    return sorted((r for r in rows if r["version"] == last), key=lambda r: r["segment"])


def add(docs: DataFrame, key: str, text: Column, path: str, sizes=(2, 3)) -> int:
    """Add a load of documents; returns the number of its segment."""
    spark, past = docs.sparkSession, state(docs.sparkSession, path)
    n = len(past)
    own = docs.select(F.col(key).alias("key"), text.alias("text")).filter("key IS NOT NULL")
    counts = gram_counts(own, "key", F.col("text"), sizes).withColumn("part", _part(F.col("key")))
    write_typed(counts, f"{path}/documents/segment={n}", ["part"], mode="overwrite")
    counts = spark.read.schema(counts.schema).parquet(f"{path}/documents/segment={n}")
    documents = own.count()

    frequencies = counts.groupBy("gram").agg(F.count("*").alias("df"))
    if past:
        before = _totals(spark, path, n - 1).select("gram", "df")
        frequencies = frequencies.unionByName(before).groupBy("gram").agg(F.sum("df").alias("df"))
    total = documents + sum(r["documents"] for r in past)
    idf = F.log(F.lit(total + 1) / (F.col("df") + 1)) + 1
    (frequencies.withColumn("idf", idf).repartitionByRange("gram").sortWithinPartitions("gram")
     .write.mode("overwrite").parquet(f"{path}/totals/version={n}"))
    totals = _sent(_totals(spark, path, n).select("gram", "idf"))

    length = F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).over(Window.partitionBy("key")))       # a document's n-grams
    postings = counts.join(totals, "gram").select("gram", "key", (F.col("tf") / length).alias("impact"))
    band = F.greatest(F.lit(0), F.least(F.lit(BANDS - 1), F.floor(-2 * F.log2("impact")))).cast("int")
    # Ranges of (band, n-gram, key): a frequent n-gram is spread over tasks, a rare one is found by file statistics.
    (postings.withColumn("band", band).repartitionByRange("band", "gram", "key").sortWithinPartitions("band", "gram")
     .write.mode("overwrite").partitionBy("band").parquet(f"{path}/postings/segment={n}"))
    written = spark.read.schema("gram string, impact double, band int").parquet(f"{path}/postings/segment={n}")
    (written.groupBy("gram", "band").agg(F.count("*").alias("rows"), F.max("impact").alias("most"))
     .repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/bands/segment={n}"))

    moved = {r["version"]: (r["low"], r["high"]) for r in _moved(spark, path, n).collect()} if past else {}       # one row a segment
    kind = own.schema["key"].dataType.simpleString()
    rows = [(r["segment"], r["documents"], *moved.get(r["segment"], (1.0, 1.0)), kind) for r in past] + [(n, documents, 1.0, 1.0, kind)]
    (spark.createDataFrame(rows, STATE).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/state/version={n}"))
    return n


def search(spark: SparkSession, path: str, key: str, query: str, k: int = 10, sizes=(2, 3)) -> DataFrame:
    """(rank, key, score) of the k documents of largest cosine with the query."""
    segments = state(spark, path)
    if not segments:
        raise ValueError(f"no index at {path}")
    version, kind = segments[-1]["segment"], segments[-1]["key_type"]
    totals, q = _totals(spark, path, version), query.lower()
    tf = Counter(q[i:i + n] for n in sizes for i in range(len(q) - n + 1))
    idf = {r["gram"]: r["idf"] for r in totals.filter(F.col("gram").isin(list(tf))).collect()}            # n-grams of one query
    length = sqrt(sum((tf[g] * x) ** 2 for g, x in idf.items()))
    weight = {g: tf[g] * x * x / length for g, x in idf.items()}

    own = (F.col("segment") <= version) & F.col("gram").isin(list(weight))
    low, high = (_lookup({r["segment"]: r[c] for r in segments}, "segment") for c in ("low", "high"))
    bands = spark.read.schema("gram string, rows long, most double, segment int, band int").parquet(f"{path}/bands").filter(own).groupBy("gram", "band")
    listed: dict[str, list] = {g: [] for g in weight}
    for r in bands.agg(F.sum("rows").alias("rows"), F.max(F.col("most") / low).alias("most")).orderBy("band").collect():
        listed[r["gram"]].append((r["band"], r["rows"], r["most"] * weight[r["gram"]]))         # n-grams of a query times BANDS

    postings = spark.read.schema(f"gram string, key {kind}, impact double, segment int, band int").parquet(f"{path}/postings").filter(own)
    depth = first_depths(listed, 4 * k)
    bound = _kth(_partial(postings, weight, depth, listed, low, high), k)
    deeper = depths_for(listed, depth, bound)
    if deeper != depth:
        depth, bound = deeper, _kth(_partial(postings, weight, deeper, listed, low, high), k)
    left = _partial(postings, weight, depth, listed, low, high).filter(F.col("most") >= bound - SLACK)
    left = materialise(left.select("segment", "key", _part(F.col("key")).alias("part")), "candidates")

    parts = [r[0] for r in left.select("part").distinct().collect()]                             # at most PARTS
    counts = spark.read.schema(f"key {kind}, gram string, tf long, segment int, part int").parquet(f"{path}/documents")
    counts = counts.filter((F.col("segment") <= version) & F.col("part").isin(parts))
    counts = counts.join(_sent(left), ["segment", "part", "key"]).join(_sent(totals.select("gram", "idf")), "gram")
    dot = F.sum(F.coalesce(_lookup(weight, "gram"), F.lit(0.0)) * F.col("tf"))
    score = F.round(dot / F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))), 9)
    best = counts.groupBy("segment", "key").agg(score.alias("score")).orderBy(F.desc("score"), "key", "segment").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "key", "segment"))                # over k rows
    return best.select(rank.alias("rank"), F.col("key").alias(key), "score")


def first_depths(listed: dict[str, list], rows: int) -> dict[str, int]:
    """The bands of each n-gram, from the strongest, that hold ``rows`` postings: how many of its bands to read."""
    depth = {}
    for g, bands in listed.items():
        seen = depth[g] = 0
        while depth[g] < len(bands) and seen < rows:
            seen += bands[depth[g]][1]
            depth[g] += 1
    return depth


def rest_of(listed: dict[str, list], depth: dict[str, int]) -> dict[str, float]:
    """What an unread posting of each n-gram can add to a score at most."""
    return {g: max((b[2] for b in bands[depth[g]:]), default=0.0) for g, bands in listed.items()}


def depths_for(listed: dict[str, list], depth: dict[str, int], bound: float) -> dict[str, int]:
    """Read on, where it lowers the rest most for the postings read, until no unread document can reach ``bound``."""
    depth = dict(depth)
    while sum(rest_of(listed, depth).values()) >= bound - SLACK:
        rest, steps = rest_of(listed, depth), []
        for g, bands in listed.items():
            if depth[g] < len(bands):
                after = max((b[2] for b in bands[depth[g] + 1:]), default=0.0)
                steps.append(((rest[g] - after) / bands[depth[g]][1], g))
        if not steps:
            break
        depth[max(steps)[1]] += 1
    return depth


def _partial(postings: DataFrame, weight: dict, depth: dict, listed: dict, low: Column, high: Column) -> DataFrame:
    """(segment, key, least, most): bounds of the score of every document in the bands read."""
    last = {g: bands[depth[g] - 1][0] for g, bands in listed.items() if depth[g]}
    rest = rest_of(listed, depth)
    read = postings.filter(F.col("band") <= F.lit(max(last.values(), default=-1))).filter(F.col("band") <= _lookup(last, "gram"))
    share = _lookup(weight, "gram") * F.col("impact")
    return read.groupBy("segment", "key").agg(
        F.sum(share / high).alias("least"), (F.sum(share / low - _lookup(rest, "gram")) + F.lit(sum(rest.values()))).alias("most"))


def _kth(partial: DataFrame, k: int) -> float:
    """The k-th largest certain score; zero if fewer documents were seen."""
    best = partial.select("least").orderBy(F.desc("least")).limit(k)
    seen, least = best.agg(F.count("*"), F.min("least")).first()
    return least if seen == k else 0.0


def _moved(spark: SparkSession, path: str, version: int) -> DataFrame:
    """By which factors the weights of earlier versions have changed: (version, low, high)."""
    earlier = spark.read.schema("gram string, df long, idf double, version int").parquet(f"{path}/totals").filter(F.col("version") < version).select("version", "gram", F.col("idf").alias("was"))
    factor = F.col("idf") / F.col("was")
    return earlier.join(_sent(_totals(spark, path, version).select("gram", "idf")), "gram").groupBy("version").agg(F.min(factor).alias("low"), F.max(factor).alias("high"))


def _totals(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("gram string, df long, idf double").parquet(f"{path}/totals/version={version}")


def _sent(side: DataFrame) -> DataFrame:
    """A side to join with, sent or shuffled by its rows."""
    return side.hint("broadcast" if side.count() <= MOST_SENT else "merge")


def _lookup(values: dict, column: str) -> Column:
    pairs = [F.lit(x) for kv in sorted(values.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(column)) if pairs else F.lit(None).cast("double")


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")
