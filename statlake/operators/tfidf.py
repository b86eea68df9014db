"""Character n-gram TF-IDF: cosine search and keyword extraction.

Weights follow the usual smoothed form: idf = ln((1 + N) / (1 + df)) + 1,
vectors scaled to length one. N-grams are counted in the task that reads the
document's text, so what is shuffled is texts and a task's sums, not n-grams of documents.
"""

from __future__ import annotations

import heapq
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from statlake.session import materialise
from statlake.sources.sinks import write_typed

register_pickle_by_value(sys.modules[__name__])         # counting travels with its jobs


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"(?U)\s\s+", " ")


def _by_key(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, texts): the texts of a key in one row, so that its n-grams are counted where they are read and only texts travel."""
    return docs.select(F.col(key), _clean(text).alias("_t")).groupBy(key).agg(F.collect_list("_t").alias("_texts"))


def _counted(sizes, of: Callable[[Iterator[pa.RecordBatch], Callable[[list], Counter]], Iterator[pa.RecordBatch]]):
    """A function over Arrow batches whose last column holds lists of texts; ``of`` gets them with a counter of n-grams."""
    def count(texts: list[str]) -> Counter:
        grams: Counter = Counter()
        for t in texts:
            for n in sizes:
                grams.update(map("".join, zip(*[t[i:] for i in range(n)])))
        return grams
    return lambda batches: of(batches, count)


def _per_key(batches, count):
    for batch in batches:
        for key, texts in zip(batch.column(0), batch.column(1)):                       # a batch of results is a key's
            grams = count(texts.as_py())
            if grams:
                keys = pa.repeat(key, len(grams))
                yield pa.RecordBatch.from_arrays([keys, pa.array(grams.keys(), pa.string()), pa.array(grams.values(), pa.int64())], names=[batch.schema.names[0], "gram", "tf"])


def gram_counts(docs: DataFrame, key: str, text: Column, sizes) -> DataFrame:
    """(key, gram, tf) over whole lower-cased texts; runs of white space count as one blank."""
    texts = _by_key(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    return texts.mapInArrow(_counted(sizes, _per_key), f"`{key}` {kind}, gram string, tf long")


MOST_GRAMS = 200_000                # n-grams a task holds before it hands its sums on


def _totals(batches, count):
    total, df = Counter(), Counter()

    def sums():
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64()), pa.array([df[g] for g in total], pa.int64())], names=["gram", "tf", "df"])
    for batch in batches:
        for texts in batch.column(batch.num_columns - 1):
            grams = count(texts.as_py())
            total.update(grams)
            df.update(grams.keys())
            if len(total) > MOST_GRAMS:
                yield sums()
                total.clear()
                df.clear()
    yield sums()


def gram_totals(docs: DataFrame, key: str, text: Column, sizes) -> DataFrame:
    """(gram, total, df): occurrences of an n-gram and the keys that hold it. Sums of a task's texts travel, not their n-grams."""
    sums = _by_key(docs, key, text).mapInArrow(_counted(sizes, _totals), "gram string, tf long, df long")
    return sums.groupBy("gram").agg(F.sum("tf").alias("total"), F.sum("df").alias("df"))


def inverse_frequencies(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per n-gram. Document frequency is a map-side count, so a common n-gram costs one row per task."""
    total = docs.agg(F.count("*").alias("n")).scalar()
    df = counts.groupBy("gram").agg(F.count("*").alias("df"))
    return df.select("gram", "df", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf_search(docs: DataFrame, key: str, text: Column, query: str, k: int = 10, sizes=(2, 3)) -> DataFrame:
    """Top k documents by cosine similarity with a query."""
    counts = gram_counts(docs, key, text, sizes)
    idf = inverse_frequencies(counts, docs)
    weighted = counts.join(idf, "gram").select(key, "gram", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    q = query.lower()
    q_counts: dict[str, int] = {}
    for n in sizes:
        for i in range(len(q) - n + 1):
            q_counts[q[i:i + n]] = q_counts.get(q[i:i + n], 0) + 1
    q_map = F.create_map(*[F.lit(x) for kv in q_counts.items() for x in kv]) if q_counts else F.lit(None).cast("map<string,int>")
    q_tf = F.try_element_at(q_map, F.col("gram"))
    # Dot product and length of a document come from the same grouping.
    per_doc = weighted.groupBy(key).agg(F.sum(F.col("w") * q_tf * F.col("idf")).alias("dot"), F.sum(F.col("w") * F.col("w")).alias("len2"))
    q_len2 = idf.agg(F.sum(F.pow(F.try_element_at(q_map, F.col("gram")) * F.col("idf"), 2)).alias("l")).scalar()
    score = F.col("dot") / (F.sqrt("len2") * F.sqrt(q_len2))
    hits = per_doc.filter(F.col("dot").isNotNull())
    return hits.select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(k)


def build_index(docs: DataFrame, key: str, text: Column, path: str, sizes=(2, 3), buckets: int = 64) -> None:
    """Write postings (bucket, gram, key, weight, idf) of documents whose vectors have length one.

    Postings are cut into ``buckets`` folders by n-gram, so a query reads the folders of its own n-grams only.
    """
    counts = materialise(gram_counts(docs, key, text, sizes), "grams")
    weighted = counts.join(inverse_frequencies(counts, docs), "gram").select(key, "gram", "idf", (F.col("tf") * F.col("idf")).alias("w"))
    lengths = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    postings = weighted.join(lengths, key).select(_bucket(F.col("gram"), buckets).alias("bucket"), "gram", key, (F.col("w") / F.col("l")).alias("weight"), "idf")
    write_typed(postings, path, ["bucket"])


def search_index(spark: SparkSession, path: str, key: str, query: str, k: int = 10, sizes=(2, 3), buckets: int = 64) -> DataFrame:
    """(rank, key, score) of the top k documents of an index; scores equal in nine places rank by key."""
    q = query.lower()
    tf = Counter(q[i:i + n] for n in sizes for i in range(len(q) - n + 1))
    terms = spark.createDataFrame(sorted(tf.items()), "gram string, tf long").withColumn("bucket", _bucket(F.col("gram"), buckets))
    own = [r["bucket"] for r in terms.select("bucket").distinct().collect()]          # n-grams of one query
    hits = spark.read.parquet(path).filter(F.col("bucket").isin(own) & F.col("gram").isin(list(tf)))
    weight = F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(tf.items()) for x in kv]), F.col("gram")) * F.col("idf") if tf else F.lit(0.0)
    length = hits.groupBy("gram").agg(F.max(weight).alias("w")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l")).scalar()
    score = F.round(F.sum(F.col("weight") * weight) / length, 9)
    best = hits.groupBy(key).agg(score.alias("score")).orderBy(F.desc("score"), key).limit(k)
    return best.select(F.row_number().over(Window.orderBy(F.desc("score"), key)).alias("rank"), key, "score")


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def _best(idf: dict[str, float], k: int):
    def best(batches, count):
        for batch in batches:
            keys, at, rank, gram, weight = batch.column(0), [], [], [], []
            for i, texts in enumerate(batch.column(1)):
                held = ((g, n * idf[g]) for g, n in count(texts.as_py()).items() if g in idf)
                for r, (g, w) in enumerate(heapq.nsmallest(k, held, key=lambda x: (-x[1], x[0])), 1):
                    at.append(i)
                    rank.append(r)
                    gram.append(g)
                    weight.append(w)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(rank, pa.int32()), pa.array(gram, pa.string()), pa.array(weight, pa.float64())], names=[batch.schema.names[0], "rank", "gram", "w"])
    return best


def tfidf_keywords(docs: DataFrame, key: str, text: Column, k: int = 10, sizes=(2, 3, 4), features: int = 1000) -> DataFrame:
    """Best n-grams of every document among the ``features`` most frequent n-grams of the corpus.

    Documents are read twice: for the n-grams' sums, and for the best of each document, chosen where its text lies.
    """
    vocabulary = gram_totals(docs, key, text, sizes).orderBy(F.desc("total"), "gram").limit(features)
    total = docs.agg(F.count("*").alias("n")).scalar()
    idf = {r["gram"]: r["idf"] for r in vocabulary.select("gram", (F.log((total + 1) / (F.col("df") + 1)) + 1).alias("idf")).collect()}       # at most ``features`` rows
    kind = docs.schema[key].dataType.simpleString()
    return _by_key(docs, key, text).mapInArrow(_counted(sizes, _best(idf, k)), f"`{key}` {kind}, rank int, gram string, w double")
