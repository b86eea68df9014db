"""Catalog search: matching, filters, scores, ranked results for a batch of queries.

Queries are literals of the plan: every catalog row meets all of them inside
one projection and only matches leave it. There is no join between queries and
catalog, and the top k is kept per task before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions import text as X
from statlake.functions.timecode import computed_once
from statlake.operators.ranking import top_per_group

QUERY_BATCH = 200      # queries per projection; longer lists are answered batch by batch


def prepare(catalog: DataFrame) -> DataFrame:
    """Add the lower-case search columns once per row, whatever the number of words tried on them."""
    def low(c):
        return F.transform(c, F.lower)
    return computed_once(catalog, [
        F.lower("title").alias("_title"), F.lower("description").alias("_description"), low("keywords").alias("_keywords"),
        low("column_names").alias("_columns"), low("tags").alias("_tags")])


def count_containing(arr: str, word: Column) -> Column:
    return F.size(F.filter(arr, lambda w: w.contains(word)))


def any_containing(arr: str, word: Column) -> Column:
    return F.exists(arr, lambda w: w.contains(word))


def matches(word: Column) -> Column:
    """Lower-case word in title, description, a keyword, a column name or a tag of a prepared entry."""
    return (F.col("_title").contains(word) | F.col("_description").contains(word) | any_containing("_keywords", word)
            | any_containing("_columns", word) | any_containing("_tags", word))


def catalog_filters(*, domain: str | None = None, start: str | None = None, end: str | None = None,
                    tags: list[str] | None = None, min_records: int | None = None, status: str | None = None) -> Column:
    """All given filters together; an entry without a range fails a range filter."""
    conds = [F.lit(True)]
    if domain is not None:
        conds.append(F.col("domain") == domain)
    if start is not None:
        conds.append(F.coalesce((F.col("time_range_start") != "") & (F.col("time_range_start") >= start), F.lit(False)))
    if end is not None:
        conds.append(F.coalesce((F.col("time_range_end") != "") & (F.col("time_range_end") <= end), F.lit(False)))
    if tags:
        conds.append(F.size(F.array_except(X.literal_array(tags), F.col("tags"))) == 0)
    if min_records:
        conds.append(F.col("record_count") >= min_records)
    if status is not None:
        conds.append(F.col("ingestion_status") == status)
    return reduce(lambda a, b: a & b, conds)


def has_time_range() -> Column:
    return F.coalesce((F.col("time_range_start") != "") & (F.col("time_range_end") != ""), F.lit(False))


def points(cond: Column, value: float) -> Column:
    return F.when(cond, value).otherwise(0.0)


def catalog_score(word: Column) -> Column:
    title = F.col("_title")
    return (points(title.contains(word), 10.0) + points(title.startswith(word), 5.0)
            + count_containing("_keywords", word) * 3.0 + points(F.col("_description").contains(word), 2.0)
            + count_containing("_columns", word) * 1.0
            + points(F.col("record_count") > 10000, 1.0) + points(has_time_range(), 0.5))


def final_score(word: Column) -> Column:
    title, n = F.col("_title"), F.col("record_count")
    return (points(title.contains(word), 100.0) + points(title == word, 50.0) + points(title.startswith(word), 25.0)
            + points(F.col("_description").contains(word), 50.0)
            + count_containing("_keywords", word) * 30.0 + count_containing("_columns", word) * 10.0
            + F.when(n > 100000, 20.0).when(n > 10000, 10.0).when(n > 1000, 5.0).otherwise(0.0)
            + points(has_time_range(), 15.0) + points(F.size("partition_fields") > 0, 10.0)
            + points(F.col("ingestion_status") == "success", 5.0))


def search_catalog(catalog: DataFrame, query: str, **filters) -> DataFrame:
    """Matches of one query with their catalog score, best first, registration order on ties."""
    word = F.lower(F.lit(query))
    hits = prepare(catalog.filter(catalog_filters(**filters))).filter(matches(word))
    return hits.select(*catalog.columns, catalog_score(word).alias("score")).orderBy(F.desc("score"), "seq")


def _query_rows(queries: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("query_id"), F.lit(q).alias("query"), X.expand_query(F.lit(q)).alias("words"))
                     for i, q in enumerate(queries)])


def expanded_matches(catalog: DataFrame, queries: list[str], **filters) -> DataFrame:
    """Each (query, entry) once: the first expanded word that finds the entry, and the entry's score for it.

    Expansion is constant-folded, so the plan holds plain word lists.
    """
    filters.setdefault("status", "success")
    rows = prepare(catalog.filter(catalog_filters(**filters)))
    per_query = F.transform(_query_rows(queries), lambda q: F.struct(
        q["query_id"].alias("query_id"), q["query"].alias("query"),
        F.get(F.filter(F.transform(q["words"], lambda w, i: F.struct(i.alias("word_idx"), F.lower(w).alias("word"))),
                       lambda w: matches(w["word"])), F.lit(0)).alias("hit")))
    found = rows.withColumn("q", F.explode(F.filter(per_query, lambda q: q["hit"].isNotNull())))
    return found.select("*", F.col("q.query_id").alias("query_id"), F.col("q.query").alias("query"),
                        F.col("q.hit.word_idx").alias("word_idx"), F.col("q.hit.word").alias("word")).drop("q")


def search(catalog: DataFrame, queries: list[str], max_results: int = 20, **filters) -> DataFrame:
    """Ranked results of every query.

    Order: score for the original query, then the expanded word that found the
    entry, then the entry's score for that word, then registration order.
    """
    parts = []
    for at in range(0, len(queries), QUERY_BATCH):
        hits = expanded_matches(catalog, queries[at:at + QUERY_BATCH], **filters).withColumn("query_id", F.col("query_id") + at)
        scored = hits.select("query_id", "query", "dataset_id", "title", "word_idx", "seq",
                             final_score(F.lower("query")).alias("score"), catalog_score(F.col("word")).alias("word_score"))
        parts.append(scored)
    order = [F.desc("score"), F.asc("word_idx"), F.desc("word_score"), F.asc("seq")]
    best = top_per_group(reduce(DataFrame.unionByName, parts), ["query_id"], order, max_results, "rank")
    return best.select("query_id", "query", "rank", "dataset_id", "title", "score")


def suggestions(catalog: DataFrame, queries: list[str], results: DataFrame | None = None, fewer_than: int = 3) -> DataFrame:
    """Other words for queries with few results (all queries if no results are given)."""
    top = (catalog.groupBy("domain").agg(F.count("*").alias("n"), F.min("seq").alias("s"))
           .orderBy(F.desc("n"), "s").limit(3))
    names = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "s", "domain"))).alias("a"))
    spark = catalog.sparkSession
    rows = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    if results is not None:
        counts = results.groupBy("query_id").agg(F.count("*").alias("hits"))
        rows = rows.join(counts, "query_id", "left").filter(F.coalesce("hits", F.lit(0)) < fewer_than)
    popular = names.select(F.transform("a", lambda d: d["domain"])).scalar()
    return rows.withColumn("_top", popular).select("query_id", "query", X.suggest(F.col("query"), F.col("_top")).alias("suggestions"))


def search_statistics(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count("*").alias("total_datasets"), F.count_if(F.col("ingestion_status") == "success").alias("searchable_datasets"),
                       F.coalesce(F.avg(F.size("keywords")), F.lit(0.0)).alias("avg_keywords_per_dataset"))


# --- detail search over dimension items --------------------------------------------------

def by_place(summary: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Datasets that cover all prefectures, or hold an area item with the name."""
    named = items.filter((F.col("dim_id") == "area") & F.col("name").contains(name)).select("dataset_id")
    full = summary.filter("has_all_prefectures").select("dataset_id")
    return full.unionByName(named).distinct()


def by_year(summary: DataFrame, year: int) -> DataFrame:
    return summary.filter(F.lit(year).between(F.col("start_year"), F.col("end_year"))).select("dataset_id")


def by_year_range(summary: DataFrame, start: int, end: int) -> DataFrame:
    return summary.filter(~((F.col("end_year") < start) | (F.col("start_year") > end))).select("dataset_id")


def by_indicator(summary: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Datasets whose summary indicators, or else any item, hold the name; each once."""
    direct = summary.filter(F.exists("indicators", lambda i: i.contains(name))).select("dataset_id")
    return direct.unionByName(items.filter(F.col("name").contains(name)).select("dataset_id")).distinct()


def by_unit(items: DataFrame, unit: str) -> DataFrame:
    return items.filter(F.col("unit") == unit).select("dataset_id").distinct()


def by_explanation(catalog: DataFrame, word: str) -> DataFrame:
    return catalog.filter(F.col("description").contains(word)).select("dataset_id", "title")


def two_step(light: DataFrame, full: DataFrame, word: str, detail: Column) -> DataFrame:
    """Candidates from the light catalog by keyword, then a check on their full entries."""
    w = F.lower(F.lit(word))
    picked = light.filter(F.lower("title").contains(w) | F.exists("keywords", lambda k: F.lower(k).contains(w))).select("dataset_id")
    return full.join(picked, "dataset_id", "left_semi").filter(detail)


def light_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.select("dataset_id", "title", "domain", "keywords", "record_count", "time_range_start", "time_range_end")


# --- vectors and fusion ----------------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_search(vectors: DataFrame, query: list[float] | Column, k: int, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Top k vectors by dot product with one query vector (a literal or a scalar subquery)."""
    q = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.withColumn("_q", q).select(id_column, dot(F.col(column), F.col("_q")).alias("score"))
    return scored.orderBy(F.desc("score"), id_column).limit(k)


def mean_vector(vectors: DataFrame, column: str = "embedding") -> Column:
    """Component-wise mean of all vectors as a scalar subquery: one partial sum per component and task."""
    parts = vectors.select(F.posexplode(column).alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    whole = parts.agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("a"))
    return whole.select(F.transform("a", lambda s: s["m"])).scalar()


def fuse(keyword: DataFrame, tfidf: DataFrame, key: str, k: int, depth: int = 20) -> DataFrame:
    """Rank fusion: twice the inverted keyword rank plus the inverted text rank (ranks from 1)."""
    a = keyword.filter(F.col("rank") <= depth).select(key, ((depth + 1 - F.col("rank")) * 2).alias("s"))
    b = tfidf.filter(F.col("rank") <= depth).select(key, (depth + 1 - F.col("rank")).alias("s"))
    return a.unionByName(b).groupBy(key).agg(F.sum("s").alias("score")).orderBy(F.desc("score"), key).limit(k)
