"""Substring index: n-gram postings name the rows that may hold a word, their texts decide.

A stored index has three tables: ``entries`` (the rows, by a hash of their number),
``postings`` (n-gram, block of rows, row numbers) and ``grams`` (n-gram, number of rows),
the latter two in folders by a hash of the n-gram. Words are rows of a table: a thousand of
them make the same plan as one. Of each word the rarest n-grams are read and intersected,
and only folders that hold such n-grams or the rows left are opened; a word with an n-gram
that does not occur ends there. Words too short for an n-gram are tried on every row.

Three characters of a long phrase stand in most texts. Words of ``LONG`` characters or more are found
by a fourth table, ``prints`` (rows, how many fingerprints each has, and these, in lists by a hash of the fingerprint): of every ``LONG`` characters of a text the least hash of the
``PRINT`` characters within. A text that holds a word holds the fingerprints of all its stretches of that length.
A bitmap of fixed size (``BITMAP_BITS``, of the words' fingerprints) drops most stored ones where they are read; the join decides.

Texts are tried where they lie, in one call with all their words, lower-cased once. A text with few words is searched for
each of them; with ``MANY`` of a length it is walked once, and its stretches of that length are looked up among the words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from statlake.functions.text import char_ngrams, expand_query
from statlake.operators import search as S
from statlake.operators.ranking import top_per_group
from statlake.session import materialise
from statlake.sources.sinks import write_typed

register_pickle_by_value(sys.modules[__name__])         # fingerprints travel with their jobs

BUCKETS, PARTS = 64, 64
LONG, PRINT = 24, 16                # characters of a long word, and of what is hashed in it
MANY = 128                          # words of one length tried on a text: from here on a walk costs less
BITMAP_BITS = 1 << 25               # 4 MB, whatever the number of words
BLOCK_BITS = 12                     # rows of a posting: at most 2^12
PIECE = 1 << 20                     # n-grams or fingerprints folded and handed on at once
RAREST = 3                          # n-grams of a word that are intersected
CATALOG_FIELDS = ["title", "description", "keywords", "column_names", "tags"]
_CUT = "\0"                         # between texts; no n-gram spans two of them


def grams(text: Column) -> Column:
    """Distinct n-grams of a lower-case text: three characters, or two if one is beyond ASCII. ``_postings`` makes the same."""
    three = F.filter(char_ngrams(text, (3,)), lambda g: ~g.contains(_CUT))
    two = F.filter(char_ngrams(text, (2,)), lambda g: g.rlike(r"[^\x00-\x7F]") & ~g.contains(_CUT))
    return F.array_distinct(F.concat(three, two))


def _word_grams(word: Column) -> Column:
    """N-grams a row must hold to hold the word: of three characters, for a word of two that one."""
    three = F.array_distinct(F.filter(char_ngrams(word, (3,)), lambda g: ~g.contains(_CUT)))
    return F.when(F.length(word) == 2, F.filter(F.array(word), lambda g: g.rlike(r"[^\x00-\x7F]") & ~g.contains(_CUT))).otherwise(three)


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _part(row: Column) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(PARTS)).cast("int")


def _texts(df: DataFrame, fields: list[str]) -> list[Column]:
    """Lower-case texts of a row as arrays."""
    kinds = dict((f.name, f.dataType) for f in df.schema.fields)
    return [F.transform(f, F.lower) if isinstance(kinds[f], T.ArrayType) else F.array(F.lower(f)) for f in fields]


def _all_texts(df: DataFrame, fields: list[str]) -> Column:
    """Lower-case texts of a row in one array, nulls among them."""
    return F.flatten(F.array(*[F.coalesce(t, F.array().cast("array<string>")) for t in _texts(df, fields)]))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype("<u4") if text.isascii() else np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _distinct(numbers: np.ndarray) -> np.ndarray:
    return pa.array(numbers).unique().to_numpy()         # by hashing: a text repeats most of its numbers


def _least(points: np.ndarray) -> np.ndarray:
    """Least hashes of every ``LONG`` characters, along the last axis; equal stretches have equal ones, others may."""
    h, width = points, 1
    while width < PRINT:                                 # hashes of ever longer stretches
        step = min(width, PRINT - width)
        h = h[..., :-step] * np.uint32(0x9E3779B1) + h[..., step:]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(13)
        width += step
    width, wanted = 1, LONG - PRINT + 1                  # least of ever wider windows
    while 2 * width <= wanted:
        h, width = np.minimum(h[..., :-width], h[..., width:]), 2 * width
    rest = wanted - width
    return np.minimum(h[..., :-rest], h[..., rest:]) if rest else h


def _prints_of(text: str) -> np.ndarray:
    """Distinct fingerprints of a text."""
    points = _points(text)
    if len(points) < LONG:
        return np.empty(0, np.int32)
    h = _least(points)
    return _distinct(h[np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))].view(np.int32))


def _word_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, print) of long words, some more than once. Words of a length make one array: a call for each takes longer than its hashes."""
    for batch in batches:
        by_length: dict[int, list[str]] = {}
        for w in batch.column(0).to_pylist():
            if len(w) >= LONG:
                by_length.setdefault(len(w), []).append(w)
        for n, own in by_length.items():
            at_once = max(1, PIECE // n)
            for i in range(0, len(own), at_once):
                part = own[i:i + at_once]
                h = _least(np.frombuffer("".join(part).encode("utf-32-le"), dtype="<u4").reshape(len(part), n)).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part).take(pa.array(np.repeat(np.arange(len(part)), h.shape[1]))), pa.array(h.ravel())], names=["word", "print"])


def _print_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, rows, counts, prints): the fingerprints of a piece, folded by bucket, with the rows that follow each other in it."""
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        for places, found in _in_pieces(batch, _prints_of):
            buckets = (found % BUCKETS).astype(np.uint8)
            order = np.argsort(buckets, kind="stable")
            buckets, places, found = buckets[order], places[order], found[order]
            run = _starts(buckets, places)                            # fingerprints of one row in one bucket
            first, held = _starts(buckets), _starts(buckets[run])     # of a bucket: its fingerprints, its rows
            lists = [_lists(held, numbers[places[run]]), _lists(held, np.diff(np.append(run, len(found))).astype(np.int32)), _lists(first, found)]
            yield pa.RecordBatch.from_arrays([pa.array(buckets[first].astype(np.int32)), *lists], names=["bucket", "rows", "counts", "prints"])


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in sorted keys."""
    new = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(np.concatenate([[True], new]))


def _lists(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values))


def _bit(prints: np.ndarray) -> np.ndarray:
    """The bit of a fingerprint: mixed anew, for the least of many hashes are small numbers."""
    return (prints.view(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(7)).astype(np.int64)          # BITMAP_BITS are 2^25


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word of the bitmap, its bits) of a task's fingerprints."""
    held = np.zeros(BITMAP_BITS >> 5, np.int64)
    for batch in batches:
        bit = _bit(batch.column(0).to_numpy())
        np.bitwise_or.at(held, bit >> 5, 1 << (bit & 31))
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["at", "bits"])


def _bitmap(prints: DataFrame) -> np.ndarray:
    """Bitmap of the fingerprints; the driver gets its words that are not empty, at most 2^20."""
    rows = prints.select("print").mapInArrow(_bits, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(BITMAP_BITS >> 5, np.uint32)
    held[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return held


def _within(bitmap: np.ndarray):
    """A function over lists of rows and fingerprints: (_row, print) of the fingerprints that are in the bitmap."""
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, counts, prints = (batch.column(c)[i].values.to_numpy() for c in (0, 1, 2))
                bit = _bit(prints)
                own = np.flatnonzero(bitmap[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1))
                yield pa.RecordBatch.from_arrays([pa.array(rows[np.searchsorted(np.cumsum(counts), own, side="right")]), pa.array(prints[own])], names=["_row", "print"])
    return within


def _in_pieces(batch: pa.RecordBatch, of_text) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in the batch, number) of the numbers that each text gives, in pieces of about ``PIECE``; a text is never cut."""
    places, found, held, last = [], [], 0, batch.num_rows - 1
    for i in range(batch.num_rows):
        own = of_text(batch.column(1)[i].as_py() or "")
        places.append(np.full(len(own), i))
        found.append(own)
        held += len(own)
        if held >= PIECE or (held and i == last):
            yield np.concatenate(places), np.concatenate(found)
            places, found, held = [], [], 0


def _grams_of(text: str) -> np.ndarray:
    """The n-grams of ``grams`` as numbers: 21 bits a character, so that n-grams of two are the small ones."""
    p = _points(text).astype(np.int64)
    pair = (p[:-1] << 21) | p[1:]
    three = (pair[:-1] << 21) | p[2:] if len(p) > 2 else p[:0]
    if _CUT in text:
        cut = p == ord(_CUT)
        three = three[~(cut[:-2] | cut[1:-1] | cut[2:])] if len(p) > 2 else three
        pair = np.where(cut[:-1] | cut[1:], 0, pair)
    two = pair[:0] if text.isascii() else pair[(pair >> 21 > 127) | (pair & 0x1FFFFF > 127)]
    return np.concatenate([_distinct(two), _distinct(three)])


def _gram_texts(codes: np.ndarray) -> list[str]:
    points = np.stack([codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype("<u4")
    text = points.tobytes().decode("utf-32-le")
    return [text[i:i + 3].lstrip(_CUT) for i in range(0, len(text), 3)]


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, block, rows): the rows of a piece folded by n-gram and block."""
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        for places, codes in _in_pieces(batch, _grams_of):
            rows = numbers[places]
            numbered = pa.array(codes).dictionary_encode()
            group = numbered.indices.to_numpy().astype(np.uint16 if len(numbered.dictionary) <= 1 << 16 else np.int32)         # short numbers sort fastest
            order = np.argsort(group, kind="stable")
            rows, codes, group = rows[order], codes[order], group[order]
            block = rows >> BLOCK_BITS
            start = _starts(group, block)
            yield pa.RecordBatch.from_arrays([pa.array(_gram_texts(codes[start])), pa.array(block[start]), _lists(start, rows)], names=["gram", "block", "rows"])


def build(entries: DataFrame, fields: list[str], path: str) -> None:
    """Store the rows and the postings of their text fields (strings or arrays of them)."""
    rows = materialise(entries.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    write_typed(rows.withColumn("part", _part(F.col("_row"))), f"{path}/entries", ["part"])
    text = F.array_join(F.array_compact(_all_texts(rows, fields)), _CUT)
    each = rows.select("_row", text.alias("t")).mapInArrow(_postings, "gram string, block long, rows array<long>")
    blocks = each.groupBy("gram", "block").agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))
    postings = blocks.select("gram", "rows", F.size("rows").alias("n"), _bucket(F.col("gram")).alias("bucket"))
    write_typed(postings, f"{path}/postings", ["bucket"])
    held = rows.sparkSession.read.parquet(f"{path}/postings")
    write_typed(held.groupBy("bucket", "gram").agg(F.sum("n").alias("n")), f"{path}/grams", ["bucket"])
    prints = rows.select("_row", text.alias("t")).mapInArrow(_print_lists, "bucket int, rows array<long>, counts array<int>, prints array<int>")
    write_typed(prints, f"{path}/prints", ["bucket"])


def candidates(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """(word, _row, part) of rows that hold the rarest n-grams of a word; only words long enough have any."""
    wanted = words.select("word", _word_grams(F.col("word")).alias("g")).filter("size(g) > 0")
    keys = wanted.select("word", F.size("g").alias("of"), F.explode("g").alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    own = [r[0] for r in keys.select("bucket").distinct().collect()]                 # at most BUCKETS numbers
    known = spark.read.parquet(f"{path}/grams").filter(F.col("bucket").isin(own)).join(keys, ["bucket", "gram"])
    rare = known.groupBy("word", "of").agg(F.count("*").alias("met"), F.array_sort(F.collect_list(F.struct("n", "gram", "bucket"))).alias("g"))
    rare = rare.filter("met = of").select("word", F.slice("g", 1, RAREST).alias("g"))
    rare = materialise(rare.select("word", F.size("g").alias("of"), F.inline("g")).drop("n"), "rare-grams")
    read = [r[0] for r in rare.select("bucket").distinct().collect()]
    rows = (spark.read.parquet(f"{path}/postings").filter(F.col("bucket").isin(read)).join(rare, ["bucket", "gram"])
            .select("word", "of", F.explode("rows").alias("_row")))
    return rows.groupBy("word", "of", "_row").count().filter("count = of").select("word", "_row", _part(F.col("_row")).alias("part"))


def long_candidates(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """(word, _row, part) of rows that hold the fingerprints of a long word, ``RAREST`` of them at most."""
    own = words.select("word").mapInArrow(_word_prints, "word string, print int")
    few = own.groupBy("word").agg(F.slice(F.array_sort(F.collect_set("print")), 1, RAREST).alias("p"))
    keys = materialise(few.select("word", F.size("p").alias("of"), F.explode("p").alias("print")), "fingerprints")
    read = [r[0] for r in keys.select(F.pmod("print", F.lit(BUCKETS)).cast("int")).distinct().collect()]           # at most BUCKETS numbers
    lists = spark.read.schema("rows array<long>, counts array<int>, prints array<int>, bucket int").parquet(f"{path}/prints").filter(F.col("bucket").isin(read))
    rows = lists.select("rows", "counts", "prints").mapInArrow(_within(_bitmap(keys)), "_row long, print int").join(keys, "print")
    return rows.groupBy("word", "of", "_row").count().filter("count = of").select("word", "_row", _part(F.col("_row")).alias("part"))


def holds(df: DataFrame, fields: list[str], word: Column) -> Column:
    """Whether one of the text fields holds the lower-case word."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.exists(t, lambda x: x.contains(word)), F.lit(False)) for t in _texts(df, fields)])


def _held_in(texts: list[str], words: list[str]) -> list[str]:
    """The words that a text holds; each at most once."""
    held, by_length = [], {}
    for w in words:
        by_length.setdefault(len(w), set()).add(w)
    for n, own in by_length.items():
        if len(own) < MANY:
            held += [w for w in own if any(w in t for t in texts)]
        else:
            held += own.intersection(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    return held


@F.arrow_udf(returnType=T.ArrayType(T.StringType()))
def _held(texts: pa.Array, words: pa.Array) -> pa.Array:
    """Of each row the words that one of its texts holds."""
    return pa.array([_held_in([t for t in texts[i].as_py() if t is not None], words[i].as_py()) for i in range(len(words))], pa.list_(pa.string()))


def containing(spark: SparkSession, path: str, words: DataFrame, fields: list[str]) -> DataFrame:
    """``word`` and the stored row, for every row that holds a word of ``words`` (lower case) in one of the fields."""
    entries = spark.read.parquet(f"{path}/entries")
    own = materialise(words.select("word").filter(F.col("word").isNotNull()).distinct(), "words")
    long = F.length("word") >= LONG
    near_words = candidates(spark, path, own.filter(~long))
    if not own.filter(long).isEmpty():
        near_words = near_words.unionByName(long_candidates(spark, path, own.filter(long)))
    found = materialise(near_words, "substring-candidates")
    parts = [r[0] for r in found.select("part").distinct().collect()]                # at most PARTS numbers; none: nothing is read
    if parts:                                                                        # a row's texts travel once, with all words to try on them
        near = entries.filter(F.col("part").isin(parts)).join(found.groupBy("_row").agg(F.collect_list("word").alias("_words")), "_row")
        met = near.withColumn("word", F.explode(_held(_all_texts(near, fields), F.col("_words")))).drop("_words")
    else:
        met = entries.limit(0).withColumn("word", F.lit(""))
    short = own.filter(F.size(_word_grams(F.col("word"))) == 0)
    if not short.isEmpty():
        tried = entries.withColumn("_short", short.agg(F.collect_list("word")).scalar())
        each = tried.withColumn("word", F.explode(F.filter("_short", lambda w: holds(tried, fields, w)))).drop("_short")
        met = met.unionByName(each)
    return met.drop("_row", "part")


def expanded_matches(spark: SparkSession, path: str, queries: DataFrame, fields: list[str], **filters) -> DataFrame:
    """Each (query, entry) once, with the first expanded word that finds the entry. ``queries``: query_id, query."""
    filters.setdefault("status", "success")
    words = queries.select("query_id", "query", F.posexplode(F.transform(expand_query(F.col("query")), F.lower)).alias("word_idx", "word"))
    first = words.groupBy("query_id", "query", "word").agg(F.min("word_idx").alias("word_idx"))
    hits = containing(spark, path, words, fields).filter(S.catalog_filters(**filters)).join(first, "word")
    return hits


def search(spark: SparkSession, path: str, queries: DataFrame, max_results: int = 20, **filters) -> DataFrame:
    """Ranked results of every query over a stored catalog index, ordered as ``operators.search.search`` orders them."""
    hits = S.prepare(expanded_matches(spark, path, queries, CATALOG_FIELDS, **filters))
    scored = hits.select("query_id", "query", "dataset_id", "title", "seq", "word_idx", S.final_score(F.lower("query")).alias("score"),
                         S.catalog_score(F.col("word")).alias("word_score"))
    once = scored.groupBy("query_id", "query", "dataset_id", "title", "seq", "score").agg(F.min(F.struct("word_idx", "word_score")).alias("w"))
    order = [F.desc("score"), F.asc("w.word_idx"), F.desc("w.word_score"), F.asc("seq")]
    return top_per_group(once, ["query_id"], order, max_results, "rank").select("query_id", "query", "rank", "dataset_id", "title", "score")


def search_word(spark: SparkSession, path: str, word: str, **filters) -> DataFrame:
    """Matches of one word with their catalog score, best first, registration order on ties."""
    words = spark.createDataFrame([(word.lower(),)], "word string")
    hits = S.prepare(containing(spark, path, words, CATALOG_FIELDS).filter(S.catalog_filters(**filters)))
    return hits.select("dataset_id", "title", "seq", S.catalog_score(F.col("word")).alias("score")).orderBy(F.desc("score"), "seq")
