"""Benchmark decontamination by winnowing.

The least k-gram hash of every window of ``w`` consecutive k-grams is a fingerprint, on
both sides. Texts that share ``k + w - 1`` words share such a window, thus its least
hash: with ``k + w - 1`` equal to the length looked for, no shared passage is missed.
Document and benchmark fingerprints are joined, and every hit is extended to the full
windows around it, which are joined with the benchmark's windows by their very words;
a hash collision never counts.

Items of fewer words than a full window are looked for at their own length, with a
smaller ``k`` and ``w``; every length that occurs adds a level of fingerprints.

Before the join a bitmap of fixed size (``BITMAP_BITS``, of the benchmark's
fingerprints) drops most document fingerprints where they arise. It only ever passes
too many; its size is the only thing sent to the tasks and does not grow.

Defined results: null texts and texts without words hold nothing and are not hit; such
items match nothing; equal items all count, as do repeated rows; of a null item_id
windows hit, but it is in no list; empty tables give empty results or no hits; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.llm.common import ascii_lower, fresh, text_of
from statlake.session import materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTH, GRAM = 10, 5
BITMAP_BITS = 1 << 24
AT_ONCE = 1 << 21                   # bytes of text a task turns into arrays at a time

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) ^ (h >> np.uint64(32))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and text numbers of the words in the folded UTF-8 bytes of several texts."""
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64), starts
    long = ends - starts
    at = np.flatnonzero(inside)
    place = np.minimum(at - np.repeat(starts, long), 255)
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * _POWERS[place]
    hashes = _mixed(np.add.reduceat(terms, np.concatenate([[0], np.cumsum(long)[:-1]])))
    return starts, ends, hashes, np.searchsorted(offsets, starts, side="right") - 1


def level_of(length: int) -> tuple[int, int]:
    """k and w for passages of ``length`` words."""
    k = min(GRAM, length)
    return k, length - k + 1


def winnowed(hashes: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and hashes of the fingerprints; windows stay within a text."""
    k, w = level_of(length)
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = hashes[:len(hashes) - k + 1].copy()
    for j in range(1, k):
        grams = _mixed(grams * np.uint64(0x100000001B3)) + hashes[j:len(hashes) - k + 1 + j]
    grams = _mixed(grams + np.uint64(length))
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, w):
        other = grams[j:n + j]
        less = other <= best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    valid = text[:n] == text[length - 1:]
    at = np.unique(at[valid])
    return at, grams[at]


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, folded bytes, offsets) of slices of about AT_ONCE bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + AT_ONCE, side="right")) - 1)
        yield at, to, _FOLD[raw[offsets[at]:offsets[to]]], offsets[at:to + 1] - offsets[at]
        at = to


def fingerprints(df: DataFrame, lengths: list[int], bitmap: np.ndarray | None = None) -> DataFrame:
    """``id, key, n_words, text, hits array<struct<length, at, hash>>`` from ``id, key, text``.

    With ``bitmap`` only fingerprints in it stay, and the text only where one does.
    """
    schema = "id long, key string, n_words long, text string, hits array<struct<length:int,at:int,hash:long>>"
    kind = pa.list_(pa.struct([("length", pa.int32()), ("at", pa.int32()), ("hash", pa.int64())]))
    context = df.sparkSession.sparkContext
    shared = context.broadcast(bitmap) if bitmap is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value if shared is not None else None
        for batch in batches:
            for first, last, data, offsets in _chunks(batch.column(2)):
                _, _, hashes, text = tokens(data, offsets)
                n = last - first
                words = np.bincount(text, minlength=n)
                begin = np.concatenate([[0], np.cumsum(words)])
                rows, long, at, found = [], [], [], []
                for length in lengths:
                    where, what = winnowed(hashes, text, length)
                    if bits is not None:
                        slot = what & np.uint64(BITMAP_BITS - 1)
                        keep = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        where, what = where[keep], what[keep]
                    rows.append(text[where])
                    long.append(np.full(len(where), length, np.int32))
                    at.append(where - begin[text[where]])
                    found.append(what)
                row = np.concatenate(rows) if rows else np.empty(0, np.int64)
                order = np.argsort(row, kind="stable")
                cat = [np.concatenate(x)[order] if x else np.empty(0) for x in (long, at, found)]
                counts = np.bincount(row.astype(np.int64), minlength=n)
                items = pa.StructArray.from_arrays([pa.array(cat[0].astype(np.int32)), pa.array(cat[1].astype(np.int32)),
                                                    pa.array(cat[2].astype(np.uint64).view(np.int64))], fields=list(kind.value_type))
                hits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), items).cast(kind)
                part = batch.slice(first, n)
                texts = part.column(2) if bits is None else part.column(2).take(pa.array(np.arange(n), mask=counts == 0))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(words.astype(np.int64)), texts, hits],
                                                 names=["id", "key", "n_words", "text", "hits"])

    return df.select("id", "key", "text").mapInArrow(run, schema)


def extended(candidates: DataFrame) -> DataFrame:
    """``key, start, length, window`` for every window around a hit, from ``key, text, hits``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hits = batch.column(0).to_pylist(), batch.column(2)
            for first, last, data, offsets in _chunks(batch.column(1)):
                starts, ends, _, text = tokens(data, offsets)
                words = np.bincount(text, minlength=last - first)
                begin = np.concatenate([[0], np.cumsum(words)])
                raw = data.tobytes()
                out = ([], [], [], [])
                for row in range(first, last):
                    at, n = int(begin[row - first]), int(words[row - first])
                    wanted = set()
                    for hit in hits[row].as_py() or []:
                        _, w = level_of(hit["length"])
                        low, high = max(0, hit["at"] - w + 1), min(hit["at"], n - hit["length"])
                        wanted.update((s, hit["length"]) for s in range(low, high + 1))
                    own = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at:at + n].tolist(), ends[at:at + n].tolist())] if wanted else []
                    for s, length in wanted:
                        for column, value in zip(out, (keys[row], s, length, " ".join(own[s:s + length]))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                                                  pa.array(out[3], pa.string())], names=["key", "start", "length", "window"])

    return candidates.select("key", "text", "hits").mapInArrow(run, "key string, start int, length int, window string")


def item_windows(benchmark: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``item_id, length, window``: the windows of ``length`` words, or the whole item if it is shorter."""
    words = F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).filter("size(words) > 0")
    items = items.withColumn("length", F.least(F.size("words"), F.lit(length)))
    window = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("length")),
                         lambda i: F.array_join(F.slice("words", i + 1, F.col("length")), " "))
    return items.select("item_id", "length", F.explode(window).alias("window")).distinct()


def bitmap_of(prints: DataFrame) -> np.ndarray:
    """Bitmap of ``hash`` values: at most BITMAP_BITS / 32 rows reach the driver, whatever the table's size."""
    slot = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1))
    cells = prints.select(F.shiftright(slot, 5).cast("int").alias("cell"), F.expr("shiftleft(1L, cast(hash & 31 as int))").alias("bit"))
    rows = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 32, dtype="<u4")
    out[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_sha256`` of each row of ``docs``.

    What a text holds depends on the text alone, so documents are known by a digest of
    it from here on, and copies are looked at once.
    """
    windows = materialise(item_windows(benchmark, text, length), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())          # at most ``length`` values
    sought = windows.select(F.lit(0).cast("long").alias("id"), F.lit("").alias("key"), F.col("window").alias("text"), "length")
    levels = [fingerprints(sought.filter(F.col("length") == n), [n]).select(F.explode("hits").alias("h")).select("h.hash") for n in lengths]
    prints = None
    for level in levels:
        prints = level if prints is None else prints.union(level)
    prints = materialise(prints.distinct() if prints is not None else docs.sparkSession.createDataFrame([], "hash long"), "benchmark-prints")

    content = text_of(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.sha2(content.cast("binary"), 256).alias("key"), content.alias("text"))
    read = materialise(fingerprints(rows, lengths, bitmap_of(prints)), "document-prints")
    possible = read.filter("size(hits) > 0").groupBy("key").agg(F.first("text").alias("text"), F.first("hits").alias("hits"))
    possible = materialise(possible, "document-candidates")
    sure = (possible.select("key", F.explode("hits").alias("h")).join(prints, F.col("h.hash") == F.col("hash"), "left_semi")
            .groupBy("key").agg(F.collect_list("h").alias("hits")))
    around = extended(possible.select("key", "text").join(sure, "key"))
    # A window of many items meets a place once; its items are taken once a text, not once a place.
    met = materialise(around.join(windows.select("window", "length").distinct(), ["window", "length"], "left_semi"), "document-hits")

    spans = met.select("key", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    upto = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(upto), F.lit(0))
    covered = (spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached)))
               .groupBy("key").agg(F.sum("new").alias("n_hit")))
    held = met.select("key", "window", "length").distinct().join(windows, ["window", "length"])
    items = held.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by_text = materialise(covered.join(items, "key"), "contaminated-texts")      # a plain side: the join can split a text of many rows
    return read.select("id", "key", "n_words").join(by_text, "key", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.col("key").alias("text_sha256"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage."""
    bad = fresh(docs, "bad")
    digests = contamination(docs, benchmark, text=text).filter("contaminated").select(F.col("text_sha256").alias(bad)).distinct()
    return docs.join(digests, F.sha2(text_of(text).cast("binary"), 256) == F.col(bad), "left_anti")
