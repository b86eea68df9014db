"""Ranked lexical search by NRA: sorted reads only, with a lower and an upper score per document.

Items are queries against all documents. Their terms form a vocabulary of bounded size
(items beyond it follow in further blocks); documents are reduced to their counts of these
terms, written once. A task turns its documents into shards: per term a list of documents
by falling impact, which is what the term adds to a score. For an item the lists of its
terms are read in step, from the top. What was read of a document is its lower bound; the
next impact of each list where it has not been met is the most it can still gain. Once the
k-th lower bound is above what an unmet document could reach, only documents whose upper
bound reaches the k-th lower one stay, and reading goes on, for them alone, until every
one of them is known in full: membership, ties and scores. The k-th score of a task's
earlier shards is the bar for its later ones. The best of all tasks are ranked per item.

Defined results: a row is a document, and a row is an item, so repeated rows count each;
null texts have no terms, documents without terms count nowhere, items without terms have
no result; equal scores go by ascending doc_id, null ids last, rows of equal id in any
order; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.session import materialise

K = 50
#: Terms of items (each item's own counted) that one pass over the documents serves.
TERMS_AT_ONCE = 1 << 18
SHARD_POSTINGS, SHARD_DOCS = 1 << 20, 1 << 15
FIRST_READ = 128                     # of each list; later rounds read twice as many
MOST_LISTS = 256                     # weaker lists of an item are added up into one
_AT_ONCE = 1 << 22
_LONG = 64                           # longer terms are known by a 128-bit hash

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")           # after A-Z are lowered; bytes of other letters are above 7F
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def term_counts(text: str | None) -> Counter:
    """How often each term occurs in a whole text; works through long ones piece by piece."""
    raw, counts, at = (text or "").encode("utf-8", "surrogatepass").lower(), Counter(), 0
    while at < len(raw):
        gap = _GAP.search(raw, at + _AT_ONCE)
        to = gap.start() if gap else len(raw)
        counts.update(_TERM.findall(raw, at, to))
        at = to
    return counts


def _key(term: bytes) -> bytes:
    return term if len(term) <= _LONG else b"\0" + xxhash.xxh3_128_digest(term)          # no term holds \0


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """``item, term``: the distinct terms of each item (``item`` long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = sorted({_key(t) for t in term_counts(text.as_py())})
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(terms), pa.int64()), pa.array(terms, pa.binary())], names=["item", "term"])

    return items.select("item", F.col(text).cast("string").alias("text")).mapInArrow(run, "item long, term binary")


def document_counts(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text") -> DataFrame:
    """``doc_id, n, terms, counts`` of documents with terms: their number, and counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)         # at most TERMS_AT_ONCE terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            keep, n, terms, counts, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column(1)):
                found = term_counts(text.as_py())
                if not found:
                    continue
                own = [(i, c) for t, c in found.items() if (i := of.get(_key(t))) is not None]
                keep.append(row)
                n.append(found.total())
                terms.extend(i for i, _ in own)
                counts.extend(c for _, c in own)
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, k)) for x, k in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists],
                                             names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def document_frequencies(counts: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term; a task sends one row a term it has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["term", "n"])

    rows = counts.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(terms, np.int64)
    out[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return out


def term_weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


class Shard:
    """Documents of a task by term, each term's list by falling impact."""

    def __init__(self, parts: list[pa.RecordBatch], weights: np.ndarray, documents: int, words: int) -> None:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table.column("doc_id")
        self.unnamed = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        lists = table.column("terms").chunk(0)
        term, tf = lists.flatten().to_numpy(), table.column("counts").chunk(0).flatten().to_numpy()
        m = np.array([50 + 50 * n * documents // words for n in table.column("n").to_pylist()], np.int64)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        some = np.flatnonzero(impact > 0)
        order = some[np.lexsort((-impact[some], term[some]))]
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents and impacts, and where each list of ``terms`` starts and ends in them."""
        low, high = self.starts[terms], self.starts[terms + 1]
        full = high > low
        low, high = low[full], high[full]
        if len(low) <= MOST_LISTS:
            return self.doc, self.impact, low, high
        order = np.argsort(-self.impact[low], kind="stable")
        strong, weak = order[:MOST_LISTS - 1], order[MOST_LISTS - 1:]
        at = _ranges(low[weak], high[weak] - low[weak])
        total = np.zeros(len(self.ids), np.int64)
        np.add.at(total, self.doc[at], self.impact[at])
        doc = np.flatnonzero(total)
        doc = doc[np.argsort(-total[doc], kind="stable")]
        n = len(self.doc)
        return (np.concatenate([self.doc, doc.astype(np.int32)]), np.concatenate([self.impact, total[doc]]),
                np.append(low[strong], n), np.append(high[strong], n + len(doc)))

    def ranked(self, docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.ids[docs], self.unnamed[docs], -scores))[:k]
        return docs[best], scores[best]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def best_documents(shard: Shard, terms: np.ndarray, k: int, bar: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of a shard, and their scores, of those that reach ``bar``."""
    doc, impact, at, end = shard.lists(terms)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    name = np.arange(len(shard.ids))                      # documents looked at; all at first, then the candidates
    place = name.astype(np.int32)                         # of a document among these, -1 if it is none
    lower, seen = np.zeros(len(name), np.int64), np.zeros((len(at), len(name)), dtype=bool)
    step, only_candidates = FIRST_READ, False
    while True:
        sizes = np.minimum(step, end - at)
        read = _ranges(at, sizes)
        to, which = place[doc[read]], np.repeat(np.arange(len(at)), sizes)
        if only_candidates:
            kept = to >= 0
            read, to, which = read[kept], to[kept], which[kept]
        np.add.at(lower, to, impact[read])
        seen[which, to] = True
        at, step = at + sizes, step * 2
        open_ = at < end
        gain = np.where(open_, impact[np.minimum(at, end - 1)], 0)          # the next impact of a list, 0 at its end
        missing = int(gain.sum()) - gain[open_] @ seen[open_]               # what a document can still gain
        kth = max(bar, int(np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) > k else bar)
        if only_candidates or int(gain.sum()) < kth:
            stay = np.flatnonzero((lower + missing >= kth) & (lower > 0))
            name, lower, seen, missing = name[stay], lower[stay], seen[:, stay], missing[stay]
            place = np.full(len(shard.ids), -1, np.int32)
            place[name] = np.arange(len(name), dtype=np.int32)
            only_candidates = True
            if not missing.any():                          # every score is whole, and all that could reach the k-th are here
                return shard.ranked(name, lower, k)


def search_shards(counts: DataFrame, queries: list[tuple[int, np.ndarray]], weights: np.ndarray, documents: int, words: int, k: int) -> DataFrame:
    """``item, doc_id, score``: each task's k best documents of every item (items and term numbers in ``queries``)."""
    shared = counts.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        best: list[list] = [[] for _ in asked]             # (-score, no id, id) of at most k documents

        def work(parts: list[pa.RecordBatch]) -> None:
            shard = Shard(parts, weight, documents, words)
            for have, (_, terms) in zip(best, asked):
                bar = -have[-1][0] if len(have) == k else 1
                docs, scores = best_documents(shard, terms, k, bar)
                if len(docs):
                    have += zip((-scores).tolist(), shard.unnamed[docs].tolist(), shard.ids[docs].tolist())
                    have.sort()
                    del have[k:]

        held, postings, rows = [], 0, 0
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            at = 0
            while at < batch.num_rows:                     # cut so that a shard stays within its bounds, one document at least
                room = int(np.searchsorted(np.cumsum(lengths[at:]), SHARD_POSTINGS - postings, side="right"))
                take = min(room, SHARD_DOCS - rows, batch.num_rows - at)
                if take <= 0 and held:
                    work(held)
                    held, postings, rows = [], 0, 0
                    continue
                take = max(1, take)
                held.append(batch.slice(at, take))
                postings, rows, at = postings + int(lengths[at:at + take].sum()), rows + take, at + take
        if held:
            work(held)
        for have, (item, _) in zip(best, asked):
            if have:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(have), pa.int64()), pa.array([None if none else i for _, none, i in have], pa.int64()),
                     pa.array([-s for s, _, _ in have], pa.int64())], names=["item", "doc_id", "score"])

    return counts.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = materialise(items.select("item_id", F.col(text).cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id()), "search-items")
    pairs = materialise(item_terms(asked), "item-terms")
    blocks = max(1, -(-pairs.count() // TERMS_AT_ONCE))
    found = None
    for block in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "term").toArrow()      # about TERMS_AT_ONCE terms
        if not own.num_rows:
            continue
        names, term = np.unique(np.array(own.column("term").to_pylist(), dtype=object), return_inverse=True)
        item = own.column("item").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]])).tolist()
        queries = [(int(item[s]), term[s:e]) for s, e in zip(cuts, cuts[1:])]
        counts = materialise(document_counts(docs, {t: i for i, t in enumerate(names.tolist())}, text), "term-counts")
        documents, words = counts.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        weights = term_weights(document_frequencies(counts, len(names)), documents)
        best = search_shards(counts, queries, weights, documents, words, k)
        found = best if found is None else found.union(best)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return asked.select("item", "item_id").join(best, "item").select("item_id", "rank", "doc_id", "score")
