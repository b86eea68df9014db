"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers letters, drops accents and zero-width characters, maps letters that look
like Latin ones to those, and digits and signs that stand for letters to the letters;
``i``, ``l``, ``1`` and ``|`` become one. Entries are whole words or beginnings of words
with a weight; the longest entry at a word counts. Exception phrases are entries of
weight zero, longer than what they excuse. The sum of weights over the number of words
is the rate; ``rate / (rate + threshold)`` the score.

The lexicon, weights and threshold are learned from at most ``SAMPLE`` labelled rows of
either class, chosen by a hash of the id: words and beginnings by the log odds of
occurring in toxic documents, equal texts once; the threshold by the fewest errors. The
number of entries has no limit of its own: an entry has at least ``STEM[0]`` letters and
occurs in ``LEAST_DOCUMENTS`` toxic documents of the sample.

Defined results: null and empty texts, and texts without words, score 0; of an id with
several labels, toxic wins; rows with a null id are scored and not learned from;
without toxic labels the lexicon is empty; repeated rows stay; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import text_of
from statlake.session import materialise

SAMPLE = 8_000                 # labelled rows of either class
STEM = (3, 10)                 # letters of a beginning
LEAST_DOCUMENTS, LEAST_ODDS, CAUTION = 3, 10.0, 1.5

EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "stupid question")

# Letters that look like Latin ones (Cyrillic, then Greek).
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a",
}
DIGITS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "l", "|": "l"}

_TABLE = {ord(k): v for k, v in {**LOOK_ALIKES, **DIGITS}.items()}
_TABLE |= {ord("i"): "l", ord("і"): "l", ord("ι"): "l", ord("ı"): "l"}
_TABLE |= {c: None for c in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]}
_ASCII_TABLE = str.maketrans({k: v for k, v in {**DIGITS, "i": "l"}.items()})
_SIGN = re.compile(r"(?<=[\w@$!|])[@$!|](?=[@$!|]*\w)|(?<!\S)[@$](?=[@$!|]*\w)")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str | None) -> list[str]:
    """The words of a text, folded."""
    text = (text or "").lower()
    if any(s in text for s in SIGNS):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    text = text.translate(_ASCII_TABLE) if text.isascii() else unicodedata.normalize("NFKD", text).translate(_TABLE)
    return _WORD.findall(text)


@dataclass(frozen=True)
class Lexicon:
    """Entries begin with a space; those that end with one are whole words."""

    weights: dict[str, float]
    threshold: float = 1.0
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton | None:
        entries = dict(self.weights)
        for phrase in self.exceptions:
            entries[" " + "  ".join(folded(phrase)) + " "] = 0.0
        machine = ahocorasick.Automaton()
        for entry, weight in entries.items():
            machine.add_word(entry, weight)
        if not self.weights:
            return None
        machine.make_automaton()
        return machine

    def rate(self, machine: ahocorasick.Automaton | None, text: str | None) -> float:
        words = folded(text)
        if not words or machine is None:
            return 0.0
        return max(0.0, sum(w for _, w in machine.iter_long(" " + "  ".join(words) + " "))) / len(words)

    def score(self, rate: float) -> float:
        return rate / (rate + self.threshold) if rate > 0 else 0.0


def entries_of(words: set[str]) -> set[str]:
    """Whole words, and their beginnings."""
    low, high = STEM
    out = set()
    for word in words:
        if len(word) >= low:
            out.add(f" {word} ")
            out.update(f" {word[:n]}" for n in range(low, min(high, len(word)) + 1))
    return out


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text, toxic``: equal texts once; at most ``sample`` ids of either class are joined."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), 5, 0))
             .groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max("toxic").alias("toxic")))
    known = materialise(known, "toxic-labels")
    some = [known.filter(of_class).orderBy(F.xxhash64("l_id"), "l_id").limit(sample) for of_class in ("toxic > 0", "toxic <= 0")]
    chosen = some[0].union(some[1])
    text = text_of("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
    return materialise(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, sample)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return Lexicon({})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[1 if label else 0].update(entries_of(set(folded(text.as_py()))))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][n] for n in names], pa.int64()),
                                              pa.array([seen[0][n] for n in names], pa.int64())], names=["entry", "toxic", "clean"])

    counts = (rows.select("text", "toxic").mapInArrow(count, "entry string, toxic long, clean long")
              .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.ln(t / (toxic + 1)) - F.ln(c / (clean + 1)) - CAUTION * F.sqrt(1 / t + 1 / c)
    found = (counts.filter(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("weight", odds)
             .filter(F.col("weight") >= math.log(LEAST_ODDS))
             .orderBy((F.col("weight") * F.col("toxic")).desc(), F.length(F.trim("entry")).desc(), F.length("entry"), "entry").collect())      # as many as the sample has
    lexicon = Lexicon(selected([(r["entry"], r["weight"], r["toxic"]) for r in found]))

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.rate(machine, t.as_py()) for t in batch.column(0)], pa.float64()),
                                              batch.column(1).cast(pa.int32())], names=["rate", "toxic"])

    measured = rows.select("text", "toxic").mapInArrow(rates, "rate double, toxic int").toArrow()      # at most two samples
    return Lexicon(lexicon.weights, threshold_of(measured.column("rate").to_numpy(), measured.column("toxic").to_numpy()))


def selected(found: list[tuple[str, float, int]]) -> dict[str, float]:
    """Entries, best first, without those that a kept beginning covers or that add little to a kept longer one."""
    kept: dict[str, float] = {}
    covered: dict[str, int] = {}               # beginnings of kept entries, and the most documents one of those has
    for entry, weight, documents in found:
        if any(entry[:n] in kept for n in range(STEM[0] + 1, len(entry))) or documents <= 1.1 * covered.get(entry, 0):
            continue
        kept[entry] = weight
        for n in range(STEM[0] + 1, len(entry)):
            covered[entry[:n]] = max(covered.get(entry[:n], 0), documents)
    return kept


def threshold_of(rates: np.ndarray, toxic: np.ndarray) -> float:
    """The rate with the fewest errors; of equally good ones the middle of the widest gap, in logarithms."""
    order = np.argsort(rates, kind="stable")
    r, y = rates[order], toxic[order] > 0
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((~y)[::-1])[::-1], [0]])     # of cutting before each
    low = np.maximum(np.concatenate([[0], r]), 1e-4)
    high = np.maximum(np.concatenate([r, [max(1.0, r[-1] * 2) if len(r) else 1.0]]), 1e-4)
    gap = np.where(errors == errors[1:].min(initial=errors[0]), np.log(high / low), -1.0)
    at = int(np.argmax(gap))
    return float(np.sqrt(low[at] * high[at])) if gap[at] > 0 else float(max(high[at], 1e-4))


def score(docs: DataFrame, lexicon: Lexicon, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and its ``score``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            scores = [lexicon.score(lexicon.rate(machine, t.as_py())) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    rows = docs.select(*keep, F.col(text).alias("scored_text"))
    schema = rows.drop("scored_text").schema.add("score", "double")
    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row."""
    keep = [F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 5, 0).alias("held_out")]
    return score(docs, learn(docs, labels, sample), keep).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    lexicon, at = learn(docs, labels, sample), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            yield batch.filter(pa.array([lexicon.score(lexicon.rate(machine, t.as_py())) < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
