"""Line dedup by a sharded minimal perfect hash over distinct line hashes.

Documents are written once in blocks of ``BLOCK_ROWS`` rows. Each block lists its distinct
long lines as 128-bit hashes, with the number of its documents that hold them and the
largest doc_id among these; that list stands for the block's lines in all that follows, so
a line of a third of all documents is one entry a block. Entries are summed and dealt by
shard. A shard is one row of arrays: a minimal perfect hash of its keys, and by slot a
fingerprint, a count that stops at 255, and, for lines found often enough, the doc_id that
keeps them. Blocks send their entries to the shards, probe the arrays there and get back
the lines to drop; no line text travels and no line meets another in a join. The index
holds every key that is probed, so the fingerprint only guards against foreign ones.

Defined results: a null or empty text is one empty line; a document is a row, so rows with
equal doc_id count each; of a line's documents all rows with the largest doc_id keep it;
a null doc_id is below all others; doc_id -2^63 counts as null; repeated rows stay and get
equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import runs
from statlake.llm.perfect_hash import PerfectHash
from statlake.session import materialise

LEAST_CHARS, LEAST_DOCS = 20, 3
BLOCK_ROWS = 1 << 10
SHARD_ENTRIES = 1 << 17
MOST_COUNT = 255
NO_ID = -(1 << 63)
_SPACE = " \t\n\x0b\x0c\r"

_COUNTS = "block long, hi long, lo long, n long, top long"
_INDEX = "shard long, keys long, sizes binary, taken binary, marks binary, counts binary, keepers binary"


def line_hashes(lines: list[str], least_chars: int = LEAST_CHARS) -> list[bytes | None]:
    """128-bit hash of each line's key; None where the key is shorter than ``least_chars``."""
    digest = xxhash.xxh3_128_digest
    keys = [line.strip(_SPACE) for line in lines]
    return [digest(k.encode("utf-8", "surrogatepass").lower()) if len(k) >= least_chars else None for k in keys]


def _ids(column: pa.Array) -> list[int]:
    return column.fill_null(NO_ID).to_pylist()


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def blocks_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """``block, doc_id, text`` as written: rows of a block lie together and keep their block."""
    at = F.monotonically_increasing_id()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), at.alias("at"))
    return materialise(rows.select(F.shiftright("at", BLOCK_ROWS.bit_length() - 1).alias("block"), "doc_id", "text"), "line-blocks")


def block_lines(rows: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``block, hi, lo, n, top``: distinct long lines of each block, documents that hold them, the largest doc_id of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in runs(batches):
            seen: dict[bytes, list[int]] = {}
            for doc_id, text in zip(_ids(part.column(1)), part.column(2)):
                for h in set(line_hashes((text.as_py() or "").split("\n"), least_chars)):
                    if h is None:
                        continue
                    have = seen.get(h)
                    if have is None:
                        seen[h] = [1, doc_id]
                    else:
                        have[0] += 1
                        have[1] = max(have[1], doc_id)
            keys = _halves(list(seen)).view(np.int64)
            counts = np.array(list(seen.values()), np.int64).reshape(-1, 2)
            block = np.full(len(keys), part.column(0)[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (block, keys[:, 0], keys[:, 1], counts[:, 0], counts[:, 1])],
                                             names=["block", "hi", "lo", "n", "top"])

    return rows.select("block", "doc_id", "text").mapInArrow(run, _COUNTS)


def line_index(entries: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row of arrays a shard, from ``shard, hi, lo, n, top``; keys of a shard lie in one task, as many as a shard holds."""
    if not 1 <= least_docs <= MOST_COUNT:
        raise ValueError(f"least_docs from 1 to {MOST_COUNT}")

    def of(shard: int, table: pa.Table) -> pa.RecordBatch:
        hi, lo, n, top = (table.column(c).to_numpy() for c in ("hi", "lo", "n", "top"))
        keys = np.stack([hi, lo], axis=1).view(np.uint64)
        index = PerfectHash.of(keys)
        at = np.empty(len(keys), np.int64)
        at[index.slots(keys)] = np.arange(len(keys))                  # by slot
        often = n[at] >= least_docs
        values = (shard, len(keys), *index.stored(), lo[at].astype(np.uint32).tobytes(),
                  np.minimum(n[at], MOST_COUNT).astype(np.uint8).tobytes(), top[at][often].tobytes())
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                          names=["shard", "keys", "sizes", "taken", "marks", "counts", "keepers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for first, part in runs(batches):
            if first and held:
                yield of(held[0].column(0)[0].as_py(), pa.Table.from_batches(held))
                held = []
            held.append(part)
        if held:
            yield of(held[0].column(0)[0].as_py(), pa.Table.from_batches(held))

    dealt = entries.repartition("shard").groupBy("shard", "hi", "lo").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    return dealt.sortWithinPartitions("shard").select("shard", "hi", "lo", "n", "top").mapInArrow(run, _INDEX)


class _Shard:
    def __init__(self, row: pa.RecordBatch, least_docs: int) -> None:
        value = {name: row.column(i)[0].as_py() for i, name in enumerate(row.schema.names)}
        self.index = PerfectHash.read(value["sizes"], value["taken"])
        self.marks = np.frombuffer(value["marks"], np.uint32)
        self.often = np.frombuffer(value["counts"], np.uint8) >= least_docs
        self.keepers = np.frombuffer(value["keepers"], np.int64)
        self.place = np.cumsum(self.often) - 1

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys belong to lines found often enough, and the doc_id that keeps each of these."""
        slot = self.index.slots(keys)
        known = slot >= 0
        known[known] = (self.marks[slot[known]] == keys[known, 1].astype(np.uint32)) & self.often[slot[known]]
        return known, self.keepers[self.place[slot[known]]]


def probed(entries: DataFrame, index: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``block, hi, lo, keeper`` of the entries (``shard, block, hi, lo``) whose line is found in ``least_docs`` documents or more.

    A shard's arrays come first in its task; its entries pass by them in batches.
    """
    arrays = ["sizes", "taken", "marks", "counts", "keepers"]
    none = F.lit(None)
    sides = index.select("shard", F.lit(0).alias("kind"), *[none.cast("long").alias(c) for c in ("block", "hi", "lo")], *arrays).unionByName(
        entries.select("shard", F.lit(1).alias("kind"), "block", "hi", "lo", *[none.cast("binary").alias(c) for c in arrays]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for first, part in runs(batches):
            if first:
                if part.column(1)[0].as_py() != 0:
                    raise RuntimeError("a shard has no index")
                shard, part = _Shard(part.slice(0, 1), least_docs), part.slice(1)
            block, hi, lo = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            if not len(block):
                continue
            keys = np.stack([hi, lo], axis=1).astype(np.int64).view(np.uint64)
            often, keeper = shard.probe(keys)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (block[often], hi[often], lo[often], keeper)],
                                             names=["block", "hi", "lo", "keeper"])

    dealt = sides.repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "block long, hi long, lo long, keeper long")


def without_lines(rows: DataFrame, drops: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: rows (``block, doc_id, text``) without the lines that ``drops`` names for their block.

    A block's lines come first in its task, then its documents, one at a time.
    """
    none = F.lit(None)
    sides = drops.select("block", F.lit(0).alias("kind"), F.col("keeper").alias("doc_id"), "hi", "lo", none.cast("string").alias("text")).unionByName(
        rows.select("block", F.lit(1).alias("kind"), "doc_id", none.cast("long").alias("hi"), none.cast("long").alias("lo"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keepers: dict[bytes, int] = {}
        for first, part in runs(batches):
            if first:
                keepers = {}
            kinds = part.column(1).to_numpy()
            upto = int((kinds == 0).sum())
            if upto:
                keys = np.stack([part.column(i).slice(0, upto).to_numpy() for i in (3, 4)], axis=1).astype(np.int64)
                raw = keys.tobytes()
                keepers.update(zip((raw[i:i + 16] for i in range(0, len(raw), 16)), part.column(2).slice(0, upto).to_pylist()))
            docs = part.slice(upto)
            out, n_lines, n_dropped = [], [], []
            for doc_id, text in zip(_ids(docs.column(2)), docs.column(5)):
                text = text.as_py() or ""
                lines = text.split("\n")
                if keepers:
                    kept = [line for line, h in zip(lines, line_hashes(lines, least_chars)) if h is None or keepers.get(h, doc_id) == doc_id]
                    out.append("\n".join(kept) if len(kept) < len(lines) else text)
                else:
                    kept = lines
                    out.append(text)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays([docs.column(2), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                             names=["doc_id", "text", "n_lines", "n_dropped"])

    dealt = sides.repartition("block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")


def deduplicated_lines(docs: DataFrame, text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of each row of ``docs``, without lines that other documents keep."""
    rows = blocks_of(docs, text)
    entries = materialise(block_lines(rows, least_chars), "block-lines")
    shards = max(1, -(-entries.count() // SHARD_ENTRIES))             # entries are at least as many as distinct lines
    entries = entries.withColumn("shard", F.pmod("hi", F.lit(shards).cast("long")))
    index = materialise(line_index(entries, least_docs), "line-index")
    return without_lines(rows, probed(entries, index, least_docs), least_chars)
