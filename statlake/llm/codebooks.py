"""Vector code compression by member-resident Lloyd.

Vectors become integers and are cut into parts. A part's codebook starts as that part of
the vectors with the smallest ids. Parts are rows of their own, dealt by (position, entry,
salt): a task owns the members of its entries, sums them up where they lie, and sends one
row of sums per entry. The new codebook, bounded by positions x entries, goes to all
tasks, which reassign their members in place. Members whose entry stays lie where they
are; only those that change it go through the next shuffle, to the task of their new entry. As
many salts as a table needs keep an entry of many members from being one task.

Distances are exact: squares and products are taken in doubles as long as all sums stay
below 2^53, else in 64-bit integers. Components are held within +-2^k, with the largest k
that keeps a vector's error within 62 bits (k = 27 for vectors of 64 components).

Defined results: vectors that are null, empty, or hold null or non-finite components are
dropped, and so are those of another length than the first kept vector's (that of the
smallest id); ids may be null (they come last) or repeat (then vectors decide the order, as
arrays compare); a length that does not divide evenly gives the first parts one component
more; fewer vectors than entries make a smaller codebook; ties go to the lower index;
null labels are one label; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import runs
from statlake.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Members a salt holds on average if all lie on one entry.
SALT_ROWS = 1 << 12
AT_ONCE = 1 << 12                    # members compared with a codebook at a time

_MEMBERS = "row long, position int, entry int, salt int, part binary"


def widths(dims: int, parts: int = PARTS) -> list[int]:
    return [dims // parts + (i < dims % parts) for i in range(parts)]


def usable(x: Column) -> Column:
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & (F.size(x) > 0), F.lit(False))


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, label, vector``: usable vectors as integers; ``row`` is their number as written."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id())
    bits = F.length(F.bin(F.size("vector").cast("long") - 1))
    limit = F.pow(F.lit(2.0), F.floor((F.lit(62) - bits) / 2) - 1).cast("long")
    held = F.transform("vector", lambda v: F.greatest(-limit, F.least(limit, F.floor(v * scale))))
    return materialise(rows.select("row", "vec_id", "label", held.alias("vector")), "whole-vectors")


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry, the lowest of equals, and its squared distance."""
    top = int(max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)))
    at, error = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    exact = top * top * parts.shape[1] * 4 < 1 << 53
    kind = np.float64 if exact else np.int64
    entries = book.astype(kind)
    square = (entries * entries).sum(axis=1)
    for i in range(0, len(parts), AT_ONCE):
        own = parts[i:i + AT_ONCE].astype(kind)
        if exact:                     # every term and sum is an integer below 2^53
            gap = square - 2 * (own @ entries.T) + (own * own).sum(axis=1)[:, None]
        else:
            gap = np.stack([((own - e) ** 2).sum(axis=1) for e in entries], axis=1)
        best = gap.argmin(axis=1)
        at[i:i + AT_ONCE] = best
        error[i:i + AT_ONCE] = gap[np.arange(len(own)), best].astype(np.int64)
    return at, error


def _parts_of(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    raw = b"".join(batch.column(column).to_pylist())
    return np.frombuffer(raw, "<i8").reshape(-1, width)


def _first(vectors: DataFrame, n: int) -> list[list[int]]:
    """Vectors of the ``n`` smallest ids."""
    return [r[0] for r in vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(n).collect()]


def members(vectors: DataFrame, dims: int, parts: int) -> DataFrame:
    """``row, position, entry, salt, part``: a row each part; no entry owns it yet (-1)."""
    cuts = np.cumsum([0, *widths(dims, parts)]).tolist()
    salts = max(1, -(-vectors.count() // SALT_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat = np.ascontiguousarray(batch.column(2).flatten().to_numpy()).reshape(-1, dims)
            for position, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                raw = np.ascontiguousarray(flat[:, s:e]).astype("<i8").tobytes()
                size = 8 * (e - s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(np.full(len(rows), position, np.int32)), pa.array(np.full(len(rows), -1, np.int32)), pa.array(salt),
                     pa.array([raw[i * size:(i + 1) * size] for i in range(len(rows))], pa.binary())],
                    names=["row", "position", "entry", "salt", "part"])

    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
    return vectors.select("row", salt.alias("salt"), "vector").mapInArrow(run, _MEMBERS)


def assigned(residents: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Members with the nearest entry of ``books``, whether it is another than before (``moved``), and the squared distance."""
    shared = residents.sparkSession.sparkContext.broadcast(books)         # positions x entries x width numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in runs(batches, 1):
            position = part.column(0)[0].as_py()
            book = shared.value[position]
            at, error = nearest(_parts_of(part, 4, book.shape[1]), book)
            moved = at != part.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(0), pa.array(at), part.column(3), part.column(4), pa.array(moved), pa.array(error)],
                                             names=["row", "position", "entry", "salt", "part", "moved", "error"])

    return residents.select("position", "row", "entry", "salt", "part").mapInArrow(run, _MEMBERS + ", moved boolean, error long")


def settled(residents: DataFrame, books: list[np.ndarray], name: str) -> tuple[DataFrame, DataFrame]:
    """Reassigned members, and where they lie from now on: those that stay as written, those that move dealt anew."""
    now = materialise(assigned(residents, books), name)
    columns = ["row", "position", "entry", "salt", "part"]
    stay = now.filter(~F.col("moved")).select(*columns)
    come = materialise(now.filter("moved").select(*columns).repartition("position", "entry", "salt").sortWithinPartitions("position", "entry"), f"{name}-moved")
    return now, stay.union(come)


def updated(residents: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries replaced by their members' componentwise floored mean; entries without members stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for _, part in runs(batches, 1):
            position, width = part.column(0)[0].as_py(), shared.value[part.column(0)[0].as_py()]
            entry, parts = part.column(1).to_numpy(), _parts_of(part, 2, width)
            order = np.argsort(entry, kind="stable")
            own, starts, counts = np.unique(entry[order], return_index=True, return_counts=True)
            for e, n, total in zip(own.tolist(), counts.tolist(), np.add.reduceat(parts[order], starts, axis=0)):
                have = sums.setdefault((position, e), [0, np.zeros((2, width), np.int64)])
                have[0] += n
                have[1][0] += total >> 32                              # high and low halves: no sum overflows
                have[1][1] += total & 0xFFFFFFFF
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array([v[0] for v in sums.values()], pa.int64()),
             pa.array([v[1].ravel().tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["position", "entry", "n", "sums"])

    shared = residents.sparkSession.sparkContext.broadcast([b.shape[1] for b in books])
    own = residents.select("position", "entry", "part").mapInArrow(run, "position int, entry int, n long, sums array<long>")
    each = own.select("position", "entry", "n", F.posexplode("sums").alias("at", "value"))
    whole = each.groupBy("position", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [b.copy() for b in books]
    halves = {(r.position, r.entry, r["at"]): (r.n, int(r.value)) for r in whole.collect()}
    for (position, entry, at), (n, value) in halves.items():
        width = out[position].shape[1]
        if at < width:
            out[position][entry, at] = ((value << 32) + halves[position, entry, at + width][1]) // n
    return out


def digest(books: list[np.ndarray]) -> str:
    """Hex digest of all components in decimal, by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``row, vec_id, label, code, error`` of each kept vector, and the final codebooks.

    ``code`` lists the entries in part order; ``row`` is a number of the row within this result.
    """
    vectors = whole_vectors(embeddings)
    first = _first(vectors, 1)
    if not first:
        empty = vectors.select("row", "vec_id", "label", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
        return empty, []
    dims = len(first[0])
    vectors = vectors.filter(F.size("vector") == dims)
    cuts = np.cumsum([0, *widths(dims, parts)])
    start = np.array(_first(vectors, entries), np.int64)
    books = [start[:, s:e] for s, e in zip(cuts[:-1], cuts[1:])]
    residents = members(vectors, dims, parts)
    for r in range(rounds):
        _, residents = settled(residents, books, f"members-{r}")
        books = updated(residents, books)
    last = materialise(assigned(residents, books).select("row", "position", "entry", "error"), "final-entries")
    codes = last.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("position", "entry"))).alias("at"), F.sum("error").alias("error"))
    coded = vectors.select("row", "vec_id", "label").join(codes, "row")
    return coded.select("row", "vec_id", "label", F.transform("at", lambda p: p["entry"]).alias("code"), "error"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over rows of an equal label."""
    coded = materialise(coded, "coded-vectors")
    sums = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")     # a plain side: the join can split a label
    sums = sums.select(F.col("label").alias("of"), "label_error")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def hex_code(code: Column) -> Column:
    return F.lower(F.array_join(F.transform(code, lambda e: F.lpad(F.hex(e.cast("long")), 2, "0")), ""))
