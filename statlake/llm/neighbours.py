"""Nearest neighbours by cosine over randomly rotated one-bit codes.

Every vector is normalised, rotated by a random orthogonal matrix (from a seed, so
every task makes the same one) and kept as the signs of its coordinates, packed into
64-bit words, with one correction scalar: the inner product of the unit vector and its
code. A query is rotated and rounded at random to four bits, so that inner products
with codes are bit counts. Divided by the scalar they estimate the cosine without bias;
the scalar also bounds the error with a chosen confidence. Within a block a candidate
is computed exactly, in double precision, unless its upper bound is below the k-th
largest lower bound of the query there.

Queries and candidates meet in packed blocks. Candidate blocks form a bounded number
of groups, query blocks are sent to every group, and each pair of blocks is worked off by
itself: no vector meets another as a row, nothing is broadcast or collected. Work is
queries times candidates, as the task states a query set against all rows.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors meet those of their own length; ties go to the smaller
vec_id; a query's own vec_id is no candidate, even if repeated; other repeated rows are
candidates each; null ids take no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.session import materialise

BLOCK, QUERY_BLOCK, GROUP_BLOCKS = 1024, 256, 4
#: Most groups, a task each; beyond, a group has more blocks, so that queries travel no more often.
MOST_TASKS = 4096
QUERY_BITS = 4
#: Error bound in standard deviations of the estimate.
CONFIDENCE = 3.5
SEED = 11


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def padded(dims: int) -> int:
    return -(-dims // 64) * 64


def rotated(vectors: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Unit vectors, filled up with zeros to whole words, rotated."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    width = padded(vectors.shape[1])
    return np.pad(unit, ((0, 0), (0, width - vectors.shape[1]))) @ rotation(width, seed)


def encode(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows of 64-bit words) and correction scalars."""
    turned = rotated(vectors, seed)
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
    return codes, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def estimates(query: np.ndarray, codes: np.ndarray, scalars: np.ndarray, rng: np.random.Generator,
              confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of one rotated query with all codes, and their error bounds."""
    width = len(query)
    low = query.min()
    step = (query.max() - low) / ((1 << QUERY_BITS) - 1) or 1.0
    levels = np.clip(np.floor((query - low) / step + rng.random(width)), 0, (1 << QUERY_BITS) - 1).astype(np.uint8)
    inner = np.zeros(len(codes), dtype=np.int64)
    for bit in range(QUERY_BITS):
        plane = np.packbits((levels >> bit) & 1, bitorder="little").view("<u8")
        inner += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << bit
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    # signs are 2 * code - 1; the query is low + step * levels
    dot = (2 * (step * inner + low * ones) - (step * int(levels.sum()) + low * width)) / np.sqrt(width)
    spread = np.sqrt(np.maximum(0.0, 1 - scalars ** 2)) / scalars / np.sqrt(max(1, width - 1))
    rounding = step / 2 / scalars                       # of a query rounded at random, against signs over the root of width
    return dot / scalars, confidence * np.sqrt(spread ** 2 + rounding ** 2)


def usable(embedding: Column) -> Column:
    """At least one component, none null or not finite, not all zero."""
    x = embedding.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & (F.size(x) > 0) & F.exists(x, lambda v: v != 0), F.lit(False))


def vectors_of(df: DataFrame, block: int) -> DataFrame:
    """Usable vectors, dealt into blocks of about ``block`` rows by a hash of the id and the vector."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("dims", F.size("vector"))
    return rows.withColumn("mix", F.xxhash64("vec_id", "vector"))


def packed(rows: DataFrame, size: int, with_codes: bool) -> DataFrame:
    """``dims, block, ids, vectors[, codes, scalars]`` as binary, one row a block of at most ``size`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def emit(dims: int, upto: int):
            ids, vectors = held[dims][0][:upto], held[dims][1][:upto]
            held[dims] = [held[dims][0][upto:], held[dims][1][upto:]]
            codes, scalars = encode(vectors) if with_codes else (np.empty(0, "<u8"), np.empty(0))
            columns = [pa.array([dims], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in (ids, vectors, codes, scalars)]
            return pa.RecordBatch.from_arrays(columns, names=["dims", "ids", "vectors", "codes", "scalars"])

        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            flat, offsets = batch.column(1).flatten().to_numpy(), np.concatenate([[0], np.cumsum(dims)])
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                part = flat.reshape(-1, d) if len(own) == len(dims) else np.stack([flat[offsets[i]:offsets[i + 1]] for i in own])
                have = held.get(d) or [np.empty(0, np.int64), np.empty((0, d))]
                held[d] = [np.concatenate([have[0], ids[own]]), np.concatenate([have[1], part])]
                while len(held[d][0]) >= size:
                    yield emit(d, size)
        for d in list(held):
            if len(held[d][0]):
                yield emit(d, len(held[d][0]))

    return rows.select("vec_id", "vector", "dims").mapInArrow(run, "dims int, ids binary, vectors binary, codes binary, scalars binary")


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines, row by row, so that equal vectors get equal values wherever they stand."""
    norm = np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / (norm * np.sqrt((vectors * vectors).sum(axis=1)))


def block_top(query_ids, queries, ids, vectors, codes, scalars, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the k best candidates of the block: exact for all that the bounds leave."""
    for query_id, query, turned in zip(query_ids.tolist(), queries, rotated(queries)):
        guess, bound = estimates(turned, codes, scalars, np.random.default_rng([SEED, query_id & 0x7FFFFFFF]))
        other = np.flatnonzero(ids != query_id)
        if not len(other):
            continue
        lower = (guess - bound)[other]
        if len(other) > k:
            other = other[(guess + bound)[other] >= np.partition(lower, len(lower) - k)[len(lower) - k]]
        score = exact(query, vectors[other])
        best = np.lexsort((ids[other], -score))[:k]
        yield query_id, ids[other][best], score[best]


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each row whose id is divisible by ``every``."""
    rows = vectors_of(embeddings, BLOCK)
    candidates = materialise(packed(rows, BLOCK, True).withColumn("group", F.monotonically_increasing_id()), "code-blocks")
    # Blocks are grouped by number within the folder written, so groups are fixed from here on.
    count = candidates.count()
    groups = min(max(1, -(-count // GROUP_BLOCKS)), MOST_TASKS)
    candidates = candidates.withColumn("group", F.pmod(F.xxhash64("group"), F.lit(groups)))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    queries = materialise(packed(queries.repartition(F.pmod("mix", F.lit(1 << 10))), QUERY_BLOCK, False), "query-blocks")
    sent = queries.select("dims", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    # Blocks are few and small beside the work they make, so the number of tasks is set, not found from their size.
    pairs = candidates.repartition(groups, "dims", "group").join(sent.repartition(groups, "dims", "group").hint("shuffle_merge"), ["dims", "group"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dims = batch.column(0)[row].as_py()
                q_ids, q, ids, v, codes, scalars = (np.frombuffer(batch.column(i)[row].as_py(), dtype=t) for i, t in
                                                    ((1, "<i8"), (2, "<f8"), (3, "<i8"), (4, "<f8"), (5, "<u8"), (6, "<f8")))
                found = list(block_top(q_ids, q.reshape(-1, dims), ids, v.reshape(-1, dims), codes.reshape(len(ids), -1), scalars, k))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                         pa.array(np.concatenate([f[1] for f in found]), pa.int64()), pa.array(np.concatenate([f[2] for f in found]), pa.float64())],
                        names=["query_id", "vec_id", "score"])

    found = pairs.select("dims", "q_ids", "q_vectors", "ids", "vectors", "codes", "scalars").mapInArrow(
        run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
