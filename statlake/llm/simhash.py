"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit where over half of its shingle hashes have it. Distinct
fingerprints are cut into segments. If two differ in at most ``r`` bits and there are
``m`` segments, then with ``a, b = divmod(r, m)`` they differ in at most ``a`` bits in
one of the first ``b + 1`` segments, or in at most ``a - 1`` in one of the others. So
each fingerprint is stored under the value of each segment, and looks up the small
Hamming ball around its own values; whatever meets is compared in full.

Copies are folded into one fingerprint before anything meets. What meets in a bucket
is linked by a search that compares an undecided fingerprint only with those not yet
reached, and leaves one link per fingerprint, not all pairs. Stored and looked-up entries
of buckets beyond ``CHUNK`` entries are cut into chunks that meet pairwise in tasks of
their own.

Defined results: null texts and texts without words have fingerprint zero and are
linked like any other; fewer words than a shingle form one shingle; ``component_id``
ignores null ids and is null only where all ids of a component are; repeated rows stay;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import fresh, text_of
from statlake.session import materialise

SHINGLE, RADIUS, SEGMENTS, BITS = 4, 4, 3, 64
CHUNK = 50_000
HASHES_AT_ONCE = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, in blocks."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().split()       # of bytes: A-Z, and space and U+0009 to U+000D
    if not raw:
        return
    joined = b" ".join(raw)
    ends = np.cumsum([len(w) + 1 for w in raw]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(raw) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if len(raw) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHES_AT_ONCE):
        yield np.array([digest(joined[s:e], 42) for s, e in zip(first[at:at + HASHES_AT_ONCE], last[at:at + HASHES_AT_ONCE])], dtype="<u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash; counts bits over blocks of shingles, so memory is bounded by the text."""
    counts, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, content, fp`` of each row; ``content`` is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "content", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("content"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, content long, fp long")


def segments(count: int = SEGMENTS) -> list[tuple[int, int]]:
    """(lowest bit, width) of each."""
    widths = [BITS // count + (i < BITS % count) for i in range(count)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def ball(width: int, radius: int) -> list[int]:
    """Masks that change 1 to ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)]


def _keys(fp: Column, radius: int, count: int) -> Column:
    """Array of (key, stored): the segment values, and the values looked up around them."""
    a, b = divmod(radius, count)
    out = []
    for i, (low, width) in enumerate(segments(count)):
        reach = a if i <= b else a - 1
        if reach < 0:
            continue
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
        key = value + F.lit(i << 48)
        out.append(F.array(F.struct(key.alias("key"), F.lit(True).alias("stored"))))
        masks = ball(width, reach)
        if masks:                                # the tag is above all segment bits, so the whole key can be flipped
            out.append(F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), _flipped(key)))
    return F.concat(*out)


def _flipped(key: Column) -> Callable[[Column], Column]:
    return lambda mask: F.struct(key.bitwiseXOR(mask).alias("key"), F.lit(False).alias("stored"))


def _reach(fps: np.ndarray, stored: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) of a spanning forest over the entries of one bucket.

    Stored entries meet all, looked-up entries meet stored ones. ``left`` shrinks as
    entries are reached, so a dense bucket costs about its size.
    """
    left, found = np.arange(len(fps)), ([], [])
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            if not stored[at]:
                near &= stored[left]
            if near.any():
                hit = left[near]
                found[0].append(np.full(len(hit), fps[at]))
                found[1].append(fps[hit])
                queue.extend(hit.tolist())
                left = left[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(found[0]), np.concatenate(found[1])) if found[0] else (none, none)


def _links_of(groups: np.ndarray, fps: np.ndarray, stored: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``groups``; runs of two are compared all at once."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(groups)]]))
    some = np.add.reduceat(stored.astype(np.int64), starts) > 0 if len(starts) else np.empty(0, bool)
    two = starts[(sizes == 2) & some]
    near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius
    out = [(fps[two][near], fps[two + 1][near])]
    for s, n in zip(starts[(sizes > 2) & some].tolist(), sizes[(sizes > 2) & some].tolist()):
        out.append(_reach(fps[s:s + n], stored[s:s + n], radius))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def links(fps: DataFrame, radius: int = RADIUS, count: int = SEGMENTS, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between distinct ``fp`` that connect all pairs at distance up to ``radius``."""
    entries = fps.select("fp", F.inline(_keys(F.col("fp"), radius, count)))
    kinds = entries.groupBy("key").agg(F.count_if("stored").alias("held"), F.count_if(~F.col("stored")).alias("asked"))
    large = (kinds.filter((F.col("held") > 0) & (F.col("held") + F.col("asked") > chunk))
             .select("key", F.ceil(F.col("held") / chunk).cast("int").alias("s"), F.greatest(F.lit(1), F.ceil(F.col("asked") / chunk)).cast("int").alias("q")))
    large = materialise(large, "large-buckets")
    mix, stored, asked = F.xxhash64("fp"), F.sequence(F.lit(0), F.col("s") - 1), F.sequence(F.lit(0), F.col("q") - 1)
    own, at = F.pmod(mix, "s").cast("int"), F.pmod(mix, "q").cast("int")
    # Chunks of stored entries meet each other, and each chunk of looked-up ones.
    among = F.array_distinct(F.transform(stored, lambda j: F.greatest(own, j) * F.col("s") + F.least(own, j)))
    tasks = F.when(F.col("s").isNull(), F.array(F.lit(0))).when(
        F.col("stored"), F.concat(among, F.transform(asked, lambda j: F.col("s") * F.col("s") + own * F.col("q") + j))).otherwise(
        F.transform(stored, lambda i: F.col("s") * F.col("s") + i * F.col("q") + at))
    split = entries.join(large, "key", "left").select("key", F.explode(tasks).alias("part"), "fp", "stored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(table):
            order = np.cumsum(np.concatenate([[False], (table["key"][1:] != table["key"][:-1]) | (table["part"][1:] != table["part"][:-1])]))
            a, b = _links_of(order, table["fp"], table["stored"], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list[dict[str, np.ndarray]] = []                # pieces of the last bucket, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            new = {"key": batch.column(0).to_numpy(), "part": batch.column(1).to_numpy(), "fp": batch.column(2).to_numpy().view(np.uint64),        # bits of signed numbers are counted otherwise
                   "stored": batch.column(3).to_numpy(zero_copy_only=False)}
            same = (new["key"] == new["key"][-1]) & (new["part"] == new["part"][-1])
            cut = len(same) - int(same.sum())
            goes_on = held and held[-1]["key"][-1] == new["key"][-1] and held[-1]["part"][-1] == new["part"][-1]
            if cut or (held and not goes_on):
                done = [*held, {k: v[:cut] for k, v in new.items()}]
                yield emit({k: np.concatenate([d[k] for d in done]) for k in new})
                held = []
            held.append({k: v[cut:] for k, v in new.items()})
        if held:
            yield emit({k: np.concatenate([d[k] for d in held]) for k in held[0]})

    dealt = split.repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): the least node of its component.

    Alternates linking every neighbour to the least one (large star) and every node to
    its least smaller neighbour (small star) until nothing changes. Neighbourhoods are
    only ever reduced to their minimum, never collected; each round is written and read
    back. The driver sees two numbers a round.
    """
    def oriented(df: DataFrame) -> DataFrame:
        return df.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    edges, mark = materialise(oriented(edges), "links"), None
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        own = materialise(least(both).select("u", F.least("u", "m").alias("m")), "least-neighbours")       # a plain side: the join can split a hub
        star = both.filter("v > u").join(own, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        star = materialise(oriented(star), "large-star")
        down = star.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = materialise(least(down), "least-below")
        small = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        edges = materialise(oriented(small), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(docs: DataFrame, radius: int = RADIUS, count: int = SEGMENTS, text: str = "text") -> DataFrame:
    """``doc_id, content, fp, root`` of each row; ``root`` is the least fingerprint of the component."""
    rows = materialise(fingerprints(docs, text), "fingerprints")
    distinct = materialise(rows.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, radius, count)).withColumnRenamed("node", "fp")
    return rows.join(roots, "fp", "left").select("doc_id", "content", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, count: int = SEGMENTS, text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row."""
    rows = materialise(grouped(docs, radius, count, text), "grouped-rows")
    # Written, so that the join has a plain side and can split a component that many rows share.
    ids = materialise(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rows.join(ids, "root").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, radius: int = RADIUS, count: int = SEGMENTS, text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the least id; of repeated rows one, null ids last.

    Shingles and distance are those of ``near_duplicates``.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("kept")
    own, content, kept_own, kept_content = (fresh(docs, name) for name in ("key", "content", "kept_key", "kept_content"))
    kept = grouped(docs, radius, count, text).groupBy("root").agg(first).select(
        _row_key("kept.doc_id").alias(kept_own), F.col("kept.content").alias(kept_content))
    kept = materialise(kept, "kept-rows")
    rows = docs.withColumn(own, _row_key("doc_id")).withColumn(content, F.xxhash64(text_of(text)))
    return (rows.join(kept, (F.col(own) == F.col(kept_own)) & (F.col(content) == F.col(kept_content)), "left_semi")
            .dropDuplicates([own, content]).drop(own, content))


def _row_key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("null"))
