"""Sharding by longest processing time.

Rows with equal texts form a group and stay together. Groups are scheduled by size, the
largest first, each to the least-loaded shard through a heap. The heap needs no names:
groups of one size are alike, so the driver gets one row per distinct size (at most the
root of twice all bytes), and a long run of equal sizes is dealt at once, with the loads
that single steps would leave. A group finds its shard by its place among the groups of
its size, counted in hash blocks.

Defined results: a null text counts as empty, is 8 bytes long and stays with empty
texts; repeated rows are rows of one group; slots count from 0 without gaps in each
shard and agree between runs; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.llm.common import text_of
from statlake.session import materialise

PIECE = 1 << 14                      # repeated rows that one row stands for at most when they are written out


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, list[tuple[int, int]]]:
    """(shard, number of groups) for each size of ``sizes`` (size, number of groups): longest first, to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, count in sorted(sizes, reverse=True):
        taken: Counter = Counter()
        if count > shards and size > 0:
            # Up to a level T, every shard below T takes groups until it is at T or above, whatever the order.
            low, high = heap[0][0], heap[0][0] + size * (count + 1)
            while low < high:
                middle = (low + high + 1) // 2
                if sum(-(-(middle - load) // size) for load, _ in heap if load < middle) <= count:
                    low = middle
                else:
                    high = middle - 1
            fill = {shard: max(0, -(-(low - load) // size)) for load, shard in heap}
            heap = [(load + fill[shard] * size, shard) for load, shard in heap]
            heapq.heapify(heap)
            taken.update(fill)
            count -= sum(fill.values())
        for _ in range(count if size > 0 else 1):
            load, shard = heap[0]
            taken[shard] += 1 if size > 0 else count
            heapq.heapreplace(heap, (load + size, shard))
        placed[size] = [(s, n) for s, n in sorted(taken.items()) if n]
    return placed


def _numbered(rows: DataFrame, within: str, order: list[str], weight: Column, out: str) -> DataFrame:
    """``rows`` with ``out``: the weights of the rows before, in each ``within``; rows are counted in hash blocks, about as many as a block has rows."""
    most = rows.groupBy(within).count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, int(most ** 0.5))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks))).withColumn("weight", weight)
    counts = rows.groupBy(within, "block").agg(F.sum("weight").alias("n"))
    before = F.sum("n").over(Window.partitionBy(within).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialise(counts.select(within, "block", F.coalesce(before, F.lit(0)).alias("offset")), "shard-offsets")
    earlier = F.sum("weight").over(Window.partitionBy(within, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    local = rows.withColumn("local", F.coalesce(earlier, F.lit(0)))
    return local.join(offsets, [within, "block"]).withColumn(out, (F.col("offset") + F.col("local")).cast("long")).drop("block", "weight", "offset", "local")


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (with ``group`` long and ``size`` long) with ``shard``."""
    if shards < 1:
        raise ValueError("at least one shard")
    spark = rows.sparkSession
    groups = materialise(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("groups")).collect()              # distinct sizes: at most the root of twice all bytes
    ends = []
    for size, parts in schedule([(r["bytes"], r["groups"]) for r in sizes], shards).items():
        upto = 0
        for shard, n in parts:
            upto += n
            ends.append((size, upto, shard))
    ends = spark.createDataFrame(ends, "bytes long, upto long, shard int").groupBy("bytes").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("ends"))
    ends = materialise(ends, "shard-ends")
    placed = _numbered(groups, "bytes", ["group"], F.lit(1), "place").join(ends, "bytes")
    own = F.filter("ends", lambda e: F.col("place") < e["upto"])[0]["shard"]
    placed = materialise(placed.select("group", own.alias("shard")), "shard-of-group")        # a plain side: the join can split a group of many rows
    return rows.join(placed, "group")


def number(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``shard``) with ``slot``, gapless in each shard.

    Rows that are equal in all columns are counted first and written out again at the end, so
    neither a shard nor a row repeated without end is one task.
    """
    columns = rows.columns
    counted = materialise(rows.groupBy(*columns).agg(F.count("*").alias("copies")), "shard-counted")
    first = _numbered(counted, "shard", order, F.col("copies"), "first")
    few = first.filter(F.col("copies") <= PIECE).withColumn("slot", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)))
    many = first.filter(F.col("copies") > PIECE)
    starts = F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1, F.lit(PIECE).cast("long")))
    many = many.withColumn("start", starts).repartition("start")
    last = F.least(F.col("start") + PIECE, F.col("first") + F.col("copies")) - 1
    many = many.withColumn("slot", F.explode(F.sequence("start", last)))
    return few.select(*columns, "slot").union(many.select(*columns, "slot"))


def thin(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, group`` of each row; equal texts share a group."""
    content = text_of(text)
    return docs.select("doc_id", (F.octet_length(content) + 8).cast("long").alias("size"),
                       F.crc32(content.cast("binary")).alias("text_crc32"), F.xxhash64(content).alias("group"))


def shard_documents(docs: DataFrame, shards: int = 24, text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row."""
    placed = materialise(assign(materialise(thin(docs, text), "shard-rows"), shards), "shard-placed")
    return number(placed, ["doc_id", "group"]).select("doc_id", "size", "text_crc32", "shard", "slot")
