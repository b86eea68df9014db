"""Top-n selections and ordered logic that stay distributed when one group is huge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from statlake.session import materialise



SALTS = 64


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows of every group, numbered from 1.

    The planner keeps ``n`` rows per group in every input task before the
    shuffle, so a hot group never travels whole; it does so for ``n`` below
    ``spark.sql.optimizer.windowGroupLimitThreshold``, which the session raises.
    What many input tasks keep of one group meets in pieces by input task
    first; any split into pieces gives the same result.
    """
    piece = Window.partitionBy(*keys, "_salt").orderBy(*order)
    kept = (df.withColumn("_salt", F.spark_partition_id() % SALTS).withColumn("_piece", F.row_number().over(piece))
            .filter(F.col("_piece") <= n).drop("_salt", "_piece"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return kept.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def first_of(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """First row per key by ascending order columns, as a map-side minimum."""
    rest = [c for c in columns if c not in keys and c not in order]
    one = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return one.select(*keys, *[F.col("_r")[c].alias(c) for c in columns if c not in keys])


def merge_ranked(first: DataFrame, second: DataFrame, key: str, rank: str) -> DataFrame:
    """Two ranked lists as one: all of the first, then what only the second has."""
    both = first.select(F.lit(0).alias("_s"), F.col(rank), key).unionByName(second.select(F.lit(1).alias("_s"), F.col(rank), key))
    one = both.groupBy(key).agg(F.min(F.struct("_s", rank)).alias("_r"))
    return one.select(key, F.col("_r._s").alias("source"), F.col("_r")[rank].alias(rank)).orderBy("source", rank, key)


def select_diverse(candidates: DataFrame, n: int) -> DataFrame:
    """Up to ``n`` datasets, an equal share per domain first, the rest by priority.

    Candidates carry dataset_id, domain, domain_seq, priority, seq. Both stages
    are top-n selections; only selected rows (at most ``n`` per stage and
    domain) are ever ordered together.
    """
    domains = candidates.agg(F.countDistinct("domain").alias("d"))
    share = domains.select(F.greatest(F.lit(1), F.floor(F.lit(n) / F.greatest(F.col("d"), F.lit(1)))).cast("int").alias("q"))
    order = [F.desc("priority"), F.asc("domain_seq"), F.asc("seq")]
    best = top_per_group(candidates, ["domain"], order, n).filter(F.col("rn") <= share.scalar())
    best = first_of(best, ["dataset_id"], ["domain_seq", "rn"], ["dataset_id", "domain", "domain_seq", "rn", "priority", "seq"])
    lead = best.filter(F.col("rn") == 1).groupBy("domain").agg(
        F.min(F.struct((-F.col("priority")).alias("k1"), F.col("domain_seq").alias("k2"), F.col("seq").alias("k3"))).alias("_d"))
    keys = ["k1", "k2", "k3", "k4"]
    stage1 = (best.join(lead, "domain").select("dataset_id", "domain", "priority", F.lit(1).alias("stage"), "_d.*", F.col("rn").alias("k4"))
              .orderBy(*keys).limit(n))
    # Stage two needs at most n rows beside those already taken; 2n by priority always hold them.
    pool = first_of(candidates.withColumn("k1", -F.col("priority")), ["dataset_id"], ["k1", "domain_seq", "seq"],
                    ["dataset_id", "k1", "domain_seq", "seq", "domain", "priority"])
    pool = pool.orderBy("k1", "domain_seq", "seq").limit(2 * n).join(stage1.select("dataset_id"), "dataset_id", "left_anti")
    stage2 = pool.select("dataset_id", "domain", "priority", F.lit(2).alias("stage"), "k1", F.col("domain_seq").alias("k2"),
                         F.col("seq").alias("k3"), F.lit(0).alias("k4"))
    return (stage1.unionByName(stage2).orderBy("stage", *keys).limit(n).select("dataset_id", "domain", "priority", "stage"))


def top_with_priority(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """Top ``n`` per group; the best of a group of size m gets priority m, the next m - 1 ..."""
    best = top_per_group(df, [group], order, n)
    size = best.groupBy(group).agg(F.max("rn").alias("_m"))
    return best.join(size, group).withColumn("priority", F.col("_m") - F.col("rn") + 1).drop("_m")


def range_blocks(df: DataFrame, columns: list[str], blocks: int | None = None) -> DataFrame:
    """Rows written with ``_block``: ranges of the columns with about equal counts, in their order."""
    dealt = df.repartitionByRange(blocks, *columns) if blocks else df.repartitionByRange(*columns)
    return materialise(dealt.withColumn("_block", F.spark_partition_id()), "range-blocks")      # block numbers must not change


def lag_by_blocks(df: DataFrame, key: str, order: list[str], column: str, out: str, blocks: int | None = None) -> DataFrame:
    """Previous value of ``column`` within a key. A key is cut by ranges of (key, order), so one with many rows is many tasks.

    A block brings its own lags; where a key starts in a block, the value is the last one
    of the key's block before. That summary has one row per key and block.
    """
    cut = range_blocks(df, [key, *order], blocks)
    summary = cut.groupBy(key, "_block").agg(F.max(F.struct(*order, column)).alias("_l"))
    before = summary.select(key, "_block", F.lag(F.col("_l")[column]).over(Window.partitionBy(key).orderBy("_block")).alias("_prev"))
    w = Window.partitionBy("_block", key).orderBy(*order)
    local = cut.withColumn("_rn", F.row_number().over(w)).withColumn("_lag", F.lag(column).over(w))
    # Only the first rows of a key in a block need the summary; rows without a key are none.
    joined = local.join(before, (local[key].eqNullSafe(before[key])) & (local["_block"] == before["_block"]), "left").drop(before[key], before["_block"])
    return joined.withColumn(out, F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("_lag"))).drop("_block", "_rn", "_lag", "_prev")


def status_transitions(events: DataFrame) -> DataFrame:
    """One row per status change of a dataset: from, to, time, error."""
    out = lag_by_blocks(events, "dataset_id", ["ts", "event_id"], "status", "from_status")
    changed = F.col("from_status").isNull() | (F.col("from_status") != F.col("status"))
    return out.filter(changed).select("dataset_id", "from_status", F.col("status").alias("to_status"), F.col("ts").alias("timestamp"),
                                      "error_message", "event_id")


# --- exact percentiles -------------------------------------------------------------------------

def exact_percentiles(df: DataFrame, group: str, value: str, points: list[float], blocks: int | None = None, interpolate: bool = True) -> DataFrame:
    """Exact percentiles, one row per group and point: interpolated, or else the first value that reaches the share.

    The built-in exact aggregate holds all distinct values of a group in one
    buffer. Here the distinct values are counted, range-partitioned over all
    groups and written; a group's ranks run through its blocks by one total per
    block, and only blocks that hold a wanted rank are ordered. A task thus
    holds one block, whose size is the data over the number of blocks
    (``blocks``, else the session's shuffle partitions), however large a group is.
    """
    rows = df.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("v"))
    counted = rows.groupBy(group, "v").agg(F.count("*").alias("c"))
    cut = counted.repartitionByRange(blocks, group, "v") if blocks else counted.repartitionByRange(group, "v")
    cut = materialise(cut.withColumn("block", F.spark_partition_id()), "ranked")      # block numbers must not change
    sums = cut.groupBy(group, "block").agg(F.sum("c").alias("size"))
    of_group = Window.partitionBy(group)
    upto = F.sum("size").over(of_group.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = sums.select(group, "block", "size", (upto - F.col("size")).alias("before"), F.sum("size").over(of_group).alias("n"))
    # Positions are zero-based: the value at position i is the first with cumulative count above i.
    p = F.col("p")
    exact = p * (F.col("n") - 1) if interpolate else F.greatest(F.ceil(p * F.col("n")) - 1, F.lit(0)).cast("double")
    wanted = (sums.withColumn("p", F.explode(F.array(*[F.lit(float(x)) for x in points])))
              .withColumn("pos", exact).withColumn("i", F.floor("pos")).withColumn("j", F.ceil("pos"))
              .filter((F.col("before") <= F.col("j")) & (F.col("i") < F.col("before") + F.col("size"))))
    w = Window.partitionBy(group, "block").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cut.join(wanted.select(group, "block").distinct(), [group, "block"], "left_semi").withColumn("last", F.sum("c").over(w))
    hit = ranked.join(wanted, [group, "block"])
    last = F.col("before") + F.col("last")
    first = last - F.col("c")

    def at(i):
        return F.max(F.when((first <= F.col(i)) & (F.col(i) < last), F.col("v")))
    picked = hit.groupBy(group, "p", "pos").agg(at("i").alias("x"), at("j").alias("y"))
    return picked.select(group, p.alias("point"), (F.col("x") + (F.col("y") - F.col("x")) * (F.col("pos") - F.floor("pos"))).alias("value"))
