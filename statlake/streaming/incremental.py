"""Updated datasets and new or changed records, as a batch plan and as a stream."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from statlake.sources.landing import RECORD, all_fields, spread, stripped

register_pickle_by_value(sys.modules[__name__])         # the state update travels with its jobs


def updated_since(listing: DataFrame, last_ingested: DataFrame) -> DataFrame:
    """Listed datasets whose source changed after their last ingestion, or that were never ingested."""
    j = listing.join(last_ingested.select("dataset_id", "last_ingested"), "dataset_id", "left")
    return j.filter(F.col("last_ingested").isNull() | (F.col("updated_at") > F.col("last_ingested")))


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*columns)


def new_or_changed(fetched: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Fetched rows that are not stored with the same key and content.

    One anti join on key and content hash answers both cases.
    """
    rest = [c for c in fetched.columns if c not in keys]
    old = stored.select(*[F.col(k).alias(f"_k_{k}") for k in keys], row_hash(rest).alias("_h"))
    cond = F.col("_hash") == F.col("_h")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return fetched.withColumn("_hash", row_hash(rest)).join(old, cond, "left_anti").drop("_hash")


def latest(versions: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """The newest version of every key."""
    rest = [c for c in versions.columns if c not in keys and c not in recency]
    return versions.groupBy(*keys).agg(F.max(F.struct(*recency, *rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


_STORED = "key string, version long, path string, text string"
KEY_GROUPS = 2048                   # groups of keys by hash; a group is one call, its keys share a row of state


def _changed(group: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest landed piece of every key of a group if its content is another than the stored one's; the state holds hash and version by key."""
    newest: dict[str, tuple] = {}
    for frame in pieces:
        for key, *row in zip(frame["key"], frame["landed"], frame["path"], frame["content"], frame["text"]):
            if key not in newest or row > newest[key]:
                newest[key] = row
    known = json.loads(state.get[0]) if state.exists else {}
    out = []
    for key, (_, path, content, text) in newest.items():
        before, version = known.get(key, (None, 0))
        if content != before:
            known[key] = (int(content), version + 1)
            out.append((key, version + 1, path, text))
    if out:
        state.update((json.dumps(known),))
        yield pd.DataFrame(out, columns=["key", "version", "path", "text"])


def stream_landing(spark: SparkSession, landing: str, out: str, checkpoint: str, keys: list[str], files_per_batch: int = 1000) -> None:
    """Append new and changed records of newly landed files, then stop.

    Files hold arrays, lone objects or lines of flat records with any fields, and are cut at
    closing braces; ``keys`` are landed field names. The state store keeps a hash of the content
    and a version number per key, so a batch reads nothing of what is stored. Keys are handled in
    ``KEY_GROUPS`` groups by hash, since a call costs more than a key; a batch touches the state of
    the groups it brings. Of several versions of a key within a batch the one landed last counts (time of its file, then its name). The file sink keeps each batch exactly once. Pieces
    that are no records are stored as well, see ``stored_failures``.
    """
    source = spark.readStream.option("maxFilesPerTrigger", files_per_batch).format("text").option("lineSep", "}").load(landing)
    piece = stripped("value")
    text = F.concat(piece, F.lit("}"))
    landed = source.select(F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_path").alias("path"), text.alias("text"),
                           F.from_json(text, RECORD).alias("record")).filter(F.col("text") != "}")
    own = F.to_json(F.array(*[F.element_at("record", F.lit(k)) for k in keys]), {"ignoreNullFields": "false"})
    sorted_record = F.array_sort(F.map_entries("record"))
    rows = landed.select("landed", "path", "text", F.when(F.col("record").isNotNull(), own).alias("own"), F.xxhash64(sorted_record, F.col("record").isNull()).alias("content"))
    rows = rows.select(F.coalesce("own", F.concat(F.lit("!"), "path", F.lit(" "), "text")).alias("key"), "landed", "path", "content", "text")
    changed = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(KEY_GROUPS))).groupBy("group").applyInPandasWithState(_changed, _STORED, "known string", "append", GroupStateTimeout.NoTimeout)
    query = changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stored_versions(spark: SparkSession, out: str) -> DataFrame:
    """Everything stored: key, version number, file and text."""
    return spark.read.schema(_STORED).parquet(out)


def stored_records(spark: SparkSession, out: str, fields: list[str] | None = None) -> DataFrame:
    """What ``stream_landing`` has stored: the newest version of every key, one column a field (a survey finds them if none are given)."""
    newest = latest(stored_versions(spark, out).filter(~F.col("key").startswith("!")), ["key"], ["version"])
    records = newest.select(F.from_json("text", RECORD).alias("record"))
    if fields is None:
        fields = [r[0] for r in records.select(F.explode(F.map_keys("record"))).distinct().collect()]
    return spread(records, all_fields(fields))


def stored_failures(spark: SparkSession, out: str) -> DataFrame:
    """(path, text) of pieces that were no records; files whose texts hold braces are read in whole by ``read_raw``."""
    return stored_versions(spark, out).filter(F.col("key").startswith("!")).select("path", "text")
