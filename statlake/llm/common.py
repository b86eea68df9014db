"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def text_of(column: str) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("long")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def runs(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Sorted batches cut where one of the first ``keys`` columns changes; the flag marks the first piece of a run."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = last is None or any(c[0] != x for c, x in zip(columns, last))
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        ends = [*np.flatnonzero(new).tolist(), batch.num_rows]
        if ends[0] > 0:
            yield False, batch.slice(0, ends[0])
        yield from ((True, batch.slice(s, e - s)) for s, e in pairwise(ends))
        last = [c[-1] for c in columns]
