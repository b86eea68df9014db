"""Secret scan over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger
keeps, in two Parquet folders, which blob was scanned by which rule version and what
was found. A run scans only pairs the ledger has not seen and joins findings back to
all paths and versions, so a copy costs nothing and a new rule version scans only
itself.

Defined results: a null text is the empty text; repeated rows and versions are kept,
each with the findings of its blob; an empty table gives an empty result; extra
columns are ignored; positions count code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlake.llm.common import text_of
from statlake.session import materialise, scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds; a match stays if ``group`` of it has ``least`` code points."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    order: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three are the base kinds. For the character classes of `access` and `hex`
#: asking for the least length in the pattern finds the same runs and passes over the rest.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, 0),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18, 1),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16, 2),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, 3),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28, 4),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 27, 5),
)
BASE = ("assign", "access", "hex")
SCANNED, FOUND = "blob string, rule string", "blob string, kind string, rule string, kind_order int, start int, end int"


def _lengths(values: Column) -> Column:
    return F.transform(values, F.length)


def _found_by(rule: Rule, text: Column) -> Column:
    """Lengths of the pieces before each match, of the matches, and of the tested group."""
    pattern = F.lit(rule.pattern)
    wanted = F.array_contains("todo", rule.key) & text.rlike(rule.pattern)
    return F.when(wanted, F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"), F.lit(rule.order).alias("kind_order"), F.lit(rule.least).alias("least"),
        F.arrays_zip(_lengths(F.split(text, rule.pattern, -1)).alias("before"),
                     _lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("long"),
                     _lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("tested")).alias("matches")))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of ``blobs`` (``blob, text, todo``), one row each."""
    found = (blobs.select("blob", F.explode(F.array_compact(F.array(*[_found_by(r, F.col("text")) for r in rules]))).alias("f"))
             .select("blob", "f.kind", "f.rule", "f.kind_order", "f.least", F.posexplode("f.matches").alias("at", "m")))
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.before") + F.coalesce(F.col("m.long"), F.lit(0))).over(upto)
    return (found.withColumn("end", end.cast("int")).filter("m.tested >= least")
            .select("blob", "kind", "rule", "kind_order", (F.col("end") - F.col("m.long")).cast("int").alias("start"), "end"))


def create_ledger(spark: SparkSession, path: str) -> None:
    """Adds empty files, so that reading needs no test of the file system."""
    for part, schema in (("scanned", SCANNED), ("found", FOUND)):
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{part}")


def address(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``blob``, the SHA-256 of the content in lowercase hex."""
    return df.withColumn("blob", F.sha2(text_of(text).cast("binary"), 256))


def update_ledger(versions: DataFrame, blobs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan unseen (blob, rule version) pairs; ``versions`` has ``blob`` and the text, ``blobs`` the blobs to mark.

    Copies are folded before the shuffle, so a text that a third of the rows share
    travels once per input task. Findings are written before the pairs are marked; a
    run that dies between leaves findings that the next one repeats, and readers take
    them as a set.
    """
    spark = versions.sparkSession
    create_ledger(spark, ledger)
    seen = (spark.read.schema(SCANNED).parquet(f"{ledger}/scanned").groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    all_rules = F.array(*[F.lit(r.key) for r in rules])

    def unseen(df: DataFrame) -> DataFrame:
        todo = F.array_except(all_rules, F.coalesce("seen", F.array().cast("array<string>")))
        return df.join(seen, "blob", "left").withColumn("todo", todo).filter("size(todo) > 0")

    texts = versions.select("blob", text_of(text).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    marks = unseen(blobs.select("blob").distinct()).select("blob", F.explode("todo").alias("rule"))
    scan_blobs(unseen(texts), rules).write.mode("append").parquet(f"{ledger}/found")
    marks.write.mode("append").parquet(f"{ledger}/scanned")


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with ``spans``: the findings of their blobs, ordered by start, then kind."""
    found = versions.sparkSession.read.schema(FOUND).parquet(f"{ledger}/found")
    by_blob = (found.filter(F.col("rule").isin([r.key for r in rules])).groupBy("blob")
               .agg(F.array_sort(F.collect_set(F.struct("start", "kind_order", "end", "kind"))).alias("spans")))
    by_blob = materialise(by_blob, "secret-findings")        # a plain side, so that the join can split a blob that many rows share
    none = F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")
    return versions.join(by_blob, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def scan(df: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Bring the ledger up to date with ``df``; returns its rows without the text, with ``blob`` and ``spans``.

    Without ``ledger`` a new one is made in the shared folder. Columns of ``df`` named
    ``blob`` or ``spans`` are replaced.
    """
    ledger = ledger or scratch_path(df.sparkSession, "secret-ledger")
    versions = address(df.drop("blob", "spans"), text)
    addresses = materialise(versions.drop(text), "secret-addresses")
    update_ledger(versions, addresses, ledger, rules, text)
    return findings(addresses, ledger, rules)


def joined(spans: Column) -> Column:
    """``kind:start:end`` with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def is_kind(*kinds: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"].isin(list(kinds))
