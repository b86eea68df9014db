"""Reading what an API client landed: raw records, envelopes, listing pages, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlake import rules
from statlake.functions import scalars as S
from statlake.operators.infer import list_or_one
from statlake.operators.mapping import rename_raw, split_dimension
from statlake.schemas import RAW_FIELDS

#: A landed record: every field it has, as text.
RECORD = "map<string,string>"
_CLOSE = "}"
BLANK = " \t\n\x0b\f\r"
BEFORE = BLANK + "[],\ufeff"                 # what stands between records


def stripped(piece: str) -> Column:
    """A piece without what stands around it; brackets at its end are its own."""
    return F.rtrim(F.ltrim(piece, F.lit(BEFORE)), F.lit(BLANK))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, piece, record): files cut at closing braces, wherever their lines end.

    A flat record ends at its brace, whether it stands in an array, alone or on a line of
    its own, so files split across tasks. A piece that is not a record has a null ``record``.
    """
    piece = stripped("value")
    cut = spark.read.text(path, lineSep=_CLOSE).select(F.col("_metadata.file_path").alias("path"), piece.alias("piece")).filter("piece <> ''")
    return cut.withColumn("record", F.from_json(F.concat("piece", F.lit(_CLOSE)), RECORD))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, piece, record) of files read by lines, for records that hold braces and end with their line.

    No JSON text holds a bare line break, so where every line of a file is made of whole objects
    these are its records, and the file splits. Elsewhere some line gives a null ``record``.
    """
    piece = F.rtrim(F.ltrim("value", F.lit(BEFORE)), F.lit(BEFORE))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), piece.alias("piece")).filter("piece <> ''")
    values = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "piece", F.lit("]"))), "$", "array<variant>")
    each = lines.withColumn("v", F.coalesce(values, F.array(F.lit(None).cast("variant"))))
    return each.select("path", "piece", F.explode("v").alias("v")).select("path", "piece", F.try_variant_get("v", "$", RECORD).alias("record"))


def _whole(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, piece, record) of files read whole, for records that hold braces and line breaks: an array, or values one after the other.

    No JSON text holds a bare line break, so one between brackets ends a value. If a file is no
    JSON as a whole, its lines count by themselves.
    """
    docs = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))
    values = F.regexp_replace("doc", r"([}\]])\s*\n\s*([{\[])", "$1,$2")
    v = F.try_parse_json(F.concat(F.lit("["), values, F.lit("]")))
    inner = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array(x)))
    elements = F.transform(F.flatten(inner), lambda x: F.struct(F.lit("").alias("piece"), x.alias("v")))
    lines = F.transform(F.filter(F.split("doc", "\r?\n"), lambda x: F.trim(x) != ""),
                        lambda x: F.struct(x.alias("piece"), F.when(x.rlike(r"^\s*\{.*\}[\s,\]]*$"), F.try_parse_json(x)).alias("v")))
    each = docs.select("path", F.explode(F.when(v.isNotNull(), elements).otherwise(lines)).alias("e"))
    return each.select("path", F.col("e.piece").alias("piece"), F.try_variant_get(F.col("e.v"), "$", RECORD).alias("record"))


def _survey(pieces: DataFrame) -> tuple[list[str], list[str]]:
    """Field names met, and files with pieces that are no records; both are folded where they are read."""
    met = pieces.select(F.map_keys("record").alias("fields"), F.when(F.col("record").isNull(), F.col("path")).alias("odd")).distinct()
    rows = met.select(F.explode_outer("fields").alias("field"), "odd").distinct().collect()    # one row a field name, one an odd file
    return [r["field"] for r in rows if r["field"] is not None], sorted(r["odd"] for r in rows if r["odd"] is not None)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed records as (path, record): all fields, whatever their names. Arrays, lone objects and JSON lines alike."""
    return _records(spark, path)[0]


def _records(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    pieces = _pieces(spark, path)
    fields, odd = _survey(pieces)
    if odd:
        lines = _lines(spark, odd)
        more, hard = _survey(lines)
        if hard:
            whole = _whole(spark, hard)
            lines = _without(lines, hard).unionByName(whole)
            more, _ = _survey(lines)
        fields, pieces = sorted({*fields, *more}), _without(pieces, odd).unionByName(lines)
    return pieces.filter(F.col("record").isNotNull()).select("path", "record"), fields


def _without(pieces: DataFrame, paths: list[str]) -> DataFrame:
    return pieces.join(pieces.sparkSession.createDataFrame([(x,) for x in paths], "path string"), "path", "left_anti")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """(path, piece) of what is no record in landed files, read whole if need be; an empty piece stands for an element of an array."""
    _, odd = _survey(_pieces(spark, path))
    hard = _survey(_lines(spark, odd))[1] if odd else []
    if not hard:
        return spark.createDataFrame([], "path string, piece string")
    return _whole(spark, hard).filter(F.col("record").isNull()).select("path", "piece")


def all_fields(names: list[str]) -> list[str]:
    """The fields every landing may have, in their order, then all others by name."""
    return [*RAW_FIELDS, *sorted(set(names) - set(RAW_FIELDS))]


def spread(records: DataFrame, fields: list[str], record: str = "record") -> DataFrame:
    """One renamed column a field in place of the record."""
    keep = [c for c in records.columns if c != record]
    return rename_raw(records.select(*keep, *[F.element_at(record, F.lit(f)).alias(f) for f in fields]))


def read_raw(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Landed records as all-text rows, one column a field.

    Without ``fields`` the files are surveyed first, and a column is made of every field
    that occurs. With them files are read once, and each must be cut at its braces.
    """
    if fields is not None:
        return spread(_pieces(spark, path).filter(F.col("record").isNotNull()).select("record"), all_fields(fields))
    records, names = _records(spark, path)
    return spread(records.select("record"), all_fields(names))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (path, doc), for API envelopes."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


DATA_PATH = "$.GET_STATS_DATA.STATISTICAL_DATA"
LIST_PATH = "$.GET_STATS_LIST.DATALIST_INF.TABLE_INF"


def _values(docs: DataFrame, doc: str) -> DataFrame:
    v = docs.withColumn("_v", F.try_parse_json(doc))
    return v.withColumn("_values", list_or_one(F.col("_v"), f"{DATA_PATH}.DATA_INF.VALUE", RECORD))


def unwrap_records(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Observations of data envelopes with all their fields, as ``record``; ``VALUE`` is a list or one object."""
    keep = [c for c in docs.columns if c != doc]
    return _values(docs, doc).select(*keep, F.explode("_values").alias("record"))


def unwrap_data(docs: DataFrame, doc: str = "doc", fields: list[str] | None = None) -> DataFrame:
    """Observations of data envelopes, one column a field; a survey finds the fields where none are given."""
    records = unwrap_records(docs, doc)
    if fields is None:
        fields = [r[0] for r in records.select(F.explode(F.map_keys("record"))).distinct().collect()]
    return spread(records, all_fields(fields))


def unwrap_failures(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Envelopes that hold no observations, with the reason."""
    keep = [c for c in docs.columns if c != doc]
    v = _values(docs, doc).filter(F.col("_values").isNull())
    return v.select(*keep, F.when(F.col("_v").isNull(), "not JSON").otherwise("no VALUE").alias("error"))


def unwrap_listing(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Dataset rows of listing envelopes."""
    keep = [c for c in docs.columns if c != doc]
    v = docs.withColumn("_v", F.try_parse_json(doc))
    one = F.try_variant_get("_v", LIST_PATH, "variant")
    rows = v.select(*keep, F.explode(F.coalesce(F.try_variant_get("_v", LIST_PATH, "array<variant>"), F.array(one))).alias("t"))
    t = F.col("t")

    def plain(name):
        return F.coalesce(F.try_variant_get(t, f"$.{name}", "string"), F.lit(""))
    return rows.select(*keep, F.coalesce(F.try_variant_get(t, '$["@id"]', "string"), F.lit("")).alias("id"),
                       S.text_of(t, "$.TITLE").alias("title"), S.text_of(t, "$.GOV_ORG").alias("organization"),
                       S.text_of(t, "$.STATISTICS_NAME").alias("statistics_name"), plain("SURVEY_DATE").alias("survey_date"),
                       plain("OPEN_DATE").alias("open_date"), plain("UPDATED_DATE").alias("updated_date"))


def merge_pages(rows: DataFrame, batch_size: int, page: str = "page") -> DataFrame:
    """All landed listing rows; ``after_short`` marks those of pages after the first one that is not full."""
    pages = rows.groupBy(page).agg(F.count("*").alias("_n"))
    end = pages.filter(F.col("_n") < batch_size).agg(F.min(page)).scalar()
    return rows.withColumn("after_short", F.coalesce(F.col(page) > end, F.lit(False)))


def _planned(max_records: int | None):
    return F.col("total") if max_records is None else F.least(F.col("total"), F.lit(max_records))


def chunk_plan(totals: DataFrame, chunk_size: int = rules.CHUNK_SIZE, max_records: int | None = None) -> DataFrame:
    """(dataset_id, total) to one row per chunk with its first record number (from 1); covers the total unless told otherwise."""
    n = F.ceil(_planned(max_records) / chunk_size).cast("int")
    chunks = totals.filter(n > 0).select("dataset_id", "total", n.alias("num_chunks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_num"))
    return chunks.withColumn("start_position", F.col("chunk_num").cast("bigint") * chunk_size + 1)


def retrieval_plan(totals: DataFrame, chunk_size: int = rules.CHUNK_SIZE, max_records: int | None = None) -> DataFrame:
    """One read up to ``chunk_size`` records, chunks beyond; ``max_records`` is the caller's, none by default."""
    single = F.col("total") <= chunk_size
    wanted = _planned(max_records)
    return totals.select("dataset_id", "total", F.when(single, "single").otherwise("chunked").alias("retrieval_mode"),
                         F.when(single, 1).otherwise(F.ceil(wanted / chunk_size).cast("int")).alias("num_chunks"),
                         (wanted < F.col("total")).alias("truncated"))


def merge_chunks(chunk_rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows of the chunks that succeeded (dataset_id, chunk_num, ok); failed chunks are skipped.

    Chunk order is a sort key of the result for those who read it in order; no global sort is forced here.
    """
    return chunk_rows.join(chunks.filter("ok").select("dataset_id", "chunk_num"), ["dataset_id", "chunk_num"], "left_semi")


def in_chunk_order(rows: DataFrame, position: str) -> DataFrame:
    """Range-sorted by chunk, with the record position as tie-breaker so that big chunks split."""
    return rows.orderBy("dataset_id", "chunk_num", position)


def completeness_audit(chunk_rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per dataset: failed chunks, rows received against the total, and whether it is complete."""
    got = chunk_rows.groupBy("dataset_id").agg(F.count("*").alias("received"))
    want = chunks.groupBy("dataset_id").agg(F.max("total").alias("total"), F.count_if(~F.col("ok")).alias("failed_chunks"))
    j = want.join(got, "dataset_id", "left").select("dataset_id", "total", "failed_chunks", F.coalesce("received", F.lit(0)).alias("received"))
    return j.withColumn("complete", (F.col("failed_chunks") == 0) & (F.col("received") == F.col("total")))


def merge_chunks_strict(chunk_rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows of complete datasets only."""
    done = completeness_audit(chunk_rows, chunks).filter("complete").select("dataset_id")
    return chunk_rows.join(done, "dataset_id", "left_semi")


def split_scan(df: DataFrame, values: list[str] | None = None) -> DataFrame:
    """The listed values of a dataset's finest dimension; failed values are simply not listed. A filter, no shuffle."""
    dim = split_dimension(df.columns)
    return df if dim is None or values is None else df.filter(F.col(dim).isin(values))


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("timestamp string, dataset_id string, stage_name string, error_message string, error_type string, "
                             "retry_count int, additional_context map<string,string>, date string").json(path)
