"""Aggregates, joins and growth over domain fact tables.

Every aggregate combines on the map side. Joins between fact tables run on
sides that are already aggregated to the join key, so a hot key meets one row
and never multiplies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from statlake.session import materialise

PAIR_ROWS, MOST_PIECES, PAIR_TASKS = 2048, 64, 256      # rows of a piece that meets others as a whole, pieces of a table, tasks that pairs are spread over
WORD_COLUMNS = 16                                       # words of region bits that are columns



def basic_statistics(facts: DataFrame) -> DataFrame:
    """One row: counts, distinct datasets / years / regions, value statistics, year range.

    The three distinct counts run over one row per (dataset, year, region), not over all facts.
    """
    cells = facts.groupBy("dataset_id", "year", "region_code").agg(
        F.count("*").alias("n"), F.sum("value").alias("s"), F.count("value").alias("nv"),
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"), F.countDistinct("dataset_id").alias("unique_datasets"),
        F.countDistinct("year").alias("unique_years"), F.countDistinct("region_code").alias("unique_regions"),
        F.sum("s").alias("total_value"), F.try_divide(F.sum("s"), F.sum("nv")).alias("avg_value"),
        F.min("lo").alias("min_value"), F.max("hi").alias("max_value"),
        F.min("year").alias("earliest_year"), F.max("year").alias("latest_year"))


def region_year_statistics(facts: DataFrame, limit: int = 100) -> DataFrame:
    return (facts.groupBy("year", "region_code")
            .agg(F.count("*").alias("record_count"), F.sum("value").alias("total_value"), F.avg("value").alias("avg_value"),
                 F.min("value").alias("min_value"), F.max("value").alias("max_value"))
            .orderBy(F.desc("year"), "region_code").limit(limit))


def custom_sql(spark: SparkSession, tables: dict[str, DataFrame], text: str) -> DataFrame:
    """A user's own SQL over named tables; the names are gone once the text is resolved."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def group_statistics(facts: DataFrame, keys: list[str], *, where: Column | None = None, total: str | None = None,
                     average: str | None = None, minimum: str | None = None, maximum: str | None = None,
                     count: str | None = None, deviation: str | None = None, digits: int | None = 2,
                     min_count: int | None = None, order: list | None = None) -> DataFrame:
    """Grouped value statistics; the argument that names an output column also asks for it."""
    v = F.col("value")

    def rounded(c):
        return c if digits is None else F.round(c, digits)

    aggs = [a for a in [
        F.sum(v).alias(total) if total else None, rounded(F.avg(v)).alias(average) if average else None,
        rounded(F.min(v)).alias(minimum) if minimum else None, rounded(F.max(v)).alias(maximum) if maximum else None,
        rounded(F.stddev_samp(v)).alias(deviation) if deviation else None,
        F.count("*").alias(count) if count else None] if a is not None]
    if min_count:
        aggs.append(F.count("*").alias("_n"))
    out = (facts if where is None else facts.filter(where)).groupBy(*keys).agg(*aggs)
    if min_count:
        out = out.filter(F.col("_n") >= min_count).drop("_n")
    return out.orderBy(*order) if order else out


def distinct_count(facts: DataFrame, keys: list[str], column: str, out: str, where: Column | None = None) -> DataFrame:
    rows = facts if where is None else facts.filter(where)
    return rows.groupBy(*keys).agg(F.countDistinct(column).alias(out))


def top_regions(facts: DataFrame, year: int, n: int = 10) -> DataFrame:
    return (facts.filter(F.col("year") == year).groupBy("region_code")
            .agg(F.sum("value").alias("total_value")).orderBy(F.desc("total_value"), "region_code").limit(n))


def growth(facts: DataFrame, keys: list[str], value: str, before: str, min_year: int,
           extra: list[str] | None = None) -> DataFrame:
    """Yearly totals against the total of exactly one year earlier (null across gaps)."""
    from statlake.functions.scalars import growth_percent
    yearly = facts.groupBy("year", *keys, *(extra or [])).agg(F.sum("value").alias(value))
    last = yearly.select((F.col("year") + 1).alias("year"), *keys, F.col(value).alias(before))
    out = yearly.filter(F.col("year") >= min_year).join(last, ["year", *keys], "left")
    return out.select("year", *keys, *(extra or []), value, before,
                      growth_percent(F.col(value), F.col(before)).alias("growth_rate_percent"))


# --- joins of fact tables ----------------------------------------------------------

def key_totals(facts: DataFrame, keys: list[str], name: str) -> DataFrame:
    return facts.groupBy(*keys).agg(F.sum("value").alias(name))


def join_on_keys(tables: list[DataFrame], keys: list[str], how: str = "inner") -> DataFrame:
    """Chain of joins on shared keys; sides are expected to be one row per key."""
    return reduce(lambda a, b: a.join(b, keys, how), tables)


def related_statistics(left: DataFrame, right: DataFrame, keys: list[str], group: list[str], *, how: str = "inner",
                       left_total: str | None = None, left_average: str | None = None,
                       right_average: str | None = None, distinct: dict[str, str] | None = None) -> DataFrame:
    """Statistics over the join of two fact tables, without forming its rows.

    Each side is reduced to count and sum per key. A left row meets ``n`` right
    rows, so its contribution is weighted by ``n`` (one for an unmatched row of
    a left join) and the right sums by the number of left rows.
    """
    a = left.groupBy(*dict.fromkeys([*keys, *group])).agg(F.sum("value").alias("_s"), F.count("*").alias("_n"))
    b = right.groupBy(*keys).agg(F.sum("value").alias("_t"), F.count("*").alias("_m"))
    j = a.join(b, keys, how)
    weight = F.coalesce(F.col("_m"), F.lit(1))
    total = F.sum(F.col("_s") * weight)
    aggs = []
    if distinct:
        aggs += [F.countDistinct(c).alias(out) for c, out in distinct.items()]
    if left_total:
        aggs.append(total.alias(left_total))
    if left_average:
        aggs.append((total / F.sum(F.col("_n") * weight)).alias(left_average))
    if right_average:
        aggs.append(F.try_divide(F.sum(F.col("_t") * F.col("_n")), F.sum(F.col("_m") * F.col("_n"))).alias(right_average))
    return j.groupBy(*group).agg(*aggs)


def inventory_counts(inventory: DataFrame, tables: dict[str, DataFrame], by: list[str] | None = None) -> DataFrame:
    """Row counts of tables beside every inventory row that names the table.

    A table is counted first; the inventory then joins the counts by table
    name. By definition every inventory row of a table meets every group of it,
    so the result is their product; the fact rows themselves do not take part.
    The name is an aggregate so that the planner keeps an equi-join on it; the
    adaptive engine broadcasts the counts where it measures them as small.
    """
    by = by or []
    counts = [df.groupBy(*by).agg(F.count("*").alias("record_count"), F.max(F.lit(name)).alias("table_name"))
              for name, df in tables.items()]
    return inventory.join(reduce(DataFrame.unionByName, counts), "table_name")


def domain_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row count per table, in one plan."""
    parts = [df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("domain"), "record_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts).orderBy(F.desc("record_count"), "domain")


def time_range(df: DataFrame) -> DataFrame:
    """Name and range (as text) of the first column whose name speaks of time; no row if there is none."""
    from statlake.rules import TIME_COLUMN_WORDS
    found = next((c for c in df.columns if any(w in c.lower() for w in TIME_COLUMN_WORDS)), None)
    if found is None:
        return df.sparkSession.createDataFrame([], "field string, start string, end string")
    text = F.col(found).cast("string")
    return df.agg(F.min(text).alias("start"), F.max(text).alias("end")).select(F.lit(found).alias("field"), "start", "end")


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null and exact distinct counts of columns: one row per column, one scan, one shuffle.

    Columns become (name, text) pairs that are counted per value first, so a
    column with one dominant value costs one row per task.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]))
    values = df.select(pairs.alias("p")).groupBy("p.column", "p.v").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("distinct_count"), F.sum("n").alias("row_count"))


# --- compatibility of datasets --------------------------------------------------------

def dataset_cells(facts: DataFrame) -> DataFrame:
    """(dataset_id, year, region_code, has_quarter, has_month, n): what all comparisons of datasets need, written once."""
    flags = [F.coalesce(F.col(c) > 0, F.lit(False)).alias(f"has_{c}") for c in ("quarter", "month")]
    return materialise(facts.groupBy("dataset_id", "year", "region_code", *flags).agg(F.count("*").alias("n")), "dataset-cells")


def profiles_of(cells: DataFrame) -> DataFrame:
    return cells.groupBy("dataset_id").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("year").alias("years"),
        F.countDistinct("region_code").alias("regions"), F.sum("n").alias("records"),
        F.when(F.max("has_month"), "month").when(F.max("has_quarter"), "quarter").otherwise("year").alias("granularity"))


def dataset_profiles(facts: DataFrame) -> DataFrame:
    """Year range, region count and granularity of every dataset."""
    return profiles_of(dataset_cells(facts))


def join_compatibility(facts: DataFrame, dataset_id: str) -> DataFrame:
    """How other datasets can be joined with one dataset: shared regions, overlapping years, keys, join type.

    Facts are read once, into cells; one dataset's regions are joined with the (dataset, region)
    pairs, so the work grows with the pairs, not with pairs of datasets.
    """
    cells = dataset_cells(facts)
    profiles = materialise(profiles_of(cells), "dataset-profiles")
    regions = cells.select("dataset_id", "region_code").distinct()
    own = regions.filter(F.col("dataset_id") == dataset_id).select("region_code")
    shared = (regions.filter(F.col("dataset_id") != dataset_id).join(own, "region_code")
              .groupBy("dataset_id").agg(F.count("*").alias("shared_regions")))
    me = profiles.filter(F.col("dataset_id") == dataset_id)
    start, end, grain = (me.select(c).scalar() for c in ("first_year", "last_year", "granularity"))
    overlap = F.least("last_year", end) - F.greatest("first_year", start) + 1
    joined = profiles.filter(F.col("dataset_id") != dataset_id).join(shared, "dataset_id", "left")
    years = F.greatest(overlap, F.lit(0)).cast("int")
    return _compatibility(joined, [F.col("dataset_id")], years, F.coalesce("shared_regions", F.lit(0)), F.col("granularity") == grain)


def _compatibility(pairs: DataFrame, ids: list[Column], years: Column, regions: Column, same: Column) -> DataFrame:
    both = (years > 0) & (regions > 0)
    return pairs.select(
        *ids, years.alias("overlap_years"), regions.alias("shared_regions"), same.alias("same_granularity"),
        F.when(both, "year,region_code").when(years > 0, "year").when(regions > 0, "region_code").otherwise("").alias("join_keys"),
        F.when(both & same, "inner").when(both, "left").otherwise("none").alias("join_type"))


def overlapping(left: DataFrame, right: DataFrame, start: str, end: str, least: int = 1, width: int = 4, pieces: int = 1, once: str | None = None) -> DataFrame:
    """Pairs of rows whose closed integer intervals share ``least`` points or more, as columns ``a`` and ``b`` of structs.

    An interval shortened by ``least - 1`` points meets another such one exactly where the two
    share enough. Shortened ones are cut into bins of ``width`` points and meet by bin; a pair is
    kept in the first bin that both have, so it comes once. Work follows the bins' pairs: no
    interval meets one far from it. Rows with a null bound meet nothing.

    Either side is cut into ``pieces`` by a hash of the row, and each two pieces meet by themselves, so a
    bin that holds most rows is the work of many tasks. With ``once``, a column that tells rows apart, left
    and right are the same rows: two of them are one pair, in either order, and no row meets itself.
    """
    both = ["bin", "_i", "_j"]

    def binned(df: DataFrame, name: str, own: str, other: str) -> DataFrame:
        low, high = F.floor(F.col(start) / width), F.floor((F.col(end) - (least - 1)) / width)
        piece = F.pmod(F.xxhash64(*([once] if once else [start, end, F.monotonically_increasing_id()])), F.lit(pieces)).cast("int")
        flat = [F.col(c).alias(f"_{name}_{c}") for c in df.columns]
        rows = df.filter(F.col(end) - F.col(start) >= least - 1).select(*flat, low.alias(f"{name}_first"), high.alias("_last"), piece.alias(own))
        met = F.sequence(own, F.lit(pieces - 1)) if own == "_i" else F.sequence(F.lit(0), own)
        rows = rows.withColumn(other, F.explode(met if once else F.sequence(F.lit(0), F.lit(pieces - 1))))
        rows = rows.select(*[f"_{name}_{c}" for c in df.columns], f"{name}_first", "_i", "_j", F.explode(F.sequence(f"{name}_first", F.greatest("_last", f"{name}_first"))).alias("bin"))
        return rows.repartition(min(pieces * (pieces + 1) // 2, PAIR_TASKS), *both) if pieces > 1 else rows

    a, b = binned(left, "a", "_i", "_j"), binned(right, "b", "_j", "_i")
    met = a.join(b.hint("merge") if pieces > 1 else b, both).filter(F.col("bin") == F.greatest("a_first", "b_first"))
    if once:
        met = met.filter((F.col("_i") < F.col("_j")) | (F.col(f"_a_{once}") < F.col(f"_b_{once}")))
    met = met.select(*[F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in df.columns]).alias(side) for side, df in (("a", left), ("b", right))])
    shared = F.least(F.col("a")[end], F.col("b")[end]) - F.greatest(F.col("a")[start], F.col("b")[start]) + 1
    return met.filter(shared >= least).select("a", "b", shared.cast("int").alias("shared"))


def _region_bits(cells: DataFrame) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """A row of 64-bit words over numbered regions for every dataset, and the count of regions that two such rows share.

    A few words are columns of their own, more are a map of those that are not zero.
    """
    names = cells.select("region_code").filter(F.col("region_code").isNotNull()).distinct()
    numbers = materialise(names.select("region_code", (F.row_number().over(Window.orderBy("region_code")) - 1).alias("nr")), "regions")     # one row a region
    bits = (cells.select("dataset_id", "region_code").distinct().join(numbers, "region_code")
            .groupBy("dataset_id", F.floor(F.col("nr") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(nr % 64 as int))")).alias("bits")))
    n = (numbers.count() + 63) // 64
    if n <= WORD_COLUMNS:
        words = bits.groupBy("dataset_id").agg(F.count("*").alias("_n"), *[F.max(F.when(F.col("word") == i, F.col("bits"))).alias(f"_w{i}") for i in range(n)])
        held = [F.coalesce(f"_w{i}", F.lit(0).cast("long")).alias(f"_w{i}") for i in range(n)]

        def shared(a: str, b: str) -> Column:
            counts = [F.coalesce(F.bit_count(F.col(f"{a}._w{i}").bitwiseAND(F.col(f"{b}._w{i}"))), F.lit(0)) for i in range(n)]
            return reduce(lambda x, y: x + y, counts, F.lit(0)).cast("long")
        return words.select("dataset_id", *held), shared
    words = bits.groupBy("dataset_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("region_bits"))

    def shared_of_maps(a: str, b: str) -> Column:
        both = F.transform(F.map_entries(f"{a}.region_bits"),
                           lambda e: F.bit_count(e["value"].bitwiseAND(F.coalesce(F.try_element_at(f"{b}.region_bits", e["key"]), F.lit(0).cast("long")))))
        return F.coalesce(F.aggregate(both, F.lit(0), lambda s, n: s + n), F.lit(0)).cast("long")
    return words, shared_of_maps


def joinable_pairs(facts: DataFrame, least_years: int = 1) -> DataFrame:
    """All pairs of datasets that share ``least_years`` years or more, with what they can be joined on.

    A dataset's regions are a row of 64-bit words over numbered regions, so a pair's shared
    regions are counted on the pair itself, however many datasets have a region. Datasets meet in
    pieces of about ``PAIR_ROWS``, two at a time; nearly all datasets share years, so pairs grow with their square.
    """
    cells = dataset_cells(facts)
    words, regions = _region_bits(cells)
    rows = profiles_of(cells).select("dataset_id", "first_year", "last_year", "granularity").filter(F.col("dataset_id").isNotNull()).join(words, "dataset_id", "left")
    rows = materialise(rows, "dataset-profiles")
    found = rows.agg(F.count("*").alias("n"), F.avg(F.col("last_year") - F.col("first_year")).alias("span")).first()
    width = max(4, 2 * (int(found["span"] or 0) + 2 - least_years))                       # most intervals lie in one bin or two
    pieces = min(MOST_PIECES, found["n"] // PAIR_ROWS + 1)
    pairs = overlapping(rows, rows, "first_year", "last_year", least_years, width, pieces, once="dataset_id")
    ids = [F.least("a.dataset_id", "b.dataset_id").alias("dataset_a"), F.greatest("a.dataset_id", "b.dataset_id").alias("dataset_b")]
    return _compatibility(pairs, ids, F.col("shared"), regions("a", "b"), F.col("a.granularity") == F.col("b.granularity"))


def fetch_and_join(facts: DataFrame, dataset_ids: list[str], keys: list[str]) -> DataFrame:
    """Totals of several datasets side by side, on the keys all of them have."""
    parts = [key_totals(facts.filter(F.col("dataset_id") == d), keys, d) for d in dataset_ids]
    return join_on_keys(parts, keys)
