"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies: target words over
source words. The whole part is given; the fractional parts are rounded in pairs: words
move at random from one document to the other until one of the two probabilities is 0
or 1, in proportions that keep both expectations. The words of a source are thereby
kept exactly but for its very last document.

Pairs meet in a reduction tree: small hash buckets of one source and one size class
are folded, each leaves at most one undecided document, and those meet on the next
level. One bucket of each class waits for the end, where undecided documents of large
classes meet ones of ever smaller size, so that what is left over is small.

Defined results: a null text has no words; documents without words take nothing;
rows that repeat one id, text and source are counted before the shuffle, numbered, and rounded
one by one, in buckets of their own numbers; a null source is a source, the
last one; a source without words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm.common import text_of, word_count
from statlake.session import materialise

WEIGHTS = (5, 2, 1)
BUCKET = 32
PIECE = 1 << 14                      # repeated rows that one row stands for at most when they are written out


def targets(stats: DataFrame, total: float, stop: float = 2.0) -> DataFrame:
    """``stats`` (``source, words, weight``) with ``target``.

    Shares of ``total`` by weight; a target stops at ``stop`` times the source's words
    and the excess is shared again. Only sums reach the driver.
    """
    cap = F.col("words") * F.lit(float(stop))
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= cap
        fixed, open_weight = stats.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
                                       F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if not open_weight:
            break
        raised = (total - fixed) / open_weight
        if raised <= level:
            break
        level = raised
    return stats.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def uniform(*parts) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


ITEM = "struct<order:int,hash:bigint,id:struct<doc_id:bigint,content:bigint>,size:bigint,p:double>"
STATE = f"struct<done:array<struct<id:struct<doc_id:bigint,content:bigint>,size:bigint,copies:int>>,open:{ITEM}>"


def _step(state: Column, item: Column, seed: int) -> Column:
    """One pivotal step between the undecided document of ``state`` and the next one."""
    a, b = state["open"], item
    to_a = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
    to_b = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
    toward_a = uniform(F.lit(seed), a["hash"], b["hash"], a["p"], b["p"]) * (to_a + to_b) < to_b
    a_decided = F.when(toward_a, (1 - a["p"]) * a["size"] <= b["p"] * b["size"]).otherwise(a["p"] * a["size"] <= (1 - b["p"]) * b["size"])
    p_a = F.when(toward_a, a["p"] + to_a / a["size"]).otherwise(a["p"] - to_b / a["size"])
    p_b = F.when(toward_a, b["p"] - to_a / b["size"]).otherwise(b["p"] + to_b / b["size"])

    def with_p(x: Column, p: Column) -> Column:
        return F.struct(x["order"].alias("order"), x["hash"].alias("hash"), x["id"].alias("id"), x["size"].alias("size"),
                        F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"))

    def decided(x: Column, up: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["size"].alias("size"), up.cast("int").alias("copies"))

    done = F.when(a_decided, decided(a, toward_a)).otherwise(decided(b, ~toward_a))
    left = F.when(a_decided, with_p(b, p_b)).otherwise(with_p(a, p_a))
    met = F.struct(F.concat(state["done"], F.array(done)).alias("done"), left.alias("open"))
    return F.when(a.isNull(), F.struct(state["done"].alias("done"), item.alias("open")).cast(STATE)).otherwise(met.cast(STATE))


def fold(items: Column, seed: int) -> Column:
    """``struct(done, open)``: what a bucket decides, and the document it leaves undecided."""
    start = F.struct(F.array().alias("done"), F.lit(None).alias("open")).cast(STATE)
    return F.aggregate(F.sort_array(items.cast(f"array<{ITEM}>")), start, lambda s, x: _step(s, x, seed))


def _item(p: Column) -> Column:
    return F.struct((-F.col("class")).alias("order"), F.col("hash"), F.col("id"), F.col("size"), p.alias("p"))


def round_copies(rows: DataFrame, seed: int = 7) -> DataFrame:
    """``source, id, size, copies`` from ``source, id struct(doc_id, content), nr, size, expected``; ``nr`` tells repeated rows apart.

    Sorting a bucket puts large sizes first. Levels are written to the shared folder, so
    none is computed twice and a lost executor costs one level. The driver sees only
    the number of levels.
    """
    part = F.col("expected") - F.floor("expected")
    rows = (rows.withColumn("part", part).withColumn("hash", F.xxhash64(F.lit(seed), "id", "nr"))
            .withColumn("class", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")))
    loose = (F.col("size") > 0) & (F.col("part") > 0)
    whole = rows.filter(~loose).select("source", "id", "size", F.floor("expected").cast("int").alias("copies"))
    counts = materialise(rows.filter(loose).groupBy("source", "class")
                         .agg(F.ceil(F.count("*") / BUCKET).cast("long").alias("buckets")), "mix-counts")
    c = counts.select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), "buckets")
    dealt = materialise(
        rows.filter(loose).join(c, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class")))
        .withColumn("bucket", F.pmod("hash", "buckets"))
        .select("source", "class", "bucket", F.floor("expected").cast("int").alias("base"), _item(F.col("part")).alias("item")), "mix-dealt")
    bases = dealt.select("source", "base").distinct()
    last, level = [dealt.filter("bucket = 0").select("source", "item")], dealt.filter("bucket > 0").select("source", "class", "bucket", "item")
    decided = []
    most = counts.agg(F.max("buckets")).first()[0] or 1
    depth = 0
    while most > 1:
        folded = materialise(level.groupBy("source", "class", "bucket").agg(F.collect_list("item").alias("items"))
                             .select("source", "class", "bucket", fold(F.col("items"), seed + depth).alias("f")), "mix-level")
        decided.append(folded.select("source", F.explode("f.done").alias("d")))
        level = folded.select("source", "class", F.floor(F.col("bucket") / BUCKET).alias("bucket"), F.col("f.open").alias("item"))
        most, depth = -(-most // BUCKET), depth + 1
    if depth:
        last.append(level.select("source", "item"))
    ended = materialise(reduce(DataFrame.unionByName, last).groupBy("source").agg(F.collect_list("item").alias("items"))
                        .select("source", fold(F.col("items"), seed - 1).alias("f")), "mix-last")
    decided.append(ended.select("source", F.explode("f.done").alias("d")))
    up = uniform(F.lit(seed), F.lit("last"), F.col("f.open.hash")) < F.col("f.open.p")
    decided.append(ended.select("source", F.struct(F.col("f.open.id").alias("id"), F.col("f.open.size").alias("size"),
                                                   up.cast("int").alias("copies")).alias("d")))
    b = bases.select(F.col("source").alias("b_source"), "base")
    rounded = (reduce(DataFrame.unionByName, decided).join(b, F.col("source").eqNullSafe(F.col("b_source")))
               .select("source", "d.id", "d.size", (F.col("base") + F.col("d.copies")).cast("int").alias("copies")))
    return whole.unionByName(rounded)


def thin(docs: DataFrame, text: str = "text") -> DataFrame:
    """``source, id, size`` of each row."""
    content = text_of(text)
    return docs.select("source", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(content).alias("content")).alias("id"),
                       word_count(content).alias("size"))


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with their number as ``times``."""
    return rows.groupBy("source", "id", "size").agg(F.count("*").alias("times"))


def numbered(rows: DataFrame) -> DataFrame:
    """Each row of ``counted`` as often as it was counted, with ``nr`` from 0; a row repeated without end is written out by many tasks."""
    few = rows.filter(F.col("times") <= PIECE).withColumn("nr", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(PIECE).cast("long")))
    many = rows.filter(F.col("times") > PIECE).withColumn("start", starts).repartition("id", "start")
    last = F.least(F.col("start") + PIECE, F.col("times")) - 1
    many = many.withColumn("nr", F.explode(F.sequence("start", last))).drop("start")
    return few.unionByName(many).drop("times")


def source_targets(rows: DataFrame, share: float = 1.5, stop: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, words, weight, target`` from counted rows; sources in code point order take the weights in turn, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1       # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    stats = materialise(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("words")).withColumn("weight", weight), "mix-sources")
    total = stats.agg(F.sum("words")).first()[0] or 0
    return materialise(targets(stats, share * total, stop), "mix-targets")


def mix(docs: DataFrame, share: float = 1.5, stop: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 7,
        text: str = "text") -> DataFrame:
    """``source, doc_id, content, size, source_size, target, copies, taken`` of each row; ``content`` is a hash of the text."""
    rows = materialise(counted(thin(docs, text)), "mix-rows")
    goal = source_targets(rows, share, stop, weights).select(
        F.col("source").alias("g_source"), F.col("words").alias("source_size"), "target")
    same = F.col("source").eqNullSafe(F.col("g_source"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = round_copies(numbered(rows).join(goal, same).select("source", "id", "nr", "size", expected.alias("expected")), seed)
    return copies.join(goal, same).select("source", "id.doc_id", "id.content", "size", "source_size", "target", "copies",
                                          (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Rows that are equal in source, id and text are told apart by a number on both sides.
    """
    taken = mix(docs, text=text, **options)
    number = Window.partitionBy("m_source", "m_id", "m_content")
    taken = taken.select(F.col("source").alias("m_source"), F.col("doc_id").alias("m_id"), F.col("content").alias("m_content"), F.col("copies").alias("m_copies"))
    taken = taken.withColumn("m_nr", F.row_number().over(number.orderBy("m_copies")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("m_source"),
                       F.col("doc_id").cast("long").alias("m_id"), F.xxhash64(text_of(text)).alias("m_content"))
    rows = rows.withColumn("m_nr", F.row_number().over(number.orderBy("m_id")))
    t = taken.select(*[F.col(c).alias(f"t_{c}") for c in taken.columns])
    same = F.col("m_source").eqNullSafe(F.col("t_m_source")) & F.col("m_id").eqNullSafe(F.col("t_m_id")) & (F.col("m_content") == F.col("t_m_content")) & (F.col("m_nr") == F.col("t_m_nr"))
    return (rows.join(t, same).filter("t_m_copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("t_m_copies"))).alias("m_copy")).select("row.*"))
