"""Substring index against a plain search of every text."""

import random

import pytest
from pyspark.sql import functions as F

from statlake.operators import search as S, substrings as SUB

FIELDS = ["title", "names"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(4)
    letters = list("abcdE日本統計 é.")
    rows = [(i, "".join(rng.choices(letters, k=rng.randint(0, 40))), ["".join(rng.choices(letters, k=3)) for _ in range(rng.randint(0, 4))]) for i in range(300)]
    rows += [(300, None, None), (301, "", []), (302, "same text", ["same text", None]), (303, "same text", None), (304, "𠮷野家", None), (305, "ab" * 20_000, None)]
    path = str(tmp_path_factory.mktemp("index"))
    SUB.build(spark.createDataFrame(rows, "id int, title string, names array<string>"), FIELDS, path)
    return rows, path


def brute(rows, words):
    return sorted((w, i) for w in set(words) for i, title, names in rows if any(w in (t or "").lower() for t in [title, *(names or [])] if t is not None))


def found(spark, path, words):
    df = spark.createDataFrame([(w,) for w in words], "word string")
    return sorted(tuple(r) for r in SUB.containing(spark, path, df, FIELDS).select("word", "id").collect())


@pytest.mark.parametrize("words", [["統計"], ["abc", "e日", "same text"], ["a", "", "zz", "本", "𠮷野", "𠮷"], ["no such word"], ["ab" * 15_000], ["xt\0sam", "t\0s"], []])
def test_words_long_and_short(spark, corpus, words):
    rows, path = corpus
    assert found(spark, path, words) == brute(rows, words)


def test_a_thousand_words_make_one_plan(spark, corpus):
    rows, path = corpus
    rng = random.Random(8)
    texts = [t.lower() for _, t, _ in rows if t and len(t) > 5]
    words = []
    for _ in range(1000):
        t = rng.choice(texts)
        at = rng.randrange(len(t) - 3)
        words.append(t[at:at + rng.randint(3, 6)])
    assert found(spark, path, words) == brute(rows, words)


def test_long_phrases_are_not_found_by_three_characters(spark, tmp_path):
    """Texts of the same few syllables share all their n-grams; phrases of them lead to few texts besides those that hold them."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["ka", "ki", "日本", "ko", "\U00020bb7"], k=60)), ["x"]) for i in range(120)]
    path = str(tmp_path / "i")
    SUB.build(spark.createDataFrame(rows, "id int, title string, names array<string>"), FIELDS, path)
    words = [t[a:a + n] for _, t, _ in rows for a, n in ((0, 24), (9, 25), (20, 70))] + ["ka " * 30, "k" * 23]
    want = brute(rows, words)
    assert found(spark, path, words) == want
    df = spark.createDataFrame([(w,) for w in words if len(w) >= 24], "word string").distinct()
    assert SUB.long_candidates(spark, path, df).count() * 10 < SUB.candidates(spark, path, df).count()


def test_words_without_candidates_open_no_texts(spark, corpus):
    _, path = corpus
    words = spark.createDataFrame([("no such word",), ("統計統計統計統計",)], "word string")
    plan = SUB.containing(spark, path, words, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "InMemoryFileIndex" not in plan


def test_indexed_search_ranks_like_the_scan(spark, sf, tmp_path):
    from statlake.plans import views as V
    catalog, queries = V.catalog(spark, sf), ["労働", "the", "人口 統計", "zzz", "総合データ"]
    SUB.build(catalog, SUB.CATALOG_FIELDS, str(tmp_path / "i"))
    got = SUB.search(spark, str(tmp_path / "i"), spark.createDataFrame(list(enumerate(queries)), "query_id int, query string"), 7, min_records=100)
    want = S.search(catalog, queries, 7, min_records=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_posted_grams_are_those_of_the_column(spark):
    """N-grams and rows stored by the build against the column function; short, empty, cut and null texts, characters beyond the basic plane."""
    texts = ["", None, "a", "ab", "日", "日本", "abc", "ab日", "a\0bcd", "統計\0データ", "x𠀋y\nz", "\0", "aaaa aaaa"] + ["lorem ipsum %d 調査" % (i % 7) for i in range(300)]
    df = spark.createDataFrame([(i * 37, t) for i, t in enumerate(texts)], "_row long, t string").repartition(2)
    got = df.mapInArrow(SUB._postings, "gram string, block long, rows array<long>").collect()
    want = df.select("_row", F.explode(SUB.grams(F.col("t"))).alias("gram")).collect()
    pairs = sorted((r["gram"], x) for r in got for x in r["rows"])
    assert pairs == sorted((r["gram"], r["_row"]) for r in want)
    assert all(x >> SUB.BLOCK_BITS == r["block"] for r in got for x in r["rows"])
    assert len(got) < len(pairs) / 2                       # folded before they are shuffled


def test_a_text_is_lower_cased_once_for_all_its_words(spark, corpus):
    """Words were tried on a text in a plan that lower-cased and searched it for each of them."""
    _, path = corpus
    words = spark.createDataFrame([("same text",), ("abab" * 6,)], "word string")
    plan = SUB.containing(spark, path, words, FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" not in plan and plan.count("lower(title") == 1


def test_many_words_of_a_length_are_found_by_a_walk(spark, tmp_path):
    """Texts that meet few words and texts that meet more than ``MANY``, of two lengths, against a plain search."""
    rng = random.Random(5)
    long = ["".join(rng.choices("abc日\U00020bb7", k=700)) for _ in range(3)]
    rows = [(i, t.upper(), [t[::-1], None]) for i, t in enumerate(long)] + [(3, long[0][:300], None), (4, long[1][:23], ["x"]), (5, None, [long[2][5:90]])]
    words = [t[a:a + n] for t in long for n in (24, 30) for a in range(0, 600, 4)] + [t[a:a + 23] + "z" for t in long for a in range(0, 600, 9)]
    SUB.build(spark.createDataFrame(rows, "id int, title string, names array<string>"), FIELDS, str(tmp_path / "i"))
    assert found(spark, str(tmp_path / "i"), words) == brute(rows, words)
    for texts, own in ((long, words), (long[:1], words[:9]), ([], words), ([""], ["", "a"]), (["ab", "cd"], ["bc", "cd", ""])):
        assert sorted(SUB._held_in(texts, own)) == sorted({w for w in own if any(w in t for t in texts)})


def test_stored_fingerprints_are_dropped_where_they_are_read(spark, corpus):
    """Only fingerprints of the words are joined, and folded lists hold those of every text once."""
    rows, path = corpus
    each = F.flatten(F.transform(F.arrays_zip("rows", "counts"), lambda x: F.array_repeat(x["rows"], x["counts"])))
    stored = spark.read.parquet(path + "/prints").withColumn("rows", each).select("bucket", F.inline(F.arrays_zip("rows", "prints"))).collect()
    texts = {r["_row"]: SUB._CUT.join(t.lower() for t in [r["title"], *(r["names"] or [])] if t is not None) for r in spark.read.parquet(path + "/entries").collect()}
    assert sorted((r["rows"], r["prints"]) for r in stored) == sorted((k, int(p)) for k, t in texts.items() for p in SUB._prints_of(t))
    assert all(r["bucket"] == r["prints"] % SUB.BUCKETS for r in stored)
    few = spark.createDataFrame([(int(p),) for p in SUB._prints_of("ab" * 20)], "print int")
    bitmap = SUB._bitmap(few)
    assert len(bitmap) * 32 == SUB.BITMAP_BITS and 0 < sum(int(x).bit_count() for x in bitmap) <= few.count()
    left = spark.read.parquet(path + "/prints").select("rows", "counts", "prints").mapInArrow(SUB._within(bitmap), "_row long, print int").collect()
    wanted = {r["print"] for r in few.collect()}
    assert {(r["_row"], r["print"]) for r in left} >= {(r["rows"], r["prints"]) for r in stored if r["prints"] in wanted} and 0 < len(left) < len(stored) / 10
    assert not SUB._bitmap(few.limit(0)).any()


def test_words_have_the_fingerprints_of_a_text(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("ab c日\U00020bb7", k=rng.choice([23, 24, 25, 40, 300]))) for _ in range(60)] + ["ab" * 700, "", "a" * 24]
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(2)
    got = {(r["word"], r["print"]) for r in df.mapInArrow(SUB._word_prints, "word string, print int").collect()}
    assert got == {(w, int(p)) for w in words for p in SUB._prints_of(w)}
