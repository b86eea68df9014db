"""Ranked search against a plain scoring of all documents."""

import math
import random
import re

import pytest

from statlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, n int, terms string, item int, score int", "item_id string, text string, item int, rank int"


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    docs = [(i, t) for i, t in ((i, terms_of(t)) for i, t in docs) if t]
    n, words = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item_id, text in items:
        scored = []
        for i, t in docs:
            m = 100 - 50 + (50 * len(t) * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10 ** 9 * t.count(x)) // (1000 * t.count(x) + 20 * m))
                        for x in set(terms_of(text)) if x in df and x in t)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item_id, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, parts=3, **conf):
    d = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in docs], DOCS).repartition(parts)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    return sorted((tuple(r) for r in lexical.ranked_search(d, i, **conf).collect()), key=repr)


@pytest.fixture
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]

    def text(n):
        return " ".join(rng.choices(words, [1 / (i + 1) for i in range(120)], k=n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(90)]                                  # copies: ties
    items = [(str(i), text(rng.randint(1, 25))) for i in range(25)]
    return docs, items


def test_equal_to_scoring_all(spark, corpus):
    docs, items = corpus
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_small_shards_blocks_of_items_and_merged_lists(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(lexical, "SHARD_DOCS", 37)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 300)
    monkeypatch.setattr(lexical, "TERMS_AT_ONCE", 60)
    monkeypatch.setattr(lexical, "MOST_LISTS", 4)
    monkeypatch.setattr(lexical, "FIRST_READ", 2)
    assert run(spark, docs, items, parts=2, k=5) == brute(docs, items, k=5)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "...!"), (4, "Ärger ÄRGER ärger E-Mail"), (None, "mail e"), (None, "mail e"), (5, "mail e"), (5, "mail e"), (6, "x" * 200 + " E"),
            (7, "b " * 5000), (8, "ﬁn 日本 日本 e0")]
    items = [("a", "mail E"), ("a", "mail E"), (None, "日本"), ("b", None), ("c", ""), ("d", "nothing known"), ("e", "X" * 200), ("f", "ÄRGER ärger"), ("g", "b B b")]
    assert run(spark, docs, items) == brute(docs, items)


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "_AT_ONCE", 7)
    text = "One two, three four FIVE sixteenletterword x é日 " * 20
    got = {k.decode(): n for k, n in lexical.term_counts(text).items()}
    assert got == {t: terms_of(text).count(t) for t in set(terms_of(text))}


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []
