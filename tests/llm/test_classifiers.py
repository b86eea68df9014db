"""Toxicity and quality: folding, learning, and accuracy on rows held out."""

import random
import zlib

import numpy as np
import pytest

from statlake.llm import quality, toxicity

DOCS = "doc_id long, text string, score string, toxic int"


def test_folding():
    plain = toxicity.folded("Idiot loser trash")
    for text in ("1D10T l0ser tr4sh", "ıdıоt ӏоѕеr trаsh", "ídïòt lóser träsh", "id\u200biot lo\u00adser tra\u200dsh", "idiot lo$er tr@$h"):
        assert toxicity.folded(text) == plain
    assert toxicity.folded("idiot!! loser?") == plain[:2] and toxicity.folded(None) == []


def test_scores():
    lexicon = toxicity.Lexicon({" ldlot": 4.0, " trash ": 2.0}, threshold=0.1)
    machine = lexicon.automaton()
    rate = lambda text: lexicon.rate(machine, text)
    assert rate("you idiot") == rate("you idiots") == 2.0 and rate("idiot idiot") == 4.0
    assert rate("take out the trash") == 0.5 and rate("take the trash can out") == 0 and rate("trashy") == 0 and rate("midiot") == 0
    assert lexicon.score(0.1) == 0.5 and lexicon.score(0.0) == 0.0 and rate("") == rate(None) == 0.0
    assert toxicity.Lexicon({}).rate(None, "idiot") == 0.0
    assert toxicity.threshold_of(np.array([0, 0, 0.01, 0.5, 0.9]), np.array([0, 0, 0, 1, 1])) == pytest.approx((0.01 * 0.5) ** 0.5)


def test_toxicity_learned(spark):
    rows = [(i, ("fine words here and there " * 5) + ("you zork! " if i % 4 == 0 else "") + f"w{i}") for i in range(300)]
    odd = [(None, "zork"), (1000, None), (1001, ""), (1002, "z0rk zоrk"), (1003, "x " * 100_000), (1003, "x")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows + odd], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i, _ in rows] + [(None, 1, 1), (3, None, None), (0, 1, 0)], "doc_id long, toxic int, quality int")
    got = {}
    for r in toxicity.toxicity(docs, labels).collect():
        got.setdefault(r.doc_id, r)
    assert all(got[i].predicted == (i % 4 == 0) for i, _ in rows)
    assert got[None].predicted == got[1002].predicted == 1 and got[1000].score == got[1001].score == got[1003].score == 0.0
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 75 - 2
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and {r.score for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_lexicon_keeps_rare_words_beside_many(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghmnopqrstuvwxyz", k=12)) for _ in range(290)]
    common, rare = words[:260], words[260:]
    ids = [i for i in range(2_200) if zlib.crc32(str(i).encode()) % 5]
    toxic = {i: [f"n{i}"] for i in ids[:150]}
    for word in words:
        for i in rng.sample(ids[:150], 12 if word in common else 6):
            toxic[i].append(word)
    docs = spark.createDataFrame([(i, " ".join(toxic.get(i, ["fine", f"n{i}"])), "", 1) for i in ids], DOCS)
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    machine = lexicon.automaton()
    assert all(lexicon.rate(machine, word) > 0 for word in common + rare)


def held_out_rows(spark, sf, query, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return [(r, labels[r.doc_id]) for r in query.collect() if r.held_out and r.doc_id in labels]


def test_held_out_accuracy(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    for query, label, least in ((toxicity.toxicity, "toxic", 0.95), (quality.quality, "quality", 0.95)):
        rows = held_out_rows(spark, folder, query(docs, labels), label)
        assert len(rows) > 50 and sum(r.predicted == y for r, y in rows) >= least * len(rows)
        assert all(0 <= r.score <= 1 for r, _ in rows)


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0), (None, "some text " * 30_000, "", 0), (2, "", "", 0)], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality(docs, labels).collect()] == [0.5] * 4
    one = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, None, None), (2, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs, one).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["One two two", "", "SHOUT!! | x\n\n", "é" * 50, "a"]
    data = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    whole = quality.features(np.concatenate(data), offsets)
    for i, d in enumerate(data):
        assert np.allclose(whole[i], quality.features(d, np.array([0, len(d)]))[0])
