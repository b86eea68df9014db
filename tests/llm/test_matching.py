"""SimHash, decontamination and nearest neighbours against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from statlake.llm import decontamination, neighbours, simhash

DOCS = "doc_id long, text string, fp int, root string, key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in rows], DOCS)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "one", "One TWO three", "a b c d", "a b c d e", "É é\u00a0x y z w", "w " * 70_000, "İ ß a B c"]
    assert [simhash.fingerprint(t) % 2 ** 64 for t in texts] == [brute_fingerprint(t) for t in texts]
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert spark_hash % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c d", seed=42)


@pytest.mark.parametrize("count,chunk", [(3, 50_000), (4, 50_000), (2, 50_000), (3, 3), (3, 11)])
def test_components_equal_brute_force(spark, count, chunk):
    rng = random.Random(count)
    fps = set()
    for _ in range(25):                      # clusters around centres, chains, and strays
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.add(at)
            for _ in range(rng.randint(1, 6)):
                at ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12, 20)}
    fps = [f - 2 ** 64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df, 4, count, chunk)).collect()}
    want = roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin((a ^ b) % 2 ** 64).count("1") <= 4])
    assert {f: got.get(f, f) for f in fps} == want


def test_near_duplicates(spark):
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(400)]
    near = base[:200] + ["changed"] + base[201:]
    rows = [(i, " ".join(near[:i] + near[i:])) for i in (11, 12)] + [(10, " ".join(base)), (13, " ".join(reversed(base)))]
    rows += [(20, None), (21, ""), (22, " "), (None, "of no id"), (30, "same"), (30, "same"), (31, "same")]
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert all(r.fingerprint == f"{brute_fingerprint(dict((i, t) for i, t in rows)[r.doc_id]):016x}" for r in got if r.doc_id != 30)
    assert {c for (i, _), c in by.items() if i in (10, 11, 12)} == {10} and {c for (i, _), c in by.items() if i in (20, 21, 22)} == {20}
    assert {c for (i, _), c in by.items() if i in (30, 31)} == {30} and [c for (i, _), c in by.items() if i is None] == [None]
    kept = simhash.deduplicated(docs_of(spark, rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["10", "13", "20", "30", "None"] and kept.columns == docs_of(spark, rows).columns
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items:
        its = words_of(item_text)
        n = min(10, len(its))
        windows = {tuple(its[i:i + n]) for i in range(len(its) - n + 1)} if its else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("short", [False, True])
def test_contamination_equals_brute_force(spark, short):
    rng = random.Random(3)
    words = ["a", "b", "É", "c1", "d"]
    items = [(i, " ".join(rng.choices(words + ["z"], k=rng.randint(10, 25)))) for i in range(12)] + [(100, None), (101, "!?"), (1, "A-b " * 6)]
    items += [(i, t) for i, t in enumerate(["a b c1", "É É d d a", "z", "b a b a b a b a b"], 200)] if short else []
    texts = [None, "", "...", "z", "a b c1"] + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    for i in range(30):                      # whole, partial and changed items
        its = words_of(items[i % 12][1])
        cut = its[rng.randint(0, 2):len(its) - rng.randint(0, 2)]
        texts.append(" ".join(rng.choices(words, k=i % 5)) + ",".join(cut).upper() + "\n" + " ".join(rng.choices(words, k=i % 4)))
    texts.append(" ".join(rng.choices(words + ["q"], k=30_000)) + " " + items[0][1])
    rows = list(enumerate(texts)) + [(None, items[3][1]), (7, texts[7])]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, window string")
    got = decontamination.contamination(docs_of(spark, rows), bench).drop("text_sha256")
    want = [(i, *brute_contamination(t, items)) for i, t in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    kept = decontamination.clean_documents(docs_of(spark, rows), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if not w[-1])


def test_contamination_of_and_by_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontamination.contamination(docs_of(spark, [(1, "a b")]), bench).collect()] == [False]
    assert decontamination.contamination(docs_of(spark, []), bench).count() == 0


VECTORS = "vec_id long, embedding array<float>, score string, rank int"


def neighbours_of(spark, rows, **options):
    got = {}
    df = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], VECTORS)
    for r in neighbours.nearest(df, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return got


@pytest.mark.parametrize("groups", [4096, 2])                 # as many as blocks need, and the most there may be
def test_neighbours_equal_brute_force(spark, monkeypatch, groups):
    monkeypatch.setattr(neighbours, "MOST_TASKS", groups)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 70))
    vectors = [(i, (centres[i % 8] + 0.6 * rng.standard_normal(70)).astype(np.float32)) for i in range(900)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(300)]                     # copies of a query
    rows = [(i, v.tolist()) for i, v in vectors]
    got, hits = neighbours_of(spark, rows), 0
    assert sorted(got) == [i for i, _ in vectors if i % 50 == 0]
    assert [v for _, v, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]
    ids, matrix = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], dtype=np.float64)
    for q, found in got.items():
        own = matrix[ids == q][0]
        score = matrix @ own / np.sqrt((matrix ** 2).sum(axis=1)) / np.sqrt((own ** 2).sum())
        best = [i for i in ids[np.lexsort((ids, -score.round(12)))].tolist() if i != q][:5]
        hits += len(set(best) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(score[ids == v][0], abs=1e-12) for _, v, s in found)
    assert hits >= 0.98 * 5 * len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 2.0]),
            (50, [0.0, 2.0]), (100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 3.0]), (150, [5.0]), (200, None), (8, [1.0, 1.0]), (8, [1.0, 1.0])]
    got = neighbours_of(spark, rows)
    assert [v for _, v, _ in got[0]] == [1, 8, 8, 50] and [v for _, v, _ in got[100]] == [101] and sorted(got) == [0, 50, 100]
    assert neighbours_of(spark, []) == {}


def test_deduplicated_equals_brute_force(spark):
    rng = random.Random(9)

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        return words

    texts, vocabulary = [], [f"w{i}" for i in range(300)]
    for n in (6, 24, 80, 300, 1500):                     # groups around the limit, edited copies of copies, and strays
        for _ in range(6):
            at = rng.choices(vocabulary, k=n)
            texts += [" ".join(at), " ".join(rng.choices(vocabulary, k=n))]
            for _ in range(10):
                at = edited(at, rng.randint(0, max(1, n // 200)))
                texts.append(" ".join(at))
    rows = list(enumerate(texts)) + [(5_000, texts[0]), (5_001, "short one"), (5_002, "Short ONE"), (5_003, None), (5_004, " ")]
    fps = {i: brute_fingerprint(t) for i, t in rows}
    near = [(i, j) for i in fps for j in fps if i < j and (fps[i] ^ fps[j]).bit_count() <= 4]
    want = sorted(set(roots(list(fps), near).values()))
    got = sorted(r.doc_id for r in simhash.deduplicated(docs_of(spark, rows)).collect())
    assert len(texts) * 0.3 < len(want) < len(texts) * 0.99 and got == want
