"""Sharding and mixing."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from statlake.llm import mixing, sharding

DOCS = "doc_id long, text string, source string, size int, shard string, target int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "clash", 2) for i, t, s in rows], DOCS)


def brute_schedule(sizes, shards):
    """One group at a time, longest first, to the least-loaded shard."""
    loads, taken = [0] * shards, defaultdict(Counter)
    for size in sorted((s for s, n in sizes for _ in range(n)), reverse=True):
        shard = min(range(shards), key=lambda i: (loads[i], i))
        loads[shard] += size
        taken[size][shard] += 1
    return {size: sorted(of.items()) for size, of in taken.items()}, loads


def test_schedule_equals_one_group_at_a_time():
    rng = random.Random(3)
    assert sharding.schedule([(5, 1), (4, 1), (3, 3)], 2) == {5: [(0, 1)], 4: [(1, 1)], 3: [(0, 1), (1, 2)]}
    for shards in (1, 2, 5, 24):
        for _ in range(30):
            sizes = [(s, rng.choice([1, 2, 30, 400])) for s in rng.sample(range(1, 5000), rng.randint(1, 12))]
            assert sharding.schedule(sizes, shards) == brute_schedule(sizes, shards)[0]
    assert sharding.schedule([(10 ** 9, 1), (9, 10 ** 10)], 3)[9] == [(0, 3259259259), (1, 3370370371), (2, 3370370370)]


def test_shards_equal_a_schedule_of_all_groups(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([3, 10, 10, 11, 500]) + str(rng.randint(0, 400)), None) for i in range(2500)]
    groups = Counter()
    for _, t, _ in rows:
        groups[t] += len(t) + 8
    _, want = brute_schedule(list(Counter(groups.values()).items()), 7)
    loads = Counter()
    for r in sharding.shard_documents(docs_of(spark, rows), 7).collect():
        loads[r.shard] += r["size"]
    assert [loads[i] for i in range(7)] == want


def test_rows_repeated_without_end(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 64)
    rows = [(1, "the same row", None)] * 1500 + [(i, f"text {i}", None) for i in range(3000)]
    got = sharding.shard_documents(docs_of(spark, rows), 4).collect()
    assert Counter(r.doc_id for r in got)[1] == 1501 and len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"the same row")}) == 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards(spark):
    rows = [(i, "w " * (i % 97) + str(i % 700), None) for i in range(3000)] + [(9000 + i, "same" * 50, None) for i in range(1000)]
    rows += [(None, None, None), (None, "", None), (5, rows[5][1], None), (7, None, None)]
    got = sharding.shard_documents(docs_of(spark, rows), 8).collect()
    assert len(got) == len(rows)
    slots, loads, shard_of = defaultdict(list), Counter(), {}
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        assert shard_of.setdefault((r.text_crc32, r["size"]), r.shard) == r.shard
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(8))
    others = sorted(loads.values())[:-1]                     # the copies fill one shard
    assert max(others) - min(others) <= 0.01 * max(others)
    again = sharding.shard_documents(docs_of(spark, rows).repartition(5), 8).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_many_small_groups_are_even(spark):
    rows = [(i, "x" * (i * 7919 % 500), None) for i in range(500)] + [(i, f"{i} " + "y" * (i % 300), None) for i in range(1000, 15000)]
    loads = Counter()
    for r in sharding.shard_documents(docs_of(spark, rows), 24).collect():
        loads[r.shard] += r["size"]
    assert max(loads.values()) - min(loads.values()) <= 0.005 * max(loads.values())


def test_shards_of_nothing(spark):
    assert sharding.shard_documents(docs_of(spark, []), 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(docs_of(spark, []), 0)


def brute_targets(words, share=1.5, stop=2.0):
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(words.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        each = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if each * weight[s] >= stop * words[s]]
        if not above:
            return {**fixed, **{s: each * weight[s] for s in free}}
        fixed |= {s: stop * words[s] for s in above}


def corpus():
    rows = [(i, "w " * (1 + i * 7919 % 211 + (900 if i % 50 == 0 else 0)), ["a", "b", "c", "é", None][min(4, i % 7)]) for i in range(4000)]
    return rows + [(None, "null id", "a"), (3, "same row", "b"), (3, "same row", "b"), (3, None, "b"), (4, " \n\t", "a"), (5, None, "empty")]


def test_mix_meets_targets(spark):
    rows = corpus()
    words = defaultdict(int)
    for _, t, s in rows:
        words[s] += len((t or "").split())
    want = brute_targets(dict(words))
    got = mixing.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    for s, n in words.items():
        assert target[n] == pytest.approx(want[s])
        assert abs(taken[n] - want[s]) <= max(30, 0.002 * want[s]), s
    again = mixing.mix(docs_of(spark, rows).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_expected_copies_are_kept(spark):
    rows = [(i, "w " * (1 + i % 5), s) for i, s in enumerate(["a", "b", "b", "c"] * 6)]
    total, runs = Counter(), 12
    for seed in range(runs):
        for r in mixing.mix(docs_of(spark, rows), seed=seed).collect():
            total[r.doc_id] += r.copies
            p = r.target / r.source_size
            assert int(p) <= r.copies <= int(p) + 1
    want = {r.doc_id: r.target / r.source_size for r in mixing.mix(docs_of(spark, rows)).collect()}
    assert sum(total[i] / runs - want[i] for i in want) / len(want) == pytest.approx(0, abs=0.1)
    assert all(abs(total[i] / runs - want[i]) < 0.6 for i in want)


def test_mixed_rows(spark):
    rows = corpus()
    df = docs_of(spark, rows)
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[(r.doc_id, r["size"])] += r.copies
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, len((r.text or "").split())) for r in out.collect())
    assert got == +copies


def test_row_repeated_without_end(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 100)
    rows = [(7, "one two three", "a")] * 2_050 + [(None, None, None)] * 130 + [(7, "one two three", "b")] * 60
    rows += [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(100, 4_000)]
    df = docs_of(spark, rows)
    numbers = mixing.numbered(mixing.counted(mixing.thin(df)))
    same = [r for r in numbers.collect() if r.source == "a" and r.id.doc_id == 7]
    assert sorted(r.nr for r in same) == list(range(2_050))
    held = numbers.filter("source = 'a' AND id.doc_id = 7").groupBy(F.pmod(F.xxhash64(F.lit(7), "id", "nr"), F.lit(64))).count()
    assert max(r["count"] for r in held.collect()) < 3 * 2_050 / 64                 # no bucket takes them all
    got = mixing.mix(df).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, s in rows)
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30
    copies = Counter()
    for r in got:
        copies[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixing.mixed_documents(df).collect()) == +copies


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.mixed_documents(docs_of(spark, [])).count() == 0
    only = mixing.mix(docs_of(spark, [(1, None, None), (2, "", "x")])).collect()
    assert [(r.target, r.taken) for r in only] == [(0.0, 0), (0.0, 0)]
