"""Vector codes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from statlake.llm import codebooks

SCHEMA = "vec_id long, embedding array<double>, label int, row string, position int, part string, error string"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    dims = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dims]
    widths = [dims // parts + (i < dims % parts) for i in range(parts)]
    cuts = [sum(widths[:i]) for i in range(parts + 1)]
    split = [[tuple(v[s:e]) for s, e in zip(cuts, cuts[1:])] for _, v, _ in kept]
    books = [[s[p] for s in split[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(s[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)] for s in split]
    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [s[p] for s, a in zip(split, at) if a[p][1] == i]
                if own:
                    books[p][i] = tuple(sum(c) // len(own) for c in zip(*own))
    at, total = assign(), {}
    for (_, _, label), a in zip(kept, at):
        total[label] = total.get(label, 0) + sum(g for g, _ in a)
    out = [(i, "".join(f"{e:02x}" for _, e in a), sum(g for g, _ in a), total[label]) for (i, _, label), a in zip(kept, at)]
    return sorted(out, key=repr), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def run(spark, rows, n=3, **conf):
    df = spark.createDataFrame([(*r, "x", 0, "y", "z") for r in rows], SCHEMA).repartition(n)
    coded, books = codebooks.compressed(df, **conf)
    coded = codebooks.with_label_error(coded)
    got = coded.select("vec_id", codebooks.hex_code(coded["code"]).alias("code"), "error", "label_error").collect()
    return sorted((tuple(r) for r in got), key=repr), codebooks.digest(books)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.3, 10).tolist(), int(i) % 3 or None) for i in rng.permutation(60)]
    rows += [(61, None, 1), (62, [], 1), (63, [None] * 10, 1), (64, [math.nan] * 10, 1), (65, [math.inf] + [0.0] * 9, 1), (66, [0.5] * 7, 1)]
    rows += [(None, [0.25] * 10, None), (5, [0.125] * 10, 2), (5, [0.125] * 10, 2), (70, [0.0] * 10, 2), (71, [-0.0] * 10, None), (72, [100.0, -100.0] * 5, 9)]
    assert run(spark, rows, entries=8) == brute(rows, entries=8)


def test_fewer_rows_than_entries_and_narrow_vectors(spark):
    rows = [(i, [i / 7, -i / 3, 1.0, 2.0], i % 2) for i in range(5)]
    assert run(spark, rows) == brute(rows)


def test_a_third_of_all_rows_equal(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "SALT_ROWS", 32)
    rng = np.random.default_rng(2)
    rows = [(i, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8], 1) for i in range(150)] + [(150 + i, rng.normal(0, 1, 8).tolist(), 2) for i in range(300)]
    assert run(spark, rows, n=5, entries=16) == brute(rows, entries=16)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [math.nan], 1)]])
def test_nothing_to_code(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_large_components_are_exact():
    rng = np.random.default_rng(3)
    parts, book = rng.integers(-1 << 27, 1 << 27, (50, 16)), rng.integers(-1 << 27, 1 << 27, (7, 16))
    at, error = codebooks.nearest(parts, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(book)) for p in parts]
    assert list(zip(error.tolist(), at.tolist())) == want
