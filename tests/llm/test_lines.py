"""Line dedup against plain Python, and the perfect hash it rests on."""

import numpy as np
import pytest

from statlake.llm import line_dedup
from statlake.llm.perfect_hash import PerfectHash

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, hi string, block int"


def lower(key: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)


def brute(rows, least_chars=20, least_docs=3):
    def key(line):
        k = lower(line.strip(SPACE))
        return k if len(k) >= least_chars else None

    def rank(doc_id):
        return -(1 << 63) if doc_id is None else doc_id
    texts = [((i, rank(r[0])), (r[1] or "").split("\n")) for i, r in enumerate(rows)]
    holders = {}
    for who, lines in texts:
        for k in {key(x) for x in lines} - {None}:
            holders.setdefault(k, []).append(who)
    keeper = {k: max(d for _, d in who) for k, who in holders.items() if len(who) >= least_docs}
    out = []
    for (i, doc_id), lines in texts:
        kept = [x for x in lines if keeper.get(key(x), doc_id) == doc_id]
        out.append((rows[i][0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, parts=3, **conf):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in line_dedup.deduplicated_lines(df, **conf).collect()), key=repr)


def test_odd_rows(spark):
    common, other = "This line is found in many documents.", "ÄÖ a line of another kind, also often seen"
    rows = [(i, f"own line number {i} of this text\n{common}\nshort\n  {common.upper()}\t") for i in range(9)]
    rows += [(None, common), (None, common), (None, None), (20, ""), (20, ""), (21, f"{other}\r\n{other.replace('a', 'A')}\n"), (21, other), (22, other)]
    rows += [(30, "äö" * 10), (31, "ÄÖ" * 10), (32, "äö" * 10), (33, "äö" * 10), (34, "x" * 19), (35, "X" * 19), (36, "x" * 19), (37, "\n\n\n")]
    rows += [(40, "y" * 20), (41, "Y" * 20), (42, f" {'y' * 20}\x0b")]
    assert run(spark, rows) == brute(rows)


def test_only_null_ids(spark):
    rows = [(None, "a line that is long enough to count")] * 4
    assert run(spark, rows) == brute(rows)


def test_many_lines_over_shards_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    names = [f"line {i} with enough characters" for i in range(400)]
    rows = [(int(rng.integers(0, 300)), "\n".join(names[j] for j in rng.zipf(1.3, 12) % 400)) for _ in range(600)]
    rows += [(1, "\n".join(f"line {i} of a very long text of many lines" for i in range(20_000)))]
    monkeypatch.setattr(line_dedup, "SHARD_ENTRIES", 500)
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 16)
    assert run(spark, rows, parts=7) == brute(rows)


def test_a_third_of_all_rows_repeated(spark):
    rows = [(7, "the very same row again and again\nand another long line of it")] * 500 + [(i, f"text number {i} stands for itself") for i in range(1000)]
    assert run(spark, rows, parts=5) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    index = PerfectHash.of(keys)
    again = PerfectHash.read(*index.stored())
    assert sorted(again.slots(keys).tolist()) == list(range(n))
    assert n < 1000 or index.sizes.sum() < 4 * n


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.of(np.ones((2, 2), np.uint64))
