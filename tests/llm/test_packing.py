import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import packing
from tributary.llm.queries import op6_pack


def lower_bound(lengths, limit):
    return -(-sum(k * v for k, v in lengths.items()) // limit)


def check_plan(lengths, limit):
    plan = packing.plan(dict(lengths), limit)
    used = defaultdict(int)
    for count, pattern in plan:
        assert count > 0 and sum(s * n for s, n in pattern) <= limit
        for s, n in pattern:
            used[s] += count * n
    assert dict(used) == {k: v for k, v in lengths.items() if v}
    return sum(count for count, _ in plan)


def fewest(items, limit):
    """The least number of sequences, by trying all ways."""
    best = len(items)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= rest[0] and bins[i] not in bins[:i]:
                place(rest[1:], bins[:i] + [bins[i] - rest[0]] + bins[i + 1:])
        place(rest[1:], bins + [limit - rest[0]])

    place(sorted(items, reverse=True), [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=9))
def test_reduction_keeps_a_best_packing(items):
    limit = 30
    left = [0] * (limit + 1)
    for s in items:
        left[s] += 1
    fixed = packing.reduce_by_dominance(left)
    rest = [s for s, n in enumerate(left) for _ in range(n)]
    assert sum(n for n, _ in fixed) + fewest(rest, limit) == fewest(items, limit)


def test_plans():
    rng = random.Random(1)
    assert check_plan({}, 2048) == 0
    assert check_plan({2048: 5}, 2048) == 5
    assert check_plan({1: 2048 * 3}, 2048) == 3
    assert check_plan({1025: 7, 1023: 9}, 2048) <= 9
    for _ in range(20):
        lengths = {rng.randint(1, 2048): rng.choice([1, 3, 50, 4000]) for _ in range(rng.randint(1, 900))}
        bins, bound = check_plan(lengths, 2048), lower_bound(lengths, 2048)
        large = sum(n for s, n in lengths.items() if s > 1024)
        assert bins <= max(bound * 1.01 + 1, large * 1.01 + 1, bound * 1.25)


def check_rows(rows, texts, limit):
    """texts: (doc_id, text) in any order, each a row of its own."""
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc, text in texts:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = [len(ids)] if len(ids) <= limit else [len(ids) % limit] * (len(ids) % limit > 0) + [limit] * (len(ids) // limit)
        at = 0
        for n, length in enumerate(parts):
            expected.append((doc, n, at, length, zlib.crc32(ids[at:at + length].tobytes())))
            at += length
    assert sorted(map(str, [tuple(r)[:5] for r in rows])) == sorted(map(str, expected))
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_edge_cases(spark):
    texts = [None, "", "", "a" * 5000, "word " * 4000, "<|endoftext|> spelled out", "üñ🙂 \n\n\t x", "same", "same", "x" * 3]
    rows = [(i, t, 1, "clash") for i, t in enumerate(texts)] + [(7, "same", 1, "clash"), (None, "no id", 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int, part string").repartition(3)
    check_rows(packing.packed(df, 64).collect(), [r[:2] for r in rows], 64)
    assert packing.packed(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op6_pack(spark, sf_dir).collect()
    bins = check_rows(rows, docs, 2048)
    assert bins <= -(-sum(r["length"] for r in rows) // 2048) + 2
