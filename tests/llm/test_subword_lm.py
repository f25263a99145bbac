import base64
import itertools
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from tributary.llm import subword_lm
from tributary.llm.queries import op5_subword_lm


def all_ways(word, scores):
    """Probability of a word by listing its segmentations."""
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in scores for p in parts):
            total += math.exp(sum(scores[p] for p in parts))
    return math.log(total) if total else -math.inf


def test_lattice_sums_all_segmentations():
    scores = {bytes([b]): -4.0 - b / 100 for b in b" abcdx"} | {b"ab": -2.5, b"abc": -3.0, b" a": -1.5, b"cd": -2.2, b"bcd": -6.0}
    for word in (b" abcd", b" aabbccdd", b"x", b" ", b"abcabc", b" abz"):
        assert subword_lm.lattice(word, scores, 3) == pytest.approx(all_ways(word, scores))
    assert subword_lm.lattice(b"", scores, 3) == 0.0


def model(rows):
    """rows: (doc_id, text) -> tuples like those of the report."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(p): int(r) for p, r in map(bytes.split, f)}
    encoding = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    words = {n: (t or "").encode().lower().split() for n, (_, t) in enumerate(rows)}
    counts, ends = Counter(), 0
    for n, (d, _) in enumerate(rows):
        if not held(d):
            counts.update(words[n])
            ends += 1
    tokens, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    used = Counter()
    for w, c in counts.items():
        for i in encoding.encode_ordinary(" " + w.decode()):
            used[i] += c
    total = sum(used.values()) + ends + 0.5 * (len(ranks) + 1)
    scores = {p: math.log((used[r] + 0.5) / total) for p, r in ranks.items()}
    longest, cache = max(map(len, scores)), {}
    out = []
    for n, (d, _) in enumerate(rows):
        base = lambda c: math.log10((c + 0.5) / (tokens + 0.5 * (distinct + 1)))
        b, s, known = base(ends), math.log((ends + 0.5) / total), int(ends > 0)
        for w in words[n]:
            b += base(counts[w])
            known += counts[w] > 0
            if w not in cache:
                cache[w] = subword_lm.lattice(b" " + w, scores, longest)
            s += cache[w]
        out.append((d, held(d), len(words[n]) + 1, known, tokens, b, s / math.log(10)))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4], round(r[5], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_edge_cases(spark):
    texts = [None, "", " \t\n\x0b", "One two TWO", "one", "üñ 🙂 漢字", "x" * 3000, "the the the the a", "long " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "no id"), (50, "only here"), (51, "other words entirely")]
    df = spark.createDataFrame([(d, t, b"x", 1) for d, t in rows], "doc_id long, text string, word binary, c int")
    same(subword_lm.report(df).collect(), model(rows))
    few = subword_lm.Settings(frequent=5)  # less is sent to all tasks, the result is the same
    same(subword_lm.report(df, few).collect(), model(rows))
    assert subword_lm.report(df.limit(0)).count() == 0
    held = spark.createDataFrame([(d, "a b") for d in range(200) if zlib.crc32(str(d).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r["n_known"], r["train_tokens"]) for r in subword_lm.report(held).collect()} == {(0, 0)}


def test_words_common_in_held_out_texts_only_or_long(spark):
    rows = [(d, ("y" * 200 + " some") if zlib.crc32(str(d).encode()) % 5 == 1 else "z" * 70) for d in range(100)]
    rows += [(d, None) for d in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (1, 3, 200_000):
        same(subword_lm.report(df, subword_lm.Settings(frequent=frequent)).collect(), model(rows))


def test_query_against_model(spark, sf_dir):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    same(op5_subword_lm(spark, sf_dir).collect(), model(docs))
