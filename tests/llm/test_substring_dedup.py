import time
import random

import numpy as np

from tests.llm import brute
from tributary.llm import substring_dedup
from tributary.llm.fm_index import FMIndex, WaveletMatrix
from tributary.llm.queries import op9_substring_dedup


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def model(rows, window):
    first = {}
    for d, t in rows:
        words = split(t or "")
        for i in range(len(words) - window + 1):
            if d is not None:
                key = tuple(words[i:i + window])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        words = split(t or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(words), len(gone), brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=str)


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    for size, top in ((1, 1), (64, 3), (1000, 37), (500, 1)):
        symbols = rng.integers(0, top, size)
        tree = WaveletMatrix(symbols)
        for c in set(symbols.tolist()):
            at = np.arange(size + 1)
            start = tree.moved(np.array([c]), np.array([0]))
            assert (tree.moved(np.full(size + 1, c), at) - start == [(symbols[:i] == c).sum() for i in at]).all()


def test_matching_statistics():
    rng = random.Random(5)
    for threshold in (1, 2, 3, 5, 8):
        texts = [np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 30))]) for _ in range(12)]
        index = FMIndex(texts, threshold)
        streamed = texts + [np.array([rng.randint(1, 5) for _ in range(25)]) for _ in range(6)]
        length, group, begin = index.matching(streamed)
        whole = [tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, min(len(t), i + threshold) + 1)]
        known = set(whole)
        owners = index.lowest(np.concatenate([np.full(len(t) + 1, k) for k, t in enumerate(texts)]))
        for t, b in zip(streamed, begin):
            for i in range(len(t)):
                best = max((n for n in range(1, threshold + 1) if i + n <= len(t) and tuple(t[i:i + n]) in known), default=0)
                assert length[b + i] == best
                assert (group[b + i] >= 0) == (best == threshold)
                if best == threshold:
                    holders = [k for k, x in enumerate(texts) if any(
                        tuple(x[j:j + threshold]) == tuple(t[i:i + threshold]) for j in range(len(x)))]
                    assert owners[group[b + i]] == min(holders)


def corpus(rng, docs=60):
    passages = [[f"p{k}w{rng.randint(0, 30)}" for _ in range(rng.choice([9, 10, 11, 25, 60]))] for k in range(6)]
    rows = []
    for d in range(docs):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 30))]
            if rng.random() < 0.7:
                words += rng.choice(passages)
        rows.append((d * 3 - 40, " ".join(words)))
    return rows


def test_against_all_windows(spark):
    rng = random.Random(11)
    rows = corpus(rng) + [
        (500, None), (501, ""), (502, "a " * 3000), (503, "a " * 40), (504, "b a b a b a b a b a b a b a"), (505, "a b " * 300),
        (None, "a " * 50), (502, "a " * 3000), (502, "a b " * 40),
    ]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, key int, text_key string")
    for settings in (substring_dedup.Settings(10, 3, 7, 500, 5), substring_dedup.Settings(10, 3, 128, 10_000, 1000),
                     substring_dedup.Settings(10, 10, 128, 100, 1)):
        got = sorted(map(tuple, substring_dedup.report(df, settings).collect()), key=str)
        assert got == model(rows, 10)
    assert any(r[2] for r in model(rows, 10))
    assert substring_dedup.report(df.limit(0)).count() == 0


def test_query_against_model(spark, sf_dir):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, op9_substring_dedup(spark, sf_dir).collect()), key=str)
    assert got == model(docs, 50)


def test_common_passage_is_one_body_whatever_its_neighbours(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(d, " ".join([*(f"a{d}x{i}" for i in range(12)), passage, *(f"b{d}x{i}" for i in range(12))])) for d in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) AS text_key", "text")
    bodies = lambda crowded: max(r["count"] for r in substring_dedup.shared_segments(
        df, substring_dedup.Settings(10, 3, 128, 10_000, crowded)).select("key", "body").distinct().groupBy("key").count().collect())
    assert bodies(5) <= 5  # untrimmed, every document has bodies of its own
    assert bodies(1000) >= 30
    settings = substring_dedup.Settings(10, 3, 128, 10_000, 5)
    assert sorted(map(tuple, substring_dedup.report(df, settings).collect()), key=str) == model(rows, 10)


def test_many_repeated_rows(spark):
    passage = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, passage)] + [(2, passage)] * 10_000, "doc_id long, text string").repartition(8)
    start = time.monotonic()
    rows = substring_dedup.report(df).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, rows)) == [(1, 300, 0, 1), (2, 300, 300, 10_000)]
    assert time.monotonic() - start < 60
