"""Subword lattice likelihood of documents.

The pieces of an existing vocabulary get unigram scores from how often its tokenizer uses them in the
training texts. The probability of a word, with the blank before it, is the sum over all ways to cut it
into pieces, by a forward recursion in log space. No piece crosses a blank, so the words of a document
are independent given the scores, and a word is scored once however often it occurs.

The table of words (count in training texts, lattice score) covers the whole corpus. Words so common
that each makes up a share of at least ``1 / frequent`` of all words, of which there are at most
``frequent``, are sent to every task, which adds them up on the spot; the other words of a document are
joined with the table. Words count whether the model learns from their texts or not. Long ones need a
share for every ``WORD_BYTES`` bytes begun, so what is sent has ``frequent * WORD_BYTES`` bytes at most.

Null, empty and blank texts have the end token only. Repeated rows and ids are rows of their own.
"""

import base64
import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fold_of, written

FLUSH = 200_000  # words or rows held by a task before it hands them on
WORD_BYTES = 64


@dataclass(frozen=True)
class Settings:
    ranks: str | None = None  # file of pieces; by default the byte-level one of the public tokenizers
    frequent: int = 200_000
    smoothing: float = 0.5


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _path(settings: Settings) -> str:
    if settings.ranks:
        return settings.ranks
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def lattice(word: bytes, scores: dict[bytes, float], longest: int) -> float:
    """Natural logarithm of the probability of a string over all its segmentations."""
    ends = [0.0]
    for end in range(1, len(word) + 1):
        ways = [ends[start] + score for start in range(max(0, end - longest), end)
                if (score := scores.get(word[start:end])) is not None]
        if len(ways) == 1:
            ends.append(ways[0])
        elif ways:
            top = max(ways)
            ends.append(top + math.log(sum([math.exp(w - top) for w in ways])))
        else:
            ends.append(-math.inf)
    return ends[-1]


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, c, n``: how often each word of the corpus occurs in the rows with ``train``, and in all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), Counter()

        def out() -> pa.RecordBatch:
            words = [*train, *[w for w in other if w not in train]]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()),
                 pa.array([train[w] + other[w] for w in words], pa.int64())], ["word", "c", "n"])
            train.clear(), other.clear()
            return batch

        for batch in batches:
            for use, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                (train if use else other).update(words_of(text.as_py()))
                if len(train) + len(other) > FLUSH:
                    yield out()
        yield out()

    counted = rows.select("train", "text").mapInArrow(run, "word binary, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def piece_scores(words: DataFrame, ends: int, settings: Settings) -> tuple[dict[bytes, float], float]:
    """Natural logarithms of the pieces' shares in the training words, and of the end of a text."""
    path = _path(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, encoding = _encoding(path)
        total = np.zeros(max(ranks.values()) + 1)
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in _cut(encoding, word):
                    total[piece] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used].astype(np.int64))], ["piece", "n"])

    used = words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n long")
    ranks, _ = _encoding(path)  # as many rows as the vocabulary has pieces, at most
    counts = {r["piece"]: r["n"] for r in used.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values()) + ends + settings.smoothing * (len(ranks) + 1)
    score = lambda n: math.log((n + settings.smoothing) / total)
    return {piece: score(counts.get(rank, 0)) for piece, rank in ranks.items()}, score(ends)


def _cut(encoding, word: bytes) -> list[int]:
    return encoding.encode_ordinary(" " + word.decode("utf-8", "replace"))


def scored_words(words: DataFrame, scores: dict[bytes, float]) -> DataFrame:
    """The words with ``s``, the natural logarithm of their lattice probability."""
    longest = max(map(len, scores))
    sent = words.sparkSession.sparkContext.broadcast(scores)  # one entry per piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lattice(b" " + w, sent.value, longest) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], ["word", "c", "n", "s"])

    return words.select("word", "c", "n").mapInArrow(run, "word binary, c long, n long, s double")


def _sums(rows: DataFrame, common: dict[bytes, tuple[float, float, int]]) -> DataFrame:
    """The words of each row that are not common, ``tf`` each; the sums of the common ones with one of them.

    A text without other words gives one row, under a word of its own that no text has.
    """
    sent = rows.sparkSession.sparkContext.broadcast(common)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    names = ["row", "doc_id", "word", "tf", "base", "score", "n", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, out = sent.value, [[] for _ in names]

        def full() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts = Counter(words_of(text.as_py()))
                base = score = 0.0
                n = known = 0
                rest, times = [], []
                for word, tf in counts.items():
                    found = known_words.get(word)
                    if found is None:
                        rest.append(word)
                        times.append(tf)
                    else:
                        base += tf * found[0]
                        score += tf * found[1]
                        known += tf * found[2]
                    n += tf
                if not rest:
                    rest, times = [b" %d" % row], [0]  # words have no blanks; many such rows do not meet
                more = [0] * (len(rest) - 1)
                for column, values in zip(out, (
                    [row] * len(rest), [doc] * len(rest), rest, times, [base, *more], [score, *more], [n, *more], [known, *more],
                )):
                    column.extend(values)
                if len(out[0]) > FLUSH:
                    yield full()
        yield full()

    return rows.select("row", "doc_id", "text").mapInArrow(run, ", ".join(
        f"{n} {k}" for n, k in zip(names, "long long binary long double double long long".split())))


def score(documents: DataFrame, training: Column, settings: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``, learned from the rows with ``training``."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(training, F.lit(False)).alias("train"))
    counts = written(word_counts(rows))
    ends = rows.where("train").count()
    total = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.count_if(F.col("c") > 0).alias("v"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    tokens, distinct = total["c"] + ends, total["v"] + (ends > 0)
    pieces, end = piece_scores(counts, ends, settings)
    words = written(scored_words(counts, pieces))
    scale = tokens + 0.5 * (distinct + 1)
    base = lambda c: math.log10((c + 0.5) / scale)
    often = words.where(F.col("n") * settings.frequent >= F.lit(total["n"]) * F.ceil(F.length("word") / WORD_BYTES))
    common = {bytes(r["word"]): (base(r["c"]), r["s"], int(r["c"] > 0)) for r in often.collect()}
    sums = _sums(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), common)
    table = words.select(F.col("word").alias("w"), "c", "s")
    joined = sums.join(table, F.col("word") == F.col("w"), "left")
    tf, c = F.col("tf"), F.coalesce("c", F.lit(0))
    added = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n").alias("n"),
        F.sum(F.col("known") + F.when(c > 0, tf).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(tf > 0, tf * F.log10((c + 0.5) / scale)).otherwise(0.0)).alias("base"),
        F.sum(F.col("score") + F.when(tf > 0, tf * F.col("s")).otherwise(0.0)).alias("natural"),
    )
    return added.select(
        "doc_id",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + base(ends)).alias("base_score"),
        ((F.col("natural") + end) / math.log(10)).alias("score"),
    )


def report(documents: DataFrame, settings: Settings = Settings(), folds: int = 5) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), folds) == 1
    found = score(documents, ~held_out, settings)
    return found.select("doc_id", held_out.alias("held_out"), *[c for c in found.columns if c != "doc_id"])
