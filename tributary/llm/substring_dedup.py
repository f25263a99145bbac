"""Removal of passages that a document with a smaller id holds, by compressed indexes per shard.

A window is ``window`` consecutive words. Its key is the smallest hash of the runs of ``gram`` words in
it, so equal windows have equal keys wherever they are. Consecutive windows of a document with one key
form a segment; only segments whose key occurs in two documents can hold a shared window. Equal segments
are one, under the smallest id; their words go to the shard of the key. There an FM-index is built over
them, the segments stream through it backwards, and each window gets the smallest id of the documents in
its interval of the suffix order. A window is removed from every document with a larger id.

Keys with very many segments are first trimmed to the windows whose hash occurs under two ids: a passage
that many documents hold between different neighbours becomes one body, and what is gathered under a key
grows with the different shared texts, not with the documents. Those keys are then split by a second hash
of the same kind. Runs of one key are cut after ``longest`` windows.

Null and empty texts have no words. A text shorter than a window keeps all words. Documents without id
keep theirs and are no source of removals. Rows with one id are each compared with smaller ids only.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written
from tributary.llm.fm_index import FMIndex


@dataclass(frozen=True)
class Settings:
    window: int = 50
    gram: int = 8
    longest: int = 128  # windows of a segment
    shard_words: int = 1_000_000
    crowded: int = 20_000  # segments of one key from which it is trimmed and split


FACTOR, MIX, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA24BAED4963EE407)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mixed(hashes: np.ndarray, factor: np.uint64 = MIX) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * factor
    return hashes ^ (hashes >> np.uint64(29))


def _numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_keys(numbers: np.ndarray, settings: Settings, factor: np.uint64 = MIX) -> np.ndarray:
    """The smallest hash of a run of words in each window; numbers of at least one window of words."""
    count = len(numbers) - settings.gram + 1
    grams = np.zeros(count, np.uint64)
    for i in range(settings.gram):
        grams = grams * FACTOR + numbers[i:i + count]
    least, width, runs = _mixed(grams, factor), 1, settings.window - settings.gram + 1
    while 2 * width <= runs:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:len(least) - (runs - width)], least[runs - width:])


def _runs(keys: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and number of windows of each run of one key."""
    change = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(change, len(keys)))
    pieces = -(-sizes // longest)
    starts = np.repeat(change, pieces) + longest * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return starts, np.minimum(longest, np.repeat(change + sizes, pieces) - starts)


def segments(documents: DataFrame, settings: Settings) -> DataFrame:
    """``key, body, doc_id, text_key, start, n``: runs of windows with one key; ``body`` is a hash of the words."""
    names = ["key", "body", "doc_id", "text_key", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = inverse = np.ones(1, np.uint64)
        back = np.uint64(pow(int(FACTOR), -1, 1 << 64))
        for batch in batches:
            out = [[] for _ in names]
            for doc, text_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                if len(words) < settings.window:
                    continue
                numbers = _numbers(words)
                keys = window_keys(numbers, settings)
                starts, sizes = _runs(keys, settings.longest)
                if len(powers) <= len(words):
                    with np.errstate(over="ignore"):
                        powers = np.cumprod(np.append(np.uint64(1), np.full(2 * len(words), FACTOR)))
                        inverse = np.cumprod(np.append(np.uint64(1), np.full(2 * len(words), back)))
                sums = np.append(np.uint64(0), np.cumsum(_mixed(numbers, SECOND) * powers[:len(numbers)]))
                ends = starts + sizes + settings.window - 1
                body = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
                for column, values in zip(out, (
                    keys[starts].view(np.int64), _mixed(body).view(np.int64), np.full(len(starts), doc),
                    np.full(len(starts), text_key), starts, sizes,
                )):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out], names)

    return documents.select("doc_id", "text_key", "text").where("doc_id IS NOT NULL").mapInArrow(
        run, ", ".join(f"{n} long" for n in names))


def _window_hashes(documents: DataFrame, busy: DataFrame, settings: Settings) -> DataFrame:
    """``key, doc_id, text_key, start, at, hash``: every window of the segments, ``at`` counted from the text's start."""
    names = ["key", "doc_id", "text_key", "start", "at", "hash"]
    lists = busy.select("key", "doc_id", "text_key", "start", "n").distinct().groupBy(
        F.col("doc_id").alias("of"), F.col("text_key").alias("of_text")).agg(
        F.collect_list(F.struct("key", "start", "n")).alias("parts"))
    rows = documents.join(lists, (F.col("doc_id") == F.col("of")) & (F.col("text_key") == F.col("of_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text_key, text, parts in zip(*(batch.column(k).to_pylist() for k in range(2)), batch.column(2), batch.column(3)):
                numbers, out = _mixed(_numbers(words_of(text.as_py())), SECOND), [[] for _ in names]
                for p in parts.as_py():
                    n, start = p["n"], p["start"]
                    hashes = np.zeros(n, np.uint64)
                    for i in range(settings.window):
                        hashes = hashes * FACTOR + numbers[start + i:start + i + n]
                    for column, values in zip(out, (
                        np.full(n, p["key"]), np.full(n, doc), np.full(n, text_key), np.full(n, start),
                        np.arange(start, start + n), _mixed(hashes).view(np.int64),
                    )):
                        column.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names)

    return rows.select("doc_id", "text_key", "text", "parts").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _trimmed(documents: DataFrame, busy: DataFrame, settings: Settings) -> DataFrame:
    """The segments cut to the runs of windows whose hash occurs under two ids, and a body for each run."""
    names = ["key", "body", "doc_id", "text_key", "start", "n"]
    windows = written(_window_hashes(documents, busy, settings))
    known = written(windows.groupBy(F.col("hash").alias("same")).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("many")).where("low < high"))
    # Hashes with many windows are few, at most one in ``crowded``: they go to every task, so the join has no hot key.
    often = known.where(F.col("many") > settings.crowded).select("same")
    rare = known.where(F.col("many") <= settings.crowded).select("same")
    at_often = windows.join(F.broadcast(often), F.col("hash") == F.col("same"), "left_semi")
    at_rare = windows.join(F.broadcast(often), F.col("hash") == F.col("same"), "left_anti").join(
        rare, F.col("hash") == F.col("same"), "left_semi")
    runs = at_often.unionByName(at_rare).groupBy("key", "doc_id", "text_key", "start").agg(
        F.array_sort(F.collect_set(F.struct("at", "hash"))).alias("windows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, doc, text_key, windows in zip(*(batch.column(k).to_pylist() for k in range(4))):
                at = np.array([w["at"] for w in windows])
                hashes = np.array([w["hash"] for w in windows], np.int64)
                begins = np.flatnonzero(np.append(True, np.diff(at) != 1))
                for b, e in zip(begins, np.append(begins[1:], len(at))):
                    body = xxhash.xxh64_intdigest(hashes[b:e].tobytes()) - (1 << 63)
                    out.append((key, body, doc, text_key, int(at[b]), int(e - b)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(6)], names)

    return runs.select("key", "doc_id", "text_key", "windows").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def shared_segments(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The segments whose key occurs under two ids, and whether the key is ``crowded``; those are trimmed."""
    found = written(segments(documents, settings))
    keys = found.groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("many")).where("low < high")
    keys = keys.select(F.col("key").alias("shared"), (F.col("many") > settings.crowded).alias("crowded"))
    shared = written(found.join(keys, F.col("key") == F.col("shared")).drop("shared"))
    busy = shared.where("crowded")
    if busy.isEmpty():
        return shared
    trimmed = _trimmed(documents, busy, settings).withColumn("crowded", F.lit(True))
    return written(shared.where("NOT crowded").unionByName(trimmed))


def _shard_texts(documents: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """The words of the wanted segments: ``cell, key, body, doc_id, top, shift, words``."""
    names = ["cell", "key", "body", "doc_id", "top", "shift", "words"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    lists = wanted.groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text")).agg(
        F.collect_list(F.struct("key", "body", "start", "n", "top", "crowded")).alias("parts"))
    rows = documents.join(lists, (F.col("doc_id") == F.col("of")) & (F.col("text_key") == F.col("of_text")))
    rows = rows.select("doc_id", "text", "parts", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words, out = words_of(text.as_py()), []
                for p in parts.as_py():
                    some = words[p["start"]:p["start"] + p["n"] + settings.window - 1]
                    if not p["crowded"]:
                        out.append((p["key"], p["key"], p["body"], doc, p["top"], 0, b" ".join(some)))
                        continue
                    second = window_keys(_numbers(some), settings, SECOND)
                    for start, n in zip(*_runs(second, settings.longest)):
                        cell = xxhash.xxh64_intdigest(f"{p['key']}/{second[start]}") - (1 << 63)
                        out.append((cell, p["key"], p["body"], doc, p["top"], int(start),
                                    b" ".join(some[start:start + n + settings.window - 1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", words binary")


def search(texts: list[list[bytes]], ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of the texts that hold each window, for every position of all texts (-1: no whole window),
    and where each text starts."""
    numbers: dict[bytes, int] = {}
    arrays = [np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in t), np.int64, len(t)) for t in texts]
    index = FMIndex(arrays, window)
    owners = np.repeat(ids, [len(a) + 1 for a in arrays])
    lowest = index.lowest(owners)
    _, group, begin = index.matching(arrays)
    return np.where(group >= 0, lowest[group], -1), begin


def _shared_windows(shard: pa.Table, window: int) -> pa.Table:
    """Runs of windows with one smallest owner: ``key, body, first, n, owner``, where some document has a larger id."""
    texts = [w.as_py().split(b" ") for w in shard.column("words")]
    key, body, ids, top, shift = (shard.column(n).to_numpy() for n in ("key", "body", "doc_id", "top", "shift"))
    # Ids may be any numbers: -1 stands for no window, so owners are places among the sorted ids.
    order, place = np.unique(ids, return_inverse=True)
    owner, begin = search(texts, place, window)
    out = [[] for _ in range(5)]
    for k, text in enumerate(texts):
        own = owner[begin[k]:begin[k] + len(text) - window + 1]
        starts, sizes = _runs(own, len(own))
        found = order[own[starts]]
        for column, values in zip(out, (
            np.full(len(starts), key[k]), np.full(len(starts), body[k]), starts + shift[k], sizes, found,
        )):
            column.append(values[found < top[k]])
    return pa.table(
        [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out],
        names=["key", "body", "first", "n", "owner"])


def removed_ranges(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, text_key, first, end``: ranges of words to remove (they may overlap), of ``doc_id, text_key, text``."""
    shared = shared_segments(documents, settings)
    place = F.struct("doc_id", "text_key", "start", "n", "crowded")
    wanted = shared.groupBy("key", "body").agg(F.min(place).alias("at"), F.max("doc_id").alias("top")).select(
        "key", "body", "top", "at.*")
    wanted = written(wanted)
    words = wanted.agg(F.sum(F.col("n") + settings.window)).first()[0] or 0
    shards = max(1, -(-words // settings.shard_words))
    texts = _shard_texts(documents, wanted, settings).withColumn("shard", F.pmod(F.xxhash64("cell"), F.lit(shards)))
    owners = texts.groupBy("shard").applyInArrow(
        lambda shard: _shared_windows(shard, settings.window), "key long, body long, first long, n long, owner long")
    owners = written(owners.distinct()).select(
        F.col("key").alias("k"), F.col("body").alias("b"), "first", F.col("n").alias("windows"), "owner")
    hits = shared.join(owners, (F.col("key") == F.col("k")) & (F.col("body") == F.col("b")) & (F.col("owner") < F.col("doc_id")))
    first = F.col("start") + F.col("first")
    return hits.select("doc_id", "text_key", first.alias("first"), (first + F.col("windows") + settings.window - 1).alias("end"))


def _once_each(rows: DataFrame) -> DataFrame:
    """The rows with one of each id and text. Most tables repeat none and are not shuffled."""
    repeated = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    return rows if repeated.isEmpty() else written(rows.dropDuplicates(["doc_id", "text_key"]))


def report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: its words, how many are removed, and a digest of the others joined by blanks."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    ranges = removed_ranges(_once_each(rows), settings).groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text")).agg(
        F.collect_list(F.struct("first", "end")).alias("ranges"))
    joined = rows.join(ranges, (F.col("doc_id") == F.col("of")) & (F.col("text_key") == F.col("of_text")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                keep, n = words, 0
                if ranges.is_valid:
                    cover = np.zeros(len(words) + 1, np.int64)
                    for r in ranges.as_py():
                        cover[r["first"]] += 1
                        cover[r["end"]] -= 1
                    gone = np.cumsum(cover)[:-1] > 0
                    n = int(gone.sum())
                    keep = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((doc, len(words), n, hashlib.sha256(b" ".join(keep)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.select("doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
