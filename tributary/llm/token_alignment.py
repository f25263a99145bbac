"""Tokens of two tokenizers aligned: the smallest groups that cover the same bytes.

A byte offset where a token of A and a token of B both end is a cut. The cuts of a text are found by divide
and conquer: within an interval of tokens a common end near the middle is looked up by bisection, outwards from
the middle of the side with fewer tokens; both halves follow. An interval without a cut inside is one group. The
intervals of many texts are halved together, one place looked up in each at a time.

Tokens are never empty, so exactly one token of A and one of B end at a cut: a group has one link, between its
last tokens. How often an id pair is linked counts over all rows. A row takes the counts of its links from a
table of the frequent pairs, those above one in ``frequent`` links and so at most ``frequent`` pairs, that every
task gets; links of other pairs, each of which is rare, meet their counts by a shuffle.

A is a byte-level vocabulary applied to a blank and the text, B a piece vocabulary applied to the text, which
puts the blank in front itself. Special tokens are not added, and their strings in a text are plain text. Null
and empty texts, and texts that the joined tokens of A or B do not spell, have no tokens. Repeated rows count
as often as they occur; null ids pass through; other columns are ignored.
"""

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.layout import shared_folder
from tributary.llm.common import vocabulary_path, written

GROUPS = "array<struct<a:array<int>,b:array<int>>>"
FREQUENT = 200_000
TOKENS_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Vocabularies:
    """Files of the two vocabularies: byte-level ranks, and a piece model."""

    ranks: str | None = None
    pieces: str | None = None

    def paths(self) -> tuple[str, str]:
        return self.ranks or vocabulary_path("byte_bpe_50k.tiktoken"), self.pieces or vocabulary_path("piece_bpe_32k.model")


class Encoder:
    """Ids of both sides of a text, and how many bytes each id stands for."""

    def __init__(self, ranks: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.byte_level = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.spelled = [
            bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]
        self.lengths_a = np.zeros(max(known.values()) + 1, "i8")
        for piece, rank in known.items():
            self.lengths_a[rank] = len(piece)
        self.lengths_b = np.array([len(piece) for piece in self.spelled], "i8")

    def __call__(self, text: str | None) -> tuple[list[int], list[int]]:
        """Nothing on either side for texts that are not spelled by both."""
        if not text:
            return [], []
        whole = " " + text
        raw = whole.encode()
        a, b = self.byte_level.encode_ordinary(whole), self.model.encode(text)
        same = self.byte_level.decode_bytes(a) == raw and b"".join(map(self.spelled.__getitem__, b)) == raw
        return (a, b) if same else ([], [])


@functools.cache
def encoder(ranks: str, pieces: str) -> Encoder:
    return Encoder(ranks, pieces)


@dataclass(frozen=True)
class Alignment:
    """Some texts: the ids of all of them in a row, and where texts and groups end among them."""

    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray  # ids before each text, and after the last
    text_b: np.ndarray
    cut_a: np.ndarray  # ids up to each cut
    cut_b: np.ndarray
    text_cut: np.ndarray  # cuts before each text, and after the last


def align(pairs: list[tuple[list[int], list[int]]], encode: Encoder) -> Alignment:
    def flat(k: int) -> tuple[np.ndarray, np.ndarray]:
        every = np.fromiter(chain.from_iterable(p[k] for p in pairs), "i4")
        return every, np.cumsum([0, *(len(p[k]) for p in pairs)])

    (a, text_a), (b, text_b) = flat(0), flat(1)
    # Both sides of a text have the same bytes, so one count of bytes runs through all texts.
    cut_a, cut_b = cuts(np.cumsum(encode.lengths_a[a]), np.cumsum(encode.lengths_b[b]), text_a, text_b)
    return Alignment(a, b, text_a, text_b, cut_a, cut_b, np.searchsorted(cut_a, text_a, "right"))


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, text_a: np.ndarray, text_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ids of A and of B lie before each cut, ascending. Halves all open intervals at a time."""
    some = np.flatnonzero(np.diff(text_a))
    # Rows: first id and end of A, first id and end of B, places looked at so far.
    wait = np.array([text_a[some], text_a[some + 1], text_b[some], text_b[some + 1], np.zeros_like(some)])
    groups = []
    while wait.shape[1]:
        a0, a1, b0, b1, looked = wait
        on_a = a1 - a0 <= b1 - b0
        # The last end of an interval is a cut already, so it is not looked up.
        low, count = np.where(on_a, a0, b0), np.where(on_a, a1 - a0, b1 - b0) - 1
        whole = looked >= count + (count > 0)
        if whole.any():
            groups.append(wait[[1, 3]][:, whole])
            wait, on_a, low, count = wait[:, ~whole], on_a[~whole], low[~whole], count[~whole]
            a0, a1, b0, b1, looked = wait
        # The middle, one behind it, one before it, two behind it, ...
        at = low + count // 2 + np.where(looked % 2 == 1, (looked + 1) // 2, -(looked // 2))
        inside = (at >= low) & (at < low + count)
        at = np.where(inside, at, low)
        other = np.empty_like(at)
        same = np.empty(len(at), bool)
        for side, ends, others, first, end in ((on_a, ends_a, ends_b, b0, b1), (~on_a, ends_b, ends_a, a0, a1)):
            wanted = ends[at[side]]
            found = np.searchsorted(others, wanted)
            other[side] = found
            same[side] = (others[np.minimum(found, end[side] - 1)] == wanted) & (found >= first[side]) & (found < end[side] - 1)
        same &= inside
        missed = wait[:, ~same]
        missed[4] += 1
        half_a, half_b = np.where(on_a, at, other)[same] + 1, np.where(on_a, other, at)[same] + 1
        a0, a1, b0, b1, _ = wait[:, same]
        none = np.zeros_like(half_a)
        wait = np.concatenate([[a0, half_a, b0, half_b, none], [half_a, a1, half_b, b1, none], missed], axis=1)
    cut_a, cut_b = np.concatenate([np.zeros((2, 0), "i8"), *groups], axis=1)
    order = np.argsort(cut_a)
    return cut_a[order], cut_b[order]


def _each(documents: DataFrame, vocabularies: Vocabularies, id_col: str, text_col: str, columns: str, arrays) -> DataFrame:
    """``id`` and what ``arrays(alignment)`` gives, for every row."""
    paths, names = vocabularies.paths(), [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*paths)
        for batch in batches:
            pairs, first, size = [], 0, 0
            for number, text in enumerate(batch.column(1), 1):
                pairs.append(encode(text.as_py()))
                size += len(pairs[-1][0])
                if size >= TOKENS_AT_ONCE or number == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[first:number], *arrays(align(pairs, encode))], [id_col, *names])
                    pairs, first, size = [], number, 0

    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, {columns}")


def _groups(found: Alignment) -> list[pa.Array]:
    def side(ids: np.ndarray, cut: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], cut]).astype("i4")), pa.array(ids))

    groups = pa.StructArray.from_arrays([side(found.a, found.cut_a), side(found.b, found.cut_b)], ["a", "b"])
    return [pa.ListArray.from_arrays(pa.array(found.text_cut.astype("i4")), groups)]


def aligned(documents: DataFrame, vocabularies: Vocabularies = Vocabularies(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``id, groups``: for every input row its groups of ids of A and B, in the order of the text."""
    return _each(documents, vocabularies, id_col, text_col, f"groups {GROUPS}", _groups)


def links(found: Alignment) -> pa.Array:
    """Per text the id pairs whose ends meet, one long each: the id of A in the upper half, that of B in the lower."""
    pairs = found.a[found.cut_a - 1].astype("i8") << 32 | found.b[found.cut_b - 1]
    return pa.ListArray.from_arrays(pa.array(found.text_cut.astype("i4")), pa.array(pairs))


@functools.cache
def _written_ids(size_a: int, size_b: int) -> list[str]:
    """Ids of A, then of B, each followed by its sign within a group and by its sign at the end of one."""
    return [f"{i}{sign}" for size, last in ((size_a, "|"), (size_b, ";")) for i in range(size) for sign in (",", last)]


def digests(found: Alignment, size_a: int, size_b: int) -> list[str]:
    """Per text the SHA-256 of ``a1,a2|b1;a3|b2,b3``; '' without groups."""
    size = len(found.a) + len(found.b)
    codes = np.empty(size, "i8")
    for ids, cut, other, first, behind in (
        (found.a, found.cut_a, found.cut_b, 0, False), (found.b, found.cut_b, found.cut_a, 2 * size_a, True),
    ):
        lengths = np.diff(cut, prepend=0)
        # Ids of the other side that are written before: those of earlier groups, for B also of its own.
        shift = other if behind else np.concatenate([[0], other[:-1]])
        code = first + 2 * ids.astype("i8")
        code[cut - 1] += 1
        codes[np.arange(len(ids)) + np.repeat(shift[:len(lengths)], lengths)] = code
    shown = list(map(_written_ids(size_a, size_b).__getitem__, codes.tolist()))
    bounds = (found.text_a + found.text_b).tolist()
    return [sha256("".join(shown[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(bounds, bounds[1:])]


_SUMMARY = "n_a long, n_b long, n_groups long, n_links long, links array<long>, groups_sha256 string"


def _summary(size_a: int, size_b: int):
    def arrays(found: Alignment) -> list[pa.Array]:
        counts = [pa.array(np.diff(at).astype("i8")) for at in (found.text_a, found.text_b, found.text_cut)]
        pairs = links(found)
        return [*counts, pairs.value_lengths().cast(pa.int64()), pairs, pa.array(digests(found, size_a, size_b), pa.string())]

    return arrays


def pair_counts(found: DataFrame, link_col: str = "links") -> DataFrame:
    """``link, n, best``: how often each pair is linked, and whether no other pair of its id of B is linked more often."""
    counts = found.select(F.explode(link_col).alias("link")).groupBy("link").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("b", F.col("link").bitwiseAND(F.lit(0xFFFFFFFF))))
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "b").select("link", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_sums(found: DataFrame, row_col: str = "row", link_col: str = "links", frequent: int = FREQUENT) -> DataFrame:
    """``row, n_best, count_sum`` of every row that has links."""
    pairs = written(pair_counts(found, link_col))
    total = pairs.select(F.sum("n")).first()[0] or 0
    # More than one in ``frequent`` of all links: there are fewer than ``frequent`` such pairs.
    common = F.col("n") * frequent > total
    each = found.select(row_col, F.explode(link_col).alias("link"))
    head = F.broadcast(pairs.where(common))
    known = each.join(head, "link").select(row_col, "n", "best")
    rare = each.join(F.broadcast(pairs.where(common).select("link")), "link", "left_anti")
    rare = rare.join(pairs.where(~common), "link").select(row_col, "n", "best")
    per_row = [F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum")]
    parts = known.groupBy(row_col).agg(*per_row).unionByName(rare.groupBy(row_col).agg(*per_row))
    return parts.groupBy(row_col).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def report(documents: DataFrame, vocabularies: Vocabularies = Vocabularies(), frequent: int = FREQUENT) -> DataFrame:
    """One row per document: sizes, a digest of the groups, and what its links count over all documents."""
    numbered = documents.select("text", F.struct(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row")).alias("key"))
    encode = encoder(*vocabularies.paths())
    summary = _summary(len(encode.lengths_a), len(encode.lengths_b))
    found = _each(numbered, vocabularies, "key", "text", _SUMMARY, summary).select("key.doc_id", "key.row", *(c.split()[0] for c in _SUMMARY.split(", ")))
    stored = written(found, f"{shared_folder(documents.sparkSession)}/aligned")
    sums = link_sums(stored, frequent=frequent)
    zero = F.lit(0).cast("long")
    return stored.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
