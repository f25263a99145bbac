"""Best-fit packing of tokenised documents after Martello-Toth reduction.

Documents of one length are interchangeable, so the packing is planned on the number of pieces of each
length: at most ``limit`` numbers, whatever the corpus. The reduction fixes sequences that some best
packing holds: a piece that no other fits beside stays alone; a piece goes with its exact complement;
if one other piece fits at most, with the largest that does; if two fit at most, with those that
dominate all other choices. The rest is packed best-fit, longest pieces first, equal sequences at a time.
A plan is a list of patterns (pieces of each length) with the number of sequences that follow it.

Pieces are numbered within their length by the task that cut them, plus an offset per task and length,
so no task sees all pieces of a length. The plan then gives each its sequence and offset.

Null counts as the empty text, which is one token. Every row is packed, also repeated ones and such
without id. A text over the limit is cut into pieces of the limit, the first one shorter if need be.
"""

import base64
import functools
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import written

LIMIT = 2048
SPECIAL = "<|endoftext|>"
END = 0  # the id that ends a document

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def encoder(vocabulary: str, ranks: str):
    """Ids of a text. ``ranks`` holds the same vocabulary for a faster library; texts that spell out the
    special token go to the tokenizer that knows it."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as lines:
        known = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return full.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cuts(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens."""
    first = n if n <= limit else n % limit or limit
    return [(0, first)] + [(at, limit) for at in range(first, n, limit)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, slot long"


def pieces(documents: DataFrame, limit: int = LIMIT, vocabulary: str | None = None, ranks: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents; ``slot`` numbers those of one length within the task ``part``."""
    vocabulary, ranks = vocabulary or _vocabulary("byte_bpe_50k.json"), ranks or _vocabulary("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(vocabulary, ranks), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                for number, (start, length) in enumerate(cuts(len(ids), limit)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    out.append((doc, number, start, length, crc, part, seen[length]))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)],
                [field.split()[0] for field in PIECES.split(", ")])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def _largest(left: list[int], most: int) -> int:
    """The largest length up to ``most`` of which pieces are left, or 0."""
    return next((s for s in range(min(most, len(left) - 1), 0, -1) if left[s]), 0)


def _smallest(left: list[int], how_many: int) -> list[int]:
    found = []
    for s in range(1, len(left)):
        found += [s] * min(left[s], how_many - len(found))
        if len(found) == how_many:
            break
    return found


def reduce_by_dominance(left: list[int]) -> list[tuple[int, Pattern]]:
    """Fixes sequences that some best packing holds, and takes their pieces out of ``left``."""
    limit, fixed = len(left) - 1, []

    def fix(*lengths: int) -> None:
        need = Counter(lengths)
        times = min(left[s] // n for s, n in need.items())
        for s, n in need.items():
            left[s] -= times * n
        fixed.append((times, tuple(sorted(need.items(), reverse=True))))

    def fits(*lengths: int) -> bool:
        return all(left[s] >= n for s, n in Counter(lengths).items())

    for s in range(limit, 0, -1):
        while left[s]:
            space = limit - s
            if space and fits(s, space):
                fix(s, space)
                continue
            left[s] -= 1  # the piece itself is not its own company
            three = _smallest(left, 3)
            company = sum(sum(three[:k]) <= space for k in range(1, len(three) + 1))
            one = _largest(left, space)
            two = halves = 0
            if company == 2:
                left[one] -= 1
                two = _largest(left, space - one)
                left[one] += 1
                # The longest piece that can be the shorter of two others.
                for y in range(min(space // 2, limit), 0, -1):
                    if left[y] and (left[y] > 1 or any(left[y + 1:space - y + 1])):
                        halves = y
                        break
            left[s] += 1
            if company == 0:
                fix(s)
            elif company == 1:
                fix(s, one)
            elif company == 2 and halves <= two:
                fix(s, one, two)
            elif company == 2 and one >= _best_pair(left, s, space):
                fix(s, one)
            else:
                break
    return fixed


def _best_pair(left: list[int], s: int, space: int) -> int:
    """The largest sum up to ``space`` of two pieces, one of length ``s`` set aside."""
    left[s] -= 1
    best = 0
    for x in range(1, space):
        if left[x]:
            left[x] -= 1
            y = _largest(left, space - x)
            left[x] += 1
            best = max(best, x + y if y else 0)
    left[s] += 1
    return best


def best_fit(left: list[int]) -> list[tuple[int, Pattern]]:
    """Packs what is left, longest pieces first, each into the fullest sequence that has room for it."""
    limit, done = len(left) - 1, []
    rooms: list[int] = []  # free room of open sequences, ascending
    open_: dict[int, list[tuple[int, Pattern]]] = {}

    def put(room: int, count: int, pattern: Pattern) -> None:
        if count and room == 0:
            done.append((count, pattern))
        elif count:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((count, pattern))

    for s in range(limit, 0, -1):
        n, left[s] = left[s], 0
        while n:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                count, pattern = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, count, pattern = limit, -(-n // (limit // s)), ()
            each = room // s
            full, rest = min(count, n // each), 0
            put(room - each * s, full, (*pattern, (s, each)))
            n -= full * each
            if full < count and n:
                rest = min(n, each)
                put(room - rest * s, 1, (*pattern, (s, rest)))
                n -= rest
            if pattern:
                put(room, count - full - (rest > 0), pattern)
    return done + [x for room in rooms for x in open_[room]]


def plan(lengths: dict[int, int], limit: int = LIMIT) -> list[tuple[int, Pattern]]:
    left = [0] * (limit + 1)
    for length, n in lengths.items():
        left[length] = n
    return reduce_by_dominance(left) + best_fit(left)


def _slots(patterns: list[tuple[int, Pattern]]) -> dict[str, np.ndarray]:
    """For each length, ascending ranges of piece numbers with where they go."""
    rows, sequence, used = [], 0, Counter()
    for count, pattern in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, used[length], sequence, each, offset))
            used[length] += count * each
            offset += length * each
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 48) + table[:, 1], **dict(zip(("first", "sequence", "each", "offset"), table[:, 1:].T))}


def packed(documents: DataFrame, limit: int = LIMIT, vocabulary: str | None = None, ranks: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it was in its document, and its sequence and offset there."""
    found = written(pieces(documents, limit, vocabulary, ranks, id_col, text_col))
    counts = found.groupBy("length", "part").agg((F.max("slot") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from")))
    # At most ``limit`` rows.
    slots = _slots(plan({r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}, limit))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(slots["key"], (length << 48) + number, side="right") - 1
            after = number - slots["first"][at]
            sequence = slots["sequence"][at] + after // slots["each"][at]
            offset = slots["offset"][at] + after % slots["each"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    placed = found.join(offsets, ["length", "part"]).select(*names, (F.col("slot") + F.col("from")).alias("number"))
    return placed.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
