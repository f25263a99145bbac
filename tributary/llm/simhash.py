"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; two link if at most four differ. Split in halves of 32 bits, such a pair
differs by at most two bits in the upper half, or else by at most one in the lower half. So every
fingerprint is entered under the points of the ball of radius 1 around its upper half and under its
lower half, and looks up the same ball of the upper half and the ball of radius 1 around the lower one:
two balls of radius 1 meet where the halves differ by two bits. A pair meets at several points; the join
keeps it at one of them only, and only if the complete distance is small enough.

Equal fingerprints are one node, however many documents share it. Components come from repeatedly
linking every node to the smallest neighbour of its neighbourhood, with one written table per round.

Null and empty texts and texts of white space have fingerprint zero. Null ids never name a component:
a component without any other id has none. Repeated ids and rows get a row each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at once


def text_fingerprint(text: str | None, size: int = 4) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n, ones = max(1, len(words) - size + 1), np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), SEED) for i in range(at, min(n, at + BLOCK))), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((text_fingerprint(t.as_py(), size) for t in batch.column(1)), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("<i8"))], ["doc_id", "fp"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _halves(fp: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _ball(half: Column) -> Column:
    flips = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    return F.concat(F.array(half), F.transform(flips, lambda flip: half.bitwiseXOR(flip)))


LOWER = 1 << 32  # marks the points of the lower half


def links(nodes: DataFrame, bits: int = 4) -> DataFrame:
    """``a < b``: all pairs of the distinct fingerprints ``fp`` that differ by at most ``bits`` (up to 4) bits."""
    if not 0 <= bits <= 4:
        raise ValueError("halves and balls of radius 1 find distances up to 4")
    upper, lower = _halves(F.col("fp"))
    marked = lambda point: point.bitwiseOR(F.lit(LOWER))
    entries = nodes.select(F.col("fp").alias("b"), F.explode(
        F.concat(_ball(upper), F.array(marked(lower)))).alias("point"))
    lookups = nodes.select(F.col("fp").alias("a"), F.explode(
        F.concat(_ball(upper), F.transform(_ball(lower), marked))).alias("point"))
    a, b = F.col("a"), F.col("b")
    (upper_a, _), (upper_b, _) = _halves(a), _halves(b)
    apart = upper_a.bitwiseXOR(upper_b)
    lowest = apart.bitwiseAND(-apart)
    meets = F.when(F.bit_count(apart) == 2, upper_a.bitwiseXOR(lowest)).otherwise(upper_a)
    here = F.when(F.col("point") >= LOWER, F.bit_count(apart) > 2).otherwise(
        (F.bit_count(apart) <= 2) & (F.col("point") == meets))
    close = F.bit_count(a.bitwiseXOR(b)) <= bits
    # Spark takes the points, 34 or 66 of a node, for as small as the nodes, so it is told not to broadcast them.
    return lookups.join(entries.withColumnRenamed("point", "at").hint("merge"),
                        (F.col("point") == F.col("at")) & (a < b) & here & close).select("a", "b")


SALTS = 16


def _joined_by(edges: DataFrame, node: str, other: str, least: DataFrame) -> DataFrame:
    """Edges with what is known of one of their nodes. The edges of a node are dealt over salts by their
    other end, so that a node with very many of them is not one task's."""
    salt = F.pmod(F.xxhash64(other), F.lit(SALTS).cast("long"))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = least.withColumn("salt", F.explode(salts))
    # Spark takes the salted rows for as small as they were before, so it is told not to broadcast them.
    return edges.withColumn("salt", salt).join(salted.hint("merge"), [node, "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return _joined_by(both, "a", "b", least).where("b > a").select(
        F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from a smaller a to a larger b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    return _joined_by(edges, "b", "a", least).select(
        F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                          F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")
    ).select("e.*").where("a <> b").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of its component, for every node that has an edge and is not it."""
    digest = lambda e: tuple(e.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = written(edges)
    before = digest(now)
    while True:
        now = written(_small_star(_large_star(now)))
        after = digest(now)
        if after == before:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = after


def components(documents: DataFrame, size: int = 4, bits: int = 4, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row of documents."""
    prints = written(fingerprints(documents, size, id_col, text_col))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    tops = roots(links(nodes.select("fp"), bits))
    rooted = nodes.join(tops, nodes["fp"] == tops["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = written(rooted.join(named, "root").select(F.col("fp").alias("print"), "component_id"))
    return prints.join(of_print, F.col("fp") == F.col("print")).select("doc_id", "fp", "component_id")


def deduplicated(documents: DataFrame, size: int = 4, bits: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one of each component: the row with the smallest id, missing ids last.

    Each row is judged by its own text, so rows may share an id or have none. Rows that repeat id and text become one.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    texts = documents.select(F.xxhash64(text).alias("text_key"), key.alias("id"), text.alias("text"))
    # The first id of every text, before anything is joined: a text that many rows hold is one row then.
    firsts = texts.groupBy("text_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
    groups = components(texts, size, bits, "text_key", "text").select(F.col("doc_id").alias("of"), "component_id").distinct()
    kept = firsts.join(groups, F.col("text_key") == F.col("of")).groupBy("component_id").agg(
        F.min(F.struct("first", "text_key")).alias("best")).select(
        F.col("best.first.id").alias("best_id"), F.col("best.text_key").alias("best_text"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    rows = rows.withColumns({"row_id": F.col("row").getField(id_col), "row_text": F.xxhash64(F.col("row").getField(text_col).cast("string"))})
    same = F.col("row_id").eqNullSafe(F.col("best_id")) & (F.col("row_text") == F.col("best_text"))
    one = rows.join(kept, same, "left_semi").dropDuplicates(["row_id", "row_text"])
    return one.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


def report(documents: DataFrame) -> DataFrame:
    return components(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
