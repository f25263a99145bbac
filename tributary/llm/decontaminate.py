"""Benchmark decontamination by spaced seeds.

Both sides become lower-cased words. Fixed masks lie over every run of ``span`` words and hash only the
words under a 1, so a changed word under a 0 does not hide a hit. Equal hashes of a test item and a
document give a hit; around it the two are laid side by side, and the overlap counts if enough words
agree. If they do not, a run of words as long as the span that agrees word for word counts by itself: a
quoted part of an item in another text. Everything but the small table of test seeds stays with its document: the seeds are joined in
blocks of a bounded number of rows, each small enough to send to every executor, so a larger test set
means more blocks and not a larger broadcast.

Null or empty texts have no words and no hits. An item with fewer words than the span has one seed over all
its words and is found wherever they stand in a row, however few they are.
Repeated items are found one by one, repeated documents get a row each. Null item ids are ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written

WORD_GAP = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Settings:
    masks: tuple[str, ...] = ("111010010111", "110111001011", "101100111101")
    flank: int = 8  # words on either side of the seed that are compared too
    agree: float = 0.8  # share of the compared words that must be equal
    block_rows: int = 200_000  # seeds of the test set, three numbers each, up to which they go to every executor

    @property
    def span(self) -> int:
        return len(self.masks[0])


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), WORD_GAP)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _positions(words: str, span: int) -> Column:
    return F.when(F.size(words) >= span, F.sequence(F.lit(0), F.size(words) - span)).otherwise(
        F.array().cast("array<int>"))


def _seeds(words: str, at: str, settings: Settings) -> Column:
    return F.array(*[
        F.xxhash64(F.lit(number), *[F.get(F.col(words), F.col(at) + i) for i, bit in enumerate(mask) if bit == "1"])
        for number, mask in enumerate(settings.masks)
    ])


def seeds(rows: DataFrame, settings: Settings) -> DataFrame:
    """A row for each position and mask of ``words``: all columns, ``at`` and ``seed``."""
    placed = rows.select("*", F.explode(_positions("words", settings.span)).alias("at"))
    return placed.select("*", F.explode(_seeds("words", "at", settings)).alias("seed"))


def _compared(settings: Settings) -> Column:
    """For every hit of one shift: the range around it, the share of equal words there, and whether its span agrees."""

    def of(at: Column) -> Column:
        item_at = at - F.col("shift")
        left = F.least(F.lit(settings.flank), at, item_at)
        right = F.least(F.lit(settings.span + settings.flank), F.size("words") - at, F.size("item_words") - item_at)
        pairs = F.zip_with(
            F.slice("words", at - left + 1, left + right), F.slice("item_words", item_at - left + 1, left + right),
            lambda a, b: a == b)
        same = F.slice("words", at + 1, settings.span) == F.slice("item_words", item_at + 1, settings.span)
        return F.struct(
            at.alias("at"), (at - left).alias("start"), (at + right).alias("end"), same.alias("same"),
            (F.size(F.filter(pairs, lambda equal: equal)) / (left + right)).alias("share"))

    return F.transform("ats", of)


def _sent(test: DataFrame, settings: Settings) -> DataFrame:
    """Seeds of the test set: sent to every executor up to a number, beyond it joined by one shuffle. Spark takes
    the seeds for as small as the items, so it is told not to broadcast them then."""
    return F.broadcast(test) if test.count() <= settings.block_rows else test.hint("merge")


def _short_overlaps(ours: DataFrame, test: DataFrame, settings: Settings) -> DataFrame | None:
    """Where the items of fewer words than the span stand word for word; None if there are none."""
    short = test.where(F.size("words").between(1, settings.span - 1)).select(
        "item", F.size("words").alias("n"), F.xxhash64("words").alias("seed"))
    sizes = {r["n"]: r["count"] for r in short.groupBy("n").count().collect()}
    if not sizes:
        return None

    def of(n: int) -> Column:
        return F.transform(_positions("words", n), lambda i: F.struct(
            F.lit(n).alias("n"), i.alias("at"), F.xxhash64(F.slice("words", i + 1, n)).alias("seed")))

    placed = ours.select("id", "text_key", F.explode(F.flatten(F.array(*map(of, sorted(sizes))))).alias("run")).select(
        "id", "text_key", "run.*")
    found = placed.join(_sent(short, settings), ["n", "seed"])
    return found.select(
        "id", "text_key", "item", F.col("at").alias("shift"), F.col("at").alias("start"),
        (F.col("at") + F.col("n")).alias("end"),
        F.lit(1.0).alias("agree")).distinct()


def overlaps(documents: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, text_key, item, shift, start, end, agree``: word ranges of documents that agree with an item at one shift.

    ``agree`` is the highest share of equal words around one hit, 1 for runs that agree word for word without
    what is around them. Rows with one id and text are one document; ``text_key`` is the hash of the text.

    Seeds meet as numbers only. The places at which one document and one item meet with one shift become one row
    before words are fetched for them, so texts that repeat themselves do not multiply word lists.
    """
    test = items.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), word_hashes(F.col(item_text)).alias("words"))
    test_seeds = seeds(test, settings).select("item", F.col("at").alias("item_at"), "seed")
    ours = documents.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"), word_hashes(F.col(text_col)).alias("words"))
    placed = seeds(ours, settings).select("id", "text_key", "at", "seed")
    found = placed.join(_sent(test_seeds, settings), "seed").select(
        "id", "text_key", "item", "at", (F.col("at") - F.col("item_at")).alias("shift"))
    # Written, since it is small and costly to compute again.
    shifts = written(found.groupBy("id", "text_key", "item", "shift").agg(F.collect_set("at").alias("ats"))).select(
        F.col("id").alias("of"), F.col("text_key").alias("of_text"), "item", "shift", "ats")
    shifts = shifts.join(test.select("item", F.col("words").alias("item_words")), "item")
    compared = ours.join(shifts, F.col("id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text")))

    def judged(hits: Column) -> Column:
        good, same = F.filter(hits, lambda h: h["share"] >= settings.agree), F.filter(hits, lambda h: h["same"])
        return F.struct(
            F.coalesce(F.array_min(F.transform(good, lambda h: h["start"])),
                       F.array_min(F.transform(same, lambda h: h["at"]))).alias("start"),
            F.coalesce(F.array_max(F.transform(good, lambda h: h["end"])),
                       F.array_max(F.transform(same, lambda h: h["at"])) + settings.span).alias("end"),
            F.coalesce(F.array_max(F.transform(good, lambda h: h["share"])),
                       F.when(F.size(same) > 0, 1.0)).alias("agree"),
        )

    # An array of one range or none: exploded, so that nothing is computed twice to filter it.
    ranges = F.filter(F.transform(F.array(_compared(settings)), judged), lambda r: r["agree"].isNotNull())
    long = compared.select("id", "text_key", "item", "shift", F.explode(ranges).alias("range")).select(
        "id", "text_key", "item", "shift", "range.*").distinct()
    short = _short_overlaps(ours, test, settings)
    return (long if short is None else long.unionByName(short)).withColumnRenamed("id", id_col)


def flagged(documents: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per id and text with an overlap: the items, and the word ranges as ``item:start:end``."""
    found = overlaps(documents, items, settings, id_col, text_col)
    # An id meets each item a few times at most, so what is gathered here is bounded by the test set.
    return found.groupBy(id_col, "text_key").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.array_join(F.transform(
            F.array_sort(F.collect_set(F.struct("start", "end", "item"))),
            lambda s: F.concat_ws(":", s["item"].cast("string"), s["start"].cast("string"), s["end"].cast("string")),
        ), ",").alias("overlaps"),
        F.max("agree").alias("agree"),
    )


def decontaminated(documents: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those that overlap an item; each row is judged by its own text."""
    bad = flagged(documents, items, settings, id_col, text_col).select(F.col(id_col).alias("bad"), "text_key")
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    same = F.col("row").getField(id_col).eqNullSafe(F.col("bad")) & (F.xxhash64(F.col("row").getField(text_col)) == F.col("text_key"))
    return rows.join(bad, same, "left_anti").select(*[F.col("row").getField(c).alias(c) for c in documents.columns])


def report(documents: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of documents: whether its text overlaps an item, which ones, and where."""
    found = flagged(documents, items, settings).withColumnRenamed("doc_id", "of")
    rows = documents.select("doc_id", F.xxhash64("text").alias("key"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("text_key")), "left").select(
        "doc_id",
        F.col("text_key").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
        F.coalesce(F.array_join(F.transform("items", lambda i: i.cast("string")), ","), F.lit("")).alias("items"),
        F.coalesce("overlaps", F.lit("")).alias("overlaps"),
        F.coalesce("agree", F.lit(0.0)).alias("agree"),
    )
