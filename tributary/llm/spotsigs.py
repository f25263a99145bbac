"""Document fingerprints: spot signatures.

Common words are anchors. Where a content word follows an anchor (or starts the text), the anchor and
the chain of the next ``chain`` content words, common words skipped, form one signature; at the end of
the text chains are shorter. In a text where no content word follows an anchor (lists, tables, other
languages) a chain without an anchor starts at every content word, so no part of it goes unseen. The fingerprint of a text is the set of its signatures, 32 bits each.
Fingerprints are compared by Jaccard. Only sets of similar length can reach a threshold, so the search
partitions them by length, and joins them on the rarest signatures that any similar pair must share.

Null counts as the empty text, whose set is empty; two empty sets have likeness 1, an empty and another
0. A text with words but without a content word has one signature, made of all its words; a text of
signs only has one made of the text. Repeated rows and ids are rows of their own; rows with one id in
:func:`followed` follow each other by text.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import let

# Common words of English, German, French and Spanish.
ANCHORS = """
the of and to in a is that for it with was on as by at an are be this from or not which have has but they you
der die das und ist ein eine zu den von mit sich auf dem nicht im des als auch es an werden aus er hat dass sie
le la les de des et un une du en est que qui dans pour sur pas au par il ce se plus avec sont ne ou
el los las y se del al lo una por con para su no es como pero sus este ha si o
""".split()
WORD_GAP = r"[^\p{L}\p{N}]+"
CHAIN = 3


def _hex(number: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(number.cast("long").bitwiseAND(F.lit((1 << 4 * digits) - 1))), digits, "0"))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of 32-bit signatures of a text."""
    text = F.coalesce(text, F.lit(""))

    def chains(words: Column) -> Column:
        def content(word: Column, i: Column) -> Column:
            before = F.get(words, i - 1)
            anchor = F.when((i > 0) & before.isin(ANCHORS), F.xxhash64(before))
            return F.when(~word.isin(ANCHORS), F.struct(
                F.xxhash64(word).alias("h"), anchor.alias("anchor"), (i == 0).alias("first")))

        def starts(found: Column) -> Column:
            def of(anchored: Column) -> Column:
                here = lambda c, i: F.when(~anchored | c["first"] | c["anchor"].isNotNull(), i)
                return F.filter(F.transform(found, here), lambda i: i.isNotNull())

            return let(F.exists(found, lambda c: c["anchor"].isNotNull()), of)

        none = F.lit(0).cast("long")
        return let(F.filter(F.transform(words, content), lambda c: c.isNotNull()), lambda found: F.transform(
            starts(found),
            lambda i: F.hash(
                F.coalesce(F.get(found, i)["anchor"], none), *[F.get(found, i + k)["h"] for k in range(chain)]),
        ))

    words = F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "")
    spots = let(words, chains)
    alone = F.when(text == "", F.array().cast("array<int>")).otherwise(
        F.array(F.hash(F.regexp_replace(F.lower(text), r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]+(?=[\p{L}\p{N}])", " "))))
    return F.array_sort(F.array_distinct(let(spots, lambda s: F.when(F.size(s) > 0, s).otherwise(alone))))


def fingerprint(sigs: Column) -> Column:
    """The set as text: eight hexadecimal digits per signature, in order."""
    return F.array_join(F.transform(sigs, lambda s: _hex(s, 8)), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two sets; 0 without comparing them if their lengths rule out ``at_least``."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(long == 0, 1.0).when((short == 0) | (short < at_least * long), 0.0).otherwise(
        shared / (F.size(a) + F.size(b) - shared))


def length_partition(sigs: Column, threshold: float) -> Column:
    """Sets whose likeness reaches the threshold lie in the same or in neighbouring partitions."""
    return F.when(F.size(sigs) > 0, F.floor(F.log(F.size(sigs).cast("double")) / -math.log(threshold) + 1e-9)).otherwise(-1)


def similar(rows: DataFrame, threshold: float = 0.8, id_col: str = "id", sig_col: str = "sigs") -> DataFrame:
    """``a, b, likeness`` of all pairs of different sets that reach the threshold.

    Rows with equal sets count as one, under their smallest id. Sorted from rare to common, two similar
    sets share one of their first ``n - ceil(threshold * n) + 1`` signatures, so only those are joined.
    """
    sets = rows.groupBy(F.col(sig_col).alias("sigs")).agg(F.min(id_col).alias("id"))
    sets = sets.select("id", "sigs", F.size("sigs").alias("n"), length_partition(F.col("sigs"), threshold).alias("part"))
    spots = sets.select("id", F.explode("sigs").alias("sig"))
    counts = spots.groupBy("sig").agg(F.count("*").alias("freq"))
    order = spots.join(counts, "sig").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("freq", "sig"))).alias("by"))
    prefix = F.slice("by", 1, (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int"))
    heads = sets.join(order, "id").select("id", "n", "part", F.explode(prefix).alias("head")).select(
        "id", "n", "part", F.col("head.sig").alias("sig"))
    left = heads.select(F.col("id").alias("a"), F.col("n").alias("an"), "sig", F.explode(
        F.array("part", F.col("part") + 1)).alias("part"), F.col("part").alias("own"))
    right = heads.select(F.col("id").alias("b"), F.col("n").alias("bn"), "sig", "part")
    pairs = left.join(right, ["sig", "part"]).where(
        (F.least("an", "bn") >= threshold * F.greatest("an", "bn")) & (F.col("a") != F.col("b"))
        & ((F.col("own") != F.col("part")) | (F.col("a") < F.col("b")))
    ).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sets_of = lambda side: sets.select(F.col("id").alias(side), F.col("sigs").alias(f"{side}s"))
    return pairs.join(sets_of("a"), "a").join(sets_of("b"), "b").select(
        "a", "b", likeness(F.col("as"), F.col("bs"), threshold).alias("likeness")).where(F.col("likeness") >= threshold)


def _counted(cuts: list[int], value: Column) -> Column:
    """How many of the descending cuts are not below the value, found in two steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    numbers = lambda some: F.array(*[F.lit(c).cast("long") for c in some])
    whole = F.size(F.filter(numbers([g[-1] for g in groups]), lambda c: c >= value))
    rest = F.coalesce(F.get(F.array(*map(numbers, groups)), whole), F.array().cast("array<long>"))
    return F.least(whole * step + F.size(F.filter(rest, lambda c: c >= value)), F.lit(len(cuts)))


def followed(rows: DataFrame, id_col: str, carried: dict[str, str], tie: str) -> DataFrame:
    """Every row with the next row's values (``carried``: column to new name) by descending id; the last
    row gets the first row's. Null ids come last.

    The ids are cut into as many ranges as there are shuffle partitions (times four) at ids that exist,
    so a row is shuffled once, into its range, and rows at a cut once more, as guests of the range before.
    """
    spark = rows.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / ranges for i in range(1, ranges)]
    seen = rows.agg(F.percentile_approx(id_col, at, max(10_000, 20 * ranges)).alias("cuts"), F.max(id_col).alias("top")).first()
    cuts = sorted(set(seen["cuts"] or ()), reverse=True)
    own = F.when(F.col(id_col).isNull(), len(cuts)).otherwise(_counted(cuts, F.col(id_col).cast("long")))
    place = lambda part, guest, wrap: F.struct(
        part.cast("int").alias("part"), F.lit(guest).alias("guest"), F.lit(wrap).alias("wrap"))
    is_cut = F.exists(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c == F.col(id_col)) if cuts else F.lit(False)
    places = F.array_compact(F.array(
        place(F.col("__own"), False, False),
        F.when(is_cut, place(F.col("__own") - 1, True, False)),
        F.when(F.col(id_col).eqNullSafe(F.lit(seen["top"])), place(F.lit(len(cuts)), True, True)),
    ))
    placed = rows.withColumn("__own", own).select(*rows.columns, F.explode(places).alias("__at"))
    order = Window.partitionBy("__at.part").orderBy(
        F.col("__at.wrap"), F.col(id_col).desc_nulls_last(), F.xxhash64(tie), F.col(tie))
    ahead = [F.lead(c).over(order).alias(new) for c, new in carried.items()]
    return placed.select("*", *ahead).where(~F.col("__at.guest")).drop("__at")


def report(documents: DataFrame, chain: int = CHAIN, threshold: float = 0.8) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the second half replaced by the
    start of the next document), and the likeness to the edited text and to the next document."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", signatures(F.col("text"), chain).alias("sigs"))
    rows = followed(rows, "doc_id", {"text": "next_text", "sigs": "next_sigs"}, tie="text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next_text").substr(F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sigs", "next_sigs", edited.alias("edited"))
    rows = rows.select("*", signatures(F.col("edited"), chain).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.size("sigs").cast("long").alias("n_signatures"),
        length_partition(F.col("sigs"), threshold).cast("long").alias("length_partition"),
    )
