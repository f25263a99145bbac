"""Secret scans: fixed patterns, and windows of high Shannon entropy per character class.

All of it is row-local expressions. Strings that look like keys (20 characters or more of one
character class) are walked once by a sliding window; the count of each symbol in the window and the
sum of ``c * log2(c)`` change only by the symbol that enters and the one that leaves. Windows whose
entropy reaches the threshold of their class are merged into spans. A string on the allow list
(words, numbers, UUIDs, ...) yields no such span. Spans of the fixed patterns always stay; an entropy
span that lies inside one of them is not reported twice.

Null and empty texts have no spans. Offsets count code points. Rows are independent: repeated rows
and null ids pass through, other columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import let

# The patterns, in the order in which spans with equal starts are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_VALUE = 6
ZERO = 48  # the character that stands for a count of 0

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALLOWED = (
    r"^[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]*$",  # words, also joined ones
    r"^[0-9_/=+-]+$",  # numbers, dates, rulers
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"^([A-Za-z]+|[0-9]{1,4})([-_/]([A-Za-z]+|[0-9]{1,4}))+/*$",  # paths, slugs, dated names
    r"^[-_/=+]*([A-Za-z0-9])\1{3,}([-_/=+]+([A-Za-z0-9])\3{3,})*[-_/=+]*$",  # placeholders: parts of one character again and again
)
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


@dataclass(frozen=True)
class CharacterClass:
    """Its symbols, the pattern of a run, and the bits per symbol from which a window is a secret."""

    name: str
    symbols: str
    run: str
    bits: float


@dataclass(frozen=True)
class Settings:
    window: int = 20
    classes: tuple[CharacterClass, ...] = (
        CharacterClass("hex", DIGITS + "abcdef" + "ABCDEF", r"[0-9a-fA-F]{20,}", 3.0),
        CharacterClass("upper", DIGITS + UPPER, r"[0-9A-Z]{20,}", 3.5),
        CharacterClass("lower", DIGITS + LOWER, r"(?=[a-z]*[0-9])[0-9a-z]{20,}", 3.5),
        CharacterClass("base64", DIGITS + UPPER + LOWER + "+/_=-", CANDIDATE, 3.8),
    )
    allowed: tuple[str, ...] = field(default=ALLOWED)

    def __post_init__(self):
        if not 1 <= self.window < 256 - ZERO:
            raise ValueError(f"a window has 1 to {255 - ZERO} characters")


def running(numbers: Column, add: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """Inclusive running results of an associative ``add`` over an array of ints, nulls passed over.

    An array can only be copied to grow, so results are taken within blocks and then over their ends: the
    work on n numbers is n * (block / 2) + (n / block) ** 2 / 2 instead of n ** 2 / 2.
    """

    def follow(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<int>"), lambda done, x: F.concat(
            done, F.array(F.coalesce(add(F.get(done, F.size(done) - 1), x), x))))

    def joined(blocks: Column, ends: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda b, i: F.transform(
            b, lambda x: F.coalesce(add(F.get(ends, i - 1), x), x))))

    def over(blocks: Column) -> Column:
        return let(follow(F.transform(blocks, lambda b: F.get(b, F.size(b) - 1))), lambda ends: joined(blocks, ends))

    def cut(values: Column) -> Column:
        numbers_of_blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        return F.when(F.size(values) == 0, values).otherwise(
            let(F.transform(numbers_of_blocks, lambda b: follow(F.slice(values, b * block + 1, block))), over))

    return let(numbers, cut)


def located(text: Column, pattern: str | Column) -> Column:
    """Every match of a pattern that never matches the empty text: (start, found), leftmost first."""

    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern

    def of(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        ends = running(F.zip_with(gaps, found, lambda g, f: F.length(g) + F.length(f)), lambda x, y: x + y)
        return F.zip_with(ends, found, lambda e, f: F.struct((e - F.length(f)).alias("start"), f.alias("found")))

    none = F.array().cast("array<struct<start:int,found:string>>")
    every = let(F.regexp_extract_all(text, pattern, F.lit(0)), of)
    return F.when(F.rlike(text, pattern), every).otherwise(none)


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _whole(kind: int, matches: Column) -> Column:
    return F.transform(matches, lambda m: _span(kind, m["start"], m["start"] + F.length(m["found"])))


def _longest_first(spans: Column, own: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(own).alias("own")))


def uncovered(spans: Column, others: Column | None = None) -> Column:
    """Entropy spans that lie inside none of the others; without others, inside none of themselves, each once.

    By start, the longest first, whatever covers a span comes before it: the furthest end so far decides.
    """
    every = _longest_first(spans, 1)
    if others is not None:
        every = F.concat(_longest_first(others, 0), every)

    def sweep(ordered: Column) -> Column:
        counted = F.transform(ordered, lambda s: -s["back"] if others is None else F.when(s["own"] == 0, -s["back"]))
        return let(running(counted, F.greatest), lambda furthest: F.transform(
            F.filter(ordered, lambda s, i: (s["own"] == 1) & (F.coalesce(F.get(furthest, i - 1), F.lit(0)) < -s["back"])),
            lambda s: _span(3, s["start"], -s["back"])))

    return let(F.sort_array(every), sweep)


def entropy_spans(run: Column, symbols: Column, highest: Column, window: int) -> Column:
    """Merged windows of a run of some symbols, (b, e) within it, whose sum of c * log2(c) is not above the highest."""
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    weights = F.array(*map(F.lit, weight))
    ids = F.transform(F.split(run, ""), lambda c: F.instr(symbols, c))
    # Counts are the characters of a text, one per symbol, so that a step writes two of them.
    count = lambda n, symbol: F.ascii(F.substring(n, symbol, 1)) - ZERO
    put = lambda n, symbol, c: F.overlay(n, F.char(c + ZERO), symbol, 1)

    def walk(ids: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            enters, leaves = F.get(ids, i - 1), F.coalesce(F.get(ids, i - 1 - window), F.lit(0))
            n_in, n_out = count(state["n"], enters), F.when(leaves > 0, count(state["n"], leaves))
            gain = F.get(weights, n_in + 1) - F.get(weights, n_in)
            loss = F.when(leaves > 0, F.get(weights, n_out - 1) - F.get(weights, n_out)).otherwise(0.0)
            total = F.when(enters == leaves, state["sum"]).otherwise(state["sum"] + gain + loss)
            left = F.when(leaves > 0, put(state["n"], leaves, n_out - 1)).otherwise(state["n"])
            counts = F.when(enters == leaves, state["n"]).otherwise(put(left, enters, n_in + 1))
            last, before = F.get(state["spans"], F.size(state["spans"]) - 1), i - window
            joined = F.when(
                (F.size(state["spans"]) > 0) & (last["e"] >= before),
                F.concat(F.slice(state["spans"], 1, F.greatest(F.size(state["spans"]) - 1, F.lit(0))),
                         F.array(F.struct(last["b"].alias("b"), i.alias("e")))),
            ).otherwise(F.concat(state["spans"], F.array(F.struct(before.alias("b"), i.alias("e")))))
            return F.struct(
                counts.alias("n"), total.alias("sum"),
                F.when((i >= window) & (total <= highest + 1e-9), joined).otherwise(state["spans"]).alias("spans"),
            )

        start = F.struct(
            F.repeat(F.lit(chr(ZERO)), F.length(symbols)).alias("n"), F.lit(0.0).alias("sum"),
            F.array().cast("array<struct<b:int,e:int>>").alias("spans"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(ids)), start, step, lambda state: state["spans"])

    return let(ids, walk)


def _entropy(text: Column, settings: Settings) -> Column:
    suspects = F.filter(
        located(text, CANDIDATE),
        lambda c: ~F.coalesce(*[F.when(c["found"].rlike(p), True) for p in settings.allowed], F.lit(False)),
    )

    classes = F.array(*[F.struct(
        F.lit(kind.symbols).alias("symbols"), F.lit(kind.run).alias("run"),
        F.lit(settings.window * (math.log2(settings.window) - kind.bits)).alias("highest"),
    ) for kind in settings.classes])

    def of(candidate: Column, kind: Column) -> Column:
        return F.flatten(F.transform(located(candidate["found"], kind["run"]), lambda run: F.transform(
            entropy_spans(run["found"], kind["symbols"], kind["highest"], settings.window),
            lambda s: _span(3, candidate["start"] + run["start"] + s["b"], candidate["start"] + run["start"] + s["e"]),
        )))

    spans = F.flatten(F.transform(suspects, lambda c: F.flatten(F.transform(classes, lambda kind: of(c, kind)))))
    return uncovered(spans)  # those of several classes of one string overlap


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(),
         keep_text: bool = False) -> DataFrame:
    """``id, base, spans`` (and ``text``): arrays of (start, kind, end) by start and kind, one row per input row."""
    rows = documents.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    value = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    assign = F.when(F.col("text").rlike(ASSIGN), F.filter(
        F.zip_with(_whole(0, located(F.col("text"), ASSIGN)), value, lambda s, v: F.when(F.length(v) >= ASSIGN_VALUE, s)),
        lambda s: s.isNotNull(),
    )).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    found = rows.select(
        id_col, "text", assign.alias("assign"),
        _whole(1, located(F.col("text"), ACCESS)).alias("access"),
        _whole(2, located(F.col("text"), HEX)).alias("hex"),
        F.when(F.col("text").rlike(CANDIDATE), _entropy(F.col("text"), settings))
        .otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("entropy"),
    )
    base = found.select(id_col, "text", "entropy", F.array_sort(F.concat("assign", "access", "hex")).alias("base"))
    added = uncovered(F.col("entropy"), F.col("base"))
    return base.select(
        id_col, *["text"] * keep_text, "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame, text_col: str = "text", mark: str = "[SECRET]",
           settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, with every span of the text replaced by the mark; null stays null."""
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    text = F.col("row").getField(text_col)
    rows = packed.select("row", text.alias("text_in"))
    spans = scan(rows, "row", "text_in", settings, keep_text=True)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(state: Column, s: Column) -> Column:
        return F.when(s["end"] <= state["at"], state).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(
                state["out"],
                F.when(s["start"] >= state["at"], F.concat(
                    F.col("text").substr(state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0))), F.lit(mark),
                )).otherwise(""),
            ).alias("out"),
        ))

    clean = F.aggregate("spans", begin, cut, lambda state: F.concat(
        state["out"], F.col("text").substr(state["at"] + 1, F.length("text"))))
    new = F.when(F.col("row").getField(text_col).isNull() | (F.size("spans") == 0), F.col("row").getField(text_col)).otherwise(clean)
    return spans.select("row", new.alias("new")).select(
        *[F.col("new").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in documents.columns])


def report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: counts per pattern, a digest of the pattern spans, all spans."""
    spans = scan(documents, settings=settings)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_entropy"),
    )
