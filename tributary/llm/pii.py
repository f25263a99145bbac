"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Base kinds are e-mail addresses, IP addresses, payment cards (Luhn) and international phone numbers.
They are reported wherever pattern and check hold, whatever their score. The method adds bank accounts
(IBAN, mod 97, the length of the country), social security numbers and phone numbers without a country
code; those count from ``Settings.least`` on, and only outside base spans and better added spans.

A score starts at the prior of its kind. Words of ``context`` near the span raise it once, words of
``against`` lower it once; reserved and private IP addresses and cards of one digit are lowered too.

Every search runs in time linear in the text: a run of signs is never scanned again from its inside.
Null and empty texts have no spans. Offsets count code points, ends are exclusive. Rows are independent:
repeated rows and null ids pass through; other columns are ignored by :func:`detect`, kept by :func:`redact`.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds, in the order in which they are listed; the first four are base kinds.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]

_LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_NATIONAL = re.compile(r"(?<![0-9+.(-])\(?[0-9]{2,5}\)?(?:[ ./-]{0,2}[0-9]{2,4}){2,4}(?![0-9])")
_WORD = re.compile(r"[^\W\d_]+")

# Lengths of account numbers by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

# Words that speak for a kind, in English, German, French and Spanish, and words that speak against.
CONTEXT = {
    "email": "email mail contact reach write adresse correo courriel kontakt",
    "ip": "ip address host server client login adresse dirección serveur",
    "card": "card credit debit visa mastercard amex payment karte kreditkarte carte tarjeta",
    "phone": "phone tel telephone mobile cell call fax telefon handy téléphone portable teléfono móvil",
    "iban": "iban account bank konto compte cuenta banque banco",
    "ssn": "ssn social security",
    "local_phone": "phone tel telephone mobile cell call fax telefon handy téléphone portable teléfono móvil",
}
AGAINST = {
    "email": "example noreply",
    "ip": "version release build section chapter figure firmware",
    "card": "isbn issn serial order invoice tracking sample test",
    "phone": "isbn serial order invoice tracking part",
    "iban": "sample test serial",
    "ssn": "sample test serial part order invoice",
    "local_phone": "isbn issn serial order invoice tracking part version",
}


def _words(given: dict[str, str]) -> dict[str, frozenset[str]]:
    return {kind: frozenset(words.split()) for kind, words in given.items()}


@dataclass(frozen=True)
class Settings:
    """Priors and steps of the score, and how many signs around a span are read for words."""

    prior: dict[str, float] = field(default_factory=lambda: {
        "email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3})
    raised: float = 0.25
    lowered: float = 0.3
    least: float = 0.5
    before: int = 48
    after: int = 24
    context: dict[str, frozenset[str]] = field(default_factory=lambda: _words(CONTEXT))
    against: dict[str, frozenset[str]] = field(default_factory=lambda: _words(AGAINST))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from sign to sign of ``@``; what stands before one is cut off where the last address ended."""
    free, at = 0, text.find("@")
    while at >= 0:
        name = at - free - len(text[free:at].rstrip(_LOCAL_PART))
        domain = _DOMAIN.match(text, at + 1) if name else None
        if domain:
            yield at - name, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def ip_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Numbers joined by dots, four at a time from the left."""
    for chain in _DOTTED.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() <= 37:  # 19 digits with a sign between any two
            digits = _only_digits(run[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_only_digits(found[0])) <= 15:
            yield found.span()


def accounts(text: str) -> Iterator[tuple[int, int]]:
    for head in _IBAN_HEAD.finditer(text):
        length = IBAN_LENGTH.get(head[0][:2])
        if length:
            rest = re.compile(r"(?:[ -]?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (length - 4)).match(text, head.end())
            if rest and mod97(head[0] + re.sub("[ -]", "", rest[0])):
                yield head.start(), rest.end()


def security_numbers(text: str) -> Iterator[tuple[int, int]]:
    for found in _SSN.finditer(text):
        yield found.span()


def national_phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _NATIONAL.finditer(text):
        if 7 <= len(_only_digits(found[0])) <= 13:
            yield found.span()


SEARCHES = dict(zip(KINDS, (emails, ip_addresses, cards, phones, accounts, security_numbers, national_phones)))


def _doubtful(kind: str, found: str) -> bool:
    """Values that hold the check but rarely belong to a person."""
    if kind == "ip":
        first, second, *_ = (int(p.lstrip("0") or 0) for p in found.split("."))
        return first in (0, 10, 127) or first >= 224 or (first, second) in ((192, 168), (169, 254))
    return kind == "card" and len(set(_only_digits(found))) == 1


def score(text: str, kind: str, start: int, end: int, settings: Settings) -> float:
    near = f"{text[max(0, start - settings.before):start]} {text[end:end + settings.after]}"
    words = frozenset(_WORD.findall(near.lower()))
    points = settings.prior[kind]
    points += settings.raised * (not words.isdisjoint(settings.context[kind]))
    points -= settings.lowered * (not words.isdisjoint(settings.against[kind]))
    points -= settings.lowered * _doubtful(kind, text[start:end])
    return round(min(1.0, max(0.0, points)), 4)


def find(text: str, settings: Settings = Settings()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    spans = {kind: [(s, e, score(text, kind, s, e, settings)) for s, e in SEARCHES[kind](text)] for kind in BASE}
    taken = [(s, e) for found in spans.values() for s, e, _ in found]
    added = sorted(
        ((-points, s, e, kind) for kind in KINDS[len(BASE):] for s, e in SEARCHES[kind](text)
         if (points := score(text, kind, s, e, settings)) >= settings.least),
    )
    for s, e, points, kind in _apart(taken, added):
        spans.setdefault(kind, []).append((s, e, points))
    return [(kind, *span) for kind in KINDS for span in sorted(spans.get(kind, []))]


def _apart(taken: list[tuple[int, int]], added: list[tuple[float, int, int, str]]) -> list[tuple]:
    """Of the added spans, best first, those that meet no taken one. Taken spans are kept as sorted starts
    and, since base spans of different kinds may overlap, the furthest end up to each start."""
    from bisect import bisect_left, insort

    kept, busy = [], []
    for s, e in sorted(taken):
        if busy and s < busy[-1][1]:
            busy[-1] = (busy[-1][0], max(e, busy[-1][1]))
        else:
            busy.append((s, e))
    for points, s, e, kind in added:
        at = bisect_left(busy, (e, -1))  # the busy spans before ``at`` start before e
        if not at or busy[at - 1][1] <= s:
            insort(busy, (s, e))
            kept.append((s, e, -points, kind))
    return kept


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def detect(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           settings: Settings = Settings()) -> DataFrame:
    """``id, spans``: one row per input row, spans by kind as listed, then start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(text.as_py() or "", settings)]
                     for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW_SPANS)], [id_col, "spans"])

    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, spans {SPANS}")


def redact(documents: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns, with each span replaced by its kind in capitals; of spans that overlap
    the first decides, and what it covers goes whole. A null text stays null."""
    place = documents.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for kind, start, end, _ in sorted(find(text, settings), key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([clean(t.as_py()) for t in batch.column(place)], batch.column(place).type)
            yield batch.set_column(place, batch.schema.field(place), texts)

    return documents.mapInArrow(run, documents.schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, all spans and their scores."""
    found = detect(documents, settings=settings)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
        F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )
