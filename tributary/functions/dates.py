"""Lenient date and time parsing, as SQL expressions: unreadable text becomes NULL."""

from tributary.functions.values import DAY_FIRST_LIKE

# Formats read besides ISO, and the sizes at which an all-digit
# text turns from seconds to milli-, micro- and nanoseconds since 1970.
DATE_FORMATS = ("dd-MMM-yyyy", "MM/dd/yyyy")
TIMESTAMP_FORMATS = ("dd-MMM-yyyy", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss")
MILLIS_FROM = 31_536_000_000
MICROS_FROM = 31_536_000_000_000
NANOS_FROM = 31_536_000_000_000_000
FIRST_SECOND = -62_135_596_800


def _all_digits(text: str) -> str:
    return f"{text} RLIKE '^-?[0-9]+$'"


def _epoch_timestamp(text: str) -> str:
    number = f"try_cast({text} AS decimal(20,0))"

    def seconds_per(unit: int) -> str:
        return f"try_cast({number} / {unit} AS decimal(18,6))"

    seconds = (
        f"CASE WHEN {number} < {MILLIS_FROM} THEN {seconds_per(1)}"
        f" WHEN {number} < {MICROS_FROM} THEN {seconds_per(1_000)}"
        f" WHEN {number} < {NANOS_FROM} THEN {seconds_per(1_000_000)}"
        f" ELSE {seconds_per(1_000_000_000)} END"
    )
    shifted = f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    return f"CASE WHEN {seconds} BETWEEN {FIRST_SECOND} AND {MILLIS_FROM} THEN {shifted} END"


def lenient_timestamp(text: str) -> str:
    """Wall-clock timestamp; a zone suffix is read and ignored."""
    tries = [f"try_cast({text} AS timestamp_ntz)"]
    tries += [f"CAST(try_to_timestamp({text}, '{f}') AS timestamp_ntz)" for f in TIMESTAMP_FORMATS]
    return f"CASE WHEN {_all_digits(text)} THEN {_epoch_timestamp(text)} ELSE coalesce({', '.join(tries)}) END"


def lenient_date(text: str) -> str:
    tries = [f"try_to_date({text})"] + [f"try_to_date({text}, '{f}')" for f in DATE_FORMATS]
    epoch = f"CAST({_epoch_timestamp(text)} AS date)"
    return f"CASE WHEN {_all_digits(text)} THEN {epoch} ELSE coalesce({', '.join(tries)}) END"


def is_day_first(text: str) -> str:
    """Shaped like DD-MM-YYYY; says nothing about whether it is a real day."""
    return f"{text} LIKE '{DAY_FIRST_LIKE}'"


def order_timestamp(text: str) -> str:
    """Order date: day-first text becomes midnight of that day, the rest is read leniently."""
    day = f"CAST(try_to_date({text}, 'dd-MM-yyyy') AS timestamp_ntz)"
    return f"CASE WHEN {is_day_first(text)} THEN {day} ELSE {lenient_timestamp(text)} END"
