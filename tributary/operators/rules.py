"""Validation rules: what rejects a document, what accepts it, and why it was rejected.

Rejecting and accepting are two separate three-valued conditions. A document for
which both are NULL (say, without an order date) is neither accepted nor
rejected: it is *unrouted*. Never derive one condition by negating the other.

Conditions are SQL expressions over the typed fields of a document.
"""

from itertools import takewhile
from typing import Literal, NamedTuple, get_args

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import values as V
from tributary.functions.documents import NUMERIC, uncastable, with_typed_fields

Mode = Literal["reference", "tolerant"]

ACCEPTED, REJECTED, UNROUTED = "accepted", "rejected", "unrouted"


class Rule(NamedTuple):
    name: str
    rejects: str
    accepts: str
    reason_when: str | None = None
    reason: str | None = None


def _required(field: str, message: str) -> Rule:
    missing = f"{field} IS NULL"
    return Rule(field, missing, f"{field} IS NOT NULL", missing, f"'{message}'")


def _not_negative(field: str, message: str, no_text: str) -> Rule:
    bad = f"{field} IS NULL OR {field} < 0"
    reason = f"'{message}' || coalesce({field}_text, '{no_text}')"
    return Rule(field, bad, f"{field} IS NOT NULL AND {field} >= 0", bad, reason)


_LISTED = "order_status IN ({})".format(", ".join(f"'{s}'" for s in V.ORDER_STATUSES))
_BAD_DATE = "order_timestamp IS NULL AND NOT day_first"
_SCORE_REASON = f"'{V.BAD_PERFORMANCE_SCORE}' || performance_score_text"

# In the order in which reasons are tried.
RULES = (
    _required("order_id", V.MISSING_ORDER_ID),
    # Day-first text passes by its shape alone, whether or not it is a real day.
    Rule(
        "order_date", _BAD_DATE, "order_timestamp IS NOT NULL OR day_first", _BAD_DATE, f"'{V.BAD_DATE}'"
    ),
    Rule("order_status", f"NOT {_LISTED}", _LISTED, f"NOT {_LISTED}", f"'{V.BAD_STATUS}'"),
    _required("customer_id", V.MISSING_CUSTOMER_ID),
    _required("supplier_id", V.MISSING_SUPPLIER_ID),
    # The reason looks at supplier_performance_score, the decision at performance_score.
    Rule(
        "performance_score",
        "performance_score > 100 OR performance_score < 0",
        "performance_score BETWEEN 0 AND 100",
        "supplier_performance_score > 100 OR supplier_performance_score < 0",
        _SCORE_REASON,
    ),
    Rule(
        "lead_time_days",
        "lead_time_days < 0",
        "lead_time_days >= 0 OR lead_time_days IS NULL",
        "lead_time_days < 0",
        f"'{V.BAD_LEAD_TIME}' || lead_time_days_text",
    ),
    _required("product_id", V.MISSING_PRODUCT_ID),
    Rule("quantity_missing", "quantity IS NULL", "quantity IS NOT NULL"),
    Rule("quantity", "quantity <= 0", "quantity > 0", "quantity <= 0", f"'{V.BAD_QUANTITY}' || quantity_text"),
    _not_negative("unit_price", V.BAD_UNIT_PRICE, V.NO_PRICE_TEXT),
    _not_negative("total_amount", V.BAD_TOTAL_AMOUNT, V.NO_TOTAL_TEXT),
    # A JSON null level is neither below zero nor absent.
    Rule(
        "inventory_level",
        "inventory_level < 0",
        "inventory_level >= 0 OR NOT inventory_given",
        "inventory_level < 0",
        f"'{V.BAD_INVENTORY}' || inventory_level_text",
    ),
)

# Why a document was neither accepted nor rejected, in tolerant mode.
GAPS = (
    ("order_date_text IS NULL", "'missing order date'"),
    ("order_status IS NULL", "'missing order status'"),
    ("performance_score IS NULL", "'missing performance score'"),
    ("true", "'null inventory level'"),
)


def rejected() -> str:
    return " OR ".join(f"({rule.rejects})" for rule in RULES)


def accepted() -> str:
    return " AND ".join(f"({rule.accepts})" for rule in RULES)


def _first_match(pairs, otherwise: str = "NULL") -> str:
    branches = " ".join(f"WHEN {condition} THEN {value}" for condition, value in pairs)
    return f"CASE {branches} ELSE {otherwise} END"


def error_reason() -> str:
    """Text of the first rule that explains the rejection; may be NULL."""
    explained = ((rule.reason_when, rule.reason) for rule in RULES if rule.reason_when)
    return _first_match(explained, f"'{V.UNKNOWN_REASON}'")


def cast_error() -> str:
    """Which value a strict cast cannot read, or NULL; needs ``rejected`` and ``accepted``.

    The order date and ``delay_days`` are cast for accepted documents only, and
    ``supplier_performance_score`` only where the reason gets that far.
    """
    earlier = takewhile(lambda rule: rule.name != "performance_score", RULES)
    explained = " OR ".join(f"coalesce({rule.reason_when}, false)" for rule in earlier)
    only_if = {
        "supplier_performance_score": f"rejected AND NOT ({explained})",
        "delay_days": "accepted",
    }
    pairs = [
        (
            f"{uncastable(f)} AND {only_if.get(f.name, 'true')}",
            f"'not a number: {f.name} ' || {f.name}_text",
        )
        for f in NUMERIC
    ]
    pairs.append((
        "accepted AND day_first AND order_timestamp IS NULL",
        "'not a date: order_date ' || order_date_text",
    ))
    return _first_match(pairs)


def classify(raw_orders: DataFrame, mode: Mode = "reference", columns: tuple[str, ...] | None = None) -> DataFrame:
    """Add the typed fields, ``route`` and ``error_reason`` to raw documents, or only those of ``columns``.

    Name the columns that are needed: all that are added are computed, used or not.

    ``reference`` fails on a value that a strict cast cannot read and leaves
    documents with NULL in a tested field unrouted. ``tolerant`` rejects both
    kinds with a reason, so every document is accepted or rejected.
    """
    if mode not in get_args(Mode):
        raise ValueError(f"unknown mode: {mode}")
    if mode == "reference":
        route = (
            "CASE WHEN cast_error IS NOT NULL THEN CAST(raise_error(cast_error) AS string)"
            f" WHEN rejected THEN '{REJECTED}' WHEN accepted THEN '{ACCEPTED}' ELSE '{UNROUTED}' END"
        )
        reason = f"CASE WHEN rejected THEN {error_reason()} END"
    else:
        route = f"CASE WHEN accepted AND cast_error IS NULL THEN '{ACCEPTED}' ELSE '{REJECTED}' END"
        reason = _first_match([
            ("cast_error IS NOT NULL", "cast_error"),
            ("rejected", error_reason()),
            ("NOT accepted OR accepted IS NULL", _first_match(GAPS)),
        ])
    typed = with_typed_fields(raw_orders)
    fields = [c for c in typed.columns if c not in raw_orders.columns]
    routed = (
        typed.selectExpr("*", f"{rejected()} AS rejected", f"{accepted()} AS accepted")
        .selectExpr("*", f"{cast_error()} AS cast_error")
        .selectExpr(*typed.columns, f"{route} AS route", f"{reason} AS error_reason")
    )
    # A filter on ``route`` would be rewritten into all rules over the raw document
    # and read every field again, several times. It cannot pass a generator.
    result = ", ".join(columns or [*fields, "route", "error_reason"])
    return routed.selectExpr(*raw_orders.columns, f"inline(array(struct({result})))")


def route_counts(classified: DataFrame) -> DataFrame:
    """Row accounting: every input document has exactly one route."""
    return classified.groupBy("route").agg(F.count("*").alias("documents"))
