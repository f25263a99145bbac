"""Text clean-up shared by keys and descriptive columns, as SQL expressions."""

from tributary.functions.values import UNKNOWN


def clean(text: str) -> str:
    """Upper case without surrounding blanks; NULL stays NULL."""
    return f"upper(trim({text}))"


def clean_or_unknown(text: str) -> str:
    """As ``clean``, with NULL (but not the empty string) shown as UNKNOWN."""
    return f"coalesce({clean(text)}, '{UNKNOWN}')"
