"""Column -> Column cleaners; all built-in expressions, so they fuse into one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
PLACEHOLDERS = ("UNKNOWN", "N/A", "TBD")
NAME_PLACEHOLDERS = ("UNKNOWN", "N/A", "TBD", "TEST USER")
EMAIL_PLACEHOLDERS = ("N/A", "TBD", "UNKNOWN", "NOTANEMAIL")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NAME_TITLE_PATTERN = r"^(Mr\.|Ms\.|Mrs\.|Dr\.)\s*"
FAKE_PHONE = "123-456-7890"

# Numeric date patterns: the shape of the text, and where year, month and day start.
DATE_LAYOUTS = {
    "yyyy-MM-dd": (r"^(?!0000)\d{4}-\d{2}-\d{2}$", (1, 6, 9)),
    "MM/dd/yyyy": (r"^\d{2}/\d{2}/(?!0000)\d{4}$", (7, 1, 4)),
    "dd-MM-yyyy": (r"^\d{2}-\d{2}-(?!0000)\d{4}$", (7, 4, 1)),
    "yyyyMMdd": (r"^(?!0000)\d{8}$", (1, 5, 7)),
    "yyyy/MM/dd": (r"^(?!0000)\d{4}/\d{2}/\d{2}$", (1, 6, 9)),
}
# Patterns with a month name.
NAMED_DATE_LAYOUTS = {"MMMM dd, yyyy": r"^[A-Za-z]+ \d{2}, \d{4}$"}
DATE_PATTERNS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyyMMdd", "MMMM dd, yyyy")
STREAM_DATE_PATTERNS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")

STATUS_LABELS = {
    "completed": ("COMPLETED", "COMPLETE"),
    "cancelled": ("CANCELLED", "CANCELED"),
    "pending": ("PENDING", "PROCESSING"),
    "shipped": ("SHIPPED", "DELIVERED"),
    "refunded": ("REFUNDED", "RETURNED"),
    "failed": ("FAILED", "ERROR"),
    "unknown": ("UNKNWON",),
}
SEGMENT_LABELS = {
    "Unknown": ("UNKNOWN", "N/A", "TBD"),
    "Premium": ("PREMIUM", "VIP", "GOLD"),
    "Regular": ("REGULAR", "STANDARD", "BASIC", "SILVER"),
    "Bronze": ("BRONZE", "NEW"),
}
# Searched in this order: the first keyword found decides.
CATEGORY_KEYWORDS = {
    "ELECTRONIC": "Electronics",
    "HOME": "Home & Kitchen",
    "KITCHEN": "Home & Kitchen",
    "SPORT": "Sports & Outdoors",
    "BOOK": "Books",
}
TRUE_WORDS = ("TRUE", "T", "YES", "Y", "1", "ACTIVE")
FALSE_WORDS = ("FALSE", "F", "NO", "N", "0", "INACTIVE")
# -----------------------------------------------------------------------------


def _upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def is_missing(c: Column, placeholders: Sequence[str] = ()) -> Column:
    """Null, blank, or one of the placeholder words; never null itself."""
    missing = c.isNull() | (F.trim(c) == "")
    return missing | _upper(c).isin(*placeholders) if placeholders else missing


def relabel(c: Column, labels: Mapping[str, Sequence[str]], blank: str, other: Column) -> Column:
    """Map spellings to labels in a single CASE; ``blank`` for missing, ``other`` for the rest."""
    case = F.when(is_missing(c), blank)
    for label, spellings in labels.items():
        case = case.when(_upper(c).isin(*spellings), label)
    return case.otherwise(other)


def clean_name(c: Column, title_case: bool = False) -> Column:
    tidy = F.regexp_replace(F.regexp_replace(F.trim(c), r"\s+", " "), NAME_TITLE_PATTERN, "")
    return F.when(~is_missing(c, NAME_PLACEHOLDERS), F.initcap(tidy) if title_case else tidy)


def clean_email(c: Column) -> Column:
    tidy = F.lower(F.trim(c))
    return F.when(~is_missing(c, EMAIL_PLACEHOLDERS) & tidy.rlike(EMAIL_PATTERN), tidy)


def clean_date(c: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Date from the pattern whose shape the text has; null for none or for no real date.

    Numeric dates are rearranged to ISO text and cast, which needs no formatter and
    raises nothing on the way for a month 13. Month names go through a formatter.
    """
    iso = F
    for pattern in patterns:
        if pattern in DATE_LAYOUTS:
            shape, (year, month, day) = DATE_LAYOUTS[pattern]
            parts = [F.substring(c, year, 4), F.substring(c, month, 2), F.substring(c, day, 2)]
            iso = iso.when(c.rlike(shape), F.concat_ws("-", *parts))
    named = [
        F.when(c.rlike(NAMED_DATE_LAYOUTS[p]), F.try_to_date(c, p))
        for p in patterns
        if p in NAMED_DATE_LAYOUTS
    ]
    return F.coalesce(iso.otherwise(None).try_cast("date"), *named)


def clean_status(c: Column) -> Column:
    return relabel(c, STATUS_LABELS, "unknown", F.lower(F.trim(c)))


def clean_segment(c: Column) -> Column:
    return relabel(c, SEGMENT_LABELS, "Unknown", F.trim(c))


def clean_boolean(c: Column) -> Column:
    word = _upper(c.cast("string"))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def clean_number(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Null outside the inclusive bounds; an open side is not checked."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (c < low)
    if high is not None:
        outside = outside | (c > high)
    return F.when(~outside, c)


def clean_phone(c: Column) -> Column:
    """``+1-aaa-bbb-cccc`` for a ten digit number, with or without country code 1."""
    digits = F.regexp_replace(c, r"\D", "")
    national = F.regexp_replace(digits, r"^1(?=\d{10}$)", "")
    return F.when(
        ~is_missing(c, PLACEHOLDERS) & (c != FAKE_PHONE) & national.rlike(r"^\d{10}$"),
        F.regexp_replace(national, r"^(\d{3})(\d{3})(\d{4})$", "+1-$1-$2-$3"),
    )


def clean_product_name(c: Column) -> Column:
    return F.when(is_missing(c, PLACEHOLDERS), "Unknown Product").otherwise(F.trim(c))


def clean_category(c: Column) -> Column:
    case = F.when(is_missing(c, PLACEHOLDERS), "Other")
    for keyword, label in CATEGORY_KEYWORDS.items():
        case = case.when(_upper(c).contains(keyword), label)
    return case.otherwise(F.trim(c))
