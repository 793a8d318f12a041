"""Text rules with Unicode whitespace and digits, as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as whitespace when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same as an SQL literal.
SQL_WHITESPACE = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"

# Fixed value: the phrase that marks a page footer.
FOOTER_PHRASE = "inspection report"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITESPACE))


def present(text: Column) -> Column:
    """The text, or null where it is empty: headings treat ``""`` and null alike."""
    return F.nullif(text, F.lit(""))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def is_page_number(text: Column) -> Column:
    return F.coalesce(strip(text).rlike(r"(?U)\A\d+\z"), F.lit(False))


def is_blank_or_page_number(text: Column) -> Column:
    """:func:`is_blank` or :func:`is_page_number`, in one match that ends at the first letter."""
    space = r"[\s\x1c-\x1f]"
    return F.coalesce(text.rlike(rf"(?U)\A{space}*+(\d++{space}*+)?\z"), F.lit(True))


def contains_phrase(text: Column, phrase: str = FOOTER_PHRASE) -> Column:
    return F.coalesce(text.rlike(rf"(?iu)\Q{phrase}\E"), F.lit(False))


def section_path(h1: Column, h2: Column, h3: Column) -> Column:
    return F.concat_ws(" > ", present(h1), present(h2), present(h3))


def section_level(h1: Column, h2: Column, h3: Column) -> Column:
    return (
        F.when(present(h3).isNotNull(), 3)
        .when(present(h2).isNotNull(), 2)
        .when(present(h1).isNotNull(), 1)
        .otherwise(0)
    )


def resource_url(base: str, entity: str, key: Column, option: str | None = None) -> Column:
    parts = [F.lit(f"{base.rstrip('/')}/{entity}/"), key.cast("string")]
    if option:
        parts.append(F.lit(f"?{option}"))
    return F.concat(*parts)


def signed_url(url: Column, token: Column) -> Column:
    """Append a non-empty token with ``?``, or ``&`` where the URL already has a query."""
    separator = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(present(token).isNotNull(), F.concat(url, separator, token)).otherwise(url)
