"""String expressions (F7-F13) used to line up keys between sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before_first_space(c: ColumnOrName) -> Column:
    """text before the first space; the whole text when there is none."""
    return F.substring_index(_col(c), " ", 1)


def lower_key(c: ColumnOrName) -> Column:
    """F8: Unicode lower-casing of a join key."""
    return F.lower(_col(c))


def offer_key(c: ColumnOrName) -> Column:
    """lower-cased text before the first '|'.  A missing offer id is read
    as the text 'nan' first, as a stringified missing value would be (T12)."""
    return F.lower(F.substring_index(F.coalesce(_col(c), F.lit("nan")), "|", 1))


def last_dash_token(c: ColumnOrName) -> Column:
    """text after the last '-'; the whole text when there is none."""
    return F.substring_index(_col(c), "-", -1)


# Size clean-up replacements, applied in this order.
SIZE_REPLACEMENTS = (("US", ""), ("UK", ""), ("Wm", "W"), (" ", ""))


def clean_size(c: ColumnOrName, replacements=SIZE_REPLACEMENTS) -> Column:
    """literal replacements applied in order (not regular expressions)."""
    out = _col(c)
    for search, repl in replacements:
        out = F.replace(out, F.lit(search), F.lit(repl))
    return out


def digits_and_dots(c: ColumnOrName) -> Column:
    """keep decimal digits (any script) and dots."""
    return F.regexp_replace(_col(c), r"[^\p{Nd}.]+", "")


def new_sku(sku: ColumnOrName, size: ColumnOrName) -> Column:
    """lower(sku || '-' || size)."""
    return F.lower(F.concat(_col(sku), F.lit("-"), _col(size)))
