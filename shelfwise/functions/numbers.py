"""Numeric expressions (F14-F18) and lenient text-to-number casts (T5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gtin_key(c: ColumnOrName, drop: int, clean: bool = False) -> Column:
    """F14 / J2 key: the GTIN without its last ``drop`` characters.

    ``clean=True`` first strips a trailing '.0' (a code read back from a float
    column) and turns an empty key into NULL so short codes never match each
    other.  Both sides then use the same ``drop``.
    """
    s = _col(c)
    if clean:
        s = F.regexp_replace(s, r"\.0$", "")
    key = F.left(s, F.greatest(F.length(s) - F.lit(drop), F.lit(0)))
    if clean:
        key = F.when(key != "", key)
    return key


def micros_to_units(c: ColumnOrName) -> Column:
    """ad cost in micros -> currency units (double)."""
    return _col(c).cast("double") / F.lit(1_000_000.0)


def roas(revenue: ColumnOrName, cost: ColumnOrName) -> Column:
    """F16: revenue / cost, 0.0 when the cost is zero or negative."""
    cost = _col(cost).cast("double")
    return F.when(cost <= 0, F.lit(0.0)).otherwise(_col(revenue).cast("double") / cost)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """SQL-style division: NULL instead of an error on a zero divisor."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def btdr(c: ColumnOrName) -> Column:
    """buy-to-detail rate percent -> fraction."""
    return _col(c).cast("double") / F.lit(100.0)


_REAL_PREFIX = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
_INT_PREFIX = r"^\s*([+-]?[0-9]+)"


def lenient_double(c: ColumnOrName) -> Column:
    """Text -> double taking the numeric prefix, 0.0 when there is
    none ('abc' -> 0.0, '1.5x' -> 1.5).  NULL stays NULL."""
    s = _col(c).cast("string")
    prefix = F.regexp_extract(s, _REAL_PREFIX, 1)
    return F.when(s.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(prefix.try_cast("double"), F.lit(0.0)))


def lenient_bigint(c: ColumnOrName) -> Column:
    """Text -> bigint taking the integer prefix ('12.7' -> 12,
    'abc' -> 0).  NULL stays NULL."""
    s = _col(c).cast("string")
    prefix = F.regexp_extract(s, _INT_PREFIX, 1)
    return F.when(s.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(prefix.try_cast("bigint"), F.lit(0).cast("bigint")))


def as_number(c: ColumnOrName, dtype: DataType, integral: bool = False) -> Column:
    """Numeric columns pass through; text goes through the lenient cast.

    The decision uses the column's schema type (driver-side metadata), so the
    typed path costs nothing per row.
    """
    if isinstance(dtype, NumericType):
        return _col(c)
    if isinstance(dtype, StringType):
        return lenient_bigint(c) if integral else lenient_double(c)
    return _col(c).cast("bigint" if integral else "double")
