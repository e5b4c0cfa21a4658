"""Number expressions: coercion like pandas.to_numeric(errors='coerce'),
bounds, rounding casts, exact integer rounding and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(a: Column, b: Column) -> Column:
    """Integral division of longs (Spark's `div`), no floating point."""
    return F.call_function("div", a, b)


# Numbers Java parses but pandas does not: type suffix, hexadecimal float.
_JAVA_ONLY = r"(?i)(?<!in)[df]\s*$|^\s*[+-]?0x"


def parse_number(c) -> Column:
    """String -> double; bad values -> null; NaN -> null.

    Spark's cast accepts Java forms that pandas rejects: a type suffix ('1d',
    '2f'; the word 'inf' is not one) and hex floats ('0x1p3'); they are refused
    by one regex test. NaN becomes null at once,
    because NaN >= 0 holds in Spark and would pass a lower bound.
    """
    s = _col(c).cast("string")
    num = F.when(~s.rlike(_JAVA_ONLY), s.try_cast("double"))
    return F.nanvl(num, F.lit(None).cast("double"))


def bounded(c, lo=None, hi=None) -> Column:
    """Keep the value inside [lo, hi] (either side optional), else null."""
    c = _col(c)
    if lo is not None and hi is not None:
        return F.when(c.between(lo, hi), c)
    if lo is not None:
        return F.when(c >= lo, c)
    if hi is not None:
        return F.when(c <= hi, c)
    return c


def _rounding_cast(c, type_name: str, lo: int, hi: int) -> Column:
    # A database assignment cast rounds half to even and raises on overflow;
    # the explicit check raises whatever the session's ANSI setting.
    r = F.rint(_col(c))
    return F.when(r.between(lo, hi), r.cast(type_name)).when(
        r.isNotNull(), F.raise_error(F.concat(F.lit(f"{type_name} out of range: "), r.cast("string")))
    )


def to_smallint(c) -> Column:
    return _rounding_cast(c, "smallint", -32768, 32767)


def to_int(c) -> Column:
    return _rounding_cast(c, "int", -2147483648, 2147483647)


def exact_rate_pct(part, whole) -> Column:
    """round(100 * part / whole, 2) with halves away from zero, computed on
    integers (part >= 0, whole > 0) so no engine-specific float tie can flip
    it; null when whole is 0 (like nullif(whole, 0))."""
    s = _col(part).cast("long")
    n = _col(whole).cast("long")
    q = _div(F.lit(20000) * s + n, F.lit(2) * n)
    return F.when(n != 0, q.cast("double") / F.lit(100.0))


def format_count(c) -> Column:
    """Integer with thousands separators, as Python's f"{x:,}"."""
    return F.format_number(_col(c).cast("long"), 0)


def format_fixed2(total, count) -> Column:
    """total / count with exactly two decimals, half to even, no separators,
    as Python's f"{x:.2f}" on the quotient; computed on integers."""
    s = _col(total).cast("long")
    n = _col(count).cast("long")
    scaled = F.lit(100) * s
    q0 = _div(scaled, n)
    rem = scaled - q0 * n
    up = (F.lit(2) * rem > n) | ((F.lit(2) * rem == n) & (F.pmod(q0, F.lit(2)) == 1))
    q = q0 + F.when(up, 1).otherwise(0)
    frac = F.lpad(F.pmod(q, F.lit(100)).cast("string"), 2, "0")
    return F.when(n > 0, F.concat(_div(q, F.lit(100)).cast("string"), F.lit("."), frac))
