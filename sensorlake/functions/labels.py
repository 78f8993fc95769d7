"""Display labels as column expressions.

Numbers are rounded the way Python formats floats: the exact binary value,
ties to even.  That is reproduced with IEEE double arithmetic only:
``q * 10`` is computed error-free as ``8q + 2q`` (multiplying by a power of
two is exact) with Knuth's TwoSum giving the exact rounding error, and the
fraction ``q - floor(q)`` is exact.  Every engine that follows IEEE 754
therefore prints the same text as the reference's f-strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(q: Column) -> Column:
    """Nearest integer to the exact value of double ``q``, ties to even."""
    fl = F.floor(q)
    frac = q - fl
    up = (frac > 0.5) | ((frac == 0.5) & ((fl % 2) != 0))
    return F.when(up, fl + 1).otherwise(fl)


def round_tenths(q: Column) -> Column:
    """Nearest integer to the exact value of ``10 * q``, ties to even."""
    a, b = q * F.lit(8.0), q * F.lit(2.0)
    s = a + b
    bb = s - a
    err = (a - (s - bb)) + (b - bb)  # 10q = s + err exactly
    fl = F.floor(s)
    frac = s - fl
    up = (frac > 0.5) | ((frac == 0.5) & ((err > 0) | ((err == 0) & ((fl % 2) != 0))))
    return F.when(up, fl + 1).otherwise(fl)


def _one_decimal(tenths: Column) -> Column:
    """Non-negative tenths as ``i.d``."""
    return F.concat(
        F.floor(tenths / 10).cast("bigint").cast("string"),
        F.lit("."),
        (tenths % 10).cast("bigint").cast("string"),
    )


def compact_number(x: Column) -> Column:
    """``1.2M`` / ``35K`` / ``812``."""
    x = x.cast("double")
    return (
        F.when(x >= 1_000_000, F.concat(_one_decimal(round_tenths(x / F.lit(1_000_000.0))), F.lit("M")))
        .when(x >= 1_000, F.concat(round_half_even(x / F.lit(1000.0)).cast("bigint").cast("string"), F.lit("K")))
        .otherwise(round_half_even(x).cast("bigint").cast("string"))
    )


def signed_percent(pct: Column) -> Column:
    """``+12.3%`` / ``-4.0%``; null stays null."""
    p = pct.cast("double")
    negative = (p < 0) | ((p == 0) & p.cast("string").startswith("-"))  # -0.0 prints as "-0.0"
    sign = F.when(negative, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, _one_decimal(round_tenths(F.abs(p))), F.lit("%"))


def percent(fraction: Column, decimals: int = 1) -> Column:
    """A non-negative fraction as ``12.3%``, or ``12%`` without decimals."""
    p = fraction.cast("double") * F.lit(100.0)
    number = _one_decimal(round_tenths(p)) if decimals else round_half_even(p).cast("bigint").cast("string")
    return F.concat(number, F.lit("%"))


def signed_points(pct: Column) -> Column:
    """``+12%`` / ``-4%``, no decimals."""
    p = pct.cast("double")
    negative = (p < 0) | ((p == 0) & p.cast("string").startswith("-"))
    sign = F.when(negative, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, round_half_even(F.abs(p)).cast("bigint").cast("string"), F.lit("%"))


def thousands(x: Column) -> Column:
    """Rounded integer with thousands separators, ``12,345``."""
    return F.format_number(round_half_even(x.cast("double")).cast("bigint"), 0)


def hour_label(h: Column) -> Column:
    """Zero-padded hour ``07``."""
    return F.lpad(h.cast("string"), 2, "0")


def html_escape(s: Column) -> Column:
    """Escape ``& < > " '`` ("&" first)."""
    out = F.replace(s, F.lit("&"), F.lit("&amp;"))
    for raw, esc in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def marker_radius(avg: Column) -> Column:
    """Map marker radius, sqrt(avg) x 0.55."""
    return F.sqrt(avg) * F.lit(0.55)
