"""Column expressions.  All built-in Spark functions: they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_CATEGORY = "__missing__"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_default(c, default: bool = False) -> Column:
    """``COALESCE(b, FALSE)``."""
    return F.coalesce(_c(c), F.lit(default))


def nan_to_null(c) -> Column:
    """NaN -> NULL, so NaN counts as missing (pandas semantics) instead of as a huge value."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def not_null_positive(c) -> Column:
    """F1 element: ``c IS NOT NULL AND c > 0``."""
    c = _c(c)
    return c.isNotNull() & (c > 0)


def contained(small, big) -> Column:
    """``small <= big`` (NULL rejects, as in SQL)."""
    return _c(small) <= _c(big)


def floor_rule_independent(floor, total) -> Column:
    """F4, published form: each bound checked on its own; NULL passes."""
    f, t = _c(floor), _c(total)
    return (
        (f.isNull() | (f >= 0))
        & (t.isNull() | (t > 0))
        & (f.isNull() | t.isNull() | (f <= t))
    )


def floor_rule_joint(floor, total) -> Column:
    """F4, exploratory form: all three bounds, only when both values are present."""
    f, t = _c(floor), _c(total)
    return f.isNull() | t.isNull() | ((f >= 0) & (t > 0) & (f <= t))


def iqr_fences(q1, q3, k: float = 1.5) -> tuple[Column, Column]:
    """``(q1 - k*(q3-q1), q3 + k*(q3-q1))``."""
    q1, q3 = _c(q1), _c(q3)
    iqr = q3 - q1
    return q1 - F.lit(k) * iqr, q3 + F.lit(k) * iqr


def clamp(x, lo, hi) -> Column:
    """P5: ``GREATEST(lo, LEAST(x, hi))``."""
    return F.greatest(_c(lo), F.least(_c(x), _c(hi)))


def clamp_iqr(x, q1, q3, k: float = 1.5, guard: Column | None = None) -> Column:
    """P4+P5+P6: cap ``x`` to the IQR fences unless the IQR is missing or degenerate.

    ``guard`` is an extra condition under which no capping happens (the exploratory
    cleaner passes ``n < 4``).
    """
    q1c, q3c = _c(q1), _c(q3)
    lo, hi = iqr_fences(q1c, q3c, k)
    # NULL stays NULL (GREATEST/LEAST would otherwise turn a NULL into the upper fence)
    skip = _c(x).isNull() | q1c.isNull() | (q3c <= q1c)
    if guard is not None:
        skip = skip | guard
    return F.when(skip, _c(x)).otherwise(clamp(x, lo, hi))


def try_double(c) -> Column:
    """Numeric coercion; bad strings become NULL (``to_numeric(errors='coerce')``)."""
    return _c(c).try_cast("double")


def is_finite(c) -> Column:
    """Not NaN and not +-Infinity (``try_cast('inf')`` yields Infinity)."""
    c = _c(c)
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def is_integral(c) -> Column:
    """Gate for P10: a category code must be a whole number."""
    c = _c(c).cast("double")
    return c.isNull() | (c == F.floor(c))


def category_string(c) -> Column:
    """P10: integer category -> string, NULL -> ``__missing__``."""
    return F.coalesce(_c(c).cast("bigint").cast("string"), F.lit(MISSING_CATEGORY))


def pct(n, total, digits: int = 2) -> Column:
    """``round(100 * n / total, 2)``; NULL of an empty total."""
    return F.round(F.try_divide(F.lit(100.0) * _c(n), _c(total)), digits)
