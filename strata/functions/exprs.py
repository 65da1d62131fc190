"""Scalar and aggregate expressions with the reference's exact semantics.

Decimal rules (SURVEY Hard 4): the reference averages integers as exact
numerics and rounds half away from zero. Spark's ``avg(int)`` is a double, so
averages here are ``decimal(18,0) / decimal(18,0)`` (19 fractional digits),
then ``round(.., s)`` (HALF_UP on decimals), then an ANSI cast to the target
``decimal(p, s)`` which raises on overflow like the reference (Q14).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(18,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_ratio(num, den, p: int = 18, s: int = 2) -> Column:
    """round(num / den, s) as decimal(p, s); NULL when den is 0 or NULL."""
    n = _c(num).cast(_EXACT)
    d = F.nullif(_c(den), F.lit(0)).cast(_EXACT)
    return F.round(n / d, s).cast(f"decimal({p},{s})")


def safe_ratio(num, den, p: int = 4, s: int = 2) -> Column:
    """AGG-8: ``round(num::numeric / nullif(den, 0), s)``."""
    return exact_ratio(num, den, p, s)


def exact_avg(col, p: int = 4, s: int = 2) -> Column:
    """AGG-6: exact ``round(avg(int_col), s)``; avg skips NULLs, so the divisor
    is ``count(col)``. Aggregate expression."""
    c = _c(col)
    return exact_ratio(F.sum(c), F.count(c), p, s)


def bool_pct(cond, p: int = 5, s: int = 2) -> Column:
    """AGG-7: ``round(avg(cond::int) * 100, s)``; NULL conditions are skipped
    by the average. Aggregate expression."""
    c = _c(cond)
    hits = F.count_if(c).cast(_EXACT) * F.lit(100).cast(_EXACT)
    return F.round(hits / F.nullif(F.count(c), F.lit(0)).cast(_EXACT), s).cast(
        f"decimal({p},{s})")


def result_sign(home, away) -> Column:
    """PROJ-10: 1 / 0 / -1 by comparing two scores; NULL if either is NULL
    (searched CASE without ELSE)."""
    h, a = _c(home), _c(away)
    return (F.when(h > a, 1).when(h < a, -1).when(h == a, 0)).cast("smallint")


def neg(col) -> Column:
    """PROJ-11: unary minus keeping the column type."""
    return F.negative(_c(col))


def coalesce0_sum(*cols) -> Column:
    """PROJ-9: sum where NULL counts as 0 (``coalesce(a,0)+coalesce(b,0)``)."""
    return reduce(lambda x, y: x + y, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def row_is_distinct(left: list, right: list) -> Column:
    """FILT-6: null-safe tuple inequality ``(l1,..) IS DISTINCT FROM (r1,..)``.

    Written as an OR of per-column ``NOT (l <=> r)`` so each comparison keeps
    its own column type and the whole predicate stays in codegen.
    """
    if len(left) != len(right):
        raise ValueError("tuples must have the same arity")
    parts = [~_c(l).eqNullSafe(_c(r)) for l, r in zip(left, right)]
    return reduce(lambda x, y: x | y, parts)


def iso_day_of_week(d) -> Column:
    """SCAL-19: ISO day of week, 1 = Monday ... 7 = Sunday (not dayofweek)."""
    return F.weekday(_c(d)) + 1


def season_year(d, start_month: int = 8) -> Column:
    """SCAL-22: a football season starts in August: months >= 8 belong to
    the season of that year, earlier months to the previous one."""
    c = _c(d)
    return F.when(F.month(c) >= start_month, F.year(c)).otherwise(F.year(c) - 1)
