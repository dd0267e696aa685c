"""Money and ratio expressions.

Sums are taken over exact decimals; a ratio or mean casts the sums to
double once, divides with a zero guard, then rounds. Division by zero is
NULL (``try_divide``) instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return _c(c).cast("double")


def money_sum(c, scale: int = 2) -> Column:
    """ROUND(SUM(x), scale) on the exact decimal sum, as double."""
    return F.round(F.sum(_c(c)), scale).cast("double")


#: A long's low bits are summed apart from the others: either sum is a long up to 2**33 rows.
_LIMB = 30


def unscaled(c, scale: int) -> Column:
    """The unscaled value of a decimal(18, scale) as a long; exact, as its whole part and its places are worked out apart."""
    whole = _c(c).cast("long")
    places = (_c(c) - whole.cast(f"decimal(18,{scale})")).cast("double")
    return whole * F.lit(10 ** scale) + F.rint(places * float(10 ** scale)).cast("long")


def limb_sums(units: str) -> list[Column]:
    """Aggregates: the two sums of longs that `from_limbs` puts together, in the place of a sum of decimals beyond 18 digits."""
    u = F.col(units)
    return [F.sum(F.shiftright(u, _LIMB)).alias(f"{units}_high"), F.sum(u.bitwiseAND(F.lit((1 << _LIMB) - 1))).alias(f"{units}_low")]


def from_limbs(units: str, precision: int, scale: int) -> Column:
    """The sum as a decimal; NULL without a value."""
    total = F.col(f"{units}_high").cast("decimal(19,0)") * F.lit(1 << _LIMB).cast("decimal(10,0)") + F.col(f"{units}_low").cast("decimal(19,0)")
    unit = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({max(1, scale)},{scale})")
    return (total * unit).cast(f"decimal({precision},{scale})")


def safe_ratio(num, den) -> Column:
    """num / den as doubles, NULL when den is 0 or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def mean(c) -> Column:
    """Mean as double sum / count (NULLs skipped like AVG)."""
    return safe_ratio(F.sum(_c(c)), F.count(_c(c)))


def rounded_mean(c, scale: int = 2, in_scale: int = 6, times: int = 1) -> Column:
    """Aggregate: ROUND(AVG(x) * times, scale), rounded half up (away from
    zero) on the exact decimal mean.

    ``x`` is a decimal with ``in_scale`` places. The mean S / n is rounded in
    integer arithmetic -- q = (2|S|*times*10^scale + n*10^in_scale) div
    (2*n*10^in_scale) on the unscaled sum S -- so no binary double ever decides a
    tie (78.945 rounds to 78.95 whatever its nearest double is)."""
    col = _c(c)
    return rounded_ratio(F.sum(col), F.count(col), scale, in_scale, times)


def rounded_ratio(total, count, scale: int = 2, in_scale: int = 6, times: int = 1) -> Column:
    """ROUND(total / count * times, scale), half up on the exact decimal
    value: :func:`rounded_mean` over an already-summed decimal ``total``
    (``in_scale`` places) and its value count, e.g. re-aggregated partials."""
    dec0 = "decimal(38,0)"
    unscaled = (_c(total) * F.lit(10 ** in_scale)).cast(dec0)
    n = _c(count).cast(dec0)
    d = n * F.lit(10 ** in_scale).cast(dec0)
    num = F.abs(unscaled) * F.lit(2 * times * 10 ** scale).cast(dec0) + d
    den = d * F.lit(2).cast(dec0)
    q = ((num - F.pmod(num, den)) / den).cast("long")
    signed = F.when(unscaled < 0, -q).otherwise(q)
    return F.when(n > 0, signed.cast("double") / float(10 ** scale))


def pct_of(num, den, scale: int = 2) -> Column:
    """ROUND(num / den * 100, scale) with the zero guard."""
    return F.round(safe_ratio(num, den) * 100, scale)


def lift_pct(base, other) -> Column:
    """(other - base) / base * 100, NULL when base is 0 or NULL."""
    return F.try_divide(dbl(_c(other)) - dbl(_c(base)), dbl(_c(base))) * 100


def pearson(x, y) -> Column:
    """Aggregate: Pearson correlation over rows where both are present.

    NaN when either side has zero variance (as numpy and DuckDB give), NULL
    without pairs. Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI mode for
    zero variance, so the ratio is formed here with ``try_divide``."""
    xc, yc = _c(x), _c(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    ratio = F.try_divide(F.covar_pop(xs, ys), den)
    return F.when(F.count(xs) == 0, F.lit(None).cast("double")) \
        .when(den == 0, F.lit(float("nan"))).otherwise(ratio)
