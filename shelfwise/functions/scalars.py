"""Column expressions shared by the operators. All of them stay inside code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(c: Column) -> Column:
    """NaN counts as missing, so a NaN double becomes NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def clip(c: Column, low: Column | float | None, high: Column | float | None) -> Column:
    """Limit to ``[low, high]``; NULL stays NULL (``greatest``/``least`` would turn it into a bound)."""
    out = c
    if high is not None:
        out = F.when(c > high, F.lit(high) if not isinstance(high, Column) else high).otherwise(out)
    if low is not None:
        out = F.when(c < low, F.lit(low) if not isinstance(low, Column) else low).otherwise(out)
    return out


def code_of(c: Column, order: Sequence[str]) -> Column:
    """Position of a label in ``order``; NULL for NULL and for labels outside it."""
    chain = F.when(c == order[0], F.lit(0))
    for position, label in enumerate(order[1:], start=1):
        chain = chain.when(c == label, F.lit(position))
    return chain


def band(c: Column, edges: Sequence[Column | float], labels: Sequence[str]) -> Column:
    """Right-closed bands: the first label whose inner edge is at or above the value, the last label beyond."""
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chain = chain.when(c <= edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def equal_width_edges(low: Column, high: Column, bands: int) -> list[Column]:
    """Inner edges of ``bands`` equal bands; a constant column is widened by 0.1 % so that it has a middle."""
    pad = F.when(low == high, F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)).otherwise(F.lit(0.0))
    start, stop = low - pad, high + pad
    step = (stop - start) / F.lit(float(bands))
    return [start + F.lit(float(i)) * step for i in range(1, bands)]


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL for a zero denominator (plain division raises in ANSI mode)."""
    return F.try_divide(top, bottom)


def standard_score(c: Column, mean: float, std: float) -> Column:
    return (c - F.lit(mean)) / F.lit(std if std else 1.0)


def pearson(a: str, b: str) -> Column:
    """Pairwise-complete correlation as an aggregate; NULL for constant data, where ``corr`` raises."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread_x = F.stddev_samp(F.when(y.isNotNull(), x))
    spread_y = F.stddev_samp(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_samp(x, y), spread_x * spread_y)


def rounded(c: Column, digits: int | None) -> Column:
    """Half-even rounding as in tables rounded for display; ``None`` keeps the value."""
    return c if digits is None else F.bround(c, digits)


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    return reduce(lambda acc, k: acc * x + F.lit(k), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


# Wichura (1988), algorithm AS 241 (PPND16), lowest power first.
NORMAL_CENTRE_TOP = (
    3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3,
)
NORMAL_CENTRE_BOTTOM = (
    1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3,
)
NORMAL_NEAR_TOP = (
    1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
    1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4,
)
NORMAL_NEAR_BOTTOM = (
    1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
    1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9,
)
NORMAL_FAR_TOP = (
    6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
    2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7,
)
NORMAL_FAR_BOTTOM = (
    1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
    7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15,
)


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function for ``0 < p < 1``, near double precision."""
    q = p - F.lit(0.5)
    centre = F.lit(0.180625) - q * q
    tail = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    near, far = tail - F.lit(1.6), tail - F.lit(5.0)
    outer = F.when(tail <= 5.0, _polynomial(near, NORMAL_NEAR_TOP) / _polynomial(near, NORMAL_NEAR_BOTTOM)).otherwise(
        _polynomial(far, NORMAL_FAR_TOP) / _polynomial(far, NORMAL_FAR_BOTTOM)
    )
    middle = q * _polynomial(centre, NORMAL_CENTRE_TOP) / _polynomial(centre, NORMAL_CENTRE_BOTTOM)
    return F.when(F.abs(q) <= 0.425, middle).when(q < 0, -outer).otherwise(outer)
