"""Upper tail of the F distribution, for the handful of rows that an analysis of variance ends in."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def f_upper_tail(statistic: Column, between_df: Column, within_df: Column) -> Column:
    """P(F > statistic). Evaluates the tail itself, so tiny p-values do not cancel to zero.

    With x = d2 / (d2 + d1 F) it is the regularised incomplete beta function I_x(d2/2, d1/2). Where d2 is very large that
    is the upper tail of a gamma distribution but for a relative error below 1e-11 (the leading term of its expansion
    in 1 / d2); elsewhere a continued fraction is used. NULL where that does not settle.
    """
    import math

    import pandas as pd

    def settled(terms, limit: int) -> float | None:
        # Modified Lentz evaluation of 1 / (1 + t1 / (1 + t2 / (1 + ...))), inverted; terms come in pairs (a, b).
        floor = 1e-300
        value = c = None
        d = 0.0
        for step, (a, b) in enumerate(terms):
            if value is None:
                value = c = b if abs(b) > floor else floor
                continue
            d = b + a * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = b + a / c
            c = c if abs(c) > floor else floor
            value *= c * d
            if abs(c * d - 1.0) < 1e-15 and step > 1:
                return value
            if step >= limit:
                break
        return None

    def beta_terms(x: float, a: float, b: float):
        yield 0.0, 1.0
        yield -(a + b) * x / (a + 1.0), 1.0
        m = 1
        while True:
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            m += 1

    def gamma_terms(s: float, u: float):
        yield 0.0, u + 1.0 - s
        i = 1
        while True:
            yield -i * (i - s), u + 2 * i + 1.0 - s
            i += 1

    def stirling_rest(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)

    def log_gamma_step(a: float, b: float) -> float:
        """lgamma(a + b) - lgamma(a) without the loss of digits that large a brings."""
        if a < 100.0:
            return math.lgamma(a + b) - math.lgamma(a)
        return b * math.log(a) + (a + b - 0.5) * math.log1p(b / a) - b + stirling_rest(a + b) - stirling_rest(a)

    def beta_share(x: float, y: float, a: float, b: float) -> float | None:
        # I_x(a, b) with y = 1 - x, evaluated on the side where the fraction settles quickly.
        large, small = max(a, b), min(a, b)
        log_x = math.log1p(-y) if y < 0.5 else math.log(x)
        log_y = math.log1p(-x) if x < 0.5 else math.log(y)
        front = math.exp(log_gamma_step(large, small) - math.lgamma(small) + a * log_x + b * log_y)
        if x < (a + 1.0) / (a + b + 2.0):
            fraction = settled(beta_terms(x, a, b), 200_000)
            return None if fraction is None else front / (fraction * a)
        fraction = settled(beta_terms(y, b, a), 200_000)
        return None if fraction is None else 1.0 - front / (fraction * b)

    def gamma_tail(s: float, u: float) -> float | None:
        """Regularised upper incomplete gamma function."""
        if u <= 0.0:
            return 1.0
        front = math.exp(s * math.log(u) - u - math.lgamma(s))
        if u > s + 1.0:
            fraction = settled(gamma_terms(s, u), 200_000)
            return None if fraction is None else front / fraction
        term = total = 1.0 / s
        k = s
        while term > total * 1e-17:
            k += 1.0
            term *= u / k
            total += term
        return 1.0 - front * total

    def tail(f: float, d1: float, d2: float) -> float | None:
        if any(v is None or math.isnan(v) for v in (f, d1, d2)):
            return None
        if math.isinf(f):
            return 0.0
        if f <= 0.0:
            return 1.0
        a, b, part = d2 / 2.0, d1 / 2.0, d1 * f / d2
        if a > 1e5 * (1.0 + b) ** 1.5:
            centre = a + (b - 1.0) / 2.0
            return gamma_tail(b, centre * math.log1p(part))
        return beta_share(1.0 / (1.0 + part), part / (1.0 + part), a, b)

    @F.pandas_udf("double")
    def upper_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return pd.Series([tail(*row) for row in zip(f, d1, d2)], dtype="float64")

    return upper_tail(statistic.cast("double"), between_df.cast("double"), within_df.cast("double"))
