"""Significance of a regression slope from sums, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the continued fraction; with one parameter of 1/2 it has converged after 60 for any other parameter.
STEPS = 80
# Lanczos coefficients for g = 7.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
            12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x of at least 1/2."""
    y = x - 1.0
    series = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        series = series + F.lit(c) / (y + float(i))
    t = y + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (y + 0.5) * F.ln(t) - t + F.ln(series)


def log_half_beta(a: Column) -> Column:
    """Logarithm of B(a, 1/2). Large a take the series of the ratio of the two gammas, which does not cancel."""
    r = F.lit(1.0) / a
    # ln(Gamma(a) / Gamma(a + 1/2)) = -ln(a) / 2 + 1/(8a) - 1/(192a^3) + 1/(640a^5) - 17/(14336a^7) + ...
    far = F.ln(a) * -0.5 + r / 8 - r * r * r / 192 + F.pow(r, F.lit(5)) / 640 - F.pow(r, F.lit(7)) * (17 / 14336)
    near = log_gamma(a) - log_gamma(a + 0.5)
    return F.lit(0.5 * math.log(math.pi)) + F.when(a > 25, far).otherwise(near)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its last step to its first: a fold over one number."""
    def step(value: Column, k: Column) -> Column:
        m = F.floor(k / 2)
        even = m * (b - m) / ((a + k - 1) * (a + k))
        odd = -(a + m) * (a + b + m) / ((a + k - 1) * (a + k))
        return F.lit(1.0) + F.when(k == 2 * m, even).otherwise(odd) * x / value

    return F.lit(1.0) / F.aggregate(F.lit([float(k) for k in range(STEPS, 0, -1)]), F.lit(1.0), step)


def incomplete_half_beta(a: Column, x: Column, rest: Column) -> Column:
    """The regularised incomplete beta function I_x(a, 1/2); ``rest`` is 1 - x, given apart to keep its digits."""
    a, half = a.cast("double"), F.lit(0.5)
    # A large a needs all digits of an x near 1.
    front = a * F.when(rest < 0.5, F.log1p(-rest)).otherwise(F.ln(x)) + half * F.ln(rest) - log_half_beta(a)
    below = F.exp(front) * _fraction(a, half, x) / a
    above = F.lit(1.0) - F.exp(front) * _fraction(half, a, rest) / half
    return (F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0))
            .when(x < (a + 1) / (a + 2.5), below).otherwise(above))


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for Student's t with ``df`` degrees of freedom, any number of at least 1."""
    df, square = df.cast("double"), (t * t).cast("double")
    return incomplete_half_beta(df / 2, df / (df + square), square / (df + square))


def slope_p_value(n: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Two-sided p of a simple regression's slope; NULL without variation in x or y, or for n < 3."""
    explained = F.try_divide(sxy * sxy, sxx)
    residual = F.greatest(syy - explained, F.lit(0.0))
    # t² / df is explained / residual, so no step divides by the residual.
    whole = explained + residual
    return F.when((n >= 3) & (sxx > 0) & (syy > 0), incomplete_half_beta(
        (n - 2).cast("double") / 2, residual / whole, explained / whole))


def slope_is_significant(n: Column, sxx: Column, syy: Column, sxy: Column,
                         p: float = 0.15) -> Column:
    """Is a simple regression's slope different from zero at two-sided ``p``?

    No variation in x or y, or n < 3, is FALSE.
    """
    return F.coalesce(slope_p_value(n, sxx, syy, sxy) < p, F.lit(False))
