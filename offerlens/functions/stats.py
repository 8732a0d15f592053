"""Distribution functions as column expressions: survival functions of the F
and chi-square distributions, from the incomplete beta and gamma functions.

Continued fractions and series are folds over a sequence of steps; a step
after convergence changes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients (g = 7, nine terms).
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]
STEPS = 1000
TINY = 1e-300
STIRLING_ABOVE = 1e4


def lgamma(x: Column) -> Column:
    """ln of the gamma function for x >= 0.5."""
    z = x - 1
    s = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        s = s + F.lit(c) / (z + i)
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(s)


def _ln_gamma_ratio(q: Column, p: Column) -> Column:
    """lgamma(q + p) - lgamma(q); for large q without their cancellation."""
    r = q + p
    far = (r - 0.5) * F.log1p(p / q) + p * F.ln(q) - p + (1 / r - 1 / q) / 12 - (1 / F.pow(r, 3) - 1 / F.pow(q, 3)) / 360
    return F.when(q > STIRLING_ABOVE, far).otherwise(lgamma(r) - lgamma(q))


def _away(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _fold(start: dict[str, Column], step) -> Column:
    """Fold ``step(state, i) -> dict`` over 1..STEPS until ``done``."""
    zero = F.struct(*[v.cast("double").alias(k) for k, v in start.items()], F.lit(False).alias("done"))

    def go(s: Column, i: Column) -> Column:
        new, done = step(s, i.cast("double"))
        return F.when(s["done"], s).otherwise(F.struct(*[v.alias(k) for k, v in new.items()], done.alias("done")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zero, go)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function (Lentz)."""
    d0 = 1 / _away(1 - (a + b) * x / (a + 1))

    def step(s, m):
        m2 = 2 * m
        aa = m * (b - m) * x / ((a - 1 + m2) * (a + m2))
        d1, c1 = 1 / _away(1 + aa * s["d"]), _away(1 + aa / s["c"])
        bb = -(a + m) * (a + b + m) * x / ((a + m2) * (a + 1 + m2))
        d2, c2 = 1 / _away(1 + bb * d1), _away(1 + bb / c1)
        return {"c": c2, "d": d2, "h": s["h"] * d1 * c1 * d2 * c2}, F.abs(d2 * c2 - 1) < 1e-15

    return _fold({"c": F.lit(1.0), "d": d0, "h": d0}, step)["h"]


def betainc(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Regularized incomplete beta function I_x(a, b); ``y`` is 1 - x."""
    small, large = F.least(a, b), F.greatest(a, b)
    ln_x = F.when(y < 0.5, F.log1p(-y)).otherwise(F.ln(x))
    ln_y = F.when(x < 0.5, F.log1p(-x)).otherwise(F.ln(y))
    front = F.exp(a * ln_x + b * ln_y + _ln_gamma_ratio(large, small) - lgamma(small))
    near = x < (a + 1) / (a + b + 2)
    fraction = _beta_fraction(F.when(near, a).otherwise(b), F.when(near, b).otherwise(a), F.when(near, x).otherwise(y))
    value = F.when(near, front * fraction / a).otherwise(1 - front * fraction / b)
    return F.when(x <= 0, F.lit(0.0)).when(y <= 0, F.lit(1.0)).otherwise(value)


def gammaincc(a: Column, x: Column) -> Column:
    """Regularized upper incomplete gamma function Q(a, x)."""
    front = F.exp(-x + a * F.ln(x) - lgamma(a))

    def term(s, i):
        t = s["t"] * x / (a + i)
        return {"t": t, "s": s["s"] + t}, F.abs(t) < F.abs(s["s"]) * 1e-16

    series = _fold({"t": 1 / a, "s": 1 / a}, term)["s"]
    b0 = x + 1 - a

    def step(s, i):
        an, b = -i * (i - a), b0 + 2 * i
        d, c = 1 / _away(an * s["d"] + b), _away(b + an / s["c"])
        return {"c": c, "d": d, "h": s["h"] * d * c}, F.abs(d * c - 1) < 1e-15

    fraction = _fold({"c": F.lit(1 / TINY), "d": 1 / _away(b0), "h": 1 / _away(b0)}, step)["h"]
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, 1 - front * series).otherwise(front * fraction)


def f_survival(f: Column, d1: Column, d2: Column) -> Column:
    """P(F > f) with (d1, d2) degrees of freedom; NULL where undefined."""
    f, d1, d2 = f.cast("double"), d1.cast("double"), d2.cast("double")
    whole = d2 + d1 * f
    ok = f.isNotNull() & (f >= 0) & (d1 > 0) & (d2 > 0)
    return F.when(ok, betainc(d2 / 2, d1 / 2, d2 / whole, d1 * f / whole))


def chi2_survival(x: Column, dof: Column) -> Column:
    """P(X > x) with ``dof`` degrees of freedom; NULL where undefined."""
    x, k = x.cast("double"), dof.cast("double")
    return F.when(x.isNotNull() & (k > 0), gammaincc(k / 2, x / 2))
