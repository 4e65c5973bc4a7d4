"""Scalar helpers: name handling, long-form reshaping, and the tail
probabilities used by drift tests, all as JVM-side Column expressions."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def q(name: str) -> Column:
    """Column reference that tolerates spaces/dots in the name."""
    return F.col(f"`{name}`")


def snake_name(name: str) -> str:
    """PJ1 rule: spaces to underscores, lower case."""
    return name.replace(" ", "_").lower()


def metric_name(name: str) -> str:
    """DR8 rule (driver side): characters outside word, dash, slash, space and
    dot become underscores; then lower case and spaces to underscores."""
    return re.sub(r"[^\w\-/ .]", "_", name).lower().replace(" ", "_")


def metric_name_col(c: Column) -> Column:
    """DR8 as an expression. ``(?U)`` makes Java's ``\\w`` Unicode-aware like Python's."""
    return F.replace(F.lower(F.regexp_replace(c, r"(?U)[^\w\-/ .]", "_")), F.lit(" "), F.lit("_"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def long_form(df: DataFrame, cols: list[str], ids: list[str] | None = None, value_type: str = "string",
              var: str = "column_name", val: str = "value", with_ordinal: bool = False) -> DataFrame:
    """Unpivot ``cols`` into (ids..., column[, ordinal], value). One Expand in
    the same stage as the scan; aggregations after it combine map-side."""
    ids = ids or []
    entries = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias(var)]
        if with_ordinal:
            fields.append(F.lit(i).alias("ordinal"))
        fields.append(q(c).cast(value_type).alias(val))
        entries.append(F.struct(*fields))
    return df.select(*[q(i) for i in ids], F.explode(F.array(*entries)).alias("__kv")).select(*[q(i) for i in ids], "__kv.*")


def as_double(c: Column) -> Column:
    return c.cast("double")


# ---------------------------------------------------------------- tail probabilities

# Coefficients of the Chebyshev-fitted erfc approximation.
_ERFC_COEFS = (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806,
               0.09678418, 0.37409196, 1.00002368, -1.26551223)

def erfc_col(x: Column) -> Column:
    """Complementary error function, fractional error < 1.2e-7 everywhere
    (Chebyshev-fitted exponential form; a public textbook approximation)."""
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(0.17087277)
    for coef in _ERFC_COEFS:
        poly = F.lit(coef) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def erfc_sql(x: str) -> str:
    """The same approximation as ``erfc_col`` as a SQL expression string (for oracles)."""
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = "0.17087277"
    for coef in _ERFC_COEFS:
        poly = f"({coef} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"(case when {x} >= 0 then {ans} else 2.0 - {ans} end)"


def normal_two_sided_p(z: Column) -> Column:
    """P(|Z| >= |z|) for a standard normal Z."""
    return erfc_col(F.abs(z) / F.lit(math.sqrt(2.0)))


def kolmogorov_sf(lam: Column) -> Column:
    """P(K > lambda) of the Kolmogorov distribution. Above 1 the alternating
    series 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2), below it the companion theta
    series 1 - sqrt(2 pi)/lambda sum exp(-(2k-1)^2 pi^2 / (8 lambda^2)); each
    has fallen below double precision after 8 terms on its side."""
    x = F.greatest(lam.cast("double"), F.lit(1e-3))  # the tail is 1 to double precision from 0.1 down
    ks = range(1, 9)
    above = F.lit(0.0)
    below = F.lit(0.0)
    for k in ks:
        above = above + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x)
        below = below + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (x * x))
    p = F.when(x > 1.0, above).otherwise(F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * below)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def ks_asymptotic_p(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sample KS p-value from the Kolmogorov limit distribution with the
    usual small-sample correction of lambda:
    lambda = (sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * D, ne = n1*n2/(n1+n2)."""
    a, b = n1.cast("double"), n2.cast("double")
    ne = (a * b) / (a + b)
    return kolmogorov_sf((F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d)


def log_gamma(a: Column) -> Column:
    """ln Gamma(a) for a > 0: Stirling's series at a + 8, less the logarithm of a (a+1) ... (a+7)."""
    z = a + F.lit(8.0)
    product = a
    for k in range(1, 8):
        product = product * (a + F.lit(float(k)))
    z2 = z * z
    series = (F.lit(1 / 12) - (F.lit(1 / 360) - (F.lit(1 / 1260) - F.lit(1 / 1680) / z2) / z2) / z2) / z
    return (z - F.lit(0.5)) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - F.log(product)


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for any positive number of
    degrees of freedom: the regularised incomplete gamma function, by its power
    series left of a + 1 and its continued fraction (modified Lentz) right of it,
    with the leading factor in log space. Both need on the order of sqrt(a)
    steps near x = a, and the loops take 200 + 12 sqrt(a), which is past
    convergence for every a."""
    a = dof.cast("double") / F.lit(2.0)
    h = x.cast("double") / F.lit(2.0)
    front = F.exp(a * F.log(h) - h - log_gamma(a))
    steps = F.sequence(F.lit(1), (F.lit(200) + F.ceil(F.lit(12.0) * F.sqrt(a))).cast("int"))
    power = F.aggregate(
        steps, F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s")),
        lambda acc, i: F.struct((acc["t"] * h / (a + i)).alias("t"), (acc["s"] + acc["t"] * h / (a + i)).alias("s")))["s"]
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    b0 = h + F.lit(1.0) - a
    d0 = F.lit(1.0) / safe(b0)

    def lentz(acc, i):
        an = -(i.cast("double")) * (i.cast("double") - a)
        b = acc["b"] + F.lit(2.0)
        d = F.lit(1.0) / safe(an * acc["d"] + b)
        c = safe(b + an / acc["c"])
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["v"] * d * c).alias("v"))

    fraction = F.aggregate(steps, F.struct(b0.alias("b"), F.lit(1e300).alias("c"), d0.alias("d"), d0.alias("v")), lentz)["v"]
    q_ = F.when(h < a + F.lit(1.0), F.lit(1.0) - front * power).otherwise(front * fraction)
    return F.when(h <= 0, F.lit(1.0)).when(h == F.lit(float("inf")), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q_)))

