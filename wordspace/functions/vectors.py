"""Dense-vector and scalar maths as JVM-side column expressions.

Vectors are ``array<double>`` columns; everything below is built from
higher-order functions (``zip_with``, ``aggregate``, ``transform``) so it stays
inside Catalyst and never crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the two sigmoid forms and the loss
SIGMOID_CLIP = 20.0
LOG_EPS = 1e-10
NORM_EPS = 1e-10


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b, dim: int | None = None) -> Column:
    """Sum of products, left to right. With ``dim`` known the sum is unrolled
    into plain arithmetic (whole-stage codegen); otherwise higher-order
    functions handle any length. Both give the same double."""
    if dim is not None:
        a, b = _c(a), _c(b)
        acc = F.lit(0.0)
        for i in range(dim):
            acc = acc + a[i] * b[i]
        return acc
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a, dim: int | None = None) -> Column:
    if dim is not None:
        return F.sqrt(dot(a, a, dim))
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def scale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x * s)


def normalize(a, guard: str = "add", dim: int | None = None) -> Column:
    """Row normalisation; ``guard='add'`` divides by norm+eps (variant A),
    ``guard='max'`` by max(norm, eps) (variant B)."""
    n = norm(a, dim)
    denom = n + F.lit(NORM_EPS) if guard == "add" else F.greatest(n, F.lit(NORM_EPS))
    if dim is not None:
        return F.array(*[_c(a)[i] / denom for i in range(dim)])
    return F.transform(_c(a), lambda x: x / denom)


def sigmoid_clipped(x) -> Column:
    """1 / (1 + exp(-clip(x, -20, 20)))."""
    xc = F.greatest(F.lit(-SIGMOID_CLIP), F.least(F.lit(SIGMOID_CLIP), _c(x)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-xc))


def sigmoid_branched(x) -> Column:
    """Sign-branched sigmoid without clipping."""
    x = _c(x)
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-x))).otherwise(F.exp(x) / (F.lit(1.0) + F.exp(x)))


def sigmoid(x, form: str = "clip") -> Column:
    return sigmoid_clipped(x) if form == "clip" else sigmoid_branched(x)


def neg_log(p) -> Column:
    """-ln(p + 1e-10): one loss term."""
    return -F.log(_c(p) + F.lit(LOG_EPS))


def lr_relative(step, total, lr0: float, floor_ratio: float = 1e-4) -> Column:
    """max(lr0 * (1 - step / max(total, 1)), lr0 * floor_ratio) (variant A)."""
    total = F.greatest(_c(total).cast("double"), F.lit(1.0))
    return F.greatest(F.lit(lr0) * (F.lit(1.0) - _c(step) / total), F.lit(lr0 * floor_ratio))


def lr_absolute(step, total, lr0: float, lr_min: float = 1e-4) -> Column:
    """max(lr_min, lr0 * (1 - step / total)) (variant B)."""
    return F.greatest(F.lit(lr_min), F.lit(lr0) * (F.lit(1.0) - _c(step) / _c(total).cast("double")))
