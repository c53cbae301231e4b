"""Dense-vector expressions over ``array<float|double>`` columns (O-64, O-65).

Higher-order functions keep the arithmetic inside the JVM; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Inner product in double precision; null if either is null. Vectors of unequal
    size are an error, not a shorter product."""
    x, y = _c(a), _c(b)
    prods = F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))
    total = F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, u: acc + u)
    return F.when(x.isNull() | y.isNull(), F.lit(None).cast("double")).when(
        F.size(x) == F.size(y), total).otherwise(
        F.raise_error(F.lit("vectors of unequal size")).cast("double"))


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a) -> Column:
    """Divide by the L2 norm; a zero vector is returned unchanged (as doubles).

    The squared norm is accumulated once and handed to the finish lambda, so
    it is not re-evaluated per element (lambdas are outside CSE).
    """
    arr = _c(a)
    return F.aggregate(
        arr, F.lit(0.0).cast("double"),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda acc: F.transform(arr, lambda x: F.when(acc == 0, x.cast("double"))
                                .otherwise(x.cast("double") / F.sqrt(acc))))
