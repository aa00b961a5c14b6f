"""Distances as Spark SQL expressions and Columns (V22).

``distance(a, b, metric)`` is an ordinary expression over two array
columns (``aggregate(zip_with(...))``), evaluated in the JVM; use it in
``select``/``where``/``orderBy`` like any built-in function.
``distance_sql(a, b, metric)`` is the same expression as SQL text, for
``spark.sql`` queries.  The bulk search path uses the NumPy block kernels
instead (``functions.kernels``), which see whole blocks of vectors at
once.  Both compute in double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecspark.model import metric_name

_TERMS = {
    "l2": "(double(x) - double(y)) * (double(x) - double(y))",
    "ip": "double(x) * double(y)",
    "l1": "abs(double(x) - double(y))",
    "linf": "abs(double(x) - double(y))",
}


def distance_sql(a: str, b: str, metric="l2") -> str:
    """SQL text of the distance between array expressions ``a`` and ``b``.

    Arrays of different lengths give NULL (``zip_with`` pads with NULL), so
    validate sizes first (``model.checked_vector``).
    """
    m = metric_name(metric)
    if m == "linf":  # greatest() skips NULL, so the lengths are compared
        return (f"if(size({a}) = size({b}), aggregate(zip_with({a}, {b}, (x, y) -> {_TERMS[m]}), 0D, "
                "(acc, t) -> if(isnull(t), t, greatest(acc, t))), NULL)")
    return f"aggregate(zip_with({a}, {b}, (x, y) -> {_TERMS[m]}), 0D, (acc, t) -> acc + t)"


def distance(a, b, metric="l2") -> Column:
    """Distance of two equal-length vectors as a Column: squared L2, inner product, L1 or L-infinity."""
    m = metric_name(metric)
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    terms = F.zip_with(a, b, lambda x, y: _term(m, x, y))
    if m == "linf":
        largest = F.aggregate(terms, F.lit(0.0), lambda acc, t: F.when(t.isNotNull(), F.greatest(acc, t)))
        return F.when(F.size(a) == F.size(b), largest)
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def _term(m: str, x: Column, y: Column) -> Column:
    dx, dy = x.cast("double"), y.cast("double")
    if m == "l2":
        return (dx - dy) * (dx - dy)
    if m == "ip":
        return dx * dy
    return F.abs(dx - dy)
