"""Column functions on vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def is_valid(a: Column, dim: int) -> Column:
    """Exactly ``dim`` finite, non-null numbers that are not all zero."""
    finite = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(a) == dim) & finite & F.exists(a, lambda x: x != 0), F.lit(False))


def normalized(a: Column) -> Column:
    """Unit vector; null for a zero vector."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: (x.cast("double") / n).cast("float")))


def is_unit(a: Column, tolerance: float = 1e-5) -> Column:
    """Whether the length is 1 within a tolerance above 0 and of at most 1e-5; null for a null vector."""
    if not 0 < tolerance <= 1e-5:
        raise ValueError("a tolerance lies above 0 and is 1e-5 at most")
    return F.abs(norm(a) - 1) <= tolerance
