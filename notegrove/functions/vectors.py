"""Vector arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector scaled to length one; a zero vector stays as it is."""
    # The one-element array binds the length, which is then worked out once per vector.
    return F.transform(
        F.array(norm(a)),
        lambda length: F.transform(
            a,
            lambda x: F.when(length > 0, x.cast("double") / length).otherwise(0.0).cast("float"),
        ),
    )[0]


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null when either has no direction."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def certainty(cos: Column) -> Column:
    """Cosine mapped from [-1, 1] to [0, 1]."""
    return (F.lit(1.0) + cos) / F.lit(2.0)
