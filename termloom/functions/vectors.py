"""Vector functions over array columns; sums run in double precision in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """The vector at length 1; zero stays zero."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if one of them is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def argmax(v: Column) -> Column:
    """The place of the first largest number, from 0."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def padded(v: Column, length: int, fill: int = 0) -> Column:
    """Cut or filled to a length."""
    kept = F.slice(v, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(fill).cast("long"), F.lit(length) - F.size(kept)))


def attention_mask(v: Column) -> Column:
    """1 where a padded sequence holds a token."""
    return F.transform(v, lambda x: (x > 0).cast("int"))
