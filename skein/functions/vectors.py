"""Vector arithmetic on arrays of numbers, in double precision and without UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def unit(v: Column) -> Column:
    """The vector over its length, which counts as 1e-12 at least."""
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(FLOOR))
    return let(norm, lambda n: F.transform(v, lambda x: x.cast("double") / n))


def clipped_cosine(a: Column, b: Column) -> Column:
    """Dot product of unit vectors, held to [-1, 1] against rounding."""
    return F.least(F.greatest(dot(a, b), F.lit(-1.0)), F.lit(1.0))


def assert_one_length(df: DataFrame, column: str) -> None:
    """Error if the vectors of a column differ in length."""
    r = df.agg(F.min(F.size(column)).alias("lo"), F.max(F.size(column)).alias("hi")).first()
    if r.lo != r.hi:
        raise ValueError(f"{column} has vectors of {r.lo} to {r.hi} numbers")
