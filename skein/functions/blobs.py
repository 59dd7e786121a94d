"""Binary columns of fixed-width numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOP = 1 << 63


def longs(blob: Column) -> Column:
    """The signed 64-bit numbers, low byte first, of a blob; an error unless its size is a multiple of eight."""
    n = F.octet_length(blob)
    one = lambda i: F.conv(F.concat(*(F.hex(F.substr(blob, i * 8 + k, F.lit(1))) for k in range(8, 0, -1))), 16, 10).cast("decimal(20,0)")
    signed = F.transform(F.sequence(F.lit(0), (n / 8).cast("int") - 1), lambda i: F.when(one(i) >= F.lit(str(TOP)).cast("decimal(20,0)"), one(i) - F.lit(str(2 * TOP)).cast("decimal(20,0)")).otherwise(one(i)).cast("long"))
    return F.when(n % 8 != 0, F.raise_error(F.lit("a blob of longs has a size that is no multiple of 8")).cast("array<long>")).when(n == 0, F.array().cast("array<long>")).otherwise(signed)


def blob(values: Column) -> Column:
    """An array of signed 64-bit numbers as a blob, low byte first."""
    hexed = F.transform(values, lambda x: F.lpad(F.hex(x.cast("long")), 16, "0"))
    turned = F.transform(hexed, lambda h: F.concat(*(F.substr(h, F.lit(k), F.lit(2)) for k in range(15, 0, -2))))
    return F.unhex(F.array_join(turned, ""))
