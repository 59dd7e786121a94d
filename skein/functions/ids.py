"""Identifiers as column expressions: name-based UUIDs, content digests, padded path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of name-based UUIDs.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(text: Column) -> Column:
    """The version-5 UUID of a text in the URL namespace, canonical form; null for null."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(text, "utf-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3) + 8).cast("long")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def float_text(x: Column) -> Column:
    """A double as Python writes it: 1.0, 12345678.5, 0.00012, 1e+16, 1.5e-05.

    The digits are the fewest that read back as the same number; there is an exponent from 1e16 on and below 0.0001.
    """
    x = x.cast("double")
    tried = [F.format_string(f"%.{n}e", x) for n in (14, 15, 16)]
    written = F.when(tried[0].cast("double") == x, tried[0]).when(tried[1].cast("double") == x, tried[1]).otherwise(tried[2])
    part = lambda i: F.regexp_extract(written, r"^(-?)(\d)\.(\d*?)0*e([+-]\d+)$", i)
    sign, digits, power = part(1), F.concat(part(2), part(3)), part(4).cast("int")
    n = F.length(digits)
    whole = F.when(power + 1 >= n, F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0"))).otherwise(F.concat(F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    tail = F.when(n > 1, F.concat(F.lit("."), part(3))).otherwise(F.lit(""))
    size = F.abs(power).cast("string")
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(size, F.greatest(F.lit(2), F.length(size)), "0"))
    laid = F.when((power >= 0) & (power < 16), whole).when((power < 0) & (power >= -4), small).otherwise(F.concat(part(2), tail, F.lit("e"), exponent))
    odd = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
    return F.when(x.isNotNull(), F.coalesce(odd, F.concat(sign, laid)))


def clip_uuid(session: Column, start: Column, end: Column) -> Column:
    """The id of a clip: session and both ends, ends as float text."""
    return uuid5(F.concat_ws("_", session, float_text(start), float_text(end)))


def image_id(session: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the session id."""
    return F.substring(F.sha2(session, 256), 1, 16)


def part_path(part: Column) -> Column:
    return F.concat(F.lit("part_"), F.lpad(part.cast("string"), 6, "0"))


def tar_path(tar: Column) -> Column:
    return F.concat(F.lpad(tar.cast("string"), 6, "0"), F.lit(".tar"))


def part_number(path: Column) -> Column:
    """The number in a part folder's name; null where there is none."""
    return F.nullif(F.regexp_extract(path, r"part_(\d+)", 1), F.lit("")).cast("int")
