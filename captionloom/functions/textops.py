"""Scalar text functions with the rules of Python's str where Spark's own differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space (all of Unicode's) at either end; trim() takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"(?U)^\s*(\S+)", 1)


def spaced(c: Column) -> Column:
    """Underscores as spaces."""
    return F.translate(c, "_", " ")


def title(c: Column) -> Column:
    """Every letter after a non-letter is upper case and all others lower (initcap() looks at spaces only)."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    step = lambda a, x: F.struct(F.concat(a["out"], F.when(a["inside"], F.lower(x)).otherwise(F.upper(x))).alias("out"), x.rlike(r"^\p{L}$").alias("inside"))
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(False).alias("inside")), step, lambda a: a["out"])


def fixed(c: Column, digits: int) -> Column:
    """Fixed decimals, ties to even as in Python; a tie is judged on the shortest decimal form of the number."""
    return F.format_string(f"%.{digits}f", F.bround(c.cast("decimal(28,10)"), digits).cast("double"))


def percent(c: Column, digits: int = 1) -> Column:
    return F.concat(fixed(c.cast("decimal(24,10)") * 100, digits), F.lit("%"))


def bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def base64_plain(content: Column) -> Column:
    """base64 on one line, whatever spark.sql.chunkBase64String.enabled says."""
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")


def python_list(items: Column) -> Column:
    return F.array_join(items, ", ")


def ordered_path(path: Column) -> Column:
    """A sort key: paths compare part by part."""
    return F.split(path, "/")


def python_number(c: Column) -> Column:
    """A whole or decimal double as Python writes it: 1.0, 0.5, 1e-05, 1e+16."""
    plain = c.cast("string")
    sci = F.regexp_extract(plain, r"^(-?)(\d)\.(\d+)E(-?)(\d+)$", 0) != ""
    mantissa = F.regexp_replace(F.regexp_extract(plain, r"^(-?\d\.\d+)E", 1), r"\.0$", "")
    power = F.regexp_extract(plain, r"E(-?\d+)$", 1)
    size = F.lpad(F.regexp_replace(power, "-", ""), 2, "0")
    exponent = F.concat(F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+")), F.when(F.length(F.regexp_replace(power, "-", "")) > 2, F.regexp_replace(power, "-", "")).otherwise(size))
    small = F.abs(c) < 1e-4
    large = F.abs(c) >= 1e16
    digits = F.regexp_replace(F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"0+$", ""), r"\.$", ".0")
    return F.when(c.isNull(), None).when(F.isnan(c), "nan").when(sci & (small | large) & (c != 0), F.concat(mantissa, F.lit("e"), exponent)).when(sci, digits).otherwise(plain)
