"""Text of key and value pairs for the line-oriented sink."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.functions._columns import ColumnOrName, column


def plain_number(c: ColumnOrName) -> Column:
    """A double in plain decimal notation with its shortest digits.

    A cast to string turns 12345678.5 into ``1.23456785E7``; here it stays
    ``12345678.5``, at every magnitude.
    """
    text = column(c).cast("string")
    sign = F.regexp_extract(text, r"^-?", 0)
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.", "")
    # The point stands behind the first digit and moves by the exponent.
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    padded = F.rpad(digits, F.greatest(F.length(digits), power + 2), "0")
    large = F.concat(
        F.substring(padded, F.lit(1), power + 1), F.lit("."), F.substring(padded, power + 2, F.length(padded))
    )
    moved = F.concat(sign, F.when(power < 0, small).otherwise(large))
    plain = F.regexp_replace(moved, r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def pair_text(key: ColumnOrName, value: ColumnOrName, key_is_text: bool = False) -> Column:
    """``(key, value)`` on one line; a null reads ``None``.

    A textual key is quoted, with a backslash before quotes and backslashes in it.
    """
    key, value = column(key), column(value)
    safe = F.regexp_replace(key.cast("string"), r"([\\'])", r"\\$1")
    shown = F.concat(F.lit("'"), safe, F.lit("'")) if key_is_text else key.cast("string")
    none = F.lit("None")
    return F.concat(
        F.lit("("), F.coalesce(shown, none), F.lit(", "), F.coalesce(plain_number(value), none), F.lit(")")
    )
