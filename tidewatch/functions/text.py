"""Numbers, instants and values as text in the notation the messages use.

The stored messages and hashes write values the way Python prints them, so
these expressions reproduce that notation from Spark columns.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number_text(value: Column) -> Column:
    """A double rounded to six digits: ``2.5``, ``1.0``, ``1e-06``; NULL is ``None``."""
    plain = F.regexp_replace(F.abs(value).try_cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    millionths = F.round(F.least(F.abs(value), F.lit(1.0)) * 1000000).cast("long")
    tens = (millionths / 10).cast("long")
    rest = millionths % 10
    tiny = (F.when(millionths < 10, F.concat(millionths.cast("string"), F.lit("e-06")))
            .when(rest == 0, F.concat(tens.cast("string"), F.lit("e-05")))
            .otherwise(F.concat(tens.cast("string"), F.lit("."), rest.cast("string"), F.lit("e-05"))))
    huge = F.regexp_replace(F.regexp_replace(F.abs(value).cast("string"), r"\.0E", "E"), "E", "e+")
    body = (F.when(F.abs(value) >= 1e16, huge).when((millionths > 0) & (millionths < 100), tiny).otherwise(plain))
    return F.when(value.isNull(), "None").otherwise(F.concat(F.when(value < 0, "-").otherwise(""), body))


def instant_text(value: Column) -> Column:
    """``2024-01-31 00:00:00+00:00``, with microseconds only where there are any."""
    whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(value, ".SSSSSS")
    return F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""), F.lit("+00:00"))


def quoted_text(value: Column) -> Column:
    """A string as a quoted literal; NULL is ``None``."""
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    single, double = F.lit("'"), F.lit('"')
    bare = ~value.contains("'")
    return (F.when(value.isNull(), F.lit("None"))
            .when(bare, F.concat(single, escaped, single))
            .when(~value.contains('"'), F.concat(double, escaped, double))
            .otherwise(F.concat(single, F.replace(escaped, single, F.lit("\\'")), single)))


def instant_literal_text(value: Column) -> Column:
    """An instant as the constructor call that is part of the hashed text."""
    seconds, micros = F.second(value), F.date_format(value, "SSSSSS").cast("int")
    tail = (F.when(micros != 0, F.format_string(", %d, %d", seconds, micros))
            .when(seconds != 0, F.format_string(", %d", seconds)).otherwise(F.lit("")))
    head = F.format_string("datetime.datetime(%d, %d, %d, %d, %d", F.year(value), F.month(value),
                           F.dayofmonth(value), F.hour(value), F.minute(value))
    return F.concat(head, tail, F.lit(", tzinfo=datetime.timezone.utc)"))


def ascii_json(text: Column) -> Column:
    r"""JSON text with non-ASCII characters as ``\uXXXX`` (surrogate pairs above U+FFFF)."""
    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escape(char: Column) -> Column:
        code = F.ascii(char)
        beyond = code - 0x10000
        pair = F.concat(unit(F.lit(0xD800) + F.shiftright(beyond, 10)), unit(F.lit(0xDC00) + beyond.bitwiseAND(0x3FF)))
        return F.when(code < 128, char).when(code < 0x10000, unit(code)).otherwise(pair)

    spelled = F.array_join(F.transform(F.split(text, ""), escape), "")
    return F.when(text.rlike("[^\\x00-\\x7f]"), spelled).otherwise(text)


def percent_encoded(text: Column) -> Column:
    """Percent-encoding that leaves ``:`` and ``,`` as they are."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%3A", ":"), ("%2C", ",")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded
