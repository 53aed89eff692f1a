"""Hex payload and day-range helpers."""

from __future__ import annotations

import re
import sys

from decimal import Context, Decimal

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions._col import as_col

# Python workers run this module's UDF/processor code: ship it by value so that executors
# need no installed copy of the package (they may not have it on their path).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["day_partition_range", "hex_words", "append_to_json_list", "hex_or_decimal_text", "WEI_PER_UNIT"]

WEI_PER_UNIT = 10 ** 18


def day_partition_range(start, end) -> Column:
    """S31 inclusive list of yyyymmdd integers between two dates (empty when start > end)."""
    s, e = as_col(start).cast("date"), as_col(end).cast("date")
    days = F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(F.array().cast("array<date>"))
    return F.transform(days, lambda d: (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int"))


def hex_words(data) -> Column:
    """S32 ``data2List``: 64-char words after the leading '0x', each prefixed with '0x'.

    Only whole words are returned; empty or null input gives an empty list.
    """
    d = as_col(data)
    n = F.floor((F.coalesce(F.length(d), F.lit(0)) - 2) / 64).cast("int")
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.concat(F.lit("0x"), F.substring(d, i * 64 + 3, 64)))


def append_to_json_list(json_list, element) -> Column:
    """S33 ``operateHashList``: parse a JSON string list, append, render as '[a, b]'.

    A null or blank list counts as empty; a stored list that does not parse gives null, so that it is not
    silently replaced.
    """
    stored = as_col(json_list)
    blank = F.coalesce(F.trim(stored) == "", F.lit(True))
    parsed = F.try_variant_get(F.try_parse_json(stored), "$", "array<string>")
    arr = F.when(blank, F.array().cast("array<string>")).otherwise(parsed)
    return F.concat(F.lit("["), F.array_join(F.array_append(arr, as_col(element)), ", "), F.lit("]"))


_HEX = re.compile("0x[0-9a-fA-F]+")
_DECIMAL = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,4})?", re.ASCII)


def _plain(x: Decimal) -> str:
    return format(x, "f")


def _convert_one(value, divide: bool) -> str | None:
    if value is None:
        return "0"
    text = str(value)
    if _HEX.fullmatch(text):
        num = Decimal(int(text[2:], 16))
    elif _DECIMAL.fullmatch(text):
        num = Decimal(text)
    else:
        return None  # not a number: null instead of failing the task
    if not divide:
        return _plain(num)
    _, digits, exponent = num.as_tuple()
    preferred = max(-exponent, 0)
    exact = Context(prec=len(digits) + abs(exponent) + 40)  # dividing by a power of ten adds 18 places: never rounds
    q = exact.divide(num, Decimal(WEI_PER_UNIT)).normalize(exact)
    if -q.as_tuple().exponent < preferred:
        q = q.quantize(Decimal(1).scaleb(-preferred), context=exact)
    return _plain(q)


@F.pandas_udf(T.StringType())
def _hex_to_text_div(s: pd.Series) -> pd.Series:
    return s.map(lambda v: _convert_one(v, True))


@F.pandas_udf(T.StringType())
def _hex_to_text(s: pd.Series) -> pd.Series:
    return s.map(lambda v: _convert_one(v, False))


def hex_or_decimal_text(value, divide: bool = False) -> Column:
    """S34 ``binaryConvert``: '0x..' hex or decimal text -> exact decimal text, optionally / 1e18.

    Null gives '0'; text that is no number gives null. Up to 31 hex digits without division are two JVM ``conv``
    halves in DECIMAL(38, 0); only wider or other values cross to a pandas UDF (a null is passed for all the rest).
    """
    c = as_col(value).cast("string")
    if not divide:
        digits = F.substring(c, 3, 40)
        plain_hex = F.coalesce(c.rlike("^0x[0-9a-fA-F]{1,31}$"), F.lit(False))
        n = F.length(digits)
        low = F.conv(F.substring(digits, F.greatest(n - 14, F.lit(1)), F.lit(15)), 16, 10).cast("decimal(38,0)")
        high = F.coalesce(F.conv(F.when(n > 15, F.substring(digits, F.lit(1), n - 15)), 16, 10).cast("decimal(38,0)"),
                          F.lit(0).cast("decimal(38,0)"))
        whole = (high * F.lit(16 ** 15).cast("decimal(19,0)") + low).cast("decimal(38,0)").cast("string")
        other = F.when(~plain_hex & c.isNotNull(), c)
        return F.when(c.isNull(), F.lit("0")).when(plain_hex, whole).otherwise(
            F.when(other.isNotNull(), _hex_to_text(other)))
    return _hex_to_text_div(c)
