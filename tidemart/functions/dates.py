"""Date and time functions.

All conversions are written so that they do not depend on the session time
zone: epoch values become ``TIMESTAMP_NTZ`` wall-clock times in an explicit
zone via ``convert_timezone``. The jobs default to ``Asia/Shanghai`` (the
source system parses with a fixed +08:00 offset); the driver queries pass
``UTC`` so that DuckDB agrees.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions._col import as_col

__all__ = [
    "DEFAULT_TZ", "EPOCH_NTZ", "local_from_epoch_ms", "epoch_ms_of_local", "epoch_ms_of_ntz",
    "datetime_text_to_ms", "date_text_to_ms", "ms_to_date", "ms_to_datetime", "ms_to_partition_day",
    "format_date", "event_time_from_ms", "age_on", "date_of_epoch_day", "decade_of", "star_sign",
    "STAR_SIGN_RANGES", "day_bucket_of",
]

DEFAULT_TZ = "Asia/Shanghai"


def EPOCH_NTZ() -> Column:  # noqa: N802 - a constant built lazily (needs a session)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def is_utc(tz: str) -> bool:
    return tz.upper() in ("UTC", "Z", "+00:00")


def local_from_epoch_ms(ms, tz: str = DEFAULT_TZ) -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in ``tz``."""
    utc = F.timestamp_add("MILLISECOND", as_col(ms).cast("bigint"), EPOCH_NTZ())
    return utc if is_utc(tz) else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_ms_of_local(ts, tz: str = DEFAULT_TZ) -> Column:
    """Wall-clock TIMESTAMP_NTZ in ``tz`` -> epoch milliseconds."""
    c = as_col(ts).cast("timestamp_ntz")
    utc = c if is_utc(tz) else F.convert_timezone(F.lit(tz), F.lit("UTC"), c)
    return F.timestamp_diff("MILLISECOND", EPOCH_NTZ(), utc)


def epoch_ms_of_ntz(ts) -> Column:
    """A UTC TIMESTAMP_NTZ column (the given tables) -> epoch milliseconds."""
    return epoch_ms_of_local(ts, "UTC")


def datetime_text_to_ms(text, offset: str = "+08:00") -> Column:
    """S1 ``dateTimeToTs``: 'yyyy-MM-dd HH:mm:ss' read at a fixed offset -> epoch ms."""
    parsed = F.try_to_timestamp(F.concat(as_col(text), F.lit(" " + offset)), F.lit("yyyy-MM-dd HH:mm:ss XXX"))
    return F.unix_millis(parsed)


def date_text_to_ms(text, offset: str = "+08:00") -> Column:
    """S2 ``dateToTs``: 'yyyy-MM-dd' at 00:00 of a fixed offset -> epoch ms."""
    return datetime_text_to_ms(F.concat(as_col(text), F.lit(" 00:00:00")), offset)


def ms_to_date(ms, tz: str = DEFAULT_TZ) -> Column:
    """S3/S7 ``tsToDate``: epoch ms -> 'yyyy-MM-dd' (integer ms, no float division)."""
    return F.date_format(local_from_epoch_ms(ms, tz), "yyyy-MM-dd")


def ms_to_datetime(ms, tz: str = DEFAULT_TZ) -> Column:
    """S4 ``tsToDateTime``: epoch ms -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(local_from_epoch_ms(ms, tz), "yyyy-MM-dd HH:mm:ss")


def ms_to_partition_day(ms, tz: str = DEFAULT_TZ) -> Column:
    """S5 ``tsToDateForPartition``: epoch ms -> 'yyyyMMdd'."""
    return F.date_format(local_from_epoch_ms(ms, tz), "yyyyMMdd")


def format_date(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """S6 ``format(date[, pattern])``."""
    return F.date_format(as_col(ts), pattern)


def event_time_from_ms(ms) -> Column:
    """S8 ``to_timestamp_ltz(ms, 3)``: an instant usable by ``withWatermark``."""
    return F.timestamp_millis(as_col(ms).cast("bigint"))


def age_on(birth, asof) -> Column:
    """S9 whole years between ``birth`` and ``asof`` (java.time Period semantics).

    ``asof`` is an argument (a date column or 'yyyy-MM-dd' text) so that results are stable.
    """
    b = as_col(birth).cast("date")
    a = F.lit(asof).cast("date") if isinstance(asof, str) else as_col(asof).cast("date")
    before_birthday = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(a) - F.year(b) - F.when(before_birthday, 1).otherwise(0)).cast("int")


def date_of_epoch_day(days) -> Column:
    """S10 epoch day -> DATE."""
    return F.date_from_unix_date(as_col(days).cast("int"))


def decade_of(d) -> Column:
    """S11 decade: 1983 -> 1980."""
    y = F.year(as_col(d).cast("date"))
    return (y - F.pmod(y, F.lit(10))).cast("int")


# ---- fixed values (must equal the source system's) -------------------------
# Star signs with their inclusive (start month, start day, end month, end day):
STAR_SIGN_RANGES = [
    ("白羊座", 3, 21, 4, 19),
    ("金牛座", 4, 20, 5, 20),
    ("双子座", 5, 21, 6, 21),
    ("巨蟹座", 6, 22, 7, 22),
    ("狮子座", 7, 23, 8, 22),
    ("处女座", 8, 23, 9, 22),
    ("天秤座", 9, 23, 10, 23),
    ("天蝎座", 10, 24, 11, 22),
    ("射手座", 11, 23, 12, 21),
    ("摩羯座", 12, 22, 1, 19),
    ("水瓶座", 1, 20, 2, 18),
    ("双鱼座", 2, 19, 3, 20),
]
UNKNOWN_SIGN = "未知"
# -----------------------------------------------------------------------------


def star_sign(d) -> Column:
    """S12 star sign of a date: a month/day range table as one CASE expression."""
    c = as_col(d).cast("date")
    m, day = F.month(c), F.dayofmonth(c)
    expr = None
    for name, m1, d1, m2, d2 in STAR_SIGN_RANGES:
        cond = ((m == m1) & (day >= d1)) | ((m == m2) & (day <= d2))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(UNKNOWN_SIGN)


def day_bucket_of(epoch, tz: str = DEFAULT_TZ, error_bucket: str = "error_bucket") -> Column:
    """S35 file-sink bucket: values < 1e10 are seconds, else ms -> 'yyyyMMdd'; null or no number -> error bucket."""
    v = as_col(epoch).try_cast("bigint")
    ms = F.when(v < F.lit(10_000_000_000), v * 1000).otherwise(v)
    return F.coalesce(ms_to_partition_day(ms, tz), F.lit(error_bucket))
