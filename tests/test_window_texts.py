"""Window texts made by arithmetic, against Spark's formatter; the key of a batch's window aggregate."""

import pytest
from pyspark.sql import functions as F

from tidemart.functions.dates import local_from_epoch_ms
from tidemart.operators.windows import window_aggregate, with_window_cols

MS = [0, -1, -1000, 999, 951_782_399_000, 951_782_400_000, 1_735_689_599_999, -62_135_596_800_000, -62_167_219_200_000,
      -62_198_755_200_000, -30_610_224_000_000, -30_610_224_000_001, 253_402_300_799_999, 253_402_300_800_000,
      300_000_000_000_000, -2_208_988_800_001, 1_600_000_005_500]


@pytest.mark.parametrize("tz", ["UTC", "Asia/Shanghai", "America/New_York"])
@pytest.mark.parametrize("ltz", [False, True])
def test_window_texts_equal_the_formatter(spark, tz, ltz):
    df = spark.createDataFrame([(m,) for m in MS], "ms long")
    at = F.timestamp_millis("ms") if ltz else local_from_epoch_ms("ms", "UTC")
    size = "90 minutes"
    windows = df.select("ms", F.window(at, size).alias("window"))
    as_ms = lambda c: F.unix_millis(c) if ltz else F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    text = lambda side, form: F.date_format(local_from_epoch_ms(as_ms(F.col(f"window.{side}")), tz), form)
    want = {r.ms: tuple(r)[1:] for r in windows.select("ms", text("start", "yyyy-MM-dd HH:mm:ss"), text(
        "end", "yyyy-MM-dd HH:mm:ss"), text("start", "yyyy-MM-dd")).collect()}
    got = with_window_cols(windows, "window", tz)
    assert got.columns == ["ms", "stt", "edt", "cur_date"]
    assert {r.ms: (r.stt, r.edt, r.cur_date) for r in got.collect()} == want
    many = window_aggregate(df.select("ms", at.alias("at")), "at", size, ["ms"], [F.count(F.lit(1)).alias("n")], tz)
    assert many.columns == ["ms", "n", "stt", "edt", "cur_date"]
    assert {r.ms: (r.stt, r.edt, r.cur_date) for r in many.collect()} == want


def test_batch_windows_are_grouped_by_their_start(spark):
    df = spark.createDataFrame([(0, "a"), (9_999, "a"), (10_000, "a"), (None, "a"), (5, None)], "ms long, k string")
    out = window_aggregate(df.select(local_from_epoch_ms("ms", "UTC").alias("at"), "k"), "at", "10 seconds", ["k"],
                           [F.count(F.lit(1)).alias("n")], "UTC")
    assert sorted(map(tuple, out.select("stt", "edt", "k", "n").collect()), key=str) == sorted([
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", "a", 2), ("1970-01-01 00:00:10", "1970-01-01 00:00:20", "a", 1),
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", None, 1)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "named_struct" not in plan  # start and end as a struct took four times the bytes in every group and shuffled row
