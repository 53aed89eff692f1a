"""Skew: one key holds a third of the rows. The split lag and the bucketed interval join must
spread that key over several shuffle partitions (and still give the exact answer)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators.joins import interval_join
from tidemart.operators.stateful import keyed_lag


@pytest.fixture()
def no_aqe(spark):
    """Static shuffle joins, as for tables far above any broadcast limit."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def skewed(spark, n=30_000):
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
    return spark.range(n).select(k.alias("k"), F.col("id").alias("seq"), (F.col("id") * 7 % 101).alias("v"))


def hot_share(df, key_col="k", keep=("prev_v",)):
    """Largest share of the hot key's rows in one task (``keep`` stops the operator being pruned)."""
    rows = df.where(F.col(key_col) == 0).select(F.spark_partition_id().alias("pid"), *keep).collect()
    per = Counter(r.pid for r in rows)
    return max(per.values()) / sum(per.values())


def test_split_lag_spreads_hot_key(spark, no_aqe):
    df = skewed(spark)
    plain = keyed_lag(df, "k", ["seq"], ["v"])
    split = keyed_lag(df, "k", ["seq"], ["v"], range_width=500)
    assert hot_share(plain) == 1.0                 # the whole hot key in one task
    assert hot_share(split) < 0.35                 # spread over the 8 shuffle partitions
    assert {(r.seq, r.prev_v) for r in plain.collect()} == {(r.seq, r.prev_v) for r in split.collect()}


def test_bucketed_interval_join_spreads_hot_key(spark, no_aqe):
    day = 86_400_000
    left = skewed(spark, 6_000).select(F.col("k").alias("lk"), F.col("seq").alias("ls"), (F.col("seq") * 3_600_000).alias("lt"))
    right = skewed(spark, 6_000).select(F.col("k").alias("rk"), F.col("seq").alias("rs"), (F.col("seq") * 3_600_000 + 1).alias("rt"))
    plain = interval_join(left, right, "lk", "rk", "lt", "rt", -2 * day, 2 * day)
    bucketed = interval_join(left, right, "lk", "rk", "lt", "rt", -2 * day, 2 * day, bucket_ms=2 * day)
    assert hot_share(plain, "lk", ("rs",)) == 1.0
    assert hot_share(bucketed, "lk", ("rs",)) < 0.35
    assert sorted((r.ls, r.rs) for r in plain.collect()) == sorted((r.ls, r.rs) for r in bucketed.collect())


def test_grid_interval_join_spreads_a_hot_key_of_one_bucket(spark, no_aqe):
    """50 days either way on 20 days of data: every pair of a user, all in one or two buckets, dealt over a grid."""
    day = 86_400_000
    left = skewed(spark, 3_000).select(F.col("k").alias("lk"), F.col("seq").alias("ls"), (F.col("seq") * 600_000).alias("lt"))
    right = skewed(spark, 3_000).select(F.col("k").alias("rk"), F.col("seq").alias("rs"), (F.col("seq") * 600_000 + 1).alias("rt"))
    args = (left, right, "lk", "rk", "lt", "rt", -50 * day, 50 * day)
    wide = interval_join(*args, bucket_ms=50 * day)
    grid = interval_join(*args, bucket_ms=50 * day, cell_rows=100)
    assert hot_share(wide, "lk", ("rs",)) > 0.9
    assert hot_share(grid, "lk", ("rs",)) < 0.35
    assert grid.count() == wide.count() and grid.distinct().count() == grid.count()
    assert grid.columns == wide.columns == [*left.columns, *right.columns]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=25),
       st.integers(1, 20), st.integers(1, 30))
def test_interval_join_matches_brute_force(spark, lefts, rights, width, bucket):
    """Bounds inclusive on both ends, negative times, any bucket size: every pair exactly once."""
    lo, hi = -width, width
    ldf = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(lefts)], "lk long, lt long, li long")
    rdf = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rights)], "rk long, rt long, ri long")
    want = sorted((i, j) for i, (k1, t1) in enumerate(lefts) for j, (k2, t2) in enumerate(rights)
                  if k1 == k2 and t1 + lo <= t2 <= t1 + hi)
    for b, cell in ((None, None), (bucket, None), (bucket, 3)):
        got = sorted((r.li, r.ri) for r in interval_join(ldf, rdf, "lk", "rk", "lt", "rt", lo, hi, bucket_ms=b, cell_rows=cell).collect())
        assert got == want
