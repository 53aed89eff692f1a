"""Streaming jobs: the source system's job graph wired on Structured Streaming.

Each job is a function that builds the streaming DataFrame(s) and, when given
output folders, starts the queries with their own checkpoint folders (which
must be on shared storage on a cluster). Stateful steps use
``transformWithState`` with the RocksDB state store; window aggregates use
watermarks; dimension lookups are stream-static joins.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import DEFAULT_TZ, ms_to_date
from tidemart.operators.joins import EnrichSpec, enrich
from tidemart.operators.parse import parse_json_records, route_pages, split_parsed
from tidemart.operators.routing import apply_sink_columns, latest_rules, route_by_rules
from tidemart.operators.windows import with_window_cols
from tidemart.schemas import DIM_RULE, ENVELOPE, PAGE_LOG
from tidemart.streaming.processors import (STATE_PROVIDER, HoldForRules, LastPerProcessingWindow, NewVisitorFix,
                                           PairDedupe, RetractDedupe, RunningProfile)
from tidemart.streaming.sinks import dim_batch_writer

__all__ = ["enable_state_store", "with_state", "log_cleaning_streams", "retract_stream",
           "province_window_stream", "route_cdc_batch", "route_cdc_stream", "routed_batch_writer", "pair_dedupe_stream",
           "last_per_processing_window", "running_profile_stream"]


def enable_state_store(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def with_state(df: DataFrame, key: Sequence[str] | str, processor, out_schema: T.StructType | str,
               time_mode: str = "None") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).transformWithState(processor, out_schema, "Append", time_mode)


def log_cleaning_streams(text: DataFrame, tz: str = DEFAULT_TZ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """DWD log job: (dirty records, records with ``is_new`` repaired (STA1), page records (PRJ5)).

    Start the dirty branch and the repaired branch as two queries from the same
    source, each with its own checkpoint; the page branch is a filter of the
    repaired one (write both from one ``foreachBatch``).
    """
    parsed = parse_json_records(text, PAGE_LOG, "value", mode="split")
    # a record without a usable time has no place in its device's history: it goes to the dirty side
    parsed = parsed.withColumn("is_valid", F.col("is_valid") & F.col("data.ts").isNotNull())
    good, bad = split_parsed(parsed)
    flat = good.select(F.col("data.common.mid").alias("mid"), F.col("data.common.is_new").alias("is_new"),
                       F.col("data.ts").alias("ts"), F.to_date(ms_to_date(F.col("data.ts"), tz)).alias("visit_date"),
                       F.col("data.page").alias("page"), "value")
    schema = T.StructType([f for f in flat.schema.fields])
    fixed = with_state(flat, "mid", NewVisitorFix(["ts", "value"], "visit_date", "is_new"), schema)
    return bad, fixed, route_pages(fixed)


def retract_stream(details: DataFrame, key: str, order: Sequence[str], amounts: Sequence[str],
                   ttl_ms: int | None = None) -> DataFrame:
    """STA4/STA5 on a stream: previous record negated, then the new one (state per id)."""
    schema = T.StructType(details.schema.fields + [T.StructField("sign", T.IntegerType())])
    mode = "ProcessingTime" if ttl_ms else "None"
    return with_state(details, key, RetractDedupe(order, amounts, details.schema, ttl_ms), schema, mode)


def province_window_stream(details: DataFrame, provinces: DataFrame, window: str = "10 seconds",
                           delay: str = "10 seconds", tz: str = DEFAULT_TZ) -> DataFrame:
    """STA4 -> AGG4 -> JON8 on a stream of details ``(id, order_id, province_id, split_total_amount, ts_ms)``.

    The distinct order count is exact and bounded per state row: a first
    windowed aggregate per (window, province, order) feeds a second per
    (window, province) (chained stateful aggregation in append mode), instead
    of collecting a set of order ids per window. An order counts where its
    signs sum to more than zero: one whose lines were all retracted, because
    they moved to another province or window, is gone from the old one.
    """
    signed = retract_stream(details, "id", ["ts_ms"], ["split_total_amount"])
    timed = signed.withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", delay)
    per_order = (timed.groupBy(F.window("et", window).alias("window"), "province_id", "order_id")
                 .agg(F.sum("split_total_amount").alias("amount"), F.sum("sign").alias("lines")).where("lines > 0"))
    per_prov = (per_order.groupBy("window", "province_id")
                .agg(F.sum("amount").alias("order_amount"), F.count(F.lit(1)).alias("order_count")))
    decorated = with_window_cols(per_prov, "window", tz)
    return enrich(decorated, EnrichSpec(provinces, "province_id", "id", {"name": "province_name"},
                                        how="left"))


def route_cdc_batch(batch: DataFrame, rules_path: str, dims_out: str, facts_out: str, batch_id: int) -> None:
    """DIM router micro-batch (PRJ6, PRJ7, STA9, SNK5): take the latest rules, split the batch into dimension rows and
    fact rows, merge the dimension rows cell by cell into ``dims_out/<sink_table>`` keyed by the rule's
    ``sink_row_key``, and write the facts; all of it gives the same result when the batch is replayed.

    With no rules the batch raises, so its offsets are not committed and the
    rows are processed again later instead of being lost (D7). The rules are
    the job's configuration: a few rows, one per source table.
    """
    spark = batch.sparkSession
    rule_schema = T.StructType([*DIM_RULE.fields, T.StructField("op", T.StringType()),
                                T.StructField("ts_ms", T.LongType())])
    rules = latest_rules(spark.read.schema(rule_schema).json(rules_path), order=["ts_ms"])
    sinks = {r.sink_table: r for r in rules.collect()}
    if not sinks:
        raise RuntimeError("no dimension rules yet; batch will be retried")
    env = parse_json_records(batch, ENVELOPE, "value", mode="drop").select("data.*").persist()
    try:
        dims, facts = route_by_rules(env, rules)
        image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        keyed = dims.withColumn("row_key", F.try_element_at(image, F.col("sink_row_key"))).where("row_key is not null")
        keyed = apply_sink_columns(keyed)
        for table, rule in sinks.items():
            cells = [c.strip() for c in rule.sink_columns.split(",")]
            rows = keyed.where(F.col("sink_table") == table).select(
                "row_key", "op", "ts_ms", *[F.try_element_at("after", F.lit(c)).alias(c) for c in cells])
            dim_batch_writer(f"{dims_out.rstrip('/')}/{table}", "row_key", ["ts_ms"], cells)(rows, batch_id)
        facts.write.mode("overwrite").json(f"{facts_out.rstrip('/')}/batch_id={batch_id}")
    finally:
        env.unpersist()


ROUTED = ("pos bigint, source_table string, value string, sink_table string, sink_family string, "
          "sink_columns string, sink_row_key string")


def route_cdc_stream(envelopes: DataFrame, rule_changes: DataFrame, slots: int = 32, wait_ms: int = 5000) -> DataFrame:
    """PRJ6/STA9 on streams: every change of the feed with the rule that holds at its position (``ROUTED``; ``value`` is
    the envelope as JSON, ``sink_table`` is null for facts).

    ``envelopes`` has the envelope's columns, ``rule_changes`` the rule's with ``op`` and ``ts_ms``; positions are
    ``ts_ms``. The feed is dealt over ``slots`` by table and record id, so the changes of a record stay in order and a hot
    table spreads; the rules, one per source table, are copied to every slot and folded change by change in its state.
    Rows that come before any rule wait in the state and leave in order once rules are there. A replayed micro-batch
    starts from the state of the batch before it and gives the same rows.
    """
    rid = F.coalesce(F.col("after")["id"], F.col("before")["id"])
    feed = envelopes.select(
        F.pmod(F.xxhash64(F.col("source")["table"], rid), F.lit(slots)).cast("int").alias("slot"), F.lit(False).alias("is_rule"),
        F.coalesce("ts_ms", F.lit(0)).cast("bigint").alias("pos"), "op", F.col("source")["table"].alias("source_table"),
        F.to_json(F.struct(*[f.name for f in ENVELOPE.fields])).alias("value"),
        *[F.lit(None).cast("string").alias(c) for c in HoldForRules.RULE])
    rules = rule_changes.select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.lit(True).alias("is_rule"),
        F.coalesce("ts_ms", F.lit(0)).cast("bigint").alias("pos"), "op", "source_table", F.lit(None).cast("string").alias("value"),
        *HoldForRules.RULE)
    return with_state(feed.unionByName(rules), "slot", HoldForRules(wait_ms), ROUTED, "ProcessingTime")


def routed_batch_writer(dims_out: str, facts_out: str):
    """SNK5 for :func:`route_cdc_stream`: merge a micro-batch's dimension rows cell by cell into
    ``dims_out/<sink_table>`` keyed by the rule's ``sink_row_key``, write the facts to ``facts_out/batch_id=N``.

    The driver sees the sink tables of the batch, a few names. A replayed batch replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        env = batch.withColumn("env", F.from_json("value", ENVELOPE)).select("*", "env.*").persist()
        try:
            env.where("sink_table is null and after is not null").select(*ENVELOPE.names).write.mode("overwrite").json(
                f"{facts_out.rstrip('/')}/batch_id={batch_id}")
            image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
            keyed = env.where("sink_table is not null").withColumn(
                "row_key", F.try_element_at(image, F.col("sink_row_key"))).where("row_key is not null")
            sinks: dict[str, list[str]] = {}
            for r in keyed.select("sink_table", "sink_columns").distinct().collect():
                cells = sinks.setdefault(r.sink_table, [])
                cells += [c for c in (x.strip() for x in r.sink_columns.split(",")) if c not in cells]
            for name, cells in sinks.items():
                wanted = F.split(F.regexp_replace("sink_columns", r"\s", ""), ",")
                rows = keyed.where(F.col("sink_table") == name).select("row_key", "op", "ts_ms", *[
                    F.when(F.array_contains(wanted, c), F.try_element_at("after", F.lit(c))).alias(c) for c in sorted(cells)])
                dim_batch_writer(f"{dims_out.rstrip('/')}/{name}", "row_key", ["ts_ms"], sorted(cells))(rows, batch_id)
        finally:
            env.unpersist()

    return write


def order_detail_wide_stream(details: DataFrame, headers: DataFrame, activities: DataFrame, coupons: DataFrame,
                             bound: str = "10 seconds", delay: str = "5 seconds") -> DataFrame:
    """JON1/JON2 on streams: detail ⋈ header (inner), ⟕ activity, ⟕ coupon, each side watermarked
    on ``et`` and matched within ``bound`` of the detail's time, so join state is bounded.

    Inputs carry ``id``/``order_id``/``et`` (details), ``id``/``et`` (headers),
    ``order_detail_id``/``et`` (activity, coupon). Unmatched left rows are
    emitted once the watermark passes the bound (Spark outer stream-stream join).
    """
    d = details.withWatermark("et", delay).alias("d")
    h = headers.withWatermark("et", delay).alias("h")
    a = activities.withWatermark("et", delay).alias("a")
    c = coupons.withWatermark("et", delay).alias("c")
    within = lambda x: (F.col(f"{x}.et") >= F.col("d.et") - F.expr(f"INTERVAL {bound}")) & \
        (F.col(f"{x}.et") <= F.col("d.et") + F.expr(f"INTERVAL {bound}"))
    j = d.join(h, (F.col("d.order_id") == F.col("h.id")) & within("h"), "inner")
    j = j.join(a, (F.col("d.id") == F.col("a.order_detail_id")) & within("a"), "leftOuter")
    return j.join(c, (F.col("d.id") == F.col("c.order_detail_id")) & within("c"), "leftOuter")


def exact_dedupe_stream(df: DataFrame, cols: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """STA7 on a stream: drop repeats of the listed columns seen within the watermark delay."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(cols))


def first_per_key_stream(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """STA6 on a stream: the first record per key, ever (one "seen" flag per key)."""
    from tidemart.streaming.processors import FirstPerDay

    return with_state(df, key, FirstPerDay(order), df.schema)


def page_view_window_stream(pages: DataFrame, window: str = "10 seconds", delay: str = "5 seconds",
                            tz: str = DEFAULT_TZ) -> DataFrame:
    """STA2 -> AGG2 on a stream of flat page rows ``(mid, ts, visit_date, last_page_id, during_time,
    ar, ch, vc, is_new)``: per-device flags in keyed state, then watermarked window sums."""
    from tidemart.streaming.processors import VisitFlags

    schema = T.StructType(pages.schema.fields + [T.StructField(n, T.LongType()) for n in ("uv_ct", "sv_ct", "pv_ct")])
    flagged = with_state(pages, "mid", VisitFlags(["ts"], "visit_date", "last_page_id"), schema)
    timed = flagged.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", delay)
    agg = timed.groupBy(F.window("et", window).alias("window"), "ar", "ch", "vc", "is_new").agg(
        F.sum("during_time").alias("dur_sum"), F.sum("pv_ct").alias("pv_ct"), F.sum("uv_ct").alias("uv_ct"),
        F.sum("sv_ct").alias("sv_ct"))
    return with_window_cols(agg, "window", tz)


def cart_uu_window_stream(adds: DataFrame, window: str = "10 seconds", delay: str = "5 seconds",
                          tz: str = DEFAULT_TZ, ttl_ms: int | None = 2 * 86_400_000) -> DataFrame:
    """STA3 -> AGG1 on a stream of cart adds ``(user_id, ts, add_date)``: first add per user and day
    (one flag per (user, day) in state, forgotten ``ttl_ms`` after it was set), then a watermarked count per window."""
    from tidemart.streaming.processors import FirstPerDay

    firsts = with_state(adds, ["user_id", "add_date"], FirstPerDay(["ts"], ttl_ms), adds.schema,
                        "ProcessingTime" if ttl_ms else "None")
    timed = firsts.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", delay)
    agg = timed.groupBy(F.window("et", window).alias("window")).agg(F.count(F.lit(1)).alias("cart_add_uu_ct"))
    return with_window_cols(agg, "window", tz)


def sku_window_stream(details: DataFrame, skus: DataFrame, window: str = "5 seconds", delay: str = "5 seconds",
                      ttl_ms: int | None = 10_000, tz: str = DEFAULT_TZ) -> DataFrame:
    """STA5 -> AGG3 -> JON7 on a stream of details ``(id, sku_id, ts_ms, <4 amounts>)``: retraction
    with a processing-time TTL on the id memory, windowed amount sums per SKU, SKU names joined onto
    the window rows (stream-static join; Spark chooses the strategy from the dimension's size)."""
    amounts = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
    signed = retract_stream(details, "id", ["ts_ms"], amounts, ttl_ms)
    timed = signed.withColumn("et", F.timestamp_millis("ts_ms")).withWatermark("et", delay)
    agg = timed.groupBy(F.window("et", window).alias("window"), "sku_id").agg(*[F.sum(a).alias(a) for a in amounts])
    named = enrich(with_window_cols(agg, "window", tz), EnrichSpec(skus, "sku_id", "id", {"sku_name": "sku_name"},
                                                                   how="left"))
    return named


def keyword_window_stream(pages: DataFrame, dictionary: Sequence[str], window: str = "10 seconds",
                          tz: str = DEFAULT_TZ) -> DataFrame:
    """PRJ14 -> UDF2 -> AGG5 on a parsed page-log stream (``page`` struct, ``ts`` ms): search-keyword
    rows, split into words, counted per window with a zero-delay watermark (TIM2)."""
    from tidemart.functions.tokenize import tokenize_cjk
    from tidemart.operators.logs import search_keywords

    timed = pages.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")
    words = search_keywords(timed, "et").select("et", F.explode(tokenize_cjk(F.col("full_word"), list(dictionary)))
                                                .alias("keyword"))
    agg = words.groupBy(F.window("et", window).alias("window"), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
    return with_window_cols(agg, "window", tz)


def pair_dedupe_stream(df: DataFrame, a: str, b: str, order: Sequence[str], ttl_ms: int | None = None,
                       slots: int = 200) -> DataFrame:
    """STA8 on a stream, exact: the first record of each pair ``(a, b)``. State is keyed by the pair inside ``slots`` hash
    slots, so a hot value of ``a`` or ``b`` spreads; with ``ttl_ms`` a pair may come again that long after it was seen."""
    dealt = df.withColumn("_slot", F.pmod(F.xxhash64(a, b), F.lit(slots)).cast("int"))
    out = with_state(dealt, "_slot", PairDedupe(order, a, b, ttl_ms), dealt.schema, "ProcessingTime" if ttl_ms else "None")
    return out.drop("_slot")


def running_profile_stream(df: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], sep: str = ",") -> DataFrame:
    """AGG7 on a stream: every row with its key's running ``page_count`` and distinct ``<field>_set`` so far."""
    schema = T.StructType([*df.schema.fields, T.StructField("page_count", T.LongType()),
                           *[T.StructField(f"{f}_set", T.StringType()) for f in fields]])
    return with_state(df, key, RunningProfile(order, fields, sep), schema)


def last_per_processing_window(df: DataFrame, key: str, size: str = "2 minutes", order: Sequence[str] = ("ts",),
                               tz: str = DEFAULT_TZ) -> DataFrame:
    """AGG6 on a stream: the newest record per key in each tumbling *processing-time* window, with ``stt``, ``edt`` and
    ``cur_date``. A timer closes the window at its end, without waiting for more input."""
    schema = T.StructType([*df.schema.fields, T.StructField("window_start", T.LongType()), T.StructField("window_end", T.LongType())])
    size_ms = int(pd.Timedelta(size) / pd.Timedelta(milliseconds=1))
    out = with_state(df, key, LastPerProcessingWindow(order, size_ms, df.schema), schema, "ProcessingTime")
    window = F.struct(F.timestamp_millis("window_start").alias("start"), F.timestamp_millis("window_end").alias("end"))
    return with_window_cols(out.withColumn("window", window).drop("window_start", "window_end"), "window", tz)


def age_inference_stream(order_tags: DataFrame, keyword_tags: DataFrame, bound_ms: int = 50 * 86_400_000,
                         delay: str = "5 seconds") -> DataFrame:
    """JON12 + SCO2 on streams: order tags ``(user_id, ts, <category/brand/time/price>_w_0..5)`` and
    keyword tags ``(user_id, ts, <keyword/device>_w_0..5)``, both watermarked (D14), joined per user
    within ±``bound_ms``, each pair scored into an age bracket."""
    from tidemart.operators.joins import interval_join
    from tidemart.operators.scoring import FACTOR_ORDER, infer_age

    lw = order_tags.withColumn("_let", F.timestamp_millis("ts")).withWatermark("_let", delay)
    rw = keyword_tags.withColumn("_ret", F.timestamp_millis("ts")).withWatermark("_ret", delay)
    left = lw.select(F.col("user_id").alias("l_user"), F.col("ts").alias("l_t"), "_let",
                     *[c for c in order_tags.columns if c not in ("user_id", "ts")])
    right = rw.select(F.col("user_id").alias("r_user"), F.col("ts").alias("r_t"), "_ret",
                      *[c for c in keyword_tags.columns if c not in ("user_id", "ts")])
    bound = F.expr(f"INTERVAL {bound_ms // 1000} SECONDS")
    cond = (left["l_user"] == right["r_user"]) & (right["_ret"] >= left["_let"] - bound) & \
        (right["_ret"] <= left["_let"] + bound)
    j = left.join(right, cond, "inner")
    return j.select(F.col("l_user").alias("user_id"), "l_t", "r_t",
                    infer_age({f: f"{f}_w" for f in FACTOR_ORDER}).alias("inferred_age"))
