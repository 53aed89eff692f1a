"""Fixed schemas of the topics (no inference on streams)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
MAP_SS = T.MapType(S, S)

# Change envelope: {before, after, source{db, table, ts_ms, ...}, op, ts_ms}
ENVELOPE = T.StructType([
    T.StructField("before", MAP_SS),
    T.StructField("after", MAP_SS),
    T.StructField("source", MAP_SS),
    T.StructField("op", S),
    T.StructField("ts_ms", T.LongType()),
])

PAGE_COMMON = T.StructType([T.StructField(n, S) for n in ("ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc")])
PAGE = T.StructType([
    T.StructField("page_id", S), T.StructField("last_page_id", S), T.StructField("item", S),
    T.StructField("item_type", S), T.StructField("during_time", T.LongType()),
])
PAGE_LOG = T.StructType([
    T.StructField("common", PAGE_COMMON), T.StructField("page", PAGE), T.StructField("ts", T.LongType()),
])

DIM_RULE = T.StructType([T.StructField(n, S) for n in
                         ("source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key")])

BASE_DIC = T.StructType([T.StructField("dic_code", S),
                         T.StructField("info", T.StructType([T.StructField("dic_name", S)]))])

BODY_MEASURE = T.StructType([T.StructField(n, S) for n in ("uid", "weight", "height", "unit_weight", "unit_height")])

WEIGHT_LINE = "map<string,map<string,string>>"


def ddl(schema: T.StructType) -> str:
    return schema.simpleString()[len("struct<"):-1]
