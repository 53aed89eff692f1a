"""Page-log projections: search keywords (PRJ14) and the log normaliser (PRJ15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.tags import first_word

__all__ = ["search_keywords", "normalize_logs", "DROPPED_COMMON"]

DROPPED_COMMON = ("ar", "is_new", "sid")


def search_keywords(logs: DataFrame, time_col: str = "et") -> DataFrame:
    """PRJ14: rows whose last page is the search page and whose item is a keyword."""
    return logs.where((F.col("page.last_page_id") == "search") & F.col("page.item").isNotNull()
                      & (F.col("page.item_type") == "keyword")) \
        .select(F.col("page.item").alias("full_word"), F.col(time_col))


def normalize_logs(logs: DataFrame, default_keyword: str = "", info_col: str = "log_common_info",
                   keep=()) -> DataFrame:
    """PRJ15: keep rows with a non-empty ``common`` and ``page``; os = first word; uid or '-1';
    ``common`` minus ar/is_new/sid; ``keyword`` = searched item or the default; ``has_keyword`` flag.

    ``logs`` has ``common`` (struct or map), ``page`` (struct) and ``ts``. The
    default keyword is an argument (the two source jobs use '' and '性价比'). ``keep``
    names extra columns to carry through (e.g. a record key). With a struct
    ``common`` the info column is a struct without the dropped fields (null
    fields are left out when written as JSON) and everything stays inside
    whole-stage codegen; a map ``common`` is filtered with ``map_filter``.
    """
    page_fields = [f.name for f in logs.schema["page"].dataType.fields]
    page_nonempty = F.coalesce(*[F.col(f"page.{f}").isNotNull() for f in page_fields]) if len(page_fields) == 1 \
        else F.greatest(*[F.col(f"page.{f}").isNotNull() for f in page_fields])
    if dict(logs.dtypes)["common"].startswith("struct"):
        fields = [f.name for f in logs.schema["common"].dataType.fields]
        common_nonempty = F.greatest(*[F.col(f"common.{f}").isNotNull() for f in fields])
        get = lambda name: F.col(f"common.{name}")
        info = F.struct(*[F.col(f"common.{f}").alias(f) for f in fields if f not in DROPPED_COMMON])
    else:
        common_nonempty = F.size(F.map_filter("common", lambda k, v: v.isNotNull())) > 0
        get = lambda name: F.col("common")[name]
        info = F.map_filter("common", lambda k, v: v.isNotNull() & ~k.isin(*DROPPED_COMMON))
    kept = logs.where(F.col("common").isNotNull() & common_nonempty & F.col("page").isNotNull() & page_nonempty)
    uid = get("uid")
    is_kw = F.coalesce(F.col("page.item_type") == "keyword", F.lit(False))
    return kept.select(
        *keep,
        first_word(get("os")).alias("os"),
        F.col("ts").cast("string").alias("ts"),
        F.when(uid.isNull() | (uid == ""), F.lit("-1")).otherwise(uid).alias("uid"),
        info.alias(info_col),
        F.when(is_kw, F.col("page.item")).otherwise(F.lit(default_keyword)).alias("keyword"),
        is_kw.alias("has_keyword"))
