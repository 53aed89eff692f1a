"""JSON parsing with quarantine (PRJ1-PRJ4), page routing (PRJ5), rows to JSON text (PRJ16).

Each record is parsed once into a VARIANT (``try_parse_json``); the typed
struct is read from it with ``try_variant_get``, which is null for text that
is not a JSON *object* (arrays, scalars). No Python in the path, and exactly
one parse per record (see the note in :func:`parse_json_records`). The session
setting for repeated keys in VARIANT objects is switched on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.schemas import ddl

__all__ = ["parse_json_records", "split_parsed", "route_pages", "rows_to_json"]

MODES = ("split", "drop", "null", "fail")


def parse_json_records(df: DataFrame, schema: T.StructType, value_col: str = "value",
                       mode: str = "split", out: str = "data") -> DataFrame:
    """Parse ``value_col`` into ``out`` (a struct of ``schema``) and flag ``is_valid``.

    Modes: ``split`` keeps every row with ``is_valid`` (use :func:`split_parsed`);
    ``drop`` keeps valid rows (PRJ2); ``null`` keeps all rows, ``out`` null when
    invalid (PRJ3); ``fail`` raises on the first invalid row (PRJ4).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    # an object may repeat a key, the last value counts (as in the source's parser); read when the plan is made
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.btrim(F.col(value_col).cast("string"), F.lit(" \t\r\n"))
    # the parser stops after the object, so text that goes on after it must be refused by its end
    typed = F.when(text.endswith("}"), F.try_variant_get(F.try_parse_json(text), "$", f"struct<{ddl(schema)}>"))
    # A one-element generator is an evaluation barrier: the optimizer would otherwise copy the
    # parse into every pushed-down filter and every field reference, parsing each record many times.
    parsed = df.select("*", F.explode(F.array(typed)).alias(out)).withColumn("is_valid", F.col(out).isNotNull())
    if mode == "drop":
        return parsed.where("is_valid").drop("is_valid")
    if mode == "fail":
        checked = F.when(F.col("is_valid"), F.col(out)).otherwise(
            F.raise_error(F.concat(F.lit("unparsable record: "), F.col(value_col).cast("string"))))
        return parsed.withColumn(out, checked).drop("is_valid")
    return parsed


def split_parsed(parsed: DataFrame, value_col: str = "value", out: str = "data") -> tuple[DataFrame, DataFrame]:
    """PRJ1: (valid rows with the struct, invalid raw rows for the dirty topic).

    Persist ``parsed`` (or write both in one ``foreachBatch``) when both sides are consumed.
    """
    good = parsed.where("is_valid").drop("is_valid")
    bad = parsed.where(~F.col("is_valid")).select(value_col)
    return good, bad


def route_pages(logs: DataFrame, page_col: str = "page") -> DataFrame:
    """PRJ5: records that carry a page object (an empty object counts)."""
    return logs.where(F.col(page_col).isNotNull())


def rows_to_json(df: DataFrame, keep_nulls: bool = False, out: str = "value") -> DataFrame:
    """PRJ16: one JSON text per row; null fields left out unless ``keep_nulls``."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(F.to_json(F.struct(*df.columns), opts).alias(out))
