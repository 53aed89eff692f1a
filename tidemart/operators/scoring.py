"""Tag records and weighted age-bracket inference (SCO1-SCO3, JON13, SRC9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import DEFAULT_TZ, age_on, date_of_epoch_day, decade_of, local_from_epoch_ms, star_sign
from tidemart.functions.tags import (AGE_BRACKETS, FACTOR_RATES, WEIGHTS, category1_group, price_level,
                                     time_type_of_hour)

__all__ = ["weight_table", "read_weight_file", "Weights", "prepare_weights", "attach_weights", "weight_columns",
           "infer_age", "base_tags",
           "FACTOR_ORDER"]

# order in which the weighted terms are added (the source's expression order)
FACTOR_ORDER = ["category", "brand", "time", "price", "device", "keyword"]


def weight_table(spark: SparkSession, weights: dict | None = None) -> DataFrame:
    """The fixed weight dictionaries as rows ``(factor, category, w array<double>, pos)``."""
    rows = [(factor, cat, [float(x) for x in ws], 0) for factor, cats in (weights or WEIGHTS).items()
            for cat, ws in cats.items()]
    return spark.createDataFrame(rows, "factor string, category string, w array<double>, pos bigint")


def read_weight_file(spark: SparkSession, path: str, factor: str) -> DataFrame:
    """SRC9: JSON lines ``{category: {bracket: weight}}`` -> ``(factor, category, w, pos)``.

    Weights may be JSON strings or numbers; they are read as text then cast. A
    missing bracket is 0 (D10). ``pos`` is the order in the file: of a category
    listed twice the last entry counts. An empty file is an error (D19), raised when the weights are read.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("pos"))
    parsed = lines.where(F.length(F.trim("value")) > 0).select("pos", F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("category", "m"))
    out = parsed.select(F.lit(factor).alias("factor"), "category",
                        F.array(*[F.coalesce((F.col("m")[b]).try_cast("double"), F.lit(0.0)) for b in AGE_BRACKETS])
                        .alias("w"), "pos")
    # a row of the factor whose other columns raise: a filter on the factor does not prune it
    error = F.raise_error(F.lit(f"weight file {path} is empty"))
    empty = parsed.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit(factor).alias("factor"), *[error.cast(out.schema[c].dataType).alias(c) for c in ("category", "w", "pos")])
    return out.unionByName(empty)


def prepare_weights(weights: DataFrame) -> DataFrame:
    """Weight rows pivoted to six columns; of a (factor, category) listed twice the last entry (by ``pos``) stays."""
    order = F.col("pos") if "pos" in weights.columns else F.lit(0)
    last = weights.groupBy("factor", "category").agg(F.max_by("w", order).alias("w"))
    return last.select("factor", F.col("category").alias("_k"),
                       *[F.col("w")[i].alias(f"_w{i}") for i in range(len(AGE_BRACKETS))])


def attach_weights(df: DataFrame, weights: DataFrame, factor: str, category_col: str,
                   fallback: str | None = None, out: str | None = None) -> DataFrame:
    """JON13/SCO1: add the bracket weights of ``category_col`` as six DOUBLE columns
    ``<out>_0 .. <out>_5`` (bracket order), from a table of :func:`prepare_weights`.

    The weight arrays are columns on the small side, so the big side only does primitive arithmetic. Categories that
    the table lacks (and null) take the ``fallback`` row through a second left join, or zeros without one (D10, D11).
    """
    out = out or f"{factor}_w"
    n = range(len(AGE_BRACKETS))
    rows = (prepare_weights(weights) if "w" in weights.columns else weights).where(F.col("factor") == factor)
    res = df.join(rows.drop("factor"), F.col(category_col) == F.col("_k"), "left")
    if fallback is None:
        return res.select(*df.columns, *[F.coalesce(F.col(f"_w{i}"), F.lit(0.0)).alias(f"{out}_{i}") for i in n])
    other = rows.select(F.col("_k").alias("_fk"), *[F.col(f"_w{i}").alias(f"_f{i}") for i in n])
    key = F.when(F.col("_k").isNull(), F.lit(fallback))
    res = res.withColumn("_miss", key).join(other, F.col("_miss") == F.col("_fk"), "left")
    return res.select(*df.columns, *[
        F.when(F.col("_k").isNotNull(), F.coalesce(F.col(f"_w{i}"), F.lit(0.0)))
        .otherwise(F.coalesce(F.col(f"_f{i}"), F.lit(0.0))).alias(f"{out}_{i}") for i in n])


def weight_columns(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}_{i}") for i in range(len(AGE_BRACKETS))]


def infer_age(weight_cols: dict[str, str], rates: dict | None = None) -> Column:
    """SCO2: for each bracket, sum weight x rate over the factors; the bracket of the maximum
    (first wins). ``weight_cols`` maps a factor to the prefix of its six weight columns.
    Missing weights count as 0 (D10)."""
    rates = rates or FACTOR_RATES
    sums = []
    for i in range(len(AGE_BRACKETS)):
        total = None
        for factor in FACTOR_ORDER:
            term = F.coalesce(F.col(f"{weight_cols[factor]}_{i}"), F.lit(0.0)) * F.lit(rates[factor])
            total = term if total is None else total + term
        sums.append(total)
    arr = F.array(*sums, F.lit(0.0))
    brackets = F.array(*[F.lit(b) for b in AGE_BRACKETS], F.lit(AGE_BRACKETS[0]))
    return F.element_at(brackets, F.array_position(arr, F.array_max(arr)).cast("int"))


def base_tags(df: DataFrame, birthday_day_col: str, create_ms_col: str, amount_col: str,
              category1_col: str | None, asof: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """SCO3: birthday, age (as of ``asof``), star sign, decade, time type, price level, category group."""
    bday = date_of_epoch_day(F.col(birthday_day_col))
    hour = F.hour(local_from_epoch_ms(F.col(create_ms_col), tz))
    cols = [F.date_format(bday, "yyyy-MM-dd").alias("birthday"), age_on(bday, asof).alias("age"),
            star_sign(bday).alias("star_sign"), decade_of(bday).alias("decade"),
            time_type_of_hour(hour).alias("time_type"), price_level(F.col(amount_col)).alias("price_level")]
    if category1_col:
        cols.append(category1_group(F.col(category1_col)).alias("c1_name"))
    return df.select("*", *cols)
