"""Stream sources (SRC2-SRC7): Kafka topics or JSON-line files, value-only text, watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.parse import parse_json_records
from tidemart.operators.windows import event_time_coalesce

__all__ = ["kafka_options", "read_kafka", "read_text_stream", "read_with_watermark", "register_json_topic"]


def kafka_options(servers: str, topic: str, group: str | None = None, offset: str = "earliest",
                  discovery_ms: int = 10_000, extra: dict | None = None) -> dict[str, str]:
    """SRC2/SRC3 reader options (group defaults to topic + '1'; 10 s partition discovery;
    lost offsets fail the query instead of giving an incomplete result)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offset,
            "kafka.group.id": group or f"{topic}1", "kafka.metadata.max.age.ms": str(discovery_ms),
            "failOnDataLoss": "true"}
    opts.update({k if k.startswith("kafka.") or k in ("maxOffsetsPerTrigger", "minPartitions", "failOnDataLoss") else f"kafka.{k}": v
                 for k, v in (extra or {}).items()})
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """SRC2: value-only UTF-8 text of a topic (key ignored)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topic, **kw).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of ``value`` text (the tests' stand-in for a topic)."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def read_with_watermark(text: DataFrame, schema: T.StructType, delay: str = "3 seconds",
                        time_fields: tuple[str, str] = ("ts_ms", "ts")) -> DataFrame:
    """SRC4/TIM3: parse records, time = ``ts_ms`` else ``ts`` else 0 (ms), bounded-delay watermark on ``et``."""
    extra = [T.StructField(f, T.LongType()) for f in time_fields if f not in schema.names]  # one parse for both
    parsed = parse_json_records(text, T.StructType([*schema.fields, *extra]), "value", mode="null")
    t = event_time_coalesce(*[F.col("data").getField(f) for f in time_fields])
    data = F.when(F.col("data").isNotNull(), F.struct(*[F.col("data").getField(n).alias(n) for n in schema.names]))
    return parsed.select("value", data.alias("data"), F.timestamp_millis(t).alias("et")).withWatermark("et", delay)


def register_json_topic(df: DataFrame, schema: T.StructType, view: str) -> DataFrame:
    """SRC5/SRC7: a declared JSON table over a topic: parse with a fixed schema, expose as a view."""
    table = parse_json_records(df, schema, "value", mode="drop").select("data.*")
    table.createOrReplaceTempView(view)
    return table
