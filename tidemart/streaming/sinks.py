"""Sinks (SNK1-SNK7) for streams, all idempotent per micro-batch via ``foreachBatch`` where needed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import DEFAULT_TZ, day_bucket_of
from tidemart.operators.stateful import arrival_struct, last_per_key
from tidemart.streaming.changelog import BATCH, Version, append_changes, compaction_due, read_rows, write_snapshot

__all__ = ["kafka_sink_options", "to_kafka_value", "write_kafka", "write_kafka_batch", "olap_batch_writer", "upsert_batch_writer",
           "dim_batch_writer", "read_dim_table", "compact_dim_table", "read_upserted", "compact_upserted", "day_bucket_writer", "query_checkpoint", "start", "console_debug"]


def kafka_sink_options(servers: str, topic: str, exactly_once: bool = False, extra: dict | None = None) -> dict:
    """SNK1/SNK2 producer options: acks=all and the idempotent producer when asked."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if exactly_once:
        opts.update({"kafka.acks": "all", "kafka.enable.idempotence": "true"})
    opts.update({f"kafka.{k}" if not k.startswith("kafka.") else k: v for k, v in (extra or {}).items()})
    return opts


def to_kafka_value(df: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON text ``value`` (and a JSON ``key`` of the primary key for upsert topics)."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key_cols:
        cols.insert(0, F.to_json(F.struct(*key_cols)).alias("key"))
    return df.select(*cols)


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, exactly_once: bool = False,
                key_cols: Sequence[str] | None = None):
    """SNK1/SNK3: stream to a topic (at-least-once; Kafka has no transactional Spark sink). With ``key_cols`` each
    record carries its primary key, so a compacted topic keeps the last value per key."""
    w = to_kafka_value(df, key_cols).writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in kafka_sink_options(servers, topic, exactly_once).items():
        w = w.option(k, v)
    return w.start()


def write_kafka_batch(df: DataFrame, servers: str, topic: str, key_cols: Sequence[str] | None = None) -> None:
    """SNK2: write the rows of a batch frame to a topic, one record per row."""
    w = to_kafka_value(df, key_cols).write.format("kafka")
    for k, v in kafka_sink_options(servers, topic).items():
        w = w.option(k, v)
    w.save()


def olap_batch_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """SNK4: each micro-batch to ``path/batch_id=N`` with overwrite, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def upsert_batch_writer(path: str, key: Sequence[str], order: Sequence[str],
                        compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """SNK3: keyed latest per micro-batch appended to the change log of ``path`` (:mod:`tidemart.streaming.changelog`);
    :func:`read_upserted` merges it with the snapshot, :func:`compact_upserted` folds it in when it is due."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(last_per_key(batch, list(key), list(order)), path, batch_id)
        if compaction_due(batch.sparkSession, path, compact_every):
            compact_upserted(batch.sparkSession, path, key, order)

    return write


def read_upserted(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str],
                  at: Version | None = None) -> DataFrame:
    """SNK3: the keyed table, the last record per key over snapshot and later batches (later batches win)."""
    rows = read_rows(spark, path, None, at)
    return last_per_key(rows, list(key), [BATCH, *order]).drop(BATCH)


def compact_upserted(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str]) -> None:
    """SNK3: fold the committed batches into a new snapshot of ``path``."""
    write_snapshot(spark, path, lambda at: read_upserted(spark, path, key, order, at))


def _fold_cells(rows: DataFrame, key: str, cells: Sequence[str], place: Column, wipes: Column, lives: Column,
                wipe_first: bool) -> DataFrame:
    """One row per key: ``_wiped`` (some row wiped what was before), ``_alive`` (some row lives after the last wipe), and per
    cell the last non-empty value after it. One aggregate, combined before the shuffle. ``wipe_first``: a row that
    wipes and lives at one place wipes before it lives."""
    def after(c: Column) -> Column:
        return F.col("_w").isNull() | (c >= F.col("_w") if wipe_first else c > F.col("_w"))

    picks = [F.max(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.struct(place.alias("p"), F.col(c).alias("v"))))
             .alias(f"_m_{i}") for i, c in enumerate(cells)]
    folded = rows.groupBy(key).agg(F.max(F.when(wipes, place)).alias("_w"), F.max(F.when(lives, place)).alias("_l"), *picks)
    return folded.select(key, F.col("_w").isNotNull().alias("_wiped"),
                         (F.col("_l").isNotNull() & after(F.col("_l"))).alias("_alive"),
                         *[F.when(after(F.col(f"_m_{i}.p")), F.col(f"_m_{i}.v")).alias(c) for i, c in enumerate(cells)])


def dim_batch_writer(table_path: str, key: str, order: Sequence[str], cells: Sequence[str],
                     op_col: str = "op", compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """SNK5: append a micro-batch of dimension changes, folded to one row per key, to the table's change log.

    Semantics are those of :func:`tidemart.sources.dims.merge_cells`, later batches after earlier ones: only changes
    after a key's last delete count, empty cells do not overwrite. A batch writes as many rows as it has keys and reads
    nothing of the table; a replayed batch replaces its own folder. When the log is due (:func:`compaction_due`) it is
    folded into a new snapshot.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        gone = F.col(op_col) == "d"
        folded = _fold_cells(batch.where(F.col(op_col).isNotNull()), key, cells, arrival_struct(list(order)), gone, ~gone, False)
        append_changes(folded, table_path, batch_id)
        if compaction_due(batch.sparkSession, table_path, compact_every):
            schema = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in [key, *cells])
            compact_dim_table(batch.sparkSession, table_path, schema)

    return write


def read_dim_table(spark: SparkSession, table_path: str, schema: str, at: Version | None = None) -> DataFrame:
    """The committed table of :func:`dim_batch_writer`: snapshot and later batches, merged cell by cell per key
    (``schema``: its key, then its cells; cells a batch did not have count as empty)."""
    key, *cells = [f.name for f in T.StructType.fromDDL(schema).fields]
    rows = read_rows(spark, table_path, f"{schema}, _wiped boolean, _alive boolean", at)
    folded = _fold_cells(rows, key, cells, F.col(BATCH), F.col("_wiped"), F.coalesce("_alive", F.lit(True)), True)
    return folded.where("_alive").select(key, *cells)


def compact_dim_table(spark: SparkSession, table_path: str, schema: str) -> None:
    """SNK5: fold the committed batches into a new snapshot. ``schema`` must name every cell that is to stay."""
    write_snapshot(spark, table_path, lambda at: read_dim_table(spark, table_path, schema, at).withColumn(
        "_wiped", F.lit(False)).withColumn("_alive", F.lit(True)))


def day_bucket_writer(path: str, epoch_col: str, fmt: str = "json", tz: str = DEFAULT_TZ):
    """SNK6: files partitioned by ``day=yyyyMMdd`` from an epoch field (s or ms), bad rows in ``error_bucket``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("day", day_bucket_of(F.col(epoch_col), tz)).withColumn("batch_id", F.lit(batch_id))
        # dynamic overwrite: a replayed batch replaces exactly the (day, batch_id) folders it wrote
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").format(fmt).save(path))

    return write


def query_checkpoint(spark, name: str) -> str:
    """``<spark.checkpoint.dir>/streams/<name>``: per-query state and offsets in the shared folder the
    cluster names (read from the session; a local folder only when the setting is unset, as in tests)."""
    from tidemart.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def start(df: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str | None = None,
          trigger: dict | None = None, name: str | None = None):
    """Start a ``foreachBatch`` query with its checkpoint (offsets and state are restored on restart).

    Without ``checkpoint`` the query's folder is :func:`query_checkpoint` of ``name``.
    """
    if checkpoint is None:
        if not name:
            raise ValueError("give a checkpoint path or a query name")
        checkpoint = query_checkpoint(df.sparkSession, name)
    w = df.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if name:
        w = w.queryName(name)
    return w.start()


def console_debug(df: DataFrame, checkpoint: str, rows: int = 20):
    """SNK7: print micro-batches to the console (debugging only)."""
    return (df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
            .option("checkpointLocation", checkpoint).start())
