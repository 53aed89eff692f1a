"""Keyed tables as a snapshot and a log of changes (SNK3, SNK5).

``<table>/changes/batch_id=N`` holds the rows of micro-batch N, ``<table>/snapshot/upto=N`` the table after batch N. A
folder counts once it is committed, that is, holds the committer's ``_SUCCESS`` file, which is written last. A reader
takes the newest snapshot and the batches after it. Writing a batch costs its own rows; folding the log into a new
snapshot is a step of its own that runs when the log has grown to a share of the snapshot, so each row is rewritten a
bounded number of times and a read does not slow down with the number of batches. A replayed batch overwrites its
folder; if a snapshot already covers it, readers ignore the folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["BATCH", "Version", "append_changes", "read_rows", "compaction_due", "write_snapshot", "version_of"]

BATCH = "batch_id"
LOG_SHARE = 0.25  # a log of this share of the snapshot's bytes is folded in


@dataclass(frozen=True)
class Version:
    """A committed state: the snapshot's last batch (-1: none) and the batches after it."""

    upto: int = -1
    batches: tuple[int, ...] = ()
    superseded: tuple[str, ...] = field(default=(), compare=False)  # folders that no reader of this version needs
    snapshot_bytes: int = 0
    log_bytes: int = 0

    @property
    def last(self) -> int:
        return max((self.upto, *self.batches))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> dict[int, int]:
    """Committed folders ``<name>=N`` of a path: N and bytes."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return {}
    done = spark._jvm.org.apache.hadoop.fs.Path
    return {int(s.getPath().getName().split("=")[1]): fs.getContentSummary(s.getPath()).getLength()
            for s in fs.listStatus(p) if "=" in s.getPath().getName() and fs.exists(done(s.getPath(), "_SUCCESS"))}


def version_of(spark: SparkSession, table: str) -> Version:
    """The newest committed state of a table. One listing of its folders, which compaction keeps few."""
    root = table.rstrip("/")
    snapshots, log = _folders(spark, f"{root}/snapshot"), _folders(spark, f"{root}/changes")
    upto = max(snapshots, default=-1)
    after = tuple(sorted(n for n in log if n > upto))
    before = max((n for n in snapshots if n < upto), default=-1)  # a reader may still be at the snapshot before
    old = [f"{root}/snapshot/upto={n}" for n in snapshots if n < before]
    old += [f"{root}/changes/batch_id={n}" for n in log if n <= before]
    return Version(upto, after, tuple(old), snapshots.get(upto, 0), sum(log[n] for n in after))


def append_changes(rows: DataFrame, table: str, batch_id: int) -> None:
    """Write the rows of a micro-batch to its folder (again, if it is replayed)."""
    rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}/changes/batch_id={batch_id}")


def read_rows(spark: SparkSession, table: str, schema: str | None, at: Version | None = None) -> DataFrame:
    """Snapshot rows and the rows of later batches, with ``batch_id`` (a snapshot's rows: its last batch).

    ``schema``: DDL of the rows; None takes that of the files, and raises if there are none. An unreadable folder
    raises, it is never skipped.
    """
    root, at = table.rstrip("/"), at or version_of(spark, table)
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = []
    if at.upto >= 0:
        parts.append(reader.parquet(f"{root}/snapshot/upto={at.upto}").withColumn(BATCH, F.lit(at.upto).cast("bigint")))
    if at.batches:
        kind = None if schema is None else T.StructType.fromDDL(f"{schema}, {BATCH} bigint")
        log = (spark.read if kind is None else spark.read.schema(kind)).option("basePath", f"{root}/changes")
        log = log.parquet(*[f"{root}/changes/batch_id={n}" for n in at.batches])
        parts.append(log.withColumn(BATCH, F.col(BATCH).cast("bigint")))
    if parts:
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    if schema is None:
        raise ValueError(f"no committed batch in {root}")
    return spark.createDataFrame([], f"{schema}, {BATCH} bigint")


def compaction_due(spark: SparkSession, table: str, most_batches: int) -> bool:
    """True if the log has ``most_batches`` batches, or ten of them and ``LOG_SHARE`` of the snapshot's bytes."""
    at = version_of(spark, table)
    return len(at.batches) >= most_batches or len(at.batches) >= 10 and at.log_bytes >= LOG_SHARE * at.snapshot_bytes


def write_snapshot(spark: SparkSession, table: str, merged: Callable[[Version], DataFrame]) -> None:
    """Write ``merged(version)`` as the snapshot after the newest committed batch, then remove folders that neither it
    nor the snapshot before needs. Stopped half-way, it leaves the version before in place and can run again."""
    at = version_of(spark, table)
    if not at.batches:
        return
    merged(at).write.mode("overwrite").parquet(f"{table.rstrip('/')}/snapshot/upto={at.last}")
    for folder in version_of(spark, table).superseded:
        p, fs = _fs(spark, folder)
        fs.delete(p, True)
