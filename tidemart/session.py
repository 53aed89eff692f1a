"""Session helpers: a tuned builder for jobs/tests and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    * shuffle partitions: about ``target_partition_bytes`` each (100 TB -> ~100k), at least 3 waves of the cores;
      fewer, larger partitions keep the number of shuffle blocks (map tasks x partitions) and their seeks down;
    * scan splits of 1 GB (100 TB -> ~100k scan tasks), push-based shuffle to merge the remaining small blocks;
    * AQE coalescing to 256 MB, skew-join splitting above 4x the median (and 256 MB), broadcast of sides that are
      small in bytes at run time, up to 64 MB;
    * RocksDB state store with changelog checkpointing for the streaming jobs.
    """
    shuffle = max(total_cores * 3, int(input_bytes // target_partition_bytes))
    return {
        **RUNTIME_CONF,
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(1 << 30),
        "spark.shuffle.push.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemart",
                  extra: dict | None = None) -> SparkSession:
    """Session for jobs and tests. On a cluster the master and sizes come from spark-submit."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read; without it a cluster run fails. When
    it is unset in local mode (tests) a fresh local folder is made and set.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(id(spark))
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidemart-ckpt-", dir=os.environ.get("TIDEMART_SCRATCH", "/tmp"))
    _LOCAL_DIRS[id(spark)] = path
    spark.sparkContext.setCheckpointDir(path)
    return path

