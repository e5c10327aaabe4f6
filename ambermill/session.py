"""Session factory and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def object_store_conf(s3a: Mapping | None) -> dict[str, str]:
    """Hadoop settings of an S3A store; without keys the default credential chain is used."""
    if not s3a or not s3a.get("enabled"):
        return {}
    prefix = "spark.hadoop.fs.s3a."
    conf = {
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "path.style.access": str(bool(s3a.get("path_style_access", True))).lower(),
        prefix + "connection.ssl.enabled": str(bool(s3a.get("ssl_enabled", True))).lower(),
    }
    if s3a.get("endpoint"):
        conf[prefix + "endpoint"] = s3a["endpoint"]
    if s3a.get("access_key") and s3a.get("secret_key"):
        conf[prefix + "access.key"] = s3a["access_key"]
        conf[prefix + "secret.key"] = s3a["secret_key"]
    return conf


def session_conf(config: Mapping, profile: str | None = None, overrides: Mapping | None = None) -> dict[str, str]:
    """Settings in order of weight: base, profile, object store, overrides."""
    spark_cfg = config.get("spark", {})
    name = profile or spark_cfg.get("default_profile", "local")
    profiles = spark_cfg.get("profiles", {})
    if name not in profiles:
        raise ValueError(f"unknown profile {name!r}; choose one of {sorted(profiles)}")
    chosen = profiles[name]
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(spark_cfg.get("shuffle_partitions", 200))
    for key, setting in (
        ("master", "spark.master"),
        ("driver_memory", "spark.driver.memory"),
        ("executor_memory", "spark.executor.memory"),
        ("executor_cores", "spark.executor.cores"),
    ):
        if chosen.get(key) is not None:
            conf[setting] = str(chosen[key])
    conf |= object_store_conf(config.get("s3a"))
    return conf | {k: str(v) for k, v in (overrides or {}).items()}


def build_session(app: str, config: Mapping, profile: str | None = None, overrides: Mapping | None = None) -> SparkSession:
    """Create (or reuse) a session for a profile of the configuration."""
    spark = SparkSession.builder.appName(app).config(map=session_conf(config, profile, overrides)).getOrCreate()
    spark.sparkContext.setLogLevel(config.get("spark", {}).get("log_level", "WARN"))
    return spark


# What a task over whole texts holds at once: a row group of each file, a batch of rows of the reader, an Arrow batch, and what it aggregates
# of a partition. By default these are 128 MB, 4,096 rows, 10,000 rows and up to 64 MB compressed, so that 8 tasks don't fit a heap of 1 GB.
TASK_MEMORY = {
    "parquet.block.size": str(8 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


def bound_task_memory(spark: SparkSession) -> None:
    """Set TASK_MEMORY for the session, whose frames are planned and written later; what the session sets itself stays."""
    own = {r.key for r in spark.sql("SET").collect()}
    for key, value in TASK_MEMORY.items():
        if key not in own:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Where it is unset, a local master gets a temporary one; on a cluster
    other machines couldn't see that, so it is an error."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="ambermill-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def local_session(app: str = "ambermill", cpus: int | str = "*", **overrides: str) -> SparkSession:
    """Session for tests and benches."""
    conf = BASE_CONF | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"}
    conf |= {"spark.driver.memory": os.environ.get("AMBERMILL_DRIVER_MEMORY", "8g")} | overrides
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
