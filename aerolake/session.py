"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Settings every job here is written against.  Shuffle partitions are a
# default for local runs; on a cluster pass a value sized so that one
# shuffle partition is ~128-256 MB (e.g. 100 TB / 200 MB ~ 500k partitions,
# in practice AQE coalesces from a large starting number).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, cores: int, shuffle_partition_bytes: int = 200 * 2**20,
                 split_bytes: int = 256 * 2**20) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at ~``shuffle_partition_bytes`` of input each
    (never fewer than 2 waves of the cluster's cores) and AQE coalesces the
    small ones; scans split at ``split_bytes``.  E.g. 100 TB on 8000 cores:
    ~524k shuffle partitions before coalescing, 256 MB input splits.
    """
    parts = max(2 * cores, -(-input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 2**20),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(master: str | None = "local[8]", app: str = "aerolake",
                  shuffle_partitions: int | None = 8, extra: dict | None = None) -> SparkSession:
    """``master=None`` leaves the master to spark-submit (cluster runs);
    ``shuffle_partitions=None`` keeps the cluster's setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root folder on shared storage for staged writes and lineage cuts.

    The context's checkpoint dir if set, else ``spark.checkpoint.dir`` from
    the session (registered as the checkpoint dir).  Only when neither is
    set *and* the master is local (tests, laptops) is a folder created under
    the system temp dir; a cluster must name a shared folder, since a
    machine-local one would vanish with its executor.
    """
    sc = spark.sparkContext
    ckpt = sc.getCheckpointDir()
    if ckpt:
        return ckpt.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
                "for staged writes on a cluster")
        conf = tempfile.mkdtemp(prefix="aerolake-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir().rstrip("/")


def local_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """``rows`` (tuples) of metadata as a local relation: unlike a frame over an RDD its
    size is known to the planner and none of it is a task."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(kind)
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


def side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """What ``steps`` return, each in a thread of its own: their jobs share the cluster,
    so that one's last tasks and driver work do not leave it idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(s)) for s in steps]]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
