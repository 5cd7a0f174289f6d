"""Session settings and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SHARED = "spark.checkpoint.dir"
_BYTES_PER_PARTITION = 256 << 20
_FEWEST_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start from for an input of this size.

    What the aggregations exchange are labels, values and counts, a fraction of
    the documents, and small results are coalesced at run time; but no partition is
    ever split, so the start must suit the largest. There is no upper bound: values
    as large as the input may be exchanged too.
    """
    return max(-(-input_bytes // _BYTES_PER_PARTITION), _FEWEST_PARTITIONS)


def build_session(
    app_name: str = "sheafwork", input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session set up for the operators.

    ``input_bytes`` sizes the shuffles, see :func:`shuffle_partitions`. Other
    settings are given with ``__`` for a dot; the master comes from them or from
    the environment.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(input_bytes)),
        )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that all executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, else the
    warehouse, which a session always has and all its executors reach.
    """
    folder = spark.conf.get(_SHARED, None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a path made by :func:`shared_folder` that is no longer read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
