"""Session settings the plans rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A bad cast fails the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Bytes of input for each shuffle partition; what an input's rows weigh in a shuffle is of that order.
BYTES_PER_PARTITION = 128 << 20
LEAST_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input of this size. Adaptive execution merges small ones, but cuts none for a window."""
    return max(LEAST_PARTITIONS, -(-input_bytes // BYTES_PER_PARTITION))


def build_session(
    app_name: str, master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; ``extra`` uses ``__`` for the dots of a setting name.

    ``input_bytes`` sizes ``spark.sql.shuffle.partitions`` (see ``shuffle_partitions``) unless ``extra`` sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {} if input_bytes is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes))}
    for key, value in {**SETTINGS, **sized, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files that a path or glob names, as the file system reports it."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(system.getContentSummary(f.getPath()).getLength() for f in system.globStatus(pattern) or [])


def require_ansi(spark: SparkSession) -> None:
    """Refuse to load typed layers where a bad cast would silently become NULL."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true: bad casts have to fail the load")


def scratch_root(conf) -> str:
    """The shared folder named by the cluster (``spark.checkpoint.dir``).

    Without that setting it lies below the warehouse, which every session has and a cluster shares.
    """
    root = conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else f"{conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Path of a new folder for intermediate data that all executors can reach; it goes when the application ends."""
    own = f"{scratch_root(spark.conf)}/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{own}/{label}-{uuid.uuid4().hex}"
