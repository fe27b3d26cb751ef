"""Session helpers: shared scratch space and lineage cuts.

Iterative jobs cut their lineage with a *reliable* checkpoint written to the
shared folder the cluster names in ``spark.checkpoint.dir``. We read that
setting from the session and only fall back to a private folder when the
session runs in local mode (tests, single-machine benches); on a cluster an
unset checkpoint dir is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting one up only
    when none is configured and the session is local."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in Spark Connect
            conf_dir = None
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative jobs need a shared, "
                "reliable folder on a cluster"
            )
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate
    tables and exports made by a job (never a machine-local temp dir)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system of its scheme."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def persist(df: DataFrame) -> DataFrame:
    """Cache a reused frame; blocks lost with an executor are recomputed
    from (short) lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def scoped_conf(spark: SparkSession, key: str, value: str, **more: str):
    """Set SQL confs for the duration of a block, then restore them.

    Extra settings may be given as keyword arguments with dots written as
    double underscores (``spark__sql__adaptive__enabled="false"``).
    """
    settings = {key: value, **{k.replace("__", "."): v for k, v in more.items()}}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def local_session(
    cores: int | str = "*", partitions: int = 8, app: str = "quarry", extra: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and single-machine benches. Production jobs get
    their configuration from spark-submit instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Bytes up to which a small side is broadcast after its size is checked.
BROADCAST_MAX_BYTES = 32 << 20


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES):
    """Join with a side whose size is *checked*: broadcast when its rows take
    at most ``max_bytes`` (one cheap aggregate over it), otherwise a shuffle
    join, where AQE's skew handling splits oversized partitions of the big side.
    A row counts as its text form and 16 bytes a column."""
    from pyspark.sql import functions as F

    text = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)) + 16 * len(small.columns)
    size = small.agg(F.sum(text)).first()[0] or 0
    return big.join(F.broadcast(small) if size <= max_bytes else small, on, how)
