"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# SQL settings every job relies on. They are set only where the caller left
# them unset, so a cluster's own tuning always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort merge joins where every partition turned out small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# Files hold repetitive texts and lists in a hundredth of their size in memory, so
# a table's size as files says little of what a broadcast of it takes. Only tiny
# files are sent out by it; all else is by the size measured at a shuffle. Tasks
# unfold lists into many rows, so partitions are kept small.
BOUNDED = {
    "spark.sql.autoBroadcastJoinThreshold": "256KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}

# For plans whose joins, windows and groups all have a file's rows together: dealt out by
# ``file_id`` once, they meet on (file, any other key) without another shuffle. Such a
# stage keeps several sorts at a time, so its partitions are smaller, and there are so
# many to begin with that they stay so on large tables. A task that deals rows out to
# so many holds them all, so it reads less as well.
BY_FILE = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.files.maxPartitionBytes": "32MB",
}

# For tables with rows of megabytes: their writer looks at its buffers after every row, not
# after a hundred, and a reader holds one small group of rows, not a partition of them.
WIDE = {
    "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **BOUNDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession, settings: Mapping[str, str] = DEFAULTS) -> None:
    """Pin the settings results depend on, leave the rest to the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in settings.items():
        if key not in explicit:
            spark.conf.set(key, value)
    for key in BY_FILE:
        # What a query by files set does not hold for the next one of the session.
        if key not in explicit and key not in settings and key not in BOUNDED:
            spark.conf.unset(key)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is configured (tests on one machine) is a private one made.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="headway-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def staged(df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write a table once to the shared folder and read it back; ``options`` are the writer's (``WIDE``).

    Cuts lineage, and serves results that are dear to work out and read several
    times: later reads take only their own columns, and a lost executor costs no
    recomputation. ``release`` deletes it.
    """
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _located(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the caller owns, if it is there."""
    place, system = _located(spark, path)
    system.delete(place, True)


def release(df: DataFrame) -> None:
    """Delete a staged table once nothing reads it any more."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    for folder in folders:
        if "/staged-" in folder:
            remove(df.sparkSession, folder)
