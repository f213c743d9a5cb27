"""Session defaults and the few runtime helpers every operator shares."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a helper table may be broadcast. A row of a helper table is well under 1 kB.
BROADCAST_ROWS = 20_000


def local_session(cpus: str | int = "*", app: str = "ledgerlake", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; set a local one only where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"ledgerlake-{os.getpid()}")
    sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared folder: compressed and by column, where a checkpoint would hold rows
    as they are. The table goes when the session's driver ends."""
    ensure_checkpoint_dir(df.sparkSession)
    spark = df.sparkSession
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001  the session may be gone, and its folder with it
        pass


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``rows`` rows; reads no more than it needs to tell."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only where the row count proves the side small; else leave the choice to the planner."""
    return F.broadcast(df) if is_small(df, rows) else df


def collected(df: DataFrame, most: int) -> list:
    """The rows of a helper table in the driver; an error beyond ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a helper table has more than {most} rows")
    return rows


def width(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: what the session asks for, at least two waves of its cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
