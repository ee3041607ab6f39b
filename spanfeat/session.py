"""Session helpers: time zone check, checkpoint folder, sized summaries."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Zone ids that all mean UTC.
UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "Etc/GMT", "Universal", "Etc/Universal", "Zulu"}


def build_session(app: str = "spanfeat", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Instants are compared in microseconds, so the session zone must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_ZONES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC (found {zone})")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables, taken from spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would vanish with its executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current is None:
        if configured is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="spanfeat-ckpt-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder; survives the loss of executors."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back, so the planner sees the true size."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Scratch folders of this driver that are not deleted yet.
_held: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """New folder name below the shared folder, for a table only this driver reads.

    Such folders live as long as the driver at most: see ``clear_scratch``.
    """
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _held:
        atexit.register(_clear_at_exit, spark)
    _held.add(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders made by ``scratch`` or ``staged`` that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _held.discard(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch folders and staged tables of this driver; returns their number.

    To be called when no frame made from them is used any more; the end of the driver
    process calls it as well.
    """
    paths = list(_held)
    discard(spark, *paths)
    return len(paths)


def _clear_at_exit(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except Exception:  # the gateway to Spark may be gone already
        _held.clear()


def settle(df: DataFrame) -> DataFrame:
    """Run a summary once and return it as a staged table, so that its measured size decides.

    The planner broadcasts it only if its files are below the session's own threshold. An
    empty summary comes back as an empty relation, for which joins are planned away.
    """
    kept = staged(df, "summary")
    return kept.limit(0) if kept.isEmpty() else kept
