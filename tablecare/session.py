"""Session helpers: a local session for tests and benches, and the shared folder.

Library code never creates a session; it takes the caller's. ``shared_dir`` is
the one place that decides where intermediate tables and run outputs go: the
cluster's ``spark.checkpoint.dir`` (a shared file system), never a folder of one
machine. Where the setting is absent it raises; tests and benches on one machine
name a folder when they make their session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tablecare", shared: str | None = None) -> SparkSession:
    """A local session configured like the cluster settings we rely on.

    ``shared`` is used as the shared folder only where ``spark.checkpoint.dir`` is unset.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if shared and not spark.conf.get(CHECKPOINT_KEY, None):
        spark.sparkContext.setCheckpointDir(shared)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root folder shared by all executors (``spark.checkpoint.dir``).

    Read from the session: its setting, or the checkpoint folder that was set on its context.
    """
    sc = _context(spark)
    path = spark.conf.get(CHECKPOINT_KEY, None)
    if not path and sc is not None and sc.getCheckpointDir():
        # getCheckpointDir() returns <dir>/<uuid>; keep its parent
        path = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not path:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never-used folder under the shared root (one per run or test)."""
    return f"{shared_dir(spark)}/{name}/{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``fresh_dir``, on whatever file system it is."""
    root = shared_dir(spark)
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not under the shared folder {root}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_staged: dict[str, list[str]] = {}      # application id -> folders of staged tables


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. The
    files stay until ``remove_staged``, since the result is read lazily.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, f"staged-{name}")
    _staged.setdefault(spark.conf.get("spark.app.id", "") or "", []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession) -> int:
    """Delete all tables this application has staged (call it once their readers are done)."""
    paths = _staged.pop(spark.conf.get("spark.app.id", "") or "", [])
    for path in paths:
        remove_dir(spark, path)
    return len(paths)
