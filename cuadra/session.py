"""Session defaults and the shared working folder.

Intermediate files (staged text extracts, table versions, checkpoints) live
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job of the toolkit relies on.  Partition counts are left to
# the cluster: AQE coalesces small shuffles and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    # Raw extracts are many small files: pack more of them into one task.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "cuadra",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_base(spark)
    return spark


#: Shared folder of a local session that names none.
LOCAL_FOLDER = "file:///tmp/checkpoints"


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged data, as a full URI.

    Read from the session.  Only a local session may go without: on a cluster
    a folder of one machine would lose what other executors wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext)
        if not base:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share") from None
        return base
    if not base:
        current = sc.getCheckpointDir()
        if current:
            # Spark appends a per-application folder; use its parent.
            base = current.rstrip("/").rsplit("/", 1)[0]
        elif sc.master.startswith("local"):
            base = LOCAL_FOLDER
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return qualified(spark, base)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system: one without a scheme lies on the session's
    default file system, where Spark itself would write it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder ``<checkpoint base>/cuadra/<name>-<uuid>``."""
    base = checkpoint_base(spark)
    return f"{base.rstrip('/')}/cuadra/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and continue from
    there: several rules and a write then read the result instead of
    recomputing the lineage, and a lost executor does not lose it."""
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)
