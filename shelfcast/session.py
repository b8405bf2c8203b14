"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# folder of each local application that runs without the setting
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on; `master` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # bucketed tables of one sorted file per bucket need no sort for windows
        .config("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HotSpot leaves methods over 8000 bytecodes uncompiled; the feature table is
        # wide enough to generate such methods, and several times slower with them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster.

    A local session without the setting gets a temporary folder of its own; a
    cluster session without it is refused, since a machine-local folder would
    lose written tables together with the machine.
    """
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="shelfcast-")
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder; never reused, so no run sees another's files."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives the loss of executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
