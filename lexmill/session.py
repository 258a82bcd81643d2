"""Session set-up, the shared folder, and written tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_written: dict[str, list[str]] = {}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(cores: str = "*", app: str = "lexmill") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lexmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; ``drop_written`` removes what is written there."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def write_table(df: DataFrame, label: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and return the scan of it: lineage ends here.

    The shuffle files of the write go with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession) -> None:
    """Remove all that this session wrote to fresh paths; scans of it end here."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        drop_table(spark, path)


def task_count(spark: SparkSession) -> int:
    """Most tasks an explicit exchange should ask for."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    p, fs = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def file_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and time of change of a file."""
    p, fs = _hadoop_path(spark, path)
    status = fs.getFileStatus(p)
    return status.getLen(), status.getModificationTime()


def publish_folder(spark: SparkSession, aside: str, path: str) -> None:
    """Give a finished folder its name; if another writer was first, its folder stays and this one goes."""
    p, fs = _hadoop_path(spark, aside)
    target, _ = _hadoop_path(spark, path)
    if fs.exists(target) or not fs.rename(p, target):
        if not fs.exists(target):
            raise OSError(f"{aside} cannot be renamed to {path}")
        fs.delete(p, True)


def publish_files(spark: SparkSession, aside: str, folder: str, prefix: str) -> None:
    """Move the files of a written table into a folder, in place of the files there whose names begin with ``prefix``."""
    p, fs = _hadoop_path(spark, aside)
    target, _ = _hadoop_path(spark, folder)
    fs.mkdirs(target)
    for status in fs.listStatus(target):
        if status.getPath().getName().startswith(prefix):
            fs.delete(status.getPath(), True)
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), _hadoop_path(spark, f"{folder}/{prefix}{name}")[0]):
            raise OSError(f"{aside}/{name} cannot be moved to {folder}")
    fs.delete(p, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table that ``write_table`` made and that nothing reads any more."""
    if path.startswith(shared_folder(spark)):
        p, fs = _hadoop_path(spark, path)
        fs.delete(p, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-distribute a scan that has at most half as many splits as the cluster has cores.

    A large table has more splits than cores and passes through untouched; only a
    table too small to occupy the cluster is exchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if 2 * df.rdd.getNumPartitions() <= cores else df
