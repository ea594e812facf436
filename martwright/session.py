"""Spark session construction and the shared checkpoint folder.

The library never invents a storage location on a cluster: lineage is cut by
tables written below the folder named by ``spark.checkpoint.dir``. Only a local-mode session without that setting (tests, laptop runs) gets a
fresh scratch folder of its own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings of a session that nobody configured. A value given by the submitter
# (spark-submit, spark-defaults, a running session) always wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
LOCAL_MASTER, LOCAL_SHUFFLE_PARTITIONS = "local[*]", 8


def build_session(
    master: str | None = None,
    app_name: str = "martwright",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the submitter's settings; what is missing is filled in.

    Without any master this is a local run with few shuffle partitions. Values
    passed here are the caller's own choice and are set; defaults never replace
    a submitted value."""
    SparkContext._ensure_initialized()  # so that submitted settings can be read
    given = SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not given.contains(k)}
    if master or not given.contains("spark.master"):
        conf["spark.master"] = master or LOCAL_MASTER
    local = conf.get("spark.master", given.get("spark.master", "")).startswith("local")
    if local and not given.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = str(LOCAL_SHUFFLE_PARTITIONS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    builder = SparkSession.builder
    if not given.contains("spark.app.name"):
        builder = builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating one only for local mode.

    On a cluster the folder must be configured (``spark.checkpoint.dir``) and
    shared; a machine-local temporary folder would lose data with an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(HDFS/S3/ABFS) for checkpoints before running on a cluster"
        )
    folder = tempfile.mkdtemp(prefix="martwright-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # a local run's own scratch
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    The driver zips its own source files and hands them to Spark, which serves
    them to every executor (``addPyFile``). A package that was itself submitted
    as a zip is there already."""
    sc = spark.sparkContext
    source = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_martwright_shipped", False) or not os.path.isdir(source):
        return
    folder = tempfile.mkdtemp(prefix="martwright-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "martwright.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for at, folders, names in os.walk(source):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(at, name)
                z.write(path, os.path.join("martwright", os.path.relpath(path, source)))
    sc.addPyFile(archive)
    sc._martwright_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stash(df, name: str):
    """Write ``df`` as parquet in a fresh folder below the shared checkpoint
    folder and return it read back: lineage is cut like ``checkpoint()``, and
    the planner gets a size estimate from the files (a checkpointed RDD has
    none, which can make the planner broadcast the *other*, bigger side)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def path_state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(name, length, modification time) of the files at ``path``."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(place))


def partitions_by_size(spark: SparkSession, path: str, each: int) -> int:
    """A partition for each ``each`` bytes stored at ``path``, and for each core at least."""
    stored = sum(length for _, length, _ in path_state(spark, path))
    return max(spark.sparkContext.defaultParallelism, -(-stored // each))


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``text`` the content of a small file, by one rename: a reader finds
    the old content or the new."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = hadoop.Path(path)
    fs = place.getFileSystem(conf)
    fs.mkdirs(place.getParent())
    new = hadoop.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(new)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(place), how)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None where there is none."""
    if not path_exists(spark, path):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return [f.getPath().toString() for f in found or []]
