"""Session helpers: building a session for tests, and cutting lineage safely."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "patraloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests, the bench and examples; a cluster brings its own."""
    n = cpus or os.cpu_count() or 1
    settings = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{n}]").appName(app).config(map=settings)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    it need not be installed on the executors."""
    context = spark.sparkContext
    if getattr(context, "_patraloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    held = Path(tempfile.mkdtemp(prefix="patraloom-")) / "patraloom.zip"
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    context.addPyFile(str(held))
    context._patraloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A cluster names a folder all executors share in ``spark.checkpoint.dir``.
    Only a local master, where driver and executors are one process, gets a
    temporary folder; elsewhere an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="patraloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _path(spark: SparkSession, folder: str):
    """A Hadoop path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that a lost
    executor never forces the whole lineage to be computed again. It is a Parquet
    table, as a checkpoint would compute the frame twice. The files are deleted
    by :func:`forget`, or when the driver ends."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    path, files = _path(spark, folder)
    files.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(folder)
    out._patraloom_files = folder
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`cut` made. Whatever rests on them
    must have been written before."""
    for df in frames:
        held = getattr(df, "_patraloom_files", None)
        if held:
            path, files = _path(df.sparkSession, held)
            files.delete(path, True)


def source_bytes(df: DataFrame) -> int:
    """The bytes of the files a frame is read from, as Spark estimates them; 0 where it can't."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 2**60)
