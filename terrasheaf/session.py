"""Session helpers: defaults for local runs and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

# Bytes of rows in memory for a byte of Parquet, about.
ROWS_OF_FILE = 16.0


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in Python are pickled by name, so workers must be able
    to import the package even where it is not installed.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="terrasheaf-code-"), "terrasheaf.zip")
    with zipfile.ZipFile(path, "w") as package:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def local_session(cores: int | str = 8, app: str = "terrasheaf") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def true_sizes(spark: SparkSession) -> None:
    """Let size estimates of files count what their rows take in memory.

    Keys and repeated texts take a tenth to a thirtieth of their size in Parquet.  With the
    bytes on disk as the estimate, tables of a million rows pass for small ones and are
    gathered on the driver to be broadcast.  A factor that the session has set stays.
    """
    if float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) == 1.0:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", str(ROWS_OF_FILE))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors of a cluster must see the folder, so none is made up there: a
    session that has no such setting gets a folder of its own only in local
    mode, where driver and executors are one process, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="terrasheaf-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder, unique per call."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint in the shared folder; survives a lost executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=eager)


def stage(df, label: str):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For results that several branches of a plan read: they are computed once,
    survive a lost executor, keep column pruning, and their real size is known
    to the planner, which then broadcasts them only when they are small.
    """
    path = run_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df, label: str, *keys: str):
    """Write ``df`` once, laid out by ``keys``, so that later work on them moves no row.

    The files are a bucketed table of as many buckets as there are shuffle
    partitions: aggregates and joins on ``keys`` (or on more columns that begin
    with them) read a bucket a task and need no exchange.  Do not union two such
    tables below an aggregate: Spark 4.1.2 then takes the union for laid out alike
    and counts keys twice.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"{label}_{uuid.uuid4().hex}".replace("-", "_"), run_dir(spark, label)
    writer = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).option("compression", "zstd")
    writer.saveAsTable(name, format="parquet")
    return spark.table(name)


def write_by(df, label: str, key: str, parts: int) -> str:
    """Like ``stage_by`` for the rows of an aggregate on ``key``, which are laid out by it already.

    The aggregate's own shuffle deals the rows to the files: ``parts`` of them, or as many
    as there are shuffle partitions if those are more.  Gives the name of the table.
    """
    spark = df.sparkSession
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    n = max(int(before), parts)
    name, path = f"{label}_{uuid.uuid4().hex}".replace("-", "_"), run_dir(spark, label)
    spark.conf.set(setting, str(n))
    try:
        df.write.bucketBy(n, key).sortBy(key).option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet")
    finally:
        spark.conf.set(setting, before)
    return name
