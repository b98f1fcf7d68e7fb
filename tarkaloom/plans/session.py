"""Session, table access and staged tables.

Long plans cut their lineage with a table written in the shared folder that
the cluster names in ``spark.checkpoint.dir``.  A staged Parquet table keeps
column pruning.  Its size on disk is that of packed columns, several times less
than in memory, so :func:`table` and :func:`stage` have Catalyst count a file
``UNPACKED`` times (``spark.sql.sources.fileCompressionFactor``) where it asks whether
a side is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tarkaloom", master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


# bytes in memory to a byte of Parquet
UNPACKED = 8.0


def count_unpacked(spark: SparkSession) -> None:
    name = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(name)) < UNPACKED:
        spark.conf.set(name, str(UNPACKED))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only where none is named and all tasks run
    in this process."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            at = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs restart from the files when executors are lost.  A result may read
    staged tables until it is written; then :func:`drop_staged` deletes them.
    """
    count_unpacked(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables, when no DataFrame reads them any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/staged")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parents[2]
        name = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/tarkaloom", "zip", root, "tarkaloom")
        sc.addPyFile(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    count_unpacked(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer parts than there are cores (one small
    file of one row group); a scan of many parts stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
