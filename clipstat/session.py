"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clipstat")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, because there driver and executors share one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Spark deletes the shuffle files of a query when it ends.
NO_SHUFFLE_LEFT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an expensive intermediate once and read it back; cuts lineage and repeated work.

    What the write shuffled is of no use after it, so Spark is asked to delete those files at its end. A staged table is not written again.
    """
    if getattr(df, "_staged_at", None):
        return df
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/clipstat-{name}-{uuid.uuid4().hex}"
    with settings(spark, NO_SHUFFLE_LEFT):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in tables:
        path = getattr(df, "_staged_at", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what is started inside, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / "clipstat.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping the cluster's own folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
