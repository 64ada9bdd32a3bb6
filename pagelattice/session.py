"""Session helpers: a default local session, and shipping this package to the executors."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_marked: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        path = os.path.join(tempfile.mkdtemp(), "pagelattice_package.zip")
        Path(path).write_bytes(packed.getvalue())
        spark.sparkContext.addPyFile(path)  # served by the driver; executors fetch it
        _shipped.add(app)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session on one machine that names none (tests) gets one here; a cluster must name it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("/tmp/checkpoints")
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def _stages(spark: SparkSession) -> str:
    """The application's own folder for stage tables; it goes when the driver's JVM ends."""
    folder = f"{shared_folder(spark)}/stages-{spark.sparkContext.applicationId}"
    if folder not in _marked:
        path, fs = _hadoop(spark, folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(folder)
    return folder


def drop_stages(spark: SparkSession) -> None:
    """Delete the application's stage tables: for long sessions, once no DataFrame made of them is needed any more."""
    path, fs = _hadoop(spark, _stages(spark))
    fs.delete(path, True)
    fs.mkdirs(path)


def _hadoop(spark: SparkSession, folder: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage_table(df: DataFrame, tag: str) -> DataFrame:
    """A stage's outcome as a table in the shared folder, read back: later steps start from files instead of
    the whole lineage, whatever executors are lost."""
    path = f"{_stages(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
