"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold at any size; a cluster's own settings come before them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lodeweave")
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only on a local master, where all tasks are in this process, may it be
    unset (tests): a temporary folder is then made, and removed at exit. On a
    cluster that is an error, since every executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="lodeweave-")
        atexit.register(shutil.rmtree, root, True)
        spark.sparkContext.setCheckpointDir(root)
        root = f"file://{root}"
    return root.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a table into the shared folder and read it back.

    This cuts the lineage as checkpoint() does, but the copy is columnar, so a
    later step reads only the columns it needs. A lost executor costs nothing:
    the files are on shared storage. Files are removed when the session ends, or
    by discard() before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lodeweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _remove_at_exit(spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back._lodeweave_path = path
    return back


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once per Spark context, wherever they run and whatever their path is."""
    context = spark.sparkContext
    if getattr(context, "_lodeweave_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="lodeweave-")
    atexit.register(shutil.rmtree, folder, True)
    root, archive = Path(__file__).resolve().parent, f"{folder}/lodeweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    context._lodeweave_shipped = True


def discard(df: DataFrame) -> None:
    """Deletes the files of a table from materialize() that nothing reads any more."""
    path = getattr(df, "_lodeweave_path", None)
    if path:
        SharedPath(df.sparkSession, path).delete(True)
        _written[:] = [w for w in _written if w[1] != path]


class SharedPath:
    """One path of the file system that Spark uses for it, from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.jvm, self.path = jvm, jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def names(self) -> list[str]:
        """The names of what lies in the folder; none where it isn't there."""
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.path)) if self.exists() else []

    def delete(self, deep: bool = False) -> None:
        self.system.delete(self.path, deep)

    def write(self, text: str) -> None:
        """Replaces the file by the text; a reader sees the old or the new one, or none, but no part."""
        part = self.path.suffix(".part")
        out = self.system.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.system.delete(self.path, False)
        self.system.rename(part, self.path)

    def read(self) -> str:
        data = self.system.open(self.path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(data)).decode()
        finally:
            data.close()


_written: list[tuple[SparkSession, str]] = []


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))


def _clean() -> None:
    for spark, path in _written:
        try:
            SharedPath(spark, path).delete(True)
        except Exception:  # the session is already closed; its owner clears the folder
            return
