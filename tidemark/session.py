"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Parsing a change event makes generated methods past the size the JVM compiles
# by default; without this they run interpreted, at about half the speed.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan here relies on."""
    for key, value in ENGINE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session for scripts; on a cluster spark-submit supplies the master."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    jvm = {f"spark.{side}.extraJavaOptions": JVM_OPTIONS for side in ("driver", "executor")}
    for key, value in {**ENGINE_SETTINGS, **jvm, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


OWN_ROOT = "spark.tidemark.localRoot"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local session that names none gets a temporary folder, since there the
    driver and the executors are the same machine. The session's own setting is
    read, never changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_ROOT, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(OWN_ROOT, root)
    return root


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder of its own under the shared root, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tidemark/{app}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application staged. Call it when its results are read."""
    delete_folder(spark, f"{shared_root(spark)}/tidemark/{spark.sparkContext.applicationId}")


# Files moved at the same time.
MOVERS = 16


class Files:
    """File names and small files on whatever storage the paths name, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        place, system = self._at(path)
        return system.exists(place)

    def glob(self, pattern: str) -> list[str]:
        """Paths that match a pattern, in order."""
        place, system = self._at(pattern)
        return sorted(status.getPath().toString() for status in system.globStatus(place) or [])

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files under a folder."""
        place, system = self._at(path)
        return system.getContentSummary(place).getLength()

    def modified(self, path: str) -> int:
        """When a file was last written, in milliseconds."""
        place, system = self._at(path)
        return system.getFileStatus(place).getModificationTime()

    def read(self, path: str) -> str:
        place, system = self._at(path)
        source = system.open(place)
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def write(self, path: str, text: str) -> None:
        """Write a small file, in place of one of the same name."""
        place, system = self._at(path)
        out = system.create(place, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, source: str, target: str) -> None:
        """Move a file, unless an earlier try did so."""
        place, system = self._at(source)
        self._move(system, place, self._jvm.org.apache.hadoop.fs.Path(target))

    def _move(self, system, place, goal) -> None:
        if not system.exists(place):
            if not system.exists(goal):
                raise FileNotFoundError(f"neither {place} nor {goal} is there")
        elif not system.rename(place, goal):
            raise OSError(f"could not move {place} to {goal}")

    def move_all(self, pairs: list[tuple[str, str]]) -> None:
        """Move many files, several at a time: on object stores each is a copy by the store."""
        for folder in sorted({target.rsplit("/", 1)[0] for _, target in pairs}):
            self.make_folder(folder)
        if pairs:
            path, (_, system) = self._jvm.org.apache.hadoop.fs.Path, self._at(pairs[0][0])
            with ThreadPoolExecutor(MOVERS) as pool:
                list(pool.map(lambda pair: self._move(system, path(pair[0]), path(pair[1])), pairs))

    def make_folder(self, path: str) -> None:
        place, system = self._at(path)
        system.mkdirs(place)

    def delete(self, path: str) -> bool:
        """Delete a file or a folder; whether it was there."""
        place, system = self._at(path)
        return system.delete(place, True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    Files(spark).delete(path)


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    return Files(spark).glob(pattern)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def stage(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several later steps: the work above is done
    once, survives lost executors, and the reader knows its true size.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
