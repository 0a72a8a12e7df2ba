"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Anything sized to a cluster (executors, memory,
# number of shuffle partitions) is left to spark-submit.
SETTINGS = {
    # Event times without a zone are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: joins turn into broadcasts only once the measured
    # size of a side is under the threshold, and hot shuffle partitions of a
    # join or of a REBALANCE write are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even if the next step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle files of a finished query are of no more use, and many queries make one run.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Window state of long streams lives outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the settings the plans rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster
    a machine-local folder would be lost together with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Place for one named intermediate table of this application."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that is used more than once to the shared folder and read it back.

    The plan behind it is computed once, and it outlives the executors that made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """A path and its file system, local or remote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more; a missing one is no error."""
    place, system = _folder(spark, path)
    system.delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under a folder."""
    place, system = _folder(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small text file, or None if it isn't there."""
    place, system = _folder(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file beside ``path`` and move it there, over what is there, at once."""
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid4().hex}")
    place, system = _folder(spark, path)
    out = system.create(fresh, False)
    out.writeUTF(text)
    out.close()
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, place, over)
