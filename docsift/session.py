"""Session helpers: local sessions for tests/bench, and the shared checkpoint folder.

On a cluster the session comes from the platform and ``spark.checkpoint.dir``
names a shared folder; jobs read it from the session and never fall back to a
machine-local temporary folder. Only local sessions (tests, bench) set their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "docsift") -> SparkSession:
    """A local session for tests and the bench; sets a scratch checkpoint folder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("DOCSIFT_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docsift-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a scratch folder. On a cluster a
    missing setting raises: a machine-local folder would lose data when an
    executor goes away.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir() or conf
    if spark.sparkContext.master.startswith("local"):
        # Single-machine run (tests, bench): a scratch folder is shared by definition.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docsift-ckpt-"))
        return spark.sparkContext.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_up(spark: SparkSession):
    """The shuffle files of what is written within are deleted as soon as it is written.

    Otherwise they stay until the driver's JVM happens to collect the plan, and steps add up on disk. Writing plans
    its own execution, so nothing reads these files again.
    """
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


class Scratch:
    """A folder of one run's intermediate tables under the shared checkpoint folder.

    ``lean``: the tables are compressed by zstd, and the shuffle files behind each are given up once it is written.
    """

    def __init__(self, spark: SparkSession, *, lean: bool = False):
        self.spark = spark
        self.lean = lean
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/docsift-{uuid.uuid4().hex}"

    def table(self, df, name: str):
        """Write ``df`` as a parquet table and read it back.

        Cuts the lineage like ``checkpoint()`` and survives executor loss, but the
        re-read is columnar: later steps read only the columns they use, filters are
        pushed down, and the planner sees the table's real size.
        """
        path = f"{self.path}/{name}"
        if self.lean:
            with shuffles_given_up(df.sparkSession):
                df.write.option("compression", "zstd").parquet(path)
        else:
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str | None = None) -> None:
        """Delete the folder, or one table of it; nothing read from there can be used afterwards."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def materialize(df, name: str, *, lean: bool = False):
    """``df`` written as a table of its own scratch folder (see :class:`Scratch`)."""
    return Scratch(df.sparkSession, lean=lean).table(df, name)
