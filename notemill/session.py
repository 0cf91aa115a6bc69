"""Session settings and shared scratch space."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_ROWS = 250
#: Shuffle files go at the end of the write they were made for, not only when the driver happens to collect its garbage.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter configures it."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("notemill")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", memory)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """Texts are long rows: hand them to Python in batches of 250 at most, so that JVM and worker hold few at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; what was set before is set again."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: its driver and executors share one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="notemill-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the scratch folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove what was written at a path of ``scratch_path`` and is read no more."""
    if not path.startswith(f"{_scratch_root(spark)}/") or not re.fullmatch(r"\w+-[0-9a-f]{32}", path.rpartition("/")[2]):
        raise ValueError(f"{path} is not a scratch path")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str = "table", path: str | None = None, **options: str) -> DataFrame:
    """Write a frame to shared scratch, with the writer's ``options``, and read it back: later reads see one fixed result.

    Who gives a ``path`` of ``scratch_path`` can drop it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for row-wise work when the scan's rows lie in fewer splits than there are cores.

    Files are split by their bytes, but a Parquet row group is read whole by one task: a large file of few row groups has many
    splits of which few have rows. So the rows per split are counted, for which Parquet's footers are enough. A large table
    in many row groups is returned unchanged, without a shuffle; a split with more than two cores' share is dealt out.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits >= cores:
        sizes = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
        rows = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
        if not rows["all"] or rows["most"] * cores <= 2 * rows["all"]:
            return df
    return df.repartition(max(cores, splits), F.col(key))
