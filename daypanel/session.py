"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins, coalesces small shuffle partitions and splits skewed ones at run time. The shuffle partition
# count is left to the cluster: AQE coalesces downwards only, so it should be set high there.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows handed to Python hold whole sequences or feature vectors, so batches are kept short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


PARTITION_BYTES = 128 * 1024 * 1024
TASK_BYTES = 16 * 1024 * 1024
MOST_PARTITIONS = 50_000
_UNKNOWN_BYTES = 1 << 62  # Spark puts the largest long in place of a size it does not know
_OWN: dict[str, str] = {}  # scratch folders of local sessions, by application


def build_session(app: str = "daypanel", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "daypanel") -> SparkSession:
    """One-machine session for tests and the bench."""
    partitions = "8" if cores == "*" else str(cores)
    return build_session(
        app,
        **{
            "spark.master": f"local[{cores}]",
            "spark.driver.memory": memory,
            "spark.sql.shuffle.partitions": partitions,
        },
    )


def size_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Set the number of shuffle partitions from the stored size of the inputs, and return it.

    One partition per ``PARTITION_BYTES`` of input, never fewer than the session has now. AQE merges the small ones
    again but cannot split a plain exchange, so a count fit for gigabytes would make partitions spill at terabytes.
    Reads file sizes only.
    """
    total = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(now, -(-total // PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def spread(df: DataFrame, key: str, *inputs: DataFrame) -> DataFrame:
    """``df`` dealt by ``key`` over a number of partitions that follows the stored size of what ``inputs`` are read from.

    A partition stands for about ``TASK_BYTES`` of stored tables. Tasks that sort whole partitions then need the same memory
    at any size, whereas AQE merges partitions up to its own size of compressed rows, and never makes more of them than the
    session has set. A small input, a partition or less for each core, is left to AQE; others get no fewer partitions than
    the session has, or a join by ``key`` would deal them again. Runs nothing.
    """
    spark = df.sparkSession
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-sum(map(_stored_bytes, inputs)) // TASK_BYTES), MOST_PARTITIONS)
    small = wanted <= min(now, spark.sparkContext.defaultParallelism)
    return df.repartition(key) if small else df.repartition(max(now, wanted), key)


def _stored_bytes(df: DataFrame) -> int:
    """Bytes of the tables under a plan, each as often as it is read; those of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A local session without the setting gets its own scratch folder; a cluster without it is an error, since a folder
    of one machine would not be seen by the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _OWN[context.applicationId]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint, but as parquet: the reader keeps column pruning, filter pushdown and exact row
    counts, and a lost executor costs a re-read instead of a recomputation. Runs one job.
    """
    path = f"{shared_dir(df.sparkSession)}/daypanel/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
