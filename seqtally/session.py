"""Session construction and the few session-level services the operators need."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

def build_session(app: str = "seqtally", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join handling and UTC times.

    On a cluster leave `master` and `shuffle_partitions` unset: the launcher supplies the first, and
    adaptive execution coalesces a generous `spark.sql.shuffle.partitions` to the data.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A join whose output feeds another join on the same key may be split too, at the price of a shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by `spark.checkpoint.dir`; only local runs may fall back to a new one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            context.setCheckpointDir(named)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="seqtally-checkpoint-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared checkpoint folder and go on from there.

    The rows are computed once and survive the loss of executors. Unlike an RDD checkpoint the table is
    columnar and its size is known to the planner, which then picks the joins that follow by it. What was shuffled to
    compute it is removed from the executors' disks once it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._cut_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that `cut_lineage` has written, once nothing reads them any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._cut_path)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
