"""Session helpers: a local session for tests/benchmarks and the shared checkpoint folder."""
from __future__ import annotations

import contextlib
import os
import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession

# Settings this engine relies on.  AQE re-plans joins at run time (broadcast
# when the built side turns out small, split skewed partitions otherwise).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The text work is CPU-heavy per byte: do not coalesce small shuffle
    # outputs into a handful of tasks (no effect once partitions are large).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
    # A join whose one side is small in every partition hashes that side instead
    # of sorting both (AQE knows the sizes; larger sides are sorted and may spill).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The JVM never compiles a method of more than 8,000 bytes: a long row of
    # tests goes to Spark's split projections instead of one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "critiq") -> SparkSession:
    """A local session with the UI off (tests, benchmarks)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime settings above to an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None when unset)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; only when none is configured, and
    only on a local master (tests), create a scratch one."""
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="critiq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCOPE = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables
    of this application."""
    return os.path.join(_scratch(spark), getattr(_SCOPE, "name", ""), name)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, name: str):
    """Intermediate tables written by this thread inside the block lie in a folder
    of their own, which is removed at its end (for work whose results are
    written elsewhere, such as a stream's batches)."""
    _SCOPE.name = os.path.join("scopes", name)
    path = scratch_path(spark, "")
    try:
        yield
    finally:
        _SCOPE.name = ""
        _remove(spark, path)


def _scratch(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "critiq", spark.sparkContext.applicationId)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables that this application wrote (call it when
    no frame that reads them is needed any more)."""
    _remove(spark, _scratch(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(df: DataFrame, row_bytes: int) -> bool:
    """Whether a written frame of rows of that size lies under the broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.count() * row_bytes <= limit


def materialize(df: DataFrame, mode: str = "table") -> DataFrame:
    """Cut lineage before a frame feeds more than one branch.

    ``table`` writes it as Parquet under the shared checkpoint folder and reads
    it back (columnar: a branch that needs two columns reads two columns);
    ``checkpoint`` uses ``DataFrame.checkpoint`` in the same folder; both
    survive executor loss.  ``persist`` caches (memory then disk, recomputed
    from lineage when lost); ``none`` leaves the plan lazy."""
    if mode == "table":
        import uuid
        spark = df.sparkSession
        path = scratch_path(spark, f"tables/{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df
