"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
PAGES_A_BATCH = 500
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES_A_BATCH = 4 << 20
_local_roots: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A bucket is one sorted file (plans/traversal.py), so joins on buckets need not sort it again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Pages can be tens of kilobytes: keep the Arrow batches of the extraction stage small.
    BATCH_ROWS: str(PAGES_A_BATCH),
    BATCH_BYTES: str(BYTES_A_BATCH),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches at ``PAGES_A_BATCH`` rows and ``BYTES_A_BATCH`` in a session that was not configured here; a smaller setting stays.

    A worker's memory grows with its batch, which by default holds as many pages as its partition has, up to 10,000.
    """
    bounded_batches(spark)
    rows = int(spark.conf.get(BATCH_ROWS))
    if not 0 < rows <= PAGES_A_BATCH:
        spark.conf.set(BATCH_ROWS, str(PAGES_A_BATCH))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches at ``BYTES_A_BATCH``, or one longer row; a smaller setting stays.

    Both ends of a batch hold it whole: the worker beside what it makes of it, the JVM outside its heap. By default that is 64 MB for each task.
    """
    size = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(BATCH_BYTES).strip().lower())
    if not size or not 0 < int(size[1]) << 10 * " kmgtp".index(size[2] or " ") <= BYTES_A_BATCH:
        spark.conf.set(BATCH_BYTES, str(BYTES_A_BATCH))


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local session, as in tests, may go without one: it gets a temporary folder.

    The setting belongs to the cluster and cannot be changed in a running session, so the folder is remembered here.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="weblattice-")
    return _local_roots[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nothing else uses, in the shared folder; written tables survive lost executors."""
    return f"{shared_root(spark)}/weblattice/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: lineage ends here, and the planner knows the table's real size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_by_value(module: str) -> None:
    """Send a module's UDFs to the workers whole, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
