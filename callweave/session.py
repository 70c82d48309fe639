"""Spark session helpers.

Cluster jobs take their configuration from the submitting environment; the
helpers here only fill in what is missing, which is what local runs and tests
need.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "callweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        conf.setdefault("spark.driver.memory", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only for one-process local runs.

    Everything else (also ``local-cluster``) has executors in other processes, possibly on other
    machines: there ``spark.checkpoint.dir`` must name a shared folder."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    path = tempfile.mkdtemp(prefix="callweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


#: bytes of an Arrow batch that goes to or comes from a Python worker
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark) -> None:
    """Let Arrow batches of the session hold ``BATCH_BYTES``, unless fewer are set.

    At Spark's 64 MB a batch of texts takes several times that of an executor for each task, outside its heap: the
    buffer it is written to (which grows by doubling), the one its answer is read to and those of the worker."""
    number, unit = re.fullmatch("(-?[0-9]+)([kmg]?)b?", spark.conf.get(_BATCH).lower()).groups()
    if not 0 < int(number) << 10 * " kmg".index(unit or " ") <= BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def work_path(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/callweave-tables/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "t"):
    """Cut lineage: write ``df`` as Parquet under the checkpoint directory and read it back.

    Unlike ``Dataset.checkpoint`` the re-read table carries real file-size statistics,
    so iterative jobs do not inherit ever-growing join estimates from earlier rounds,
    and AQE sees true sizes when it picks broadcast or sort-merge joins.  The result's
    ``written`` is the table's path, for ``discard``."""
    spark = df.sparkSession
    bound_batches(spark)
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: no job to infer it from the files
    out = spark.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def discard(*tables) -> None:
    """Delete tables that ``materialize`` wrote (or paths of such); nothing may read them later."""
    for t in tables:
        path = t if isinstance(t, str) or t is None else getattr(t, "written", None)
        if path and "/callweave-tables/" in path:
            spark = SparkSession.getActiveSession()
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
