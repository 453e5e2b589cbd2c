"""Session helpers: a tuned local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE re-plans joins and coalesces/splits
# partitions at run time; broadcasts stay behind Spark's size threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.mergeSchema": "false",
}

# Driver-side only: skip PySpark's per-call call-site capture (used for error context) in
# our own tool sessions; it costs one extra round trip per Column operation.
LOCAL_ONLY_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clickmodel",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, small shuffle width)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("CLICKMODEL_DRIVER_MEMORY", "8g")))
    for k, v in {**RECOMMENDED_CONF, **LOCAL_ONLY_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's ``spark.checkpoint.dir``.
    Only where that is unset and the session is local (tests) a scratch folder is made and set; on
    a cluster it is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="clickmodel-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")
