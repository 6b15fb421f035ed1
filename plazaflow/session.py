"""Session settings that the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Skewed joins are left to adaptive execution: it splits the hot side of a
# shuffled join and turns a join into a broadcast only after it has measured
# the side. Operators that aggregate or rank split hot groups themselves.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # small inputs keep their parallelism; large ones are far above this floor
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "plazaflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it (spark.checkpoint.dir).

    Only a local session, where one process does all the work, may go without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        folder = _local.setdefault(app, tempfile.mkdtemp(prefix="plazaflow-"))
    return folder.rstrip("/")
