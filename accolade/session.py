"""Session settings for local runs; a cluster session needs only the adaptive ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that the operators count on at any scale; all are Spark's defaults today.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
}


def local_session(cpus: int = 8, app: str = "accolade", folder: str | None = None) -> SparkSession:
    """A session on this machine: as many shuffle partitions as threads, no web page.

    ``folder`` takes the place of ``spark.checkpoint.dir`` where that is not set.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per expression
    )
    for key, value in SCALE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if folder and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(folder)
    return spark
