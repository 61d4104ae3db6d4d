"""Session settings shared by the entry points."""

from pyspark.sql import SparkSession

# What every run wants. Master, memory and the checkpoint folder belong to the
# deployment (spark-submit or spark-defaults.conf) and are not set here; neither
# is a shuffle width, since AQE coalesces partitions to the data's size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints of results that nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # HotSpot leaves longer methods to the interpreter; Spark then runs the operators of
    # such a stage one by one, which is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name: str = "punctuality", log_level: str = "ERROR", **extra: str) -> SparkSession:
    """Build or reuse a session; ``extra`` is laid over :data:`SETTINGS`."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
