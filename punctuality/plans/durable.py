"""Intermediate results that outlive the executors that computed them."""

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    Clusters name a shared folder in ``spark.checkpoint.dir``. Where that is unset, a local session
    uses a folder in its warehouse; elsewhere that could be a folder of one machine, so it is an error.
    """
    context = spark.sparkContext
    if folder := context.getCheckpointDir():
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder and read it from there.

    A cached table would be recomputed from the source when an executor is lost;
    for a small result of a long scan that is the whole job again.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
