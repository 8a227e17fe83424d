"""Session defaults and table access."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Bytes of a batch that goes to a Python worker, at most: texts have any length.
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once for each Spark context, and
    bound the batches that they hold."""
    bound = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(bound) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, "_gleaner_shipped", False):
        home = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "gleaner"), "zip", os.path.dirname(home), os.path.basename(home))
        context.addPyFile(archive)
        context._gleaner_shipped = True
    return spark


def build_session(master: str = "local[*]", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": os.environ.get("GLEANER_DRIVER_MEMORY", "6g")} | extra
    spark = SparkSession.builder.master(master).appName("gleaner").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder. NTZ timestamps become UTC timestamps at the scan."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for column, kind in df.dtypes:
        if kind == "timestamp_ntz":
            df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df
