"""Written intermediate tables in the folder that all executors share.

A table written here cuts the lineage, survives lost executors and can be
scanned again. The folder is the one that the session names in
``spark.checkpoint.dir``; only on a local master (tests, a shell) is a temporary
folder made where none is named. Tables that lazy results refer to stay until
``release`` deletes them, which a caller does when the results are consumed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from gleaner.session import ship


def shared_folder(spark: SparkSession) -> str:
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


#: With this, Spark deletes the shuffle files of a write when it ends, and not when the
#: driver happens to collect its garbage; versions without it ignore it.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders of this process that are not cleared yet.
_OPEN: list[Scratch] = []


def release() -> None:
    """Delete what all runs of this process have written."""
    while _OPEN:
        _OPEN[-1].clear()


class Scratch:
    """Names tables of one run in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self._count = ship(spark), f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        _OPEN.append(self)

    def place(self, name: str) -> str:
        self._count += 1
        return f"{self.path}/{self._count:03d}-{name}"

    def write(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """Write and scan again. What the write shuffled is deleted with its end."""
        path, conf = self.place(name), self.spark.conf
        before = conf.get(TIDY, None)
        conf.set(TIDY, "true")
        try:
            df.write.option("compression", codec).parquet(path)
        finally:
            conf.unset(TIDY) if before is None else conf.set(TIDY, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing lazy refers to any more."""
        for df in frames:
            if path := getattr(df, "_scratch_path", None):
                self.delete(path)

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def clear(self) -> None:
        self.delete(self.path)
        if self in _OPEN:
            _OPEN.remove(self)
