"""What operators hold on disk while they run."""

import time

from pyspark.sql import functions as F

from gleaner.llm import passages
from gleaner.scratch import TIDY, Scratch


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark):
    before, scratch, setting = _shuffle_files(spark), Scratch(spark, "t"), spark.conf.get(TIDY, None)
    df = spark.range(1000).groupBy((F.col("id") % 300).alias("k")).count()
    assert scratch.write(df, "counts").count() == 300
    counted = _shuffle_files(spark) - before
    written = scratch.write(df.join(df.withColumnRenamed("count", "n"), "k"), "joined")
    for _ in range(50):
        left = _shuffle_files(spark) - before - counted
        if not left:
            break
        time.sleep(0.1)
    assert not left and written.count() == 300 and spark.conf.get(TIDY, None) == setting
    scratch.clear()


def test_pieces_are_gone_before_texts_are_shuffled(spark, sf_dir, monkeypatch):
    held, dropped = [], []
    inner_runs, inner_drop = passages.anchor_runs, Scratch.drop

    def drop(self, *frames):
        dropped.extend(f._scratch_path.rsplit("-", 1)[-1] for f in frames if hasattr(f, "_scratch_path"))
        inner_drop(self, *frames)

    def runs(*args):
        held.append("pieces" in dropped)
        return inner_runs(*args)

    monkeypatch.setattr(Scratch, "drop", drop)
    monkeypatch.setattr(passages, "anchor_runs", runs)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert passages.repeated_spans(docs).count() and held == [True]
