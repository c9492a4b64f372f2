"""Stored tables leave no shuffle files behind."""

from pyspark.sql import functions as F

from veil.llm import common


def _held(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before = _held(spark)
    setting = spark.conf.get(common._CLEANUP, None)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("n"))
    kept = common.stored(rows, "test")
    assert _held(spark) <= before
    assert spark.conf.get(common._CLEANUP, None) == setting
    assert kept.agg(F.sum("n")).first()[0] == sum(range(10_000))
