"""Small helpers of the text operators: the text column, and tables written between two parts of a job."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veil.plans.tables import scratch_folder

# Whether a query's shuffle files go when it ends; without it they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back, in the types of ``schema`` if given.

    Later parts of a job read it instead of repeating the work before it, and a lost executor costs
    a re-read only. So nothing needs the shuffle files of the write after it, and Spark removes them at its end.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/veil-llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(schema or df.schema).parquet(path)


def column(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, entries: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of rows with the one entry of their key, without sending a frequent key to one task.

    ``entries`` is a stored table whose ``weight`` is the number of rows with the key. Keys above the
    fair share of a shuffle partition, of which there are no more than partitions, are broadcast.
    """
    n = partitions(rows.sparkSession)
    total = entries.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * n > F.lit(total)
    hot, cold = entries.where(heavy).drop(weight), entries.where(~heavy).drop(weight)
    if hot.isEmpty():
        return rows.join(cold, key)
    # at most one row per shuffle partition
    hot = F.broadcast(hot)
    others = rows.join(hot.select(key), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(others)
