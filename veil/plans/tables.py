"""Tables written between two parts of a plan, and the size checks that rest on them."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 32 << 20
# Allowance per value for row headers and hash table entries.
VALUE_OVERHEAD = 24


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from the session's ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="veil-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@dataclass(frozen=True)
class Kept:
    """A written table with its measured number of rows and bytes."""

    df: DataFrame
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def keep(df: DataFrame, label: str) -> Kept:
    """Write a table to the shared folder and read it back, measuring it on the way.

    Cuts the lineage like a checkpoint, survives lost executors, and stays columnar, so that later
    reads are pruned and Catalyst knows the size on disk.
    """
    path = f"{scratch_folder(df.sparkSession)}/veil/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_width(df)).alias("bytes")).write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    return Kept(kept, seen.get["rows"], seen.get["bytes"] or 0)


def measure(df: DataFrame) -> Kept:
    """The rows and bytes of a table, from one aggregate over all of it."""
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_width(df)).alias("bytes")).first()
    return Kept(df, sizes["rows"], sizes["bytes"] or 0)


def _width(df: DataFrame) -> Column:
    width = F.lit(VALUE_OVERHEAD * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if f.dataType.typeName() not in _FIXED_WIDTH:
            width = width + F.coalesce(F.octet_length(c.cast("string")), F.lit(0))
    return width


_FIXED_WIDTH = {
    "boolean", "byte", "short", "integer", "long", "float", "double", "decimal",
    "date", "timestamp", "timestamp_ntz",
}
