"""A kept table of keys and values that grows by versions, each published at once.

A version is a folder of its own. It counts from the moment Spark's committer puts the success mark there,
so a write that dies leaves the table as it was, and the next one takes another folder. All versions are
bucketed in the same number of buckets by one text of the key columns, written in order: when the keys of
a new run are looked for, only those keys are shuffled, never the table. Many small versions are merged into
a full one, which replaces those before it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.functions.templates import quoted

KEY = "_key"
# With more versions than this the next one is a full one.
MERGE_AFTER = 8
_VERSION = re.compile(r"v(\d{6})-b(\d+)(-full)?-[0-9a-f]+")


@dataclass(frozen=True, order=True)
class Version:
    number: int
    folder: str
    buckets: int
    full: bool


def key_text(keys: Sequence[str]) -> Column:
    """One text for the key columns, equal where all of them are equal or null together."""
    parts = []
    for k in keys:
        c = F.col(quoted(k))
        # numbers have one zero, but texts for two
        zero = F.typeof(c).isin("double", "float") & (c.cast("string") == "-0.0")
        text = F.when(zero, F.lit("0.0")).otherwise(c.cast("string"))
        # the length keeps neighbouring parts apart
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


class Store:
    """The table in a folder, by its key columns."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path, list(keys)

    def versions(self) -> list[Version]:
        """The published versions that make up the table, oldest first."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = []
        for name in names:
            match = _VERSION.fullmatch(name)
            if match and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")):
                found.append(Version(int(match[1]), name, int(match[2]), bool(match[3])))
        found.sort()
        last = max((i for i, v in enumerate(found) if v.full), default=0)
        return found[last:] if found and found[last].full else found

    def table(self) -> DataFrame | None:
        """Key columns and values of all versions, or None before the first one."""
        parts = [self.spark.read.parquet(f"{self.path}/{v.folder}") for v in self.versions()]
        return reduce(DataFrame.unionByName, parts).drop(KEY) if parts else None

    def missing(self, df: DataFrame) -> DataFrame:
        """The distinct keys of ``df`` that no version has."""
        versions = self.versions()
        new = df.select(*[F.col(quoted(k)) for k in self.keys]).distinct().withColumn(KEY, key_text(self.keys))
        if versions:
            new = new.repartition(versions[0].buckets, KEY)
        for v in versions:
            new = new.join(self._bucketed(v).select(KEY), KEY, "left_anti")
        return new.select(*[F.col(quoted(k)) for k in self.keys])

    def publish(self, df: DataFrame) -> None:
        """Add the rows of ``df``, whose keys no version has."""
        versions = self.versions()
        buckets = versions[0].buckets if versions else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        full = len(versions) >= MERGE_AFTER
        if full:
            df = self.table().unionByName(df)
        number = versions[-1].number + 1 if versions else 1
        folder = f"{self.path}/v{number:06d}-b{buckets}{'-full' if full else ''}-{uuid.uuid4().hex}"
        name = f"veil_store_{uuid.uuid4().hex}"
        dealt = df.withColumn(KEY, key_text(self.keys)).repartition(buckets, KEY)
        # bucketed writing needs a name in the catalog; the name goes again, the files stay
        try:
            dealt.write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", folder).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _bucketed(self, version: Version) -> DataFrame:
        """A version with its buckets known to the planner."""
        folder = f"{self.path}/{version.folder}"
        columns = self.spark.read.parquet(folder).schema.toDDL()
        name = f"veil_store_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {version.buckets} BUCKETS LOCATION '{folder}'"
        )
        try:
            return self.spark.table(name)
        finally:
            # the analysed table keeps its files and buckets
            self.spark.sql(f"DROP TABLE {name}")
