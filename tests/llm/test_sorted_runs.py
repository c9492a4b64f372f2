"""The tree of op9: each level reads runs that were exchanged and sorted, and merges them without another sort."""

import re

from pyspark.sql import functions as F

from tests.plan_text import plan_of
from veil.llm import exact_dedup


def test_every_level_merges_sorted_runs(spark):
    docs = spark.range(500).select((F.col("id") % 90).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 40).alias("text"))
    rows = exact_dedup.stored(exact_dedup.digest_runs(docs), "runs")
    level = exact_dedup.merged_runs(rows, 1, F.struct("doc_id", "row"), F.lit(1).cast("long"))
    for _ in range(2):
        level = exact_dedup.merged_runs(level, 8, F.col("first"), F.col("size"))
    plan = plan_of(level, "simple")
    nodes = re.findall(r"(SortAggregate|HashAggregate|ObjectHashAggregate|Sort|Exchange) ?[\[(h]", plan)
    assert nodes == ["SortAggregate", "SortAggregate", "Sort", "Exchange"] * 3
    # runs are exchanged by range of digests, so a level never lies in one partition
    assert plan.count("hashpartitioning(range#") == 3
    assert level.agg(F.sum("size")).first()[0] == 500
    assert level.count() == level.select("run", "digest").distinct().count() < 500


def test_ranges_of_a_level_fill_many_partitions(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows = exact_dedup.digest_runs(docs)
    root = exact_dedup.merged_runs(rows, 8**3, F.struct("doc_id", "row"), F.lit(1).cast("long"))
    sizes = [r["count"] for r in root.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
