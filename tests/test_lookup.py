import pytest
from pyspark.sql import functions as F

from veil.operators import lookup as module
from veil.operators.lookup import attach_group_count, lookup, lookup_totals
from veil.operators.suppress import keep_singletons, suppress_rare
from veil.plans import tables

from plan_text import plan_of


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Tables count as too large to broadcast, by our check and by Spark's."""
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 2000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def shuffle_keys(df):
    return " ".join(line for line in plan_of(df, "simple").splitlines() if "hashpartitioning" in line)


def tasks_of_hot_rows(df):
    return df.where("k = 7").select(F.spark_partition_id()).distinct().count()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def facts(spark):
    """A third of the rows share key 7, some keys are null, some unknown."""
    ids = spark.range(3000, numPartitions=8)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700)
    return ids.select("id", key.alias("k"), (F.col("id") % 2).alias("p"))


@pytest.fixture
def entries(spark):
    return spark.range(600).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("val")).union(
        spark.createDataFrame([(None, "nothing")], "key long, val string")
    )


def plain(facts, entries):
    return facts.join(entries, facts.k.eqNullSafe(entries.key), "left").select("id", "k", "p", "val")


def test_small_table(facts, entries):
    assert rows(lookup(facts, entries, ["k"], ["key"], {"val": "val"})) == rows(plain(facts, entries))


def test_large_table_with_a_hot_key(no_broadcast, facts, entries):
    got = lookup(facts, entries, ["k"], ["key"], {"val": "val"})
    assert rows(got) == rows(plain(facts, entries))
    assert "_salt" in shuffle_keys(got)


def test_hot_rows_spread_over_the_shuffle(no_broadcast, no_coalescing, facts, entries):
    assert tasks_of_hot_rows(plain(facts, entries)) == 1
    assert tasks_of_hot_rows(lookup(facts, entries, ["k"], ["key"], {"val": "val"})) > 3
    assert tasks_of_hot_rows(attach_group_count(facts, ["k"], "n")) > 3
    assert tasks_of_hot_rows(suppress_rare(facts, F.col("k"), 4, "out")) > 3


def test_traffic_finds_hot_keys_only(facts):
    found = module._traffic(facts.select(F.xxhash64("k").alias("h")))
    assert found == [facts.where("k = 7").select(F.xxhash64("k")).first()[0]]
    assert module._traffic(facts.where("id < 0").select(F.xxhash64("k").alias("h"))) == []


def test_hot_groups_of_counts(spark, facts):
    hot = module.hot_groups(module.group_counts(facts, ["k"]))
    assert [tuple(r) for r in hot.collect()] == [(7, facts.where("k = 7").count())]


def test_keys_of_different_types(no_broadcast, spark, facts, entries):
    table = entries.withColumn("key", F.col("key").cast("double"))
    got = lookup(facts, table, ["k"], ["key"], {"val": "val"})
    assert rows(got) == rows(plain(facts, entries)) and "_salt" in shuffle_keys(got)
    zeros = spark.range(64, numPartitions=4).select("id", F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("z"))
    names = spark.range(100).select((F.col("id") - 1).cast("double").alias("key"), F.lit("n").alias("val"))
    assert lookup(zeros, names, ["z"], ["key"], {"val": "val"}).where("val IS NULL").count() == 0


def test_counts_of_repeated_rows_come_from_the_source(no_broadcast, facts):
    doubled = facts.union(facts)
    got = attach_group_count(doubled, ["k"], "n", source=facts, same_rows=False, null_keys="group")
    counts = {r["k"]: r["count"] for r in facts.groupBy("k").count().collect()}
    assert got.count() == 6000 and all(r["n"] == counts[r["k"]] for r in got.collect())


def test_repeated_keys_repeat_rows_even_when_hot(no_broadcast, facts, entries):
    twice = entries.union(entries.where("key = 7 OR key = 8"))
    assert rows(lookup(facts, twice, ["k"], ["key"], {"val": "val"})) == rows(plain(facts, twice))
    with pytest.raises(ValueError, match="repeats keys"):
        lookup(facts, twice, ["k"], ["key"], {"val": "val"}, unique=True)


def test_hot_key_repeated_beyond_broadcast(spark, no_broadcast, facts, entries):
    many = entries.union(spark.range(200).select(F.lit(7).alias("key"), F.lit("again").alias("val")))
    got = lookup(facts, many, ["k"], ["key"], {"val": "val"})
    assert got.count() == plain(facts, many).count()


def test_null_may_be_the_hot_key(no_broadcast, no_coalescing, facts, entries):
    mostly_null = facts.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    got = lookup(mostly_null, entries, ["k"], ["key"], {"val": "val"})
    assert rows(got) == rows(plain(mostly_null, entries))
    assert got.where("k IS NULL").select(F.spark_partition_id()).distinct().count() > 3
    grouped = attach_group_count(mostly_null, ["k"], "n", null_keys="group")
    nulls = mostly_null.where("k IS NULL").count()
    assert [tuple(r) for r in grouped.where("k IS NULL").select("n").distinct().collect()] == [(nulls,)]
    assert grouped.where("k IS NULL").select(F.spark_partition_id()).distinct().count() > 3
    assert suppress_rare(mostly_null, F.col("k"), 4, "out").where("k IS NULL AND out IS NOT NULL").count() == 0


def test_composite_keys(no_broadcast, facts, entries):
    table = entries.withColumn("half", F.col("key") % 2)
    got = lookup(facts, table, ["k", F.col("p")], ["key", "half"], {"val": "val"})
    same = facts.k.eqNullSafe(table.key) & facts.p.eqNullSafe(table.half)
    assert rows(got) == rows(facts.join(table, same, "left").select("id", "k", "p", "val"))


def test_key_counts_must_agree(facts, entries):
    with pytest.raises(ValueError, match="match columns"):
        lookup(facts, entries, ["k", "p"], ["key"], {"val": "val"})


@pytest.mark.parametrize("large", [False, True])
def test_group_count(request, facts, large):
    if large:
        request.getfixturevalue("no_broadcast")
    found = attach_group_count(facts, ["k"], "n")
    grouped = attach_group_count(facts, ["k"], "n", null_keys="group")
    counts = {r["k"]: r["count"] for r in facts.groupBy("k").count().collect()}
    assert all(r["n"] == (None if r["k"] is None else counts[r["k"]]) for r in found.collect())
    assert all(r["n"] == counts[r["k"]] for r in grouped.collect())
    assert found.count() == facts.count()
    with pytest.raises(ValueError, match="null_keys"):
        attach_group_count(facts, ["k"], "n", null_keys="keep")


def test_group_count_with_any_null_part(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, 2)], "a int, b int")
    assert [r["n"] for r in attach_group_count(df, ["a", "b"], "n").orderBy("a", "b").collect()] == [None, None, None, 1]


@pytest.mark.parametrize("under", [2, 5, 2000])
@pytest.mark.parametrize("large", [False, True])
def test_suppress_rare(request, facts, under, large):
    if large:
        request.getfixturevalue("no_broadcast")
    counts = {r["k"]: r["count"] for r in facts.groupBy("k").count().collect()}
    got = suppress_rare(facts, F.col("k"), under, "out").collect()
    assert len(got) == 3000
    assert all(r["out"] == (r["k"] if r["k"] is not None and counts[r["k"]] >= under else None) for r in got)


@pytest.mark.parametrize("large", [False, True])
def test_keep_singletons(request, facts, large):
    if large:
        request.getfixturevalue("no_broadcast")
    counts = {r["k"]: r["count"] for r in facts.groupBy("k").count().collect()}
    counts = {(r["k"], r["p"]): r["count"] for r in facts.groupBy("k", "p").count().collect()}
    want = [tuple(r) for r in facts.collect() if counts[(r["k"], r["p"])] == 1]
    assert rows(keep_singletons(facts, ["k", "p"], "group")) == sorted(want, key=str)
    want = [w for w in want if w[1] is not None]
    assert rows(keep_singletons(facts, ["k", "p"])) == sorted(want, key=str)


def test_one_null_key_is_single_only_when_grouped(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c"), (2, "d")], "k int, v string")
    assert rows(keep_singletons(df, ["k"])) == [(1, "b")]
    assert rows(keep_singletons(df, ["k"], "group")) == [(1, "b"), (None, "a")]
    assert rows(keep_singletons(df.select("k"), ["k"])) == [(1,)]


def test_empty_input(spark, facts, entries):
    none = facts.where("id < 0")
    assert lookup(none, entries, ["k"], ["key"], {"val": "val"}).count() == 0
    assert attach_group_count(none, ["k"], "n").count() == 0
    assert suppress_rare(none, F.col("k"), 3, "out").count() == 0
    assert keep_singletons(none, ["k"]).count() == 0


def test_grid_of_a_key_frequent_on_both_sides(spark, no_coalescing):
    """Rows and entries of the key are cut; copies stay bounded by the fair share, and no cell holds more."""
    facts = spark.range(8000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(-5)).otherwise(F.col("id")).alias("k"))
    table = spark.range(3000).select(F.when(F.col("id") < 2400, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("val"))
    got = lookup(facts, table, ["k"], ["key"], {"val": "val"}, broadcast_bytes=0)
    wanted = facts.join(table, F.col("k").eqNullSafe(F.col("key")), "left")
    sums = [F.count(F.lit(1)), F.sum("id"), F.sum("val"), F.sum(F.col("id") * F.coalesce("val", F.lit(-1)))]
    assert got.agg(*sums).first() == wanted.agg(*sums).first()
    share = 8000 // 8
    rows, entries = 2667, 2400
    row_slices, entry_slices = -(-rows // share), -(-entries // share)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    cells = got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(cells) > 1 and sum(c["count"] for c in cells) == rows * entries
    assert max(c["count"] for c in cells) < 0.6 * rows * entries
    # a cell takes one slice of either side
    copies = row_slices * entries + entry_slices * rows
    assert copies <= row_slices * entry_slices * 2 * share


def test_salts_follow_the_shuffle_partitions(spark, facts):
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        largest = facts.select(module._row_salt(facts).alias("s")).agg(F.max("s")).first()[0]
        assert 256 < largest < 1200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("limit", [0, None])
def test_totals_of_a_key_frequent_on_both_sides(spark, limit):
    """Entries are combined before rows meet them: 900 million pairs are never formed. Keys are compared as their common type."""
    facts = spark.range(30_000).select("id", F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 3 == 0, F.col("id") % 30).alias("k"))
    facts = facts.select("id", F.when(F.col("k") != 3, F.col("k")).alias("k"))
    entries = spark.range(45_000).select(F.when(F.col("id") < 40_000, "7").when(F.col("id") < 44_000, "07").when(F.col("id") > 44_500, "9").alias("key"), F.col("id").alias("val"))
    totals = {"n": F.count(F.lit(1)), "k": F.sum("val")}
    got = lookup_totals(facts.withColumn("m", F.col("k")), entries, ["m"], ["key"], totals, broadcast_bytes=limit)
    assert got.count() == 30_000
    found = {r["m"]: (r["n"], r["k"], r["rows"]) for r in got.groupBy("m", "n", "k").agg(F.count(F.lit(1)).alias("rows")).collect()}
    assert found[7][:2] == (44_000, sum(range(44_000))) and found[7][2] == 20_000
    assert found[None][:2] == (501, sum(range(44_000, 44_501))) and found[9][:2] == (499, sum(range(44_501, 45_000)))
    assert found[0][:2] == (None, None)
    with pytest.raises(ValueError, match="match columns"):
        lookup_totals(facts, entries, ["k"], ["key", "val"], totals)
