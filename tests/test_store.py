"""The kept table of keys: versions, what is shuffled, and writes that die."""

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from veil.operators import persons, store


def build(df, start):
    return persons.counter_table(df, ["a", "b"], start)


@pytest.fixture
def people(spark):
    rows = [(i % 40 if i % 7 else None, str(i % 3) if i % 5 else None) for i in range(300)]
    return spark.createDataFrame(rows, "a int, b string")


def test_versions_hold_every_key_once(spark, people, tmp_path):
    path = str(tmp_path / "s")
    persons.pseudonym_table(people.where("a < 20"), ["a", "b"], build, path)
    for limit in (25, 30, 30, 41):
        table = persons.pseudonym_table(people.where(f"a < {limit} OR a IS NULL"), ["a", "b"], build, path, extend=True)
    keys = people.distinct()
    assert table.count() == keys.count() == table.select("a", "b").distinct().count()
    assert sorted(r._value for r in table.collect()) == list(range(1, keys.count() + 1))
    assert len(store.Store(spark, path, ["a", "b"]).versions()) == 4  # one run had no new keys


def test_only_new_keys_are_shuffled(spark, tmp_path):
    people = spark.range(20_000).select((F.col("id") % 9000).alias("a"), F.lit("x").alias("b"))
    kept = store.Store(spark, str(tmp_path / "s"), ["a", "b"])
    kept.publish(build(people.where("a < 8000"), 1))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = kept.missing(people)
        assert fresh.count() == 1000
        plan = plan_of(fresh)
        side = plan[plan.index("SortMergeJoin") :].split("LeftAnti")[1]
        assert "SelectedBucketsCount: 8 out of 8" in plan
        # exchanges lie on the side of the new keys only: none stands above the scan of the store
        scan = next(i for i, line in enumerate(side.splitlines()) if "SelectedBucketsCount" in line)
        above = [line for line in side.splitlines()[max(0, scan - 4) : scan] if "Exchange" in line]
        assert not above, side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_write_that_dies_leaves_the_old_version(spark, people, tmp_path):
    path = str(tmp_path / "s")
    before = sorted(map(tuple, persons.pseudonym_table(people.where("a < 20"), ["a", "b"], build, path).collect()))

    def dying(df, start):
        fail = F.udf(lambda v: 1 // (0 if v == 30 else 1) + v, "long")
        return build(df, start).withColumn("_value", F.when(F.col("a") == 30, fail("a")).otherwise(F.col("_value")))

    with pytest.raises(Exception):
        persons.pseudonym_table(people, ["a", "b"], dying, path, extend=True)
    kept = store.Store(spark, path, ["a", "b"])
    assert len(kept.versions()) == 1 and sorted(map(tuple, kept.table().collect())) == before
    table = persons.pseudonym_table(people, ["a", "b"], build, path, extend=True)
    assert table.count() == people.distinct().count()
    assert set(before) <= set(map(tuple, table.collect()))


def test_many_versions_are_merged(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.range(40).select(F.col("id").cast("int").alias("a"), F.lit(None).cast("string").alias("b"))
    for limit in range(4, 44, 3):
        table = persons.pseudonym_table(rows.where(f"a < {limit}"), ["a", "b"], build, path, extend=True)
    versions = store.Store(spark, path, ["a", "b"]).versions()
    assert len(versions) <= store.MERGE_AFTER and versions[0].full
    assert sorted(r._value for r in table.collect()) == list(range(1, 41))


def test_keys_that_look_alike(spark):
    rows = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3"), ("-", "3"), ("", None), (None, "")], "a string, b string")
    assert rows.select(store.key_text(["a", "b"])).distinct().count() == 6
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "a double")
    assert zeros.select(store.key_text(["a"])).distinct().count() == 2 - 1
