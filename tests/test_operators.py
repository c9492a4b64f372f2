import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plan_text import plan_of
from veil.operators import chains, identity, persons, rewrite
from veil.operators.chains import apply_chain, register_op
from veil.plans.tables import keep


def run(df, column, *steps, cols=()):
    return apply_chain(df, column, {"cols": list(cols)} | {i + 1: s for i, s in enumerate(steps)})


def values(df, name):
    return [r[name] for r in df.collect()]


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "kim", 10, "010-1234-5678"), (2, "lee", 20, None), (3, "kim", 30, "02-555-1"), (4, None, None, "x")]
    return spark.createDataFrame(data, "id long, name string, pay int, phone string").coalesce(1)


# --- rewriting


def test_hash_step_needs_a_salt(people):
    with pytest.raises(ValueError, match="salt"):
        run(people, "name", {"fn": "hash", "origin": "{0}"})
    out = run(people, "name", {"fn": "hash", "origin": "{0}", "salt": ""})
    assert [v is None for v in values(out, "_x_name_1")] == [False, False, False, True]


def test_replace_regexp_in_sequence(people):
    rules = [{"c": r"\d{4}", "v": "####"}, {"c": r"^(\d+)-", "v": "<$1>"}]
    out = run(people, "phone", {"fn": "replace_regexp", "match": "{0}", "expr": rules})
    assert values(out, "_x_phone_1") == ["<010>####-####", None, "<02>555-1", "x"]


def test_replace_branches(people):
    out = run(
        people,
        "pay",
        {"fn": "replace", "expr": [{"c": "{0} >= 20", "v": "{0} * 2"}, {"c": "{$0}", "r": "^k", "v": None}], "else": -1},
        {"fn": "replace", "else": "{1} + 1", "type": "long"},
        cols=["name"],
    )
    assert values(out, "_x_pay_1") == [None, 40, 60, -1]
    assert dict(out.dtypes)["_x_pay_2"] == "bigint" and values(out, "_x_pay_2") == [None, 41, 61, 0]


def test_unknown_operator_and_registration(people):
    with pytest.raises(ValueError, match="unknown operator"):
        run(people, "pay", {"fn": "nothing"})
    register_op("double", lambda df, step: df.withColumn(step.output, step.expr("{0} * 2")))
    try:
        assert values(run(people, "pay", {"fn": "double"}), "_x_pay_1") == [20, 40, 60, None]
    finally:
        del chains.OPS["double"]


def test_mapping_from_files(spark, people, tmp_path):
    spark.createDataFrame([("kim", "K", 1), (None, "N", 2)], "n string, code string, rank int").write.parquet(
        str(tmp_path / "names.parquet")
    )
    where = {"directory": str(tmp_path), "filename": "names.parquet", "key": "n", "value": "code"}
    out = run(people, "name", {"fn": "mapping", "match": "{0}", "map": where})
    assert sorted(values(out, "_x_name_1"), key=str) == ["K", "K", "N", None]


def test_select_block(people):
    out = rewrite.select_block(people, ["pay > 5", "name = 'kim'"], ["name"], {"who": "name", "n": "count"})
    assert [tuple(r) for r in out.collect()] == [("kim", 2)]
    assert dict(rewrite.add_null_columns(people, ["a"]).dtypes)["a"] == "string"


def test_occupation_codes(spark):
    df = spark.createDataFrame([("1", "가", "a"), ("123456", "나", "b"), (None, "다", "c")], "`코드` string, `국문 항목명` string, `영문 항목명` string")
    out = rewrite.occupation_codes(df)
    assert out.columns == ["code", "name_ko", "name_en"] and values(out, "code") == ["10000", "123456", None]


# --- suppression and coding


def test_local_delete(people):
    with pytest.raises(ValueError, match="under"):
        run(people, "name", {"fn": "local_delete"})
    out = run(people, "name", {"fn": "local_delete", "under": 2}, {"fn": "local_delete", "regexp": "^l", "origin": "{0}"})
    assert sorted(values(out, "_x_name_1"), key=str) == [None, None, "kim", "kim"]
    assert sorted(values(out, "_x_name_2"), key=str) == [None, None, "kim", "kim"]
    both = run(people, "pay", {"fn": "local_delete", "under": 1, "regexp": "^2"})
    assert dict(both.dtypes)["_x_pay_1"] == "int" and sorted(values(both, "_x_pay_1"), key=str) == [10, 30, None, None]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.sampled_from([1, 2, 3, 4, None]), max_size=25), under=st.integers(1, 6))
def test_no_small_cell_survives(spark, data, under):
    df = spark.createDataFrame([(v,) for v in data], "v int")
    left = run(df, "v", {"fn": "local_delete", "under": under}).where("_x_v_1 IS NOT NULL")
    assert left.groupBy("_x_v_1").count().where(F.col("count") < under).count() == 0
    assert left.where("v <> _x_v_1").count() == 0


@pytest.mark.parametrize("rule", ["3sigma", "1.5iqr"])
def test_coding_bounds_outliers(spark, rule):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v")).union(
        spark.createDataFrame([(1e6,), (-1e6,), (None,)], "v double")
    )
    out = run(df, "v", {"fn": "top_bottom_coding", "top": rule, "bottom": rule})
    row = out.agg(F.min("_x_v_1"), F.max("_x_v_1"), F.count("_x_v_1"), F.count_if(F.expr("v = _x_v_1"))).first()
    assert -1e6 < row[0] and row[1] < 1e6 and row[2] == 102 and row[3] == 100
    # a bound of its own side only
    only_bottom = run(df, "v", {"fn": "top_bottom_coding", "bottom": rule})
    assert only_bottom.agg(F.max("_x_v_1")).first()[0] == 1e6 and only_bottom.agg(F.min("_x_v_1")).first()[0] == row[0]


def test_coding_joins_and_shuffles_nothing(spark, tmp_path):
    path = str(tmp_path / "v.parquet")
    spark.range(100).withColumn("other", F.lit("x")).write.parquet(path)
    out = run(spark.read.parquet(path), "id", {"fn": "top_bottom_coding", "top": "3sigma", "bottom": [5, 5]})
    main_plan = plan_of(out).split("===== Subqueries =====")[0]
    assert "Join" not in main_plan and "Exchange" not in main_plan


def test_coding_without_effect(people):
    out = run(people, "pay", {"fn": "top_bottom_coding"}, {"fn": "top_bottom_coding", "top": [20, 0]})
    assert values(out, "_x_pay_1") == [10, 20, 30, None] and values(out, "_x_pay_2") == [10, 20, 0, None]
    one = people.where("id = 1")
    assert values(run(one, "pay", {"fn": "top_bottom_coding", "top": "3sigma"}), "_x_pay_1") == [10]
    with pytest.raises(ValueError, match="string column"):
        run(people, "name", {"fn": "top_bottom_coding", "top": "1.5iqr"})
    with pytest.raises(ValueError, match="unknown rule"):
        run(people, "pay", {"fn": "top_bottom_coding", "top": "2sigma"})


# --- persons and noise


def test_counter_is_kept_and_extended(spark, people, tmp_path):
    settings_ = {"fn": "person_counter", "match": ["{0}"], "directory": str(tmp_path)}
    first = run(people.where("id < 3"), "name", settings_)
    numbers = {r["name"]: r["_x_name_1"] for r in first.collect()}
    assert sorted(numbers.values()) == [1, 2]
    later = {r["name"]: r["_x_name_1"] for r in run(people, "name", settings_).collect()}
    assert later == numbers | {None: None}
    grown = {r["name"]: r["_x_name_1"] for r in run(people, "name", settings_ | {"extend": True}).collect()}
    assert grown == numbers | {None: 3}
    assert (tmp_path / "person_counter.name.parquet").exists()


def test_counter_order_can_be_secret(spark):
    df = spark.range(200).select(F.col("id").alias("p"))
    plain = [r["_value"] for r in persons.counter_table(df, ["p"]).orderBy("p").collect()]
    secret = [r["_value"] for r in persons.counter_table(df, ["p"], seed="s").orderBy("p").collect()]
    assert plain == list(range(1, 201)) and secret != plain and sorted(secret) == plain
    assert secret == [r["_value"] for r in persons.counter_table(df, ["p"], seed="s").orderBy("p").collect()]


@pytest.mark.parametrize("extra", [{}, {"seed": "k"}, {"seed": "k", "directory": True}])
def test_person_noise_is_constant_per_person(spark, tmp_path, extra):
    extra = {k: str(tmp_path) if v is True else v for k, v in extra.items()}
    df = spark.range(400).select("id", (F.col("id") % 20).alias("p"))
    out = run(df, "p", {"fn": "person_noise", "match": "{0}", "origin": "{0} * 100", "range": [-40, 40]} | extra)
    assert "_x_noise_1" not in out.columns
    moved = out.select("p", (F.col("_x_p_1") - F.col("p") * 100).alias("d")).distinct().collect()
    assert len(moved) == 20 and all(-40 <= r["d"] <= 40 for r in moved)


@pytest.mark.parametrize("seed", [{}, {"seed": "k"}])
def test_person_date_noise(spark, seed):
    day = datetime.date(2024, 2, 28)
    df = spark.createDataFrame([(1, day, 1), (2, day, 1), (3, None, 2)], "id int, d date, p int")
    step = {"fn": "person_noise_date", "match": "p", "origin": "{0}", "range_day": [3, 9]} | seed
    out = run(df, "d", step, step | {"range_minute": [61, 90]}, step | {"range_day": None, "range_minute": [1, 1]})
    rows = out.orderBy("id").collect()
    assert rows[0]["_x_d_1"] == rows[1]["_x_d_1"] and 3 <= (rows[0]["_x_d_1"] - day).days <= 9
    moved = rows[0]["_x_d_2"] - datetime.datetime(2024, 2, 28)
    assert 3 <= moved.days <= 9 and 61 <= moved.seconds // 60 <= 90
    assert rows[0]["_x_d_3"] == datetime.datetime(2024, 2, 28, 0, 1)
    assert rows[2]["_x_d_1"] is None and rows[2]["_x_d_2"] is None


def test_row_noise(spark):
    df = spark.range(500)
    out = run(df, "id", {"fn": "noise", "origin": "{0}", "range": [2, 4]})
    found = {r[0] for r in out.select(F.col("_x_id_1") - F.col("id")).distinct().collect()}
    assert found == {2, 3, 4}
    with pytest.raises(ValueError, match="keys"):
        run(df, "id", {"fn": "noise", "origin": "{0}", "range": [2, 4], "seed": "x"})


# --- row ids


def test_row_numbers_over_ties_and_many_partitions(spark):
    ids = spark.range(5000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("v"))
    out = identity.number_rows(ids, "v", column="n", start=10)
    rows = out.orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(10, 5010))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)
    # the frequent value fills more than one slice
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    slices = identity.ordered_slices(ids, "v").df
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert slices.where("v = 1").select(identity.SLICE).distinct().count() > 1


def test_row_numbers_of_nothing_and_one(spark):
    none = spark.range(0)
    assert identity.number_rows(none, "id", column="n").count() == 0
    assert values(identity.number_rows(spark.range(1), "id", column="n"), "n") == [1]


def test_no_window_over_all_rows(spark):
    df = identity.number_rows(spark.range(1000), "id", column="n")
    rows_plan = plan_of(df, "simple")
    # the only single-partition step works on one row per slice, below the broadcast
    assert rows_plan.index("BroadcastExchange") < rows_plan.index("SinglePartition")


def test_keep_measures(spark):
    kept = keep(spark.createDataFrame([("abc",), (None,)], "v string"), "t")
    assert kept.rows == 2 and kept.bytes == 51 and kept.small
    assert kept.df.count() == 2
