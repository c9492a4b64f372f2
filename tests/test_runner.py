"""A whole run from CSV to published files, and the steps as functions."""

import copy

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from veil.plans import steps
from veil.plans.runner import run_jobs

CSV = "seq,name,birth,age,pay\n" + "\n".join(
    f"{i},{'kim' if i % 3 else 'lee' + str(i)},1990-01-{i % 28 + 1:02d},{20 + i % 7},\"{i},000\"" for i in range(1, 61)
)


@pytest.fixture
def config(tmp_path):
    (tmp_path / "in.csv").write_text(CSV + "\n60,dup,1990-01-01,30,1\n")
    return {
        "catalog": "people",
        "storage": str(tmp_path / "out"),
        "step_org": {
            "in": {
                "directory": str(tmp_path),
                "filename": "in.csv",
                "type_cast": {"seq": "long", "age": "int", "pay": "double", "birth": "date"},
                "filter": "seq > 1",
            }
        },
        "step_pre": {
            "filter_in": "seq > 2",
            "column": {"name": {1: {"fn": "replace", "else": "upper({0})"}}},
            "remove_duplicated": ["seq"],
            "filter_out": "age < 100",
        },
        "step_deid": {
            "column": {
                "_jk": {"cols": ["seq", "birth"], 1: {"fn": "hash", "origin": "concat_ws('|', {$0}, {$1})", "salt": "s"}},
                "name": {1: {"fn": "local_delete", "under": 5}},
                "birth": {1: {"fn": "person_noise_date", "match": ["seq"], "origin": "{0}", "range_day": [1, 3], "seed": "n"}, "cols": ["seq"]},
                "age": {1: {"fn": "top_bottom_coding", "top": [25, 25], "bottom": "1.5iqr"}},
                "pay": {1: {"fn": "replace", "else": "round({0}, -4)"}, 2: {"fn": "replace", "else": "{-1} / 10000"}},
            }
        },
        "step_post": {"exclude": ["seq"], "filter_out": "age IS NOT NULL"},
        "step_dist_old": {"include": ["name", "age"]},
        "step_dist_new": {"exclude": ["pay"]},
        "step_sum_old": {"include": ["age", "pay", "name"]},
        "step_sum_new": {},
        "step_sample": {"default_filter": ["age > 20"], "filters": [{"filter": "age = 22", "count": 2}, {"count": 1}]},
    }


def csv(spark, path):
    return spark.read.option("header", True).csv(path)


def test_full_run(spark, config):
    before = copy.deepcopy(config)
    paths = run_jobs(
        spark, config, "org,pre,deid,post, post_1_file,post_jk,dist_old,dist_new,dist_org,sum_old,sum_new,sample,count"
    )
    assert config == before
    org, pre = spark.read.parquet(paths["org"]), spark.read.parquet(paths["pre"])
    assert org.count() == 60 and pre.count() == 57 and set(org.columns) == {"_rn", "seq", "name", "birth", "age", "pay"}
    assert csv(spark, f"{config['storage']}/step_pre/duplicated_jk_count.people.csv").collect() == [
        ("1", "57", "57"), ("2", "1", "2"),
    ]
    post = spark.read.parquet(paths["post"])
    assert post.columns == ["_rn", "name", "birth", "age", "pay"] and post.count() == 57
    row = post.join(pre.select("_rn", "seq", F.col("name").alias("n0"), F.col("pay").alias("p0"), F.col("birth").alias("b0")), "_rn")
    assert {r["name"] for r in row.collect()} == {"KIM", None}
    assert row.where("NOT (name <=> CASE WHEN n0 = 'KIM' THEN n0 END) OR pay <> round(p0, -4) / 10000").count() == 0
    assert row.where("datediff(birth, b0) NOT BETWEEN 1 AND 3").count() == 0 and row.agg(F.max("age")).first()[0] == 25

    exported, links = csv(spark, paths["post_1_file"]), csv(spark, paths["post_jk"])
    assert exported.count() == 57 and links.columns == ["_rn", "_jk"] and links.select("_jk").distinct().count() == 57
    assert {r["column"] for r in csv(spark, paths["dist_old"]).collect()} == {"name", "age"}
    assert {r["column"] for r in csv(spark, paths["dist_new"]).collect()} == {"name", "birth", "age"}
    profile = csv(spark, paths["sum_old"])
    assert [r["column"] for r in profile.collect()] == ["age", "pay"] and paths["sum_new"] is None
    lines = csv(spark, paths["sample"])
    assert lines.where("name = 'age'").count() == 3
    counts = {r["dataset"]: r for r in spark.read.json(paths["count"]).collect()}
    assert counts["in.csv"]["row_count"] == 60 and counts["in.csv"]["column_count"] == 5
    assert counts["data.people.csv"]["row_count"] == 57 and counts["data.people.csv"]["filesize"] > 0


def test_linkage_ids_in_the_data(spark, config):
    config |= {"data_with_jk": True, "step_pre": {"filter_out": "seq < 10"}}
    paths = run_jobs(spark, config, ["org", "pre", "deid", "post", "post_jk", "post_1_file"])
    assert "post_jk" not in paths
    assert csv(spark, paths["post_1_file"]).columns == ["_jk", "name", "birth", "age", "pay"]
    assert spark.read.parquet(paths["pre"]).agg(F.max("seq")).first()[0] == 9


def test_no_pre_step(spark, config):
    config = {k: v for k, v in config.items() if k != "step_pre"}
    paths = run_jobs(spark, config, ["org", "pre", "deid"])
    assert paths["pre"] is None and spark.read.parquet(paths["deid"]).count() == 60
    with pytest.raises(ValueError, match="unknown job"):
        run_jobs(spark, config, "org,nothing")


def test_publish_order_and_exclusion(spark):
    df = spark.createDataFrame([(1, "a", 2)], "_rn long, x string, y int")
    chains = {"y": {1: {"fn": "replace", "else": "{0} * 2"}}, "new": {1: {"fn": "replace", "else": "'n'"}}}
    done = steps.deidentify(df, chains)
    assert steps.publish(done, chains).columns == ["_rn", "x", "y"]
    out = steps.publish(done, chains, ["new", "y", "x", "_jk"], ["x", "unknown"])
    assert out.columns == ["_rn", "new", "y"] and tuple(out.first()) == (1, "n", 4)


def test_row_local_chains_make_one_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).select("id", F.lit("x").alias("a"), F.lit(1).alias("b"), F.lit(2).alias("unused")).write.parquet(path)
    chains = {
        "a": {1: {"fn": "hash", "origin": "{0}", "salt": "s"}, 2: {"fn": "replace", "else": "substring({1}, 1, 8)"}},
        "b": {1: {"fn": "noise", "origin": "{0}", "range": [1, 2]}},
    }
    df = spark.read.parquet(path).withColumn("_rn", F.col("id"))
    plan = plan_of(steps.publish(steps.deidentify(df, chains), chains, ["a", "b"]))
    assert plan.count("Scan parquet") == 2 and "Exchange" not in plan and "Join" not in plan
    assert "ReadSchema: struct<id:bigint,a:string,b:int>" in plan


def test_count_sees_what_was_exported(spark, config, tmp_path):
    """Rows and bytes are those of the exported file, line breaks in values included, not of the table behind it."""
    config["step_deid"]["column"]["name"] = {1: {"fn": "replace", "else": "concat({0}, '\n', '\"x')"}}
    paths = run_jobs(spark, config, "org,pre,deid,post,post_1_file,count")
    counts = {r["dataset"]: r for r in spark.read.json(paths["count"]).collect()}
    exported = sorted((tmp_path / "out/step_post_1_file/data.people.csv").glob("part-*"))
    assert counts["data.people.csv"].row_count == spark.read.parquet(paths["post"]).count() > 50
    assert counts["data.people.csv"].filesize == sum(p.stat().st_size for p in exported)
    largest = max(exported, key=lambda p: p.stat().st_size)
    largest.write_bytes(largest.read_bytes()[:200])
    for crc in largest.parent.glob(".*.crc"):
        crc.unlink()
    again = {r["dataset"]: r for r in spark.read.json(run_jobs(spark, config, "count")["count"]).collect()}
    assert again["data.people.csv"].row_count < counts["data.people.csv"].row_count
