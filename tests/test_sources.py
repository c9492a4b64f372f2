import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructType

from veil.sources import audit, people, readers, schema, writers


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text('seq, name ,pay\n1, kim ,"1,234"\n2,"l ""x"" ee",\n')
    (tmp_path / "b.csv").write_text("pay,seq,name\n7,3,park\n")
    return tmp_path


def test_schema():
    spec = [
        {"name": "a", "data_type": "Long", "nullable": False},
        {"name": "b", "data_type": "decimal", "nullable": True, "precision": 9, "scale": 2},
    ]
    made = schema.make_schema(spec)
    assert isinstance(made, StructType) and made["a"].dataType == LongType() and made["b"].dataType == DecimalType(9, 2)
    assert not made["a"].nullable and schema.make_schema([]) is None
    with pytest.raises(ValueError, match="unknown data type"):
        schema.make_schema([{"name": "a", "data_type": "bool"}])


def test_one_file_with_casts_and_filter(spark, folder):
    storage = {"directory": str(folder), "type_cast": {"seq": "int", "pay": "double"}, "filter": "seq > 0", "compression": "none"}
    df = readers.load_table(spark, storage, "a.csv")
    assert rows(df, "seq") == [(1, "kim", 1234.0), (2, 'l "x" ee', None)]


@pytest.mark.parametrize("names", ["?.csv", ["a.csv", "b.csv"]])
def test_files_with_different_column_order(spark, folder, names):
    df = readers.load_table(spark, {"directory": str(folder), "type_cast_default": "string"}, names)
    assert sorted(map(tuple, df.select("seq", "name", "pay").collect())) == [
        ("1", "kim", "1,234"), ("2", 'l "x" ee', None), ("3", "park", "7"),
    ]


def test_any_number_of_files_with_several_headers(spark, tmp_path):
    orders = [("a", "b", "c"), ("c", "a", "b"), ("b", "c", "a")]
    for i in range(230):
        names = orders[i % 3]
        row = {"a": i, "b": f"x{i}", "c": -i}
        (tmp_path / f"{i:03}.csv").write_text("\n" * (i % 2) + ",".join(names) + "\n" + ",".join(str(row[n]) for n in names) + "\n")
    (tmp_path / "999.csv").write_text("")
    df = readers.load_table(spark, {"directory": str(tmp_path)}, "*.csv")
    found = sorted((int(r["a"]), r["b"], int(r["c"])) for r in df.collect())
    assert found == [(i, f"x{i}", -i) for i in range(230)]


def test_mode_depends_on_schema(spark, folder):
    assert readers.csv_options({})["mode"] == "FAILFAST"
    assert readers.csv_options({"schema": "a int", "multiline": True, "sep": ";"}) == {
        "header": True, "escape": '"', "multiLine": True, "mode": "PERMISSIVE", "sep": ";",
        "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True,
    }
    df = readers.read_csv(spark, str(folder / "a.csv"), schema=[{"name": c, "data_type": "long"} for c in ("s", "n", "p")])
    assert rows(df, "s")[0] == (1, None, None)


def test_filter_reaches_the_scan(spark, tmp_path):
    from plan_text import plan_of

    spark.range(10).withColumn("v", F.lit(1)).write.parquet(str(tmp_path / "t.parquet"))
    df = readers.load_table(spark, {"directory": str(tmp_path), "filter": ["id > 3", "v = 1"]}, "t.parquet").select("id")
    plan = plan_of(df)
    assert "GreaterThan(id,3)" in plan and df.count() == 6


def test_create_table(spark):
    assert readers.create_table(spark, [(1, "a")], columns=["x", "y"]).columns == ["x", "y"]
    spec = [{"name": "x", "data_type": "int"}]
    assert dict(readers.create_table(spark, [(1,)], spec).dtypes) == {"x": "int"}


def test_csv_writer_order_and_parts(spark, tmp_path):
    df = spark.range(20, numPartitions=4).select((F.col("id") % 5).alias("g"), "id")
    storage = {"directory": str(tmp_path), "make_1_file": True, "orderby": [{"g": "desc"}, {"id": "asc"}]}

    def lines(name):
        parts = sorted((tmp_path / name).glob("part-*.csv"))
        return len(parts), [x for p in parts for x in p.read_text().splitlines() if not x.startswith("g")]

    want = [f"{g},{i}" for g in range(4, -1, -1) for i in range(20) if i % 5 == g]
    writers.save_table(df, storage, "one.csv")
    assert lines("one.csv") == (1, want)
    # without the wish for one file a table keeps its parts, in order and whole
    del storage["make_1_file"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.save_table(df, storage, "many.csv")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    count, found = lines("many.csv")
    assert count > 1 and found == want


def test_audit_finds_bad_types_and_arity(spark, tmp_path):
    (tmp_path / "good.csv").write_text("seq,name,age\n1,kim,20\n2,lee,\n")
    (tmp_path / "bad.csv").write_text("seq,name,age\n3,park,x\n4,choi\n5,a,6,7\n6,ok,1\n")
    declared = [{"name": "seq", "data_type": "long"}, {"name": "name", "data_type": "string"}, {"name": "age", "data_type": "int"}]
    checked = audit.audit_csv(spark, str(tmp_path / "*.csv"), declared)
    summary = {r["_file"].rsplit("/", 1)[1]: (r["row_count"], r["corrupt_count"]) for r in checked.summary().collect()}
    assert summary == {"good.csv": (2, 0), "bad.csv": (4, 3)}
    assert [r["_corrupt_record"] for r in checked.first_lines(2).orderBy("line").collect()] == ["3,park,x", "4,choi"]
    assert not checked.is_clean() and not checked.promote(str(tmp_path / "out"))
    # all-string form: only wrong arity shows
    text = audit.audit_csv(spark, str(tmp_path / "bad.csv"))
    assert text.bad.count() == 2
    clean = audit.audit_csv(spark, str(tmp_path / "good.csv"), declared)
    assert clean.promote(str(tmp_path / "org_rn"))
    promoted = spark.read.parquet(str(tmp_path / "org_rn"))
    assert promoted.columns == ["seq", "name", "age", "_rn"] and promoted.count() == 2


def test_infer_types(spark):
    data = [
        ("1", "1.5", "2024-01-02", "2024-01-02 10:00:00", "x", None, "99999999999999999999", "1d"),
        ("-20", "7", None, "2024-01-03T00:00:00", "1", None, "3", "2d"),
    ]
    df = spark.createDataFrame(data, "i string, d string, day string, ts string, s string, none string, big string, j string")
    found = {r["column"]: r["data_type"] for r in audit.infer_types(df).collect()}
    assert found == {
        "i": "long", "d": "double", "day": "date", "ts": "timestamp", "s": "string", "none": "string", "big": "double",
        "j": "string",
    }


def test_people(spark):
    df = people.synthetic_people(spark, 2003, datetime.date(1945, 8, 17))
    first = df.where("sid IN (0, 1, 2, 3, 1234)").orderBy("sid").collect()
    assert [r["name"] for r in first] == ["banaa", "banabe", "banaci", "banado", "deldoeu"]
    assert [r["birthday"].day for r in first[:4]] == [15, 16, 17, 15]
    assert first[1]["date1"] == datetime.date(1955, 8, 16) and first[1]["date2"] == datetime.date(1955, 8, 26)
    assert [r["gender"] for r in first[:2]] == ["F", "M"] and first[4]["income"] == 1234000 and df.count() == 2003
