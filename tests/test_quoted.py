"""Files with line breaks in quotes, read in ranges, against Spark's reading in one task."""

import random

import pytest
from pyspark.sql import SparkSession

import __spark_entry__ as registered
from veil.sources import quoted, readers


@pytest.fixture
def ranged(spark):
    """A session that cuts files into ranges of few bytes."""
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "57b")
    small.conf.set("spark.sql.files.openCostInBytes", "0")
    small.conf.set("spark.sql.files.minPartitionNum", "1")
    yield small
    spark.newSession()
    SparkSession._instantiatedSession = spark


def write_files(folder, rng, end, escape, sep, files=2):
    """Records with quoted breaks, separators, doubled or escaped quotes, and some too short or too long."""

    def value():
        if rng.random() < 0.5:
            inner = "".join(rng.choices(["a", "\n", end, sep, "Q", " ", "# ", "bb", "é漢"], k=rng.randrange(7)))
            return '"' + inner.replace("Q", '""' if escape == '"' else '\\"') + '"'
        return rng.choice(["x", "ab c", "", "12", "é漢"] + (['a"b', '5"'] if end == "\n" else []))

    folder.mkdir()
    for f in range(files):
        with open(folder / f"{f}.csv", "w", newline="") as out:
            out.write(rng.choice(["", end]) + sep.join("abc") + end)
            for _ in range(rng.randrange(10)):
                out.write(sep.join(value() for _ in range(rng.choice([3] * 9 + [1, 2, 4]))) + rng.choice([end] * 9 + [end * 2]))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("escape", ['"', "\\"])
def test_as_in_one_task(ranged, tmp_path, end, escape):
    rng = random.Random(f"{end}{escape}")
    for k in range(2):
        sep = rng.choice([",", ";", "\t"])
        path = tmp_path / str(k)
        write_files(path, rng, end, escape, sep)
        for trims in (True, False):
            for schema in (None, "a string, b string, c string, _corrupt_record string"):
                settings = {"sep": sep, "escape": escape, "multiline": True, "ignoreLeadingWhiteSpace": trims, "ignoreTrailingWhiteSpace": trims}
                options = readers.csv_options(settings) | {"mode": "PERMISSIVE"}
                reader = ranged.read.options(**options)
                wanted = (reader.schema(schema) if schema else reader).csv(str(path)).select("a", "b", "c")
                given = readers.read_csv(ranged, str(path), **settings, mode="PERMISSIVE", **({"schema": schema} if schema else {}))
                assert sorted(map(str, given.select("a", "b", "c").collect())) == sorted(map(str, wanted.collect()))


def test_many_tasks_for_one_file(ranged, tmp_path):
    long = "a line,\n" * 40
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"{long}""{i}"""\n' for i in range(30)))
    df = readers.read_csv(ranged, str(tmp_path / "a.csv"), multiline=True)
    assert sorted(map(tuple, df.collect())) == sorted((str(i), f'{long}"{i}"') for i in range(30))
    options = readers.csv_options({"multiline": True})
    assert quoted.ranges(ranged, str(tmp_path / "a.csv"), options).count() > 100
    assert ranged.read.options(**options).csv(str(tmp_path / "a.csv")).rdd.getNumPartitions() == 1
    assert [tuple(r) for r in quoted.count_records(ranged, str(tmp_path / "a.csv"), options).select("records").collect()] == [(30,)]


def test_file_of_each_row_and_corrupt_records(ranged, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,"x\ny"\n2\n')
    (tmp_path / "b.csv").write_text('n,t\nz,"p\n\nq"\n')
    schema = "n int, t string, _corrupt_record string"
    df = readers.read_csv(ranged, str(tmp_path), file_column="f", multiline=True, schema=schema, columnNameOfCorruptRecord="_corrupt_record")
    found = sorted((r.f[-5:], r.n, r.t, r._corrupt_record) for r in df.collect() if r.f)
    assert found == [("a.csv", 1, "x\ny", None), ("a.csv", 2, None, "2"), ("b.csv", None, "p\n\nq", 'z,"p\n\nq"')]


def test_empty_files(ranged, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n")
    assert readers.read_csv(ranged, str(tmp_path / "a.csv"), multiline=True).collect() == []
    (tmp_path / "b.csv").write_text("n,t\n" + "\n" * 300 + '1,"\n"\n')
    assert readers.read_csv(ranged, str(tmp_path / "b.csv"), multiline=True, ignoreTrailingWhiteSpace=False).collect() == [("1", "\n")]


def test_other_encodings_are_left_to_spark():
    assert quoted.splittable({"encoding": "utf-8"}) and not quoted.splittable({"encoding": "cp949"})
    assert not quoted.splittable({"inferSchema": True}) and not quoted.splittable({"lineSep": "\r"})


def test_texts_with_line_breaks_pass_through_many_tasks(spark, tmp_path):
    """A table of several files is not written through one task, and comes back whole."""
    rows = [(i, "a\n" * (i % 4) + f'"{i}",', "en", "x\ny") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = registered.queries()["csv_line_breaks"](spark, str(tmp_path))
    assert len(got.inputFiles()) == 3
    assert sorted(map(tuple, got.collect())) == sorted((d, t, f'{lang}\n"{source}') for d, t, lang, source in rows)
