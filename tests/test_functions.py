import base64
import datetime
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veil.functions import (
    Chain,
    Step,
    ceil_to,
    concat_present,
    floor_to,
    keyed_between,
    parse_date,
    parse_number,
    random_between,
    register_sql_functions,
    round_significant,
    salted_digest,
    salted_hash,
    sha256_concat,
)

VALUES = ["kim", "", "가나다", None]


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def texts(spark, values=VALUES):
    return spark.createDataFrame([(v,) for v in values], "v string")


@pytest.mark.parametrize(
    "algorithm, size, expected",
    [
        ("SHA224", None, lambda b: hashlib.sha224(b).digest()),
        ("SHA256", None, lambda b: hashlib.sha256(b).digest()),
        ("SHA384", None, lambda b: hashlib.sha384(b).digest()),
        ("SHA512", None, lambda b: hashlib.sha512(b).digest()),
        ("SHA512", 32, lambda b: hashlib.new("sha512_256", b).digest()),
        ("SHA512", 28, lambda b: hashlib.new("sha512_224", b).digest()),
        ("SHA512", 33, lambda b: hashlib.sha512(b).digest()),
        ("SHA3_224", None, lambda b: hashlib.sha3_224(b).digest()),
        ("SHA3_256", 5, lambda b: hashlib.sha3_256(b).digest()),
        ("SHA3_384", None, lambda b: hashlib.sha3_384(b).digest()),
        ("SHA3_512", None, lambda b: hashlib.sha3_512(b).digest()),
        ("SHAKE128", 16, lambda b: hashlib.shake_128(b).digest(16)),
        ("SHAKE128", 33, lambda b: hashlib.shake_128(b).digest(32)),
        ("SHAKE256", None, lambda b: hashlib.shake_256(b).digest(64)),
        ("BLAKE2s", 8, lambda b: hashlib.blake2s(b, digest_size=8).digest()),
        ("BLAKE2b", None, lambda b: hashlib.blake2b(b).digest()),
    ],
)
def test_hash_matches_hashlib(spark, algorithm, size, expected):
    df = texts(spark)
    got = column(df, salted_hash(F.col("v"), "s!", algorithm=algorithm, size=size))
    assert got == [None if v is None else expected((v + "s!").encode()).hex() for v in VALUES]
    got = column(df, salted_hash(F.col("v"), "s!", salt_first=True, algorithm=algorithm, encode="base64", size=size))
    want = [None if v is None else base64.b64encode(expected(("s!" + v).encode())).decode() for v in VALUES]
    assert got == want


def test_hash_of_other_types_and_bad_algorithm(spark):
    df = spark.createDataFrame([(12,)], "v long")
    assert column(df, salted_hash(F.col("v"), "x")) == [hashlib.sha256(b"12x").hexdigest()]
    assert column(df, salted_digest(F.col("v"), None)) == [bytearray(hashlib.sha256(b"12").digest())]
    with pytest.raises(ValueError, match="unknown hash algorithm"):
        salted_hash(F.col("v"), "x", algorithm="TupleHash128")


def test_null_skipping(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "a string, b string")
    assert column(df, concat_present("a", "b")) == ["a", ""]
    assert column(df, sha256_concat("|", "a", "b")) == [hashlib.sha256(b"a").hexdigest(), hashlib.sha256(b"").hexdigest()]


def test_rounding(spark):
    df = spark.createDataFrame([(1250.0,), (-1250.0,), (0.0,), (None,), (123456789.0,)], "x double")
    assert column(df, round_significant("x", 2)) == [1300, -1300, 0, None, 120000000]
    assert column(df, round_significant("x", 9)) == [1250, -1250, 0, None, 123456789]
    assert column(df, ceil_to("x", -1)) == [1250.0, -1250.0, 0.0, None, 123456790.0]
    assert column(df, floor_to("x", -3)) == [1000.0, -2000.0, 0.0, None, 123456000.0]


def test_lenient_parsing(spark):
    df = texts(spark, ["1,234", "x", None])
    assert column(df, parse_number("v", "long")) == [1234, None, None]
    df = texts(spark, ["2024-02-30", "2024-02-29"])
    assert column(df, parse_date("v")) == [None, datetime.date(2024, 2, 29)]


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT rand_round(1250D, 2) a, round45(12.5D, 0) b, replace_string('aXb', 'X', '-') c, "
        "sha256_concat('|', array('a', null, 'b')) d, rand_range(3, 5) e, ceil_to(123D, -1) f, floor_to(123D, -1) g"
    ).first()
    assert row["a"] == 1300 and row["b"] == 13.0 and row["c"] == "a-b" and 3 <= row["e"] <= 5
    assert row["d"] == hashlib.sha256(b"a|b").hexdigest() and row["f"] == 130.0 and row["g"] == 120.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(low=st.integers(-1000, 1000), span=st.integers(0, 500), seed=st.text("abc019", min_size=1))
def test_noise_stays_in_range(spark, low, span, seed):
    df = spark.range(300).select(
        "id", keyed_between(low, low + span, seed, "p", "id").alias("k"), random_between(low, low + span).alias("r")
    )
    row = df.agg(F.min("k"), F.max("k"), F.min("r"), F.max("r")).first()
    assert low <= row[0] <= row[1] <= low + span and low <= row[2] <= row[3] <= low + span


def test_keyed_noise_depends_on_purpose_and_key(spark):
    df = spark.range(200)
    a, b = (column(df, keyed_between(0, 10**6, "s", p, "id")) for p in ("day", "min"))
    assert a == column(df, keyed_between(0, 10**6, "s", "day", "id")) and a != b and len(set(a)) > 190


def step(config, number, column="c", cols=()):
    chain = Chain.of(column, {"cols": list(cols)} | config)
    return Step(chain, number, chain.steps[number])


def test_templates():
    chain = {1: {}, "3": {}, 7: {}}
    s = step(chain, 7, cols=["a b"])
    assert s.text("{0} + {1} + {-1} + {-2} + {$0} + {#upper}(x)") == "`c` + `_x_c_1` + `_x_c_3` + `_x_c_1` + `a b` + upper(x)"
    assert s.output == "_x_c_7" and s.chain.output == "_x_c_7"
    assert s.name("{0}") == "c" and s.name("{$0}") == "a b" and s.name("upper({0})") is None
    with pytest.raises(ValueError, match="before the first"):
        step(chain, 1).text("{-1}")
    with pytest.raises(ValueError, match="no numbered sub-step"):
        Chain.of("c", {"cols": []})


def test_expressions_may_be_columns_or_functions(spark):
    s = step({1: {}}, 1)
    df = spark.createDataFrame([("x",)], "c string")
    assert column(df, s.expr(F.upper("c"))) == ["X"]
    assert column(df, s.expr(lambda at: F.concat(F.col(at.column), F.lit("!")))) == ["x!"]
    assert column(df, s.expr(None)) == [None] and column(df, s.expr(5)) == [5]
