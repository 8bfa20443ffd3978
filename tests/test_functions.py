import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import TIMESTAMP_FORMATS, column_as_timestamp, lenient_cast, parse_timestamp, surrogate_key

DAY = dt.datetime(2024, 3, 5)
AT = dt.datetime(2024, 3, 5, 6, 7, 8)
MS = dt.datetime(2024, 3, 5, 6, 7, 8, 123000)
MICROS = dt.datetime(2024, 3, 5, 6, 7, 8, 123456)

READABLE = {
    "2024-03-05T06:07:08.123456Z": MICROS,
    "2024-03-05T06:07:08.123+02": MS.replace(hour=4),
    "2024-03-05T06:07:08.123+02:00": MS.replace(hour=4),
    "2024-03-05T06:07:08Z": AT,
    "2024-03-05T06:07:08.123": MS,
    "2024-03-05T06:07:08": AT,
    "2024-03-05 06:07:08.123": MS,
    "2024-03-05 06:07:08.123456": MICROS,
    "2024-03-05 06:07:08": AT,
    "2024-03-05": DAY,
    "03/05/2024 06:07:08": AT,
    "03/05/2024": DAY,
    "25/03/2024 06:07:08": AT.replace(day=25),
    "25/03/2024": DAY.replace(day=25),
    "05-03-2024 06:07:08": AT,
    "05-03-2024": DAY,
    "20240305 060708": AT,
    "20240305": DAY,
    "2024-3-5": DAY,
    "2024": dt.datetime(2024, 1, 1),
}
UNREADABLE = ["", "garbage", "2024-02-30", "03/05/2024 6:07", "1709618828", None, "12:30:00"]


def parsed(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", parse_timestamp(F.col("t")).cast("timestamp_ntz").alias("p")).collect()
    return {r["t"]: r["p"] for r in rows}


def test_every_layout(spark):
    assert parsed(spark, READABLE) == READABLE


def test_unreadable_text_is_null(spark):
    assert set(parsed(spark, UNREADABLE).values()) == {None}


def test_shape_checks_change_nothing(spark):
    """Against the layouts tried one by one without any check, on printed and damaged text."""
    rng = random.Random(5)
    texts = [t for t in [*READABLE, *UNREADABLE] if t is not None]
    texts += ["2024-03-05t06:07:08z", "+12024-03-05", "-0044-03-15", "2024-03-05T06:07:08+0230", "2024-03-05T06:07:08.1Z"]
    texts += [" 2024-03-05", "2024-03-05 ", "2024-03-05\n", "20240305\t", "02024-03-05", "12024-03-05 00:00:00"]
    for text in list(texts):
        for _ in range(25):
            chars = list(text)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(chars) + 1)
                action = rng.random()
                if action < 0.4 and at < len(chars):
                    chars[at] = rng.choice("0123456789-/:T. Z+")
                elif action < 0.7:
                    chars.insert(at, rng.choice("0123456789-/:T. Z+"))
                elif at < len(chars):
                    del chars[at]
            texts.append("".join(chars))
    # A year of six digits stops the plain form altogether.
    long_year = re.compile(r"(?<![.\d])0*[1-9]\d{5,}(?=.*[-/])|[-/]0*[1-9]\d{5,}|0*[1-9]\d{9,}")
    texts = [t for t in texts if not long_year.search(t)]
    df = spark.createDataFrame([(t,) for t in sorted(set(texts))], "t string")
    plain = F.coalesce(
        *(F.try_to_timestamp("t", F.lit(layout)) for layout in TIMESTAMP_FORMATS),
        F.when(F.col("t").rlike(r"^\s*[0-9]{4}(-|\s*$)"), F.col("t").try_cast("timestamp")),
    )
    different = df.select("t", plain.alias("a"), parse_timestamp(F.col("t")).alias("b")).where("NOT a <=> b")
    assert different.collect() == []


def test_year_out_of_range_is_null(spark):
    assert set(parsed(spark, ["9999990101", "999999-01-01", "01/01/9999999", "+999999999-01-01 00:00:00"]).values()) == {None}


def test_years_up_to_what_a_timestamp_holds(spark):
    texts = ["+100000-01-02", "+200000-01-02 03:04:05", "+294246-12-31", "+294247-01-01", "-290307-01-01", "-290308-12-31"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.unix_micros(parse_timestamp(F.col("t"))).alias("m"))
    got = {r["t"]: r["m"] for r in df.collect()}
    plain = spark.sql("select unix_micros(timestamp'+100000-01-02') a, unix_micros(timestamp'+200000-01-02 03:04:05') b").first()
    assert (got["+100000-01-02"], got["+200000-01-02 03:04:05"]) == tuple(plain)
    assert got["+294246-12-31"] > 0 and got["+294247-01-01"] is None
    assert got["-290308-12-31"] is None


@pytest.mark.parametrize("number", [9_300_000_000_000, -9_300_000_000_000, 2**63 - 1])
def test_numbers_beyond_a_timestamp_are_an_error(spark, number):
    df = spark.createDataFrame([(number,)], "n long")
    with pytest.raises(Exception, match="not epoch seconds"):
        df.select(column_as_timestamp(df, "n").cast("string")).collect()


def test_typed_columns(spark):
    df = spark.sql(
        "select timestamp'2024-03-05 06:07:08' a, timestamp_ntz'2024-03-05 06:07:08' b, date'2024-03-05' c,"
        " 1709618828L d, '05-03-2024' e"
    )
    got = df.select(*(column_as_timestamp(df, c).alias(c) for c in df.columns))
    assert [f.dataType.typeName() for f in got.schema.fields] == ["timestamp", "timestamp_ntz"] + ["timestamp"] * 3
    row = got.select(*(F.col(c).cast("timestamp_ntz") for c in got.columns)).first()
    assert tuple(row) == (AT, AT, DAY, dt.datetime(2024, 3, 5, 6, 7, 8), DAY)


def test_surrogate_key_facts(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c"), (None, None)], "x string, y string")
    a, b, c, d, e = [r[0] for r in df.select(surrogate_key(["x", "y"])).collect()]
    assert a == b and c == d and a != c
    assert e == int("d41d8cd98f00b20", 16)
    assert df.select(surrogate_key(["x"])).schema[0].dataType == T.LongType()


def test_lenient_cast_equals_try_cast(spark):
    texts = ["1", " 7 ", "-3", "+4", "1.5", "1e3", "1E3", "O", "N/A", "", "12abc", "99999999999", "0x1F", "1_0", "٣", "\t5\n", "1L", "1d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint", "smallint", "decimal(10,2)", "double", "date", "boolean"):
        both = df.select("t", F.col("t").try_cast(kind).alias("a"), lenient_cast(F.col("t"), T.StringType(), kind).alias("b"))
        assert both.where("NOT a <=> b").collect() == [], kind


@pytest.mark.parametrize("separator", ["||", "~"])
def test_separator(spark, separator):
    got = spark.sql("select 'a' x, 'b' y").select(surrogate_key(["x", "y"], separator)).first()[0]
    import hashlib

    assert got == int(hashlib.md5(f"a{separator}b".encode()).hexdigest()[:15], 16)


def test_key_collisions_are_found_and_nothing_else(spark):
    from strata.functions.keys import key_collisions

    rows = [("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c"), ("x", "y"), ("x", "y"), (None, None), ("", "z"), ("1:x", None)]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("k", surrogate_key(["a", "b"]))
    got = {(r["least_key"], r["greatest_key"]) for r in key_collisions(df, ["a", "b"], "k").collect()}
    assert got == {("-1:a", "1:a-"), ("1:a4:b||c", "4:a||b1:c")}
    assert key_collisions(df.limit(0), ["a", "b"], "k").count() == 0
