import datetime
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import rows
from tierstone.functions import (
    ISO_DAY,
    as_type,
    audit_time,
    issue_label,
    money,
    parse_day,
    proper_case,
)
from tierstone.operators import in_memory_bytes


def apply(spark, values, spark_type, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {spark_type}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_proper_case(spark):
    names = ["  alice   o'neil-smith ", "\tTab name", "élan vital", "", None, "BOB"]
    assert apply(spark, names, "string", proper_case) == [
        "Alice   O'neil-smith",
        "\ttab Name",
        "Élan Vital",
        "",
        None,
        "Bob",
    ]


def test_parse_day(spark):
    texts = ["2024-01-10", "10/01/2024", "2024-1-5", "2024-02-30", "", None]
    assert apply(spark, texts, "string", parse_day) == [datetime.date(2024, 1, 10)] + [None] * 5
    with pytest.raises(PySparkException):
        apply(spark, ["2024-02-30"], "string", lambda c: parse_day(c, strict=True))


def test_parse_day_equals_the_formatted_parse(spark):
    dice = random.Random(5)
    texts = ["2024-01-10\n", " 2024-01-10", "2024-01-10 ", "2024-01-1T", "2024-01-10T00", "٢٠٢٤-٠١-١٠"]
    texts += ["0000-01-01", "-2024-01-01", "+2024-01-01", "12024-01-01", "2000-02-29", "1900-02-29"]
    for _ in range(5_000):
        chars = list(f"{dice.randint(0, 9999):04d}-{dice.randint(0, 13):02d}-{dice.randint(0, 32):02d}")
        if dice.random() < 0.3:
            chars[dice.randrange(10)] = dice.choice("0123456789- /T+x\n")
        if dice.random() < 0.1:
            chars.insert(dice.randrange(10), dice.choice("0 -"))
        texts.append("".join(chars))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", parse_day(F.col("t")).alias("a"), F.try_to_date("t", ISO_DAY).alias("b"))
    assert both.filter("a is not null").count() > 2_000
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_parse_day_in_another_format(spark):
    texts = ["10/01/2024", "2024-01-10"]
    found = apply(spark, texts, "string", lambda c: parse_day(c, "dd/MM/yyyy"))
    assert found == [datetime.date(2024, 1, 10), None]


def test_as_type(spark):
    texts = ["7", "x", "1.5", None]
    assert apply(spark, texts, "string", lambda c: as_type(c, "int")) == [7, None, None, None]
    assert apply(spark, texts, "string", lambda c: as_type(c, "double")) == [7.0, None, 1.5, None]
    with pytest.raises(PySparkException):
        apply(spark, ["x"], "string", lambda c: as_type(c, "int", strict=True))


def test_money_rounds_half_up(spark):
    values = [2.675, 1.005, 0.125, -0.125, None]
    assert apply(spark, values, "double", money) == [2.68, 1.01, 0.13, -0.13, None]


def test_issue_label(spark):
    def label(c):
        return issue_label({"big": c > 10, "even": c % 2 == 0})

    assert apply(spark, [1, 2, 11, 12, None], "int", label) == [
        "clean",
        "even",
        "big",
        "big&even",
        "clean",
    ]


def test_audit_time_can_be_fixed(spark):
    moment = datetime.datetime(2024, 5, 1, 8, 30, tzinfo=datetime.timezone.utc)
    fixed = spark.range(1).select(audit_time(moment).cast("string"), audit_time())
    assert rows(fixed.select(fixed.columns[0])) == [("2024-05-01 08:30:00",)]
    assert isinstance(fixed.first()[1], datetime.datetime)


def test_size_estimate_bounds_rows(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert in_memory_bytes(df) >= 2 * (8 + 8) + 3
    assert in_memory_bytes(df.filter("n > 5")) == 0
    assert in_memory_bytes(df.select(F.array("n").alias("a"))) is None
