"""Reasons of removed rows: they account for every row, on awkward keys too."""

import time

import pytest

from tests.helpers import plan, rows
from tierstone.operators import dedupe_by_key, removed_rows, require_not_null
from tierstone.sources import shuffles_removed

SCHEMA = "id string, customer string, amount double, ingestion_timestamp timestamp"
LINES = [
    ("a", "x", 1.0, None), ("a", "x", 1.0, None), ("a", "x", 1.0, None), ("a", "y", 1.0, None),
    ("b", None, 1.0, None), ("c", "z", None, None), ("c", "z", float("nan"), None), ("c", "z", 2.0, None),
    (None, None, 1.0, None), (None, None, 1.0, None), (None, "x", 1.0, None), ("", "x", 1.0, None),
    ("d", None, 1.0, None), ("d", None, 2.0, None),
]


def removed(spark, lines, **options):
    return removed_rows(spark.createDataFrame(lines, SCHEMA), ["id"], ["customer"], **options)


def test_reasons_and_survivors(spark):
    found = rows(removed(spark, LINES).selectExpr("id", "customer", "string(amount)", "reason", "copies", "survivor_kept", "survivor_customer"))
    assert sorted(found, key=repr) == sorted(
        [
            ("a", "x", "1.0", "duplicate", 2, True, "x"),
            ("a", "y", "1.0", "duplicate", 1, True, "x"),
            ("b", None, "1.0", "missing_customer", 1, None, None),
            ("c", "z", None, "duplicate", 1, True, "z"),
            ("c", "z", "NaN", "duplicate", 1, True, "z"),
            (None, None, "1.0", "duplicate", 2, True, "x"),
            ("d", None, "2.0", "duplicate", 1, False, None),
            ("d", None, "1.0", "missing_customer", 1, None, None),
        ],
        key=repr,
    )


def test_rows_in_are_rows_out_and_reasons(spark):
    for lines in (LINES, LINES[:1], LINES * 50, []):
        df = spark.createDataFrame(lines, SCHEMA)
        kept = require_not_null(dedupe_by_key(df, ["id"]), ["customer"]).count()
        gone = sum(r["copies"] for r in removed(spark, lines).collect())
        assert kept + gone == len(lines)


def test_plans_agree(spark):
    lines = LINES * 20
    assert rows(removed(spark, lines).drop("amount")) == rows(
        removed(spark, lines, broadcast="never", min_hot_rows=1).drop("amount")
    )


def test_all_columns_are_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, n int")
    found = removed_rows(df, ["k", "n"], ["n"])
    assert rows(found.select("k", "reason", "copies")) == [("a", "duplicate", 1), ("b", "missing_n", 1)]


def test_a_row_is_shuffled_once_for_the_lookup(spark):
    """By its key; the other exchange has the surviving copies, of repeated keys alone."""
    found = plan(removed(spark, LINES, broadcast="never"))
    assert found.count("Arguments: hashpartitioning") == 2 and "SortMergeJoin" in found


def test_hot_keys_are_read_off_the_survivors(spark, monkeypatch):
    """Not counted in the rows, which would shuffle all of them once more."""
    monkeypatch.setattr("tierstone.operators.lookup.hot_key_rows", None)
    lines = LINES * 20
    found = removed(spark, lines, broadcast="never", min_hot_rows=50)
    assert "__salt" in plan(found)
    assert rows(found.drop("amount")) == rows(removed(spark, lines).drop("amount"))


def test_hot_keys_may_be_given(spark):
    lines = LINES * 20
    hot = {'{"id":"a"}': 80, "{}": 60, None: 5}
    assert rows(removed(spark, lines).drop("amount")) == rows(
        removed(spark, lines, broadcast="never", min_hot_rows=10, hot=hot).drop("amount")
    )


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_the_first_shuffle_is_gone_before_the_second(spark):
    there = _shuffle_files(spark)
    found = removed(spark, LINES, broadcast="never", hot={})
    for _ in range(100):  # removed in the background
        if not _shuffle_files(spark) - there:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - there
    assert found.count() == 8


def test_the_session_keeps_its_own_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark), shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        1 / 0
    assert spark.conf.get(name) == before
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            pass
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("options", [{}, {"broadcast": "never"}, {"broadcast": "never", "min_hot_rows": 2}])
def test_zero_has_one_sign(spark, options):
    df = spark.createDataFrame([(-0.0, -0.0), (0.0, 0.0), (0.0, -0.0), (1.0, -0.0)], "k double, n double")
    found = removed_rows(df, ["k"], ["n"], **options).selectExpr("string(k)", "string(n)", "reason", "copies", "string(survivor_n)")
    assert rows(found) == [("0.0", "0.0", "duplicate", 2, "0.0")]


def test_unknown_options_are_errors(spark):
    with pytest.raises(ValueError, match="sometimes"):
        removed(spark, LINES, broadcast="sometimes")
    with pytest.raises(TypeError, match="hottest"):
        removed(spark, LINES, hottest=1)
