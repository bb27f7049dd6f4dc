"""Checks, reports and declared tests."""

import pytest

from emberscan.operators import quality
from emberscan.operators.quality import QualityError, Rules
from emberscan.plans.declared_checks import DECLARED

from .plans import explained


def frame(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), (None, 3, None)], "k string, n int, code string"
    )


def as_dict(report):
    return {r["check"]: (r["passed"], r["failing_rows"]) for r in report.collect()}


def test_report(spark):
    rules = Rules(
        not_null=("k", "n"), unique=("k",), accepted={"code": ("x",), "n": (1, 3)},
        relationships={"k": ("parent", "id")}, invalid={"big": "n > 2"},
    )
    parent = spark.createDataFrame([("b",)], "id string")
    assert as_dict(quality.report(frame(spark), rules, {"parent": parent})) == {
        "row_count": (True, 0),
        "not_null:k": (False, 1), "not_null:n": (False, 1),
        "accepted:code": (False, 1), "accepted:n": (True, 0),
        "invalid:big": (False, 1),
        "unique:k": (False, 1),
        "relationship:k": (False, 2),
    }


def test_a_report_reads_its_table_twice_at_most(spark, folder):
    frame(spark).write.parquet(f"{folder}/t")
    rules = Rules(
        not_null=("k",), unique=("k", "code"), accepted={"n": (1, 3)},
        relationships={"k": ("parent", "id"), "code": ("parent", "id")},
    )
    table, parent = spark.read.parquet(f"{folder}/t"), spark.createDataFrame([("a",)], "id string")
    found = quality.report(table, rules, {"parent": parent})
    assert as_dict(found) == {
        "row_count": (True, 0), "not_null:k": (False, 1), "accepted:n": (True, 0), "unique:k": (False, 1),
        "unique:code": (True, 0), "relationship:k": (True, 0), "relationship:code": (False, 2),
    }
    # One scan counted the combinations of keys; what is left in the plan is the one for uniqueness.
    assert explained(found, "formatted").count(f"{folder}/t") == 1


def test_empty_table_skips_the_rest(spark):
    rules = Rules(not_null=("k",))
    assert as_dict(quality.check_columns(frame(spark).where("false"), rules)) == {
        "row_count": (False, 1), "not_null:k": (None, None),
    }


def test_group_orders_its_checks(spark):
    assert as_dict(quality.quality_group(spark, "no_such_table", ["k"])) == {"table_exists": (False, 1)}
    frame(spark).createOrReplaceTempView("checked")
    got = as_dict(quality.quality_group(spark, "checked", ["n"], {"null_n": "n IS NULL"}))
    assert got == {
        "table_exists": (True, 0), "row_count": (True, 0), "not_null:n": (False, 1), "invalid:null_n": (False, 1),
    }


def test_freshness(spark):
    df = spark.sql("select date'2024-01-05' as d")
    assert as_dict(quality.check_columns(df, Rules(), ("d", "2024-01-05")))["freshness"] == (True, 0)
    assert as_dict(quality.check_columns(df, Rules(), ("d", "2024-01-06")))["freshness"] == (False, 1)


def test_enforce(spark):
    result = quality.report(frame(spark), Rules(not_null=("k",)))
    with pytest.raises(QualityError, match="not_null:k"):
        quality.enforce(result, "t")
    assert quality.enforce(result, "t", warn=["not_null:k"]) == ["not_null:k"]


def test_all_declared_tests_are_present():
    counts = [len(r.not_null) for r in DECLARED.values()], [len(r.unique) for r in DECLARED.values()]
    assert (sum(counts[0]), sum(counts[1])) == (86, 11)
    assert sum(len(r.accepted) for r in DECLARED.values()) == 21
    assert sum(len(r.relationships) for r in DECLARED.values()) == 4
    assert sum(r.count() for r in DECLARED.values()) == 122
