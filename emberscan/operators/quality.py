"""Data-quality checks.

A rule set is data. A report scans its table once for all column rules, counted per combination of
foreign keys, from which relationships follow without the table; and once more for
uniqueness, all keys in one shuffle. Keys collapse in the tasks before any shuffle. Reports are
frames (check, passed, failing_rows); `enforce` turns a failed one into an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise


class QualityError(RuntimeError):
    """A check with severity error failed."""


@dataclass(frozen=True)
class Rules:
    """Checks of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    invalid: Mapping[str, str] = field(default_factory=dict)
    warn: tuple[str, ...] = ()

    def count(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted) + len(self.relationships)


def _report_row(check: str, failing: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        (failing == 0).alias("passed"),
        failing.cast("bigint").alias("failing_rows"),
    )


def column_checks(rules: Rules) -> dict[str, Column]:
    """Check name to condition that marks a failing row. Null passes all but not_null."""
    checks = {f"not_null:{c}": F.col(c).isNull() for c in rules.not_null}
    for name, values in rules.accepted.items():
        checks[f"accepted:{name}"] = F.col(name).isNotNull() & ~F.col(name).isin(*values)
    for name, expression in rules.invalid.items():
        checks[f"invalid:{name}"] = F.coalesce(F.expr(expression), F.lit(False))
    return checks


def _counted(df: DataFrame, rules: Rules, freshness: tuple[str, str] | None) -> DataFrame:
    """Rows and failing rows of every column rule, per combination of foreign keys."""
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(column_checks(rules).values())]
    if freshness:
        column, day = freshness
        counts.append(F.count_if(F.col(column) == F.lit(day).cast("date")).alias("fresh"))
    keys = [F.col(column).cast("string").alias(f"k{i}") for i, column in enumerate(rules.relationships)]
    return df.groupBy(*keys).agg(*counts)


def _column_rows(counted: DataFrame, rules: Rules, freshness: tuple[str, str] | None) -> DataFrame:
    names = list(column_checks(rules))
    summed = ["n", *(f"c{i}" for i in range(len(names))), *(["fresh"] if freshness else [])]
    totals = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed))
    rows = [_report_row("row_count", F.when(F.col("n") == 0, 1).otherwise(0))]

    def unless_empty(failing: Column) -> Column:
        return F.when(F.col("n") > 0, failing)

    rows += [_report_row(name, unless_empty(F.col(f"c{i}"))) for i, name in enumerate(names)]
    if freshness:
        rows.append(_report_row("freshness", unless_empty(F.when(F.col("fresh") == 0, 1).otherwise(0))))
    return totals.select(F.inline(F.array(*rows)))


def check_columns(df: DataFrame, rules: Rules, freshness: tuple[str, str] | None = None) -> DataFrame:
    """Non-emptiness, column rules and freshness, all from one aggregation.

    On an empty table only the row count is judged: the rest are skipped
    (passed is null), as they would not have run.
    """
    bare = replace(rules, relationships={})
    return _column_rows(_counted(df, bare, freshness), bare, freshness)


def _failing(found: DataFrame, names: list[str]) -> DataFrame:
    """A report row for every name, from (check, n) of those that fail."""
    every = found.sparkSession.createDataFrame([(name,) for name in names], "check string")
    sums = found.groupBy("check").agg(F.sum("n").alias("n"))
    row = _report_row("", F.coalesce("n", F.lit(0)))
    return every.join(sums, "check", "left").select("check", row["passed"].alias("passed"), row["failing_rows"].alias("failing_rows"))


def _unique_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Keys that occur more than once, of all unique columns in one shuffle."""
    pairs = F.array(*(F.struct(F.lit(f"unique:{c}").alias("check"), F.col(c).cast("string").alias("value")) for c in rules.unique))
    repeated = df.select(F.inline(pairs)).where("value is not null").groupBy("check", "value").count().where("count > 1")
    return _failing(repeated.select("check", F.lit(1).alias("n")), [f"unique:{c}" for c in rules.unique])


def _relationship_rows(counted: DataFrame, rules: Rules, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose key the parent lacks, from the combinations of keys."""
    names = [f"relationship:{column}" for column in rules.relationships]
    used = F.array(*(F.struct(F.lit(name).alias("check"), F.col(f"k{i}").alias("value")) for i, name in enumerate(names)))
    asked = counted.select("n", F.inline(used)).where("value is not null").groupBy("check", "value").agg(F.sum("n").alias("n"))
    parents = (
        tables[table].select(F.lit(name).alias("check"), F.col(field_name).cast("string").alias("value"))
        for name, (table, field_name) in zip(names, rules.relationships.values())
    )
    known = reduce(DataFrame.union, parents).where("value is not null").distinct()
    return _failing(asked.join(known, ["check", "value"], "left_anti").select("check", "n"), names)


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their row count."""
    return df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child keys the parent lacks, with the number of rows using them."""
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = parent.select(F.col(field_name).alias("missing_key")).where("missing_key is not null").distinct()
    return used.join(known, "missing_key", "left_anti")


def report(
    df: DataFrame,
    rules: Rules,
    tables: Mapping[str, DataFrame] | None = None,
    freshness: tuple[str, str] | None = None,
) -> DataFrame:
    """All checks of a table, in two scans of it at most. `tables` holds the parents of relationships."""
    counted = _counted(df, rules, freshness)
    if rules.relationships:
        # Read twice below; the combinations are few, the table is not.
        counted = materialise(counted, "counted")
    parts = [_column_rows(counted, rules, freshness)]
    if rules.unique:
        parts.append(_unique_rows(df, rules))
    if rules.relationships:
        parts.append(_relationship_rows(counted, rules, tables or {}))
    return reduce(DataFrame.unionByName, parts)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def quality_group(
    spark: SparkSession,
    name: str,
    not_null: Iterable[str] = (),
    invalid: Mapping[str, str] | None = None,
    freshness: tuple[str, str] | None = None,
) -> DataFrame:
    """Exists, then non-empty, then everything else, for a catalog table or view."""
    if not table_exists(spark, name):
        return spark.range(1).select(F.inline(F.array(_report_row("table_exists", F.lit(1)))))
    exists = spark.range(1).select(F.inline(F.array(_report_row("table_exists", F.lit(0)))))
    rules = Rules(not_null=tuple(not_null), invalid=invalid or {})
    return exists.unionByName(check_columns(spark.table(name), rules, freshness))


def enforce(checks: DataFrame, table: str, warn: Iterable[str] = ()) -> list[str]:
    """Raise on failed checks; the names in `warn` are returned instead.

    A report has one row per declared check, so collecting it is bounded.
    """
    failed = [(r["check"], r["failing_rows"]) for r in checks.collect() if r["passed"] is False]
    tolerated = set(warn)
    fatal = [f"{check} ({rows} rows)" for check, rows in failed if check not in tolerated]
    if fatal:
        raise QualityError(f"{table}: {', '.join(fatal)}")
    return [check for check, _ in failed]
