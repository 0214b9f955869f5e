"""Declarative column checks, and counts of rows and values, in one scan of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import QualityError
from ..schemas import DIM_STATION, FACT


@dataclass(frozen=True)
class Rule:
    """One check of one column (or, for ``unique``, a combination of columns)."""

    check: str
    columns: tuple[str, ...]
    severity: str = "error"
    low: float | None = None
    high: float | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def unique(*columns: str, severity: str = "error") -> Rule:
    return Rule("unique", columns, severity)


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule("not_null", (column,), severity)


def accepted_range(column: str, low: float, high: float, severity: str = "error") -> Rule:
    return Rule("accepted_range", (column,), severity, low, high)


# The checks the Gold tables must pass.
GOLD_RULES = {
    DIM_STATION: (
        unique("estacao_codigo"),
        not_null("estacao_codigo"),
        not_null("latitude"),
        not_null("longitude"),
    ),
    FACT: (
        not_null("estacao_codigo"),
        not_null("datetime"),
        accepted_range("temperatura_c", -20, 55, severity="warn"),
    ),
}


def _failing_rows(rule: Rule) -> Column:
    """Number of failing rows, as an aggregate expression."""
    value = F.col(rule.columns[0])
    if rule.check == "not_null":
        return F.count_if(value.isNull())
    # Bounds are inclusive and NULL passes.
    return F.count_if((value < rule.low) | (value > rule.high))


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """``failures`` = number of values that occur more than once.  A value with a NULL is not counted."""
    repeated = df.dropna(subset=list(columns)).groupBy(*columns).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures"))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """``failures`` = number of rows where ``column`` is NULL."""
    return df.agg(_failing_rows(not_null(column)).alias("failures"))


def check_accepted_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """``failures`` = number of rows outside ``[low, high]``."""
    return df.agg(_failing_rows(accepted_range(column, low, high)).alias("failures"))


def _grouped_once(df: DataFrame, sets: Sequence[Sequence[str]], *totals: Column) -> DataFrame:
    """One row per value of each of ``sets`` of columns (``_set`` is its number), with ``_rows`` and the totals.

    The empty set is the whole table.  Grouping sets make a thin copy of each row per set, all in one scan, and what is
    grouped is added up before the shuffle.
    """
    columns = list(dict.fromkeys(name for names in sets for name in names))
    rows = F.count(F.lit(1)).alias("_rows")
    if not columns:
        return df.agg(rows, *totals).select(F.lit(0).alias("_set"), "*")
    grouped = df.groupingSets([[F.col(c) for c in names] for names in sets], *map(F.col, columns))
    # Which columns a set lacks, as bits, says which set a row belongs to.
    def bits(names: Sequence[str]) -> int:
        return int("".join("0" if column in names else "1" for column in columns), 2)

    found = grouped.agg(F.grouping_id().alias("_missing"), rows, *totals)
    number = reduce(lambda rest, i: F.when(F.col("_missing") == bits(sets[i]), i).otherwise(rest), range(len(sets)), F.lit(None))
    return found.withColumn("_set", number)


def quality_report(df: DataFrame, rules: Sequence[Rule], table: str = "") -> DataFrame:
    """``(table, column, check, severity, failures, passed)``, one row per rule; all rules share one scan."""
    keys = list(dict.fromkeys(tuple(sorted(rule.columns)) for rule in rules if rule.check == "unique"))
    sets = [(), *keys]
    row_wise = {rule: f"_f{i}" for i, rule in enumerate(rules) if rule.check != "unique"}
    grouped = _grouped_once(df, sets, *(_failing_rows(rule).alias(name) for rule, name in row_wise.items()))

    def repeated(columns: tuple[str, ...]) -> Column:
        """Values that occur more than once, among those without a NULL."""
        whole = reduce(lambda found, name: found & F.col(name).isNotNull(), columns, F.col("_rows") > 1)
        return F.count_if(whole & (F.col("_set") == sets.index(columns)))

    names = [f"f{i}" for i in range(len(rules))]
    failures = [
        repeated(tuple(sorted(rule.columns))) if rule.check == "unique"
        else F.coalesce(F.sum(F.when(F.col("_set") == 0, F.col(row_wise[rule]))), F.lit(0))
        for rule in rules
    ]
    totals = grouped.agg(*(value.alias(name) for value, name in zip(failures, names)))
    records = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(rule.column).alias("column"),
            F.lit(rule.check).alias("check"),
            F.lit(rule.severity).alias("severity"),
            F.col(name).alias("failures"),
            (F.col(name) == 0).alias("passed"),
        )
        for rule, name in zip(rules, names)
    ]
    return totals.select(F.inline(F.array(*records)))


def value_counts(
    df: DataFrame, tables: Mapping[str, Sequence[str]], table: str = "tabela", rows: str = "linhas"
) -> DataFrame:
    """Per name the number of distinct values of its columns in ``df``, or of rows where it has none; in one scan.

    What ``row_counts`` gives for tables that are each the distinct values of some columns of one frame; a value may be NULL.
    """
    sets = list(dict.fromkeys([(), *(tuple(sorted(columns)) for columns in tables.values())]))
    grouped = _grouped_once(df, sets)
    counts = {
        name: F.count_if(F.col("_set") == sets.index(tuple(sorted(columns)))) if columns
        else F.coalesce(F.sum(F.when(F.col("_set") == 0, F.col("_rows"))), F.lit(0))
        for name, columns in tables.items()
    }
    totals = grouped.agg(*(count.alias(f"n{i}") for i, count in enumerate(counts.values())))
    records = [F.struct(F.lit(name).alias(table), F.col(f"n{i}").alias(rows)) for i, name in enumerate(counts)]
    return totals.select(F.inline(F.array(*records)))


def enforce(report: DataFrame) -> DataFrame:
    """The report, computed once; raises if a rule of severity ``error`` failed.

    What comes back is made of the report's few rows, so that looking at it scans no table again.
    """
    found = report.collect()
    failed = [row for row in found if row["severity"] == "error" and not row["passed"]]
    if failed:
        raise QualityError(
            "; ".join(f"{r['table']}.{r['column']} {r['check']}: {r['failures']} failures" for r in failed)
        )
    return report.sparkSession.createDataFrame(found, report.schema)
