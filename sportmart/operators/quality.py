"""Declarative checks whose results are ordinary rows.

All checks of a dataset share one aggregation over it (schema checks need no
data but report the row count of the same pass). Failures are rows; only
``enforce`` acts on them.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sportmart.functions.paths import path_type
from sportmart.schemas import Columns, to_ddl

RESULT_DDL = (
    "dataset STRING, check STRING, column STRING, passed BOOLEAN, "
    "unexpected_count BIGINT, element_count BIGINT, detail STRING"
)


class QualityError(Exception):
    """At least one check that must hold did not."""


@dataclass
class _Finding:
    check: str
    column: str
    # what breaks the check: a SQL aggregate, or a number known from the schema
    unexpected: str | int
    detail: str = ""


@dataclass
class Suite:
    """Checks collected by chained calls, run by ``results``."""

    dataset: str
    df: DataFrame
    findings: list[_Finding] = field(default_factory=list)

    def _schema(self, check: str, column: str, ok: bool, detail: str = "") -> None:
        self.findings.append(_Finding(check, column, 0 if ok else 1, detail))

    def columns_exist(self, names: Sequence[str]) -> Suite:
        """Every listed top-level column is present."""
        for name in names:
            ok = name in self.df.columns
            self._schema("column_exists", name, ok, "" if ok else "column is missing")
        return self

    def any_column_exists(self, names: Sequence[str]) -> Suite:
        """At least one listed column is present."""
        found = [name for name in names if name in self.df.columns]
        self._schema("any_column_exists", ",".join(names), bool(found), "found: " + ",".join(found))
        return self

    def not_null(self, names: Sequence[str] | None = None) -> Suite:
        """No null in the listed columns (default: all columns)."""
        for name in self.df.columns if names is None else names:
            if name in self.df.columns:
                self.findings.append(_Finding("not_null", name, f"count_if(`{name}` IS NULL)"))
            else:
                self._schema("not_null", name, False, "column is missing")
        return self

    def column_set(self, names: Sequence[str]) -> Suite:
        """Exactly the listed columns, in any order; both differences are reported."""
        missing = sorted(set(names) - set(self.df.columns))
        extra = sorted(set(self.df.columns) - set(names))
        detail = f"missing: {','.join(missing)}; unexpected: {','.join(extra)}" if missing or extra else ""
        self.findings.append(_Finding("column_set", "*", len(missing) + len(extra), detail))
        return self

    def column_types(self, columns: Columns, strict: bool = False) -> Suite:
        """Types by column name; type parameters count only if ``strict``."""
        for expected in T.StructType.fromDDL(to_ddl(columns)):
            if expected.name not in self.df.columns:
                self._schema("column_type", expected.name, False, "column is missing")
                continue
            actual = self.df.schema[expected.name].dataType
            ok = actual == expected.dataType if strict else type(actual) is type(expected.dataType)
            detail = f"{actual.simpleString()} for {expected.dataType.simpleString()}"
            self._schema("column_type", expected.name, ok, "" if ok else detail)
        return self

    def nested_exists(self, column: str, path: str) -> Suite:
        """``path`` is declared below ``column`` and set wherever the column is."""
        whole = f"{column}.{path}"
        if path_type(self.df.schema, whole) is None:
            self._schema("nested_exists", whole, False, "path is missing")
        else:
            absent = f"count_if({column} IS NOT NULL AND {whole} IS NULL)"
            self.findings.append(_Finding("nested_exists", whole, absent))
        return self

    def results(self, count_rows: bool = True) -> DataFrame:
        """One row per check, in one aggregation without grouping keys.

        Without ``count_rows`` a suite of schema checks runs no plan of its
        dataset at all; its element counts are null.
        """
        folds = [
            f"CAST({finding.unexpected} AS BIGINT) AS _u{position}"
            for position, finding in enumerate(self.findings)
        ]
        rows = [
            f"struct({text(self.dataset)} AS dataset, {text(finding.check)} AS check, "
            f"{text(finding.column)} AS column, _u{position} = 0 AS passed, _u{position} AS unexpected_count, "
            f"_n AS element_count, {text(finding.detail)} AS detail)"
            for position, finding in enumerate(self.findings)
        ]
        if count_rows or any(isinstance(finding.unexpected, str) for finding in self.findings):
            measured = one_row(self.df, folds)
        else:
            measured = self.df.sparkSession.range(1).selectExpr("CAST(NULL AS BIGINT) AS _n", *folds)
        return measured.selectExpr(f"inline(array({', '.join(rows)}))")


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_row(df: DataFrame, folds: Sequence[str]) -> DataFrame:
    """The row count as ``_n`` and the given aggregates, without grouping."""
    return df.agg(F.expr("count(1)").alias("_n"), *[F.expr(fold) for fold in folds])


def run_suites(suites: Sequence[Suite], count_rows: bool = True) -> DataFrame:
    """Results of several datasets as one frame."""
    return reduce(DataFrame.unionByName, [suite.results(count_rows) for suite in suites if suite.findings])


def enforce(results: DataFrame, on_fail: str = "warn") -> DataFrame:
    """Warn about or raise for failed checks; the failures come back as rows.

    At most one row per check reaches the driver.
    """
    failed = results.where("NOT passed")
    lines = [
        f"{row['dataset']}: {row['check']} {row['column']} {row['detail'] or row['unexpected_count']}".strip()
        for row in failed.collect()
    ]
    if lines and on_fail == "raise":
        raise QualityError("failed checks: " + "; ".join(lines))
    for line in lines:
        warnings.warn(f"failed check: {line}", stacklevel=2)
    return failed


def type_names(schema: T.StructType) -> list[str]:
    """Type class names without parameters: decimal(38,0) -> DecimalType."""
    return [type(column.dataType).__name__ for column in schema]


def null_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, element_count) of the listed columns in one pass."""
    names = list(names or df.columns)
    folds = [f"count_if(`{name}` IS NULL) AS _u{i}" for i, name in enumerate(names)]
    rows = [
        f"struct({text(name)} AS column, _u{i} AS null_count, _n AS element_count)" for i, name in enumerate(names)
    ]
    return one_row(df, folds).selectExpr(f"inline(array({', '.join(rows)}))")
