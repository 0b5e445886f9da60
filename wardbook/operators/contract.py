"""Checking a table against a list of column specifications."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.errors import ContractViolation

# Contract type names that differ from Spark's.
TYPE_ALIASES = {"integer": "int", "long": "bigint"}

REPORT_COLUMNS = ["position", "column_name", "check_name", "expected", "actual", "passed", "message"]


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True


def contract_report(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """One row per column and check (presence, type, nulls) with its outcome, from one pass.

    Checks that cannot be made, such as the type of a missing column, have no row. Columns
    that the contract does not name are allowed.
    """
    if not columns:
        raise ContractViolation("Contract contains no columns definition.")
    actual_types = dict(df.dtypes)
    required = [c.name for c in columns if not c.nullable and c.name in actual_types]
    nulls = {name: f"__nulls_{i}" for i, name in enumerate(required)}
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(alias) for name, alias in nulls.items()],
    )

    checks: list[Column] = []

    def add(position: int, name: str, check: str, expected: str, actual, passed, message) -> None:
        values = [F.lit(position), F.lit(name), F.lit(check), F.lit(expected),
                  F.lit(actual).cast("string"), F.lit(passed), message]
        checks.append(F.struct(*[v.alias(c) for v, c in zip(values, REPORT_COLUMNS)]))

    for position, spec in enumerate(columns):
        present = spec.name in actual_types
        add(position, spec.name, "presence", "present", "present" if present else "missing", present,
            F.lit(None if present else f"Missing required column: {spec.name}").cast("string"))
        if not present:
            continue
        expected, actual = TYPE_ALIASES.get(spec.type, spec.type), actual_types[spec.name]
        same = expected == actual
        add(position, spec.name, "type", expected, actual, same, F.lit(
            None if same
            else f"Column type mismatch for {spec.name}. Expected {expected}, got {actual}."
        ).cast("string"))
        if not spec.nullable:
            count = F.col(nulls[spec.name])
            add(position, spec.name, "nulls", "0", count, count == 0, F.when(count > 0, F.concat(
                F.lit(f"Column {spec.name} is marked nullable: false, but contains "),
                count.cast("string"), F.lit(" null records."))))
    return counted.select(F.inline(F.array(*checks)))


def enforce_contract(df: DataFrame, columns: Sequence[ColumnSpec]) -> None:
    """Raise with the message of the first failed check, in contract order."""
    failed = [r["message"] for r in contract_report(df, columns).collect() if not r["passed"]]
    if failed:
        raise ContractViolation(failed[0])
