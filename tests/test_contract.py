"""Contract checks: the messages, the order of violations, and one pass over the data."""

import json

import pytest
from pyspark.sql import functions as F

from wardbook.errors import ContractViolation
from wardbook.operators.contract import ColumnSpec, contract_report, enforce_contract
from wardbook.sources.contracts import read_contract

SPECS = [
    ColumnSpec("health_area", "string", nullable=False),
    ColumnSpec("numeric_value", "integer"),
    ColumnSpec("facility_name", "string"),
]


def frame(spark, data, schema="health_area string, numeric_value int, facility_name string"):
    return spark.createDataFrame(data, schema)


def test_success_allows_null_and_extra_columns(spark):
    df = frame(spark, [("HIV", 42, "Clinic A"), ("Malaria", None, "Clinic B")]).withColumn("extra", F.lit(1))
    enforce_contract(df, SPECS)
    assert contract_report(df, SPECS).filter("not passed").isEmpty()


def test_missing_column(spark):
    with pytest.raises(ContractViolation, match="Missing required column: facility_name"):
        enforce_contract(frame(spark, [("HIV", 42, "A")]).drop("facility_name"), SPECS)


def test_type_mismatch(spark):
    df = frame(spark, [("HIV", "42", "A")], "health_area string, numeric_value string, facility_name string")
    with pytest.raises(ContractViolation, match="Column type mismatch for numeric_value. Expected int, got string."):
        enforce_contract(df, SPECS)


def test_null_in_required_column(spark):
    with pytest.raises(ContractViolation, match="health_area is marked nullable: false, but contains 1 null records"):
        enforce_contract(frame(spark, [(None, 42, "A")]), SPECS)


def test_report_lists_every_violation_and_first_one_raises(spark):
    df = frame(spark, [(None, "x"), (None, "y")], "health_area string, numeric_value string")
    failed = [r["message"] for r in contract_report(df, SPECS).filter("not passed").collect()]
    assert failed == [
        "Column health_area is marked nullable: false, but contains 2 null records.",
        "Column type mismatch for numeric_value. Expected int, got string.",
        "Missing required column: facility_name",
    ]
    with pytest.raises(ContractViolation, match="health_area is marked"):
        enforce_contract(df, SPECS)


def test_no_columns(spark):
    with pytest.raises(ContractViolation, match="Contract contains no columns definition."):
        enforce_contract(frame(spark, [("HIV", 42, "A")]), [])


def test_read_contract_file(spark, tmp_path):
    columns = [{"name": "health_area", "type": "string", "nullable": False}, {"name": "n", "type": "long"}]
    path = tmp_path / "contract.yaml"
    path.write_text(json.dumps({"schema": {"columns": columns}}))
    assert read_contract(spark, str(path)) == [ColumnSpec("health_area", "string", False), ColumnSpec("n", "long")]
    path.write_text("schema:\n  columns:\n    - name: a\n      type: double\n      nullable: false\n")
    pytest.importorskip("yaml")
    assert read_contract(spark, str(path)) == [ColumnSpec("a", "double", False)]
    path.write_text("other: 1\n")
    assert read_contract(spark, str(path)) == []
