"""Reading a contract file."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from wardbook.operators.contract import ColumnSpec

try:
    import yaml
except ImportError:
    yaml = None


def read_contract(spark: SparkSession, path: str) -> list[ColumnSpec]:
    """Column specifications of a YAML (or, without PyYAML, JSON) contract on any Spark file system."""
    text = spark.read.text(path, wholetext=True).first()[0]
    document = (yaml.safe_load(text) if yaml else json.loads(text)) or {}
    columns = (document.get("schema") or {}).get("columns") or []
    return [ColumnSpec(c["name"], c["type"], c.get("nullable", True)) for c in columns]
