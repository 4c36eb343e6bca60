"""Pipeline configuration: a YAML file as a dict, read on the driver (a configuration is small)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def load_config(path: str, spark: SparkSession | None = None) -> dict[str, Any]:
    """The mapping in a YAML file; an empty file gives an empty dict.  With a session, any file system of the cluster will
    do as a path."""
    import yaml

    if spark is not None:
        text = spark.read.text(path, wholetext=True).first()
        found = yaml.safe_load(text[0]) if text else None
    else:
        with open(path, encoding="utf-8") as f:
            found = yaml.safe_load(f)
    return found or {}
