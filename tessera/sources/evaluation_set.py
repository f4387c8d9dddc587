"""Curated evaluation sets: a YAML or JSON file with a version and queries, each with its expected contents and category.

    version: v1
    queries:
      - query: how are sums kept apart
        expected_content_ids: [site::a, site::b]
        category: cross

Such a file is written by hand, so the driver reads it. Sets that grow with data are tables with the same columns.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "position int, query_id string, query string, expected array<string>, category string"
#: The category of a query that names none.
CATEGORY = "easy"


def load(spark: SparkSession, path: str | Path) -> tuple[DataFrame, str]:
    """The set's queries in SCHEMA, and its version. Ids are given or count from 1; repeated ids and empty queries are errors."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        found = json.loads(text)
    else:
        import yaml

        found = yaml.safe_load(text)
    rows = []
    for i, own in enumerate((found or {}).get("queries") or []):
        if not isinstance(own, dict) or not str(own.get("query") or "").strip():
            raise ValueError(f"query {i + 1} in {path} has no text")
        expected = own.get("expected_content_ids") or []
        if not isinstance(expected, list):
            raise ValueError(f"query {i + 1} in {path} needs a list of expected contents")
        rows.append((i, str(own.get("id", i + 1)), str(own["query"]), list(dict.fromkeys(map(str, expected))), str(own.get("category") or CATEGORY)))
    if len({r[1] for r in rows}) < len(rows):
        raise ValueError(f"{path} repeats ids of queries")
    return spark.createDataFrame(rows, SCHEMA), str((found or {}).get("version", ""))
