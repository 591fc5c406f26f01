"""Named datasets: where the raw text and the typed table of each one live.

The registry is a YAML or JSON document:

    root: /data/logs            # optional prefix for relative paths
    raw_dir: raw
    table_dir: tables
    datasets:
      exposure: {csv: exposure.csv, parquet: exposure.parquet, observed: natural}
    side_files:
      item_features: item_features.csv
    ingest: {compression: zstd, row_group_rows: 100000}

Paths may be any URI Spark reads. A missing document, dataset or side file is
an error; nothing falls back silently.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.operators.verdict import FAIL, PASS


@dataclass(frozen=True)
class Dataset:
    name: str
    csv: str
    parquet: str
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Registry:
    document: dict[str, Any]

    @classmethod
    def load(cls, path: str | Path) -> Registry:
        file = Path(path)
        if not file.exists():
            raise FileNotFoundError(f"registry not found: {file}")
        text = file.read_text(encoding="utf-8")
        if file.suffix in (".yaml", ".yml"):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("reading a YAML registry needs PyYAML; JSON works without it") from e
            return cls(yaml.safe_load(text))
        return cls(json.loads(text))

    def resolve(self, *parts: str) -> str:
        """Joins path parts under ``root``; an absolute path or URI starts over."""
        joined = str(self.document.get("root", ""))
        for part in parts:
            fresh = part.startswith("/") or "://" in part
            joined = part if fresh or not joined else f"{joined.rstrip('/')}/{part}"
        return joined

    @property
    def names(self) -> list[str]:
        return sorted(self.document.get("datasets", {}))

    @property
    def ingest_options(self) -> dict[str, Any]:
        return dict(self.document.get("ingest", {}))

    def dataset(self, name: str) -> Dataset:
        try:
            entry = dict(self.document["datasets"][name])
        except KeyError as e:
            raise KeyError(f"no dataset {name!r} in the registry") from e
        lacking = [k for k in ("csv", "parquet") if k not in entry]
        if lacking:
            raise ValueError(f"dataset {name!r} lacks {' and '.join(lacking)} in the registry")
        return Dataset(
            name,
            self.resolve(self.document.get("raw_dir", ""), entry.pop("csv")),
            self.resolve(self.document.get("table_dir", ""), entry.pop("parquet")),
            entry,
        )

    def side_file(self, key: str) -> str:
        try:
            entry = self.document["side_files"][key]
        except KeyError as e:
            raise KeyError(f"no side file {key!r} in the registry") from e
        return self.resolve(self.document.get("raw_dir", ""), entry)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.dataset(name).parquet)


def is_readable(spark: SparkSession, path: str) -> bool:
    """Can Spark open the Parquet table (reads footers only)."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def declared_outputs(spark: SparkSession, registry: Registry) -> DataFrame:
    """A verdict row per dataset: does the table the registry declares exist."""
    rows = []
    for name in registry.names:
        path = registry.dataset(name).parquet
        found = is_readable(spark, path)
        rows.append(
            (
                f"contract.output.{name}",
                f"{name}: the declared Parquet table exists",
                PASS if found else FAIL,
                f"path={path}, {'found' if found else 'not found; run the ingest for it'}",
            )
        )
    schema = "check_id string, description string, verdict string, evidence string"
    return spark.createDataFrame(rows, schema).select(*[F.col(c) for c in ("check_id", "description", "verdict", "evidence")])
