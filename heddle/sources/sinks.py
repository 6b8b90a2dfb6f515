"""Writers: wide CSV, JSON lines with nested evidence, manifests, registries as snapshots."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .tables import require


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A folder of CSV parts with header, columns in a fixed order; columns outside it are left out."""
    df.select(*(columns or df.columns)).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One file with a byte order mark, for people; streamed through the driver row by row, so meant for reports."""
    import csv

    cols = columns or df.columns
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(cols)
        for r in df.select(*cols).toLocalIterator():
            w.writerow(["" if v is None else v for v in r])


def write_jsonl(df: DataFrame, path: str, nested: dict[str, list[str]]) -> None:
    """JSON lines; each key of ``nested`` becomes an object of its columns."""
    inner = {c for cs in nested.values() for c in cs}
    df.select(*[c for c in df.columns if c not in inner], *[F.struct(*cs).alias(k) for k, cs in nested.items()]).write.mode("overwrite").json(path)


def write_manifest(spark: SparkSession, path: str, statistics: DataFrame | None = None, **facts) -> None:
    """The facts of a run as JSON, with the one row of ``statistics`` under that name."""
    if statistics is not None:
        facts["statistics"] = statistics.first().asDict()
    files.put(spark, path, json.dumps(facts, indent=1, sort_keys=True, default=str))


def write_stage(df: DataFrame, root: str, stage: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{stage}")


def read_stage(spark: SparkSession, root: str, stage: str, columns: list[str]) -> DataFrame:
    """What the stage before wrote, refused at once if a column of the contract is missing."""
    return require(spark.read.parquet(f"{root}/{stage}"), columns)


def save_snapshot(df: DataFrame, root: str, version: int = 1) -> str:
    """A new snapshot beside the earlier ones, then the pointer to it; a table is never written over while it is read."""
    name = uuid.uuid4().hex
    df.write.parquet(f"{root}/{name}")
    files.put(df.sparkSession, f"{root}/CURRENT", json.dumps({"snapshot": name, "format_version": version}))
    return name


def load_snapshot(spark: SparkSession, root: str, schema: str, version: int = 1) -> DataFrame:
    """The current snapshot; an empty table if there is none, its pointer can't be read or it is of another version."""
    try:
        at = json.loads(files.get(spark, f"{root}/CURRENT") or "null")
    except ValueError:
        at = None
    if not isinstance(at, dict) or at.get("format_version") != version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{at['snapshot']}")
