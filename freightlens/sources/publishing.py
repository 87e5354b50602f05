"""Publishing all tables of a run at once, by a pointer that is swapped last.

    <target>/_versions/<run>-<n>/<table>/part-*.parquet
    <target>/_current.json        the tables that readers see, and the versions they lie in

Every publication writes into a version of its own. Readers resolve the pointer, so they see the tables of one
publication, whatever happens meanwhile; one that fails, at whichever table, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .config import run_name
from .readers import TableCatalog, read_parquet
from .runs import Store, write_table

POINTER = "_current.json"


def current(spark: SparkSession, target: str) -> dict:
    """What the pointer says: tables by name (path, rows, version), and the versions so far."""
    store, path = Store(spark), f"{target.rstrip('/')}/{POINTER}"
    return json.loads(store.read(path)) if store.exists(path) else {"version": "", "tables": {}, "versions": []}


def published(spark: SparkSession, target: str) -> TableCatalog:
    """The published tables as they are now; a catalog goes on reading the version that it was made from."""
    tables = current(spark, target)["tables"]
    return TableCatalog({name: (lambda p=t["path"]: read_parquet(spark, p)) for name, t in tables.items()})


def publish(spark: SparkSession, frames: dict[str, DataFrame], target: str, audit: str | None = None, run_id: str = "", skip: Iterable[str] = (), expected: dict[str, int] | None = None, order: dict[str, list[str]] | None = None, keep: int = 2) -> dict[str, int]:
    """Writes all frames to a new version, checks row counts, and points readers to it. Returns the rows written by table.

    Tables in `skip` that are published already stay as they are, as do those that `frames` doesn't have. order: the
    physical sort key of each table. keep: how many versions stay for readers that opened them. Each call leaves a row in
    `audit`: SUCCESS or FAILED with the error.
    """
    store, target = Store(spark), target.rstrip("/")
    version = f"{run_name(run_id or 'run')}-{uuid.uuid4().hex[:8]}"
    place, counts, error, started = f"{target}/_versions/{version}", {}, "", datetime.now(timezone.utc)
    try:
        before = current(spark, target)
        tables = dict(before["tables"])
        for name, df in frames.items():
            if name in set(skip) and name in tables:
                continue
            counts[name] = write_table(df, f"{place}/{name}", order=(order or {}).get(name, ()))
            if expected and name in expected and counts[name] != expected[name]:
                raise ValueError(f"{name} has {counts[name]} rows, expected {expected[name]}")
            tables[name] = {"path": f"{place}/{name}", "rows": counts[name], "version": version}
        versions = [*before["versions"], version]
        store.replace(f"{target}/{POINTER}", json.dumps({"version": version, "tables": tables, "versions": versions, "published_at": started.isoformat()}, indent=1))
    except Exception as e:
        error = str(e).splitlines()[0] if str(e) else type(e).__name__
        store.delete(place)
        raise
    finally:
        if audit:
            row = [(run_id, "FAILED" if error else "SUCCESS", started.replace(tzinfo=None), datetime.now(timezone.utc).replace(tzinfo=None), len(counts), sum(counts.values()), error)]
            schema = "run_id string, status string, started_at timestamp_ntz, ended_at timestamp_ntz, tables int, total_rows long, error string"
            spark.createDataFrame(row, schema).coalesce(1).write.mode("append").parquet(audit)
    used = {t["version"] for t in tables.values()} | set(versions[-keep:])
    for old in versions:
        if old not in used:
            store.delete(f"{target}/_versions/{old}")
    return counts
