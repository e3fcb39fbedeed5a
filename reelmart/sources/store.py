"""Versioned tables under one root folder: stage, check, then publish.

A table is a set of Parquet folders (parts) that a row of the manifest names. Writers
stage new parts in folders of their own, check them there, and publish by appending one
manifest row; readers take the newest row. So a failed load leaves the published data as
it was, a reader never sees half a table, and an append is one more part. One row may also
name several tables (``publish_set``): they then change together. What was measured while a
part was written (row counts, failures of row-level checks) is kept in the row's note.
Old parts stay until someone deletes them; ``unreferenced_parts`` lists them.

One writer at a time per table; the manifest is a small Parquet folder on the same shared
storage. ``database_of`` names a catalog database after the root, for bucketed parts, so
two roots never share a table.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_MEMBER = "table_name string, parts array<string>, row_count long, catalog_table string, note string"
_SCHEMA = f"table_name string, seq long, parts array<string>, row_count long, catalog_table string, note string, members array<struct<{_MEMBER.replace(' ', ':').replace(',:', ', ')}>>"


@dataclass(frozen=True)
class Published:
    table: str
    seq: int
    parts: tuple[str, ...]
    rows: int
    catalog_table: str | None = None
    note: str = ""

    @property
    def measured(self) -> dict:
        """What was measured while the parts were written; empty if nothing was."""
        return json.loads(self.note) if self.note.startswith("{") else {}


@dataclass(frozen=True)
class Staged:
    """Parts that are written but not yet published."""

    table: str
    parts: tuple[str, ...]
    rows: int
    catalog_table: str | None = None
    note: str = ""


def _manifest(root: str) -> str:
    """One folder per table below, so that tables can be published side by side."""
    return f"{root.rstrip('/')}/manifest"


def new_part(root: str, table: str, name: str | None = None) -> str:
    """A folder for a part that is being staged."""
    return f"{root.rstrip('/')}/{table}/{name or uuid.uuid4().hex[:12]}"


def published(spark: SparkSession, root: str) -> dict[str, Published]:
    """The newest publication of every table under ``root``."""
    newest: dict[str, Published] = {}
    try:
        rows = spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).parquet(_manifest(root))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return newest
        raise
    for r in rows.orderBy("seq").collect():  # one row per publication of a handful of tables
        for m in r.members or [r]:
            newest[m.table_name] = Published(m.table_name, r.seq, tuple(m.parts), m.row_count, m.catalog_table, m.note or "")
    return newest


def _append(spark: SparkSession, root: str, name: str, row: tuple) -> None:
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("append").parquet(f"{_manifest(root)}/{name}")


def _next_seq(before: list[Published]) -> int:
    return max([time.time_ns(), *(p.seq + 1 for p in before)])


def publish(spark: SparkSession, root: str, table: str, parts: list[str], rows: int,
            catalog_table: str | None = None, note: str = "", before: Published | None = None) -> Published:
    """Make ``parts`` the table, at once. ``before``: the table's newest publication, if the caller has just read it."""
    before = before or published(spark, root).get(table)
    seq = _next_seq([before] if before else [])
    _append(spark, root, table, (table, seq, list(parts), rows, catalog_table, note, None))
    return Published(table, seq, tuple(parts), rows, catalog_table, note)


def publish_set(spark: SparkSession, root: str, name: str, staged: list[Staged]) -> None:
    """Make the staged parts their tables, all at once: one manifest row names every member."""
    found = published(spark, root)
    members = [(s.table, list(s.parts), s.rows, s.catalog_table, s.note) for s in staged]
    seq = _next_seq([found[s.table] for s in staged if s.table in found])
    _append(spark, root, name, (name, seq, [], sum(s.rows for s in staged), None, None, members))


def unreferenced_parts(spark: SparkSession, root: str) -> list[str]:
    """Parts that older publications named and no newest one does. A listing only: deleting them is left to the owner."""
    live = {part for p in published(spark, root).values() for part in p.parts}
    try:
        rows = spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).parquet(_manifest(root)).collect()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return []
        raise
    return sorted({part for r in rows for m in (r.members or [r]) for part in m.parts} - live)


def read_published(spark: SparkSession, entry: Published) -> DataFrame:
    """The published table, through the catalog if it is stored bucketed there."""
    if entry.catalog_table and len(entry.parts) == 1:
        return spark.table(entry.catalog_table)
    return spark.read.parquet(*entry.parts)


def database_of(root: str, prefix: str = "reelmart") -> str:
    """Catalog database that belongs to one root."""
    return f"{prefix}_{hashlib.sha256(root.rstrip('/').encode()).hexdigest()[:12]}"
