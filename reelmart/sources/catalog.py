"""Source catalogue: the five raw tables, their all-text schemas and keys."""

from __future__ import annotations

from pyspark.sql import types as T

from reelmart.constants import RAW_COLUMNS, SOURCE_FILES

RAW_TABLES = list(RAW_COLUMNS)


def raw_schema(table: str) -> T.StructType:
    """All-``StringType`` schema of a raw table, in file column order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table]])


def file_for(table: str) -> str:
    """Landing file name of a raw table."""
    for name, tbl in SOURCE_FILES.items():
        if tbl == table:
            return name
    raise KeyError(table)
