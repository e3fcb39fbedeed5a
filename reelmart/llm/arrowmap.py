"""Run a numpy function over whole texts, slice by slice, through ``mapInArrow``."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .words import SLICE_BYTES, buffers, slices

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A no-op where the package is installed or shipped with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def map_texts(docs: DataFrame, id_col: str, text_col: str, fields: list[StructField],
              fn: Callable[[np.ndarray, np.ndarray], list], slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, *fields) for every document.

    ``fn(raw, offsets)`` gets the UTF-8 bytes of some whole documents and returns one
    Arrow array (or list) per field, a row a document. A null text counts as empty. Only
    the id and text columns are read, so other columns and their names do not matter.
    """
    visible(docs.sparkSession)
    id_type = docs.select(id_col).schema[0].dataType
    schema = StructType([StructField(id_col, id_type), *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for a, b in slices(offsets, slice_bytes):
                cut = offsets[a:b + 1]
                out = fn(raw[cut[0]:cut[-1]], cut - cut[0])
                arrays = [batch.column(0).slice(a, b - a)]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, arrow.field(i + 1).type) for i, x in enumerate(out)]
                arrays = [x if x.type == f.type else x.cast(f.type) for x, f in zip(arrays, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return src.mapInArrow(run, schema)


def add_from_texts(docs: DataFrame, text_col: str, fields: list[StructField], fn: Callable[[np.ndarray, np.ndarray], list],
                   slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All columns of ``docs`` and, at the end, ``fields`` from ``fn`` as in ``map_texts``; column names may clash."""
    visible(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    plain = docs.toDF(*names)
    schema = StructType([*plain.schema.fields, *[StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)]])
    added = [f.type for f in to_arrow_schema(StructType(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(at))
            for a, b in slices(offsets, slice_bytes):
                cut = offsets[a:b + 1]
                out = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(fn(raw[cut[0]:cut[-1]], cut - cut[0]), added)]
                kept = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*kept.columns, *out], names=[f.name for f in schema])

    return plain.mapInArrow(run, schema).toDF(*docs.columns, *[f.name for f in fields])
