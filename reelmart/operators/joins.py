"""Key joins against a side that is unique on the key, safe under key skew.

Every big join in the pipeline has the same shape: a large fact-like relation
(credits, alternative titles, ratings) joined on one key to a dimension or
key set that holds each key at most once. The only skew that can hurt is on
the large side: one title or person may own a large share of all rows, and a
plain shuffle join would send all of them to one task.

``unique_key_join`` salts the hot keys:

1. ``find_hot_keys`` looks for keys that hold more than ``hot_share`` of all rows. By
   arithmetic there are fewer than 1 / ``hot_share`` of them, at any size of the data.
   One aggregate over the large side finds them for all key columns at once, with a
   mergeable frequent-items sketch (``approx_top_k``) of fixed size per task: no shuffle
   of keys, and only that many (key, share) rows reach the driver.
2. Rows of a hot key get a salt below ``ceil(share / hot_share)``; every other row gets
   salt 0. The unique side is repeated once per salt for hot keys only (fewer than
   2 / ``hot_share`` rows in all) and the join runs on (key, salt). Each row still meets
   its one partner, so the result is exactly the plain join; the list only decides the
   salts, so the sketch's error cannot change it.
3. The salt comes from ``with_row``: a hash of the row's file and its number in the file. It
   spreads identical rows too, and is the same however rows were dealt over tasks before
   and however often a task is run again. Rows that come from no Parquet file are salted by
   a hash of their columns, which is stable as well.

Without hot keys the join is planned plain, so bucketed inputs keep their partitioning.
Adaptive skew-join splitting stays on as a second line of defence.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 1000  # share of all rows above which a key is split
#: Items that the sketch tracks, as a multiple of 1 / share: its error is a small part of the share.
TRACKED = 16

_SALTS = "_salts"
_SALT = "_salt"
ROW = "_row"


def with_row(df: DataFrame) -> DataFrame:
    """``df`` with the salt source of its rows, ``ROW``: where each row is stored, or its values if that is not known."""
    try:
        return df.withColumn(ROW, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:  # no file source with numbered rows below
        return df.withColumn(ROW, F.xxhash64(*[F.col(c) for c in df.columns]))


def find_hot_keys(df: DataFrame, columns: list[str], hot_share: float = HOT_SHARE) -> dict[str, DataFrame | None]:
    """Keys of each column with more than ``hot_share`` of all rows: (column, _salts), or None where there is none."""
    k = math.ceil(1 / hot_share)
    tracked = min(1_000_000, TRACKED * k)
    found = df.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k(`{c}`, {k}, {tracked})").alias(f"k{i}")
                                                  for i, c in enumerate(columns)]).first()
    out: dict[str, DataFrame | None] = {}
    for i, column in enumerate(columns):
        hot = [(r["item"], math.ceil(r["count"] / found["n"] / hot_share)) for r in (found[f"k{i}"] or [])
               if r["item"] is not None and r["count"] > hot_share * found["n"]]
        kind = df.schema[column].dataType.simpleString()
        out[column] = df.sparkSession.createDataFrame(hot, f"`{column}` {kind}, {_SALTS} int") if hot else None
    return out


def unique_key_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: DataFrame | None = None,
                    hashed: bool = False) -> DataFrame:
    """``left`` join ``right`` on ``key``; ``right`` must hold each key at most once.

    ``how`` is one of inner, left, left_semi, left_anti. ``hot``: the hot keys of ``left``
    (``find_hot_keys``); None plans the plain join. ``hashed``: ``right`` is narrow, so each
    task holds its share of it as a hash table instead of sorting the rows of ``left``.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type for a unique-key join: {how}")
    if hot is None:
        return left.join(right.hint("shuffle_hash") if hashed else right, key, how)
    hot_b = F.broadcast(hot)  # fewer than 1 / hot_share rows

    spread = F.col(ROW) if ROW in left.columns else F.xxhash64(*[F.col(c) for c in left.columns])
    salted_left = (left.join(hot_b, key, "left")
                   .withColumn(_SALT, F.when(F.col(_SALTS).isNull(), F.lit(0))
                               .otherwise(F.pmod(spread, F.col(_SALTS))).cast("int"))
                   .drop(_SALTS))
    replicas = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - F.lit(1))
    salted_right = (right.join(hot_b, key, "left")
                    .withColumn(_SALT, F.explode(replicas))
                    .drop(_SALTS))
    joined = salted_left.join(salted_right.hint("shuffle_hash") if hashed else salted_right, [key, _SALT], how).drop(_SALT)
    return joined.select(*left.columns, *[c for c in right.columns if c != key]) \
        if how in ("inner", "left", "left_outer") else joined.select(*left.columns)


def semi_join(left: DataFrame, keys: DataFrame, key: str, hot: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """Rows of ``left`` whose ``key`` is in the unique key set ``keys`` (``IN (subquery)``)."""
    return unique_key_join(left, keys.select(key), key, "left_semi", hot=hot, hashed=hashed)
