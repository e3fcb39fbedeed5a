"""Ranges of a key for laying out a table, found without running the table's plan.

``DataFrame.repartitionByRange`` samples its input first, which runs the whole plan of a
mart once more. ``find_bounds`` looks at the key columns alone: a bottom-k sketch, the
``SAMPLE`` rows with the smallest hashes (each task keeps its own smallest, so its size is
fixed and no keys are shuffled). It is a uniform sample of the rows; its largest hash
also estimates how many rows there are, which sets the number of ranges. ``deal`` sends
every row straight to the partition of its range.

A key with more rows than a range takes several bounds of the same value; its rows are
dealt over all ranges between them by a hash of their other columns, so a hot key is split
and files stay in key order.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 65_536  # rows of the sketch
ROWS_PER_RANGE = 5_000_000
MAX_RANGES = 8_192  # eight rows of the sketch to a range


@dataclass(frozen=True)
class RangeBounds:
    """Ascending first keys of all ranges but the first; equal ones split a hot key."""

    cuts: tuple

    @property
    def ranges(self) -> int:
        return len(self.cuts) + 1

    def _below(self, key: Column, values: list, places: list[int]) -> Column:
        """places[number of ``values`` that are <= key], by binary search."""
        steps = max(1, len(values).bit_length())
        array = F.array(*[F.lit(v) for v in values])

        def halve(state: Column, _: Column) -> Column:
            middle = ((state["lo"] + state["hi"]) / 2).cast("int")
            right = (state["lo"] < state["hi"]) & (F.get(array, middle) <= key)
            return F.struct(F.when(right, middle + 1).otherwise(state["lo"]).alias("lo"), F.when(right, state["hi"]).otherwise(middle).alias("hi"))

        start = F.struct(F.lit(0).alias("lo"), F.lit(len(values)).alias("hi"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])
        return F.get(F.array(*[F.lit(p) for p in places]), found)

    def range_of(self, key: Column, spread: Column) -> Column:
        """Range of a row; ``spread``: a hash that deals the rows of a key over its ranges. A null key is in the first."""
        if not self.cuts:
            return F.lit(0)
        values = sorted(set(self.cuts))
        last = [0, *[bisect_right(self.cuts, v) for v in values]]
        out = self._below(key, values, last)
        # a key that is a cut itself may lie in any range from the one it ends to the last one it begins
        hot = [v for v in values if bisect_right(self.cuts, v) - bisect_left(self.cuts, v) > 1]
        if hot:
            width = F.create_map(*[x for v in hot for x in (F.lit(v), F.lit(bisect_right(self.cuts, v) - bisect_left(self.cuts, v)))])
            out = out - F.coalesce(F.pmod(spread, width[key]).cast("int"), F.lit(0))
        return F.coalesce(out, F.lit(0))

    def deal(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with one partition per range, in range order."""
        others = [F.col(c) for c in df.columns if not df.schema[c].dataType.typeName() in ("map", "variant")]
        return df.repartitionById(self.ranges, self.range_of(F.col(key), F.xxhash64(*others)).cast("int"))


def find_bounds(keys: DataFrame, ranges: int | None = None, sample: int = SAMPLE) -> RangeBounds:
    """Bounds that split the rows of ``keys`` about evenly by its first column (further columns only tell rows apart).

    ``ranges``: how many (default: one for about ``ROWS_PER_RANGE`` rows, but one for each core
    at least, as far as the sketch has rows, and ``MAX_RANGES`` at most).
    """
    spark, key = keys.sparkSession, keys.columns[0]
    held = (keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(*keys.columns).alias("h"))
            .orderBy("h", "k").limit(sample).collect())  # at most ``sample`` narrow rows
    if ranges is None:
        share = (held[-1].h + 2**63) / 2**64 if len(held) == sample else 1.0
        cores = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ranges = min(MAX_RANGES, max(cores, round(len(held) / max(share, 2**-60) / ROWS_PER_RANGE)))
    values = sorted(r.k for r in held)
    ranges = max(1, min(ranges, len(values)))
    return RangeBounds(tuple(values[i * len(values) // ranges] for i in range(1, ranges)))
