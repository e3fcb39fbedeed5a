"""Column-expression helpers.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen: no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(branches: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Searched CASE: first true condition wins; NULL conditions fall through."""
    expr = None
    for cond, value in branches:
        value_col = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value_col) if expr is None else expr.when(cond, value_col)
    if expr is None:
        return otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    if otherwise is None:
        return expr
    return expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def below_ladder(col: Column, steps: Sequence[tuple[object, str]], top: str,
                 null_label: str | None = None, inclusive: bool = False) -> Column:
    """Bucket ``col`` by ascending upper bounds: ``col < bound`` (or ``<=``)."""
    branches: list[tuple[Column, object]] = []
    if null_label is not None:
        branches.append((col.isNull(), null_label))
    for bound, label in steps:
        branches.append(((col <= bound) if inclusive else (col < bound), label))
    return ladder(branches, top)


def at_least_ladder(col: Column, steps: Sequence[tuple[object, str]], bottom: str) -> Column:
    """Bucket ``col`` by descending lower bounds: ``col >= bound``."""
    return ladder([(col >= bound, label) for bound, label in steps], bottom)


def in_ladder(col: Column, groups: Sequence[tuple[Sequence[str], str]], otherwise: object) -> Column:
    """Simple CASE over IN-lists."""
    return ladder([(col.isin(list(values)), label) for values, label in groups], otherwise)


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN true ELSE false END``: NULL becomes false."""
    return F.coalesce(cond, F.lit(False))


def comma_pieces(col: Column) -> Column:
    """Number of comma-separated pieces, trailing empties counted.

    NULL for NULL input and for the empty string (an empty array has no length).
    """
    return F.when(col != "", F.size(F.split(col, ",", -1)))


def comma_count_or_zero(col: Column) -> Column:
    """``CASE WHEN col IS NOT NULL THEN pieces ELSE 0``: '' stays NULL."""
    return F.when(col.isNull(), F.lit(0)).otherwise(comma_pieces(col))


def decade_of(year: Column) -> Column:
    """``floor(year / 10) * 10`` as int; NULL kept."""
    return (F.floor(year / F.lit(10)) * F.lit(10)).cast("int")


def contains_any_ci(col: Column, needles: Iterable[str]) -> Column:
    """Case-blind substring match of any needle; NULL input gives false."""
    cond = None
    for needle in needles:
        c = col.ilike(f"%{needle}%")
        cond = c if cond is None else (cond | c)
    return flag(cond)


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)`` as bigint."""
    return F.count(F.when(cond, F.lit(1)))


def exact_avg(col: Column, int_digits: int = 12, scale: int = 12) -> Column:
    """Average with exact decimal arithmetic (result keeps ``scale + 4`` decimals).

    Spark's ``avg`` of a narrow decimal keeps too few decimals and ``avg`` of an
    integer is a double; casting the input to a wide decimal first keeps the
    result exact to well past the rounding position used by callers.
    """
    return F.avg(col.cast(f"decimal({int_digits + scale},{scale})"))


def rounded_avg(col: Column, digits: int, int_digits: int = 12) -> Column:
    """``ROUND(AVG(col), digits)`` with exact half-away-from-zero rounding, as double."""
    return F.round(exact_avg(col, int_digits=int_digits), digits).cast("double")


def exact_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * part / whole, digits)`` exactly; NULL when ``whole`` is 0."""
    ratio = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(ratio, digits).cast("double")
