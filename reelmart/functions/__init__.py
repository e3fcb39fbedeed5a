"""Column-expression helpers (built-in functions only)."""

from reelmart.functions.columns import (  # noqa: F401
    at_least_ladder,
    below_ladder,
    comma_count_or_zero,
    comma_pieces,
    contains_any_ci,
    count_when,
    decade_of,
    exact_avg,
    exact_pct,
    flag,
    in_ladder,
    ladder,
    rounded_avg,
)
