"""Data-quality checks: each returns the violating rows as a DataFrame.

A check passes when it returns no rows. Semantics follow the usual warehouse
test conventions:

* ``unique``: key values occurring more than once (NULLs ignored),
  as ``(unique_field, n_records)``;
* ``not_null``: rows where the column is NULL;
* ``accepted_values``: values outside the list with their counts (NULL passes),
  as ``(value_field, n_records)``;
* ``relationships``: child keys (not NULL) missing from the parent, as ``from_field``;
* ``expression``: rows inside ``where`` for which the predicate is false
  (a NULL predicate passes).

``quality_report`` evaluates every declared check and returns one row per
check with its failure count and status.

* Row-level checks of a relation that was measured while it was written
  (``operators.measure``) are not computed again; of any other relation they are one
  aggregate of conditional counts in one pass.
* ``key_census`` counts the keys of all relations in one aggregation: few counts a row, one
  row per key for each set of columns that are compared. All unique and relationship checks
  are sums over it.
* Accepted-values checks need distinct bad values: rows with one are filtered out first, so
  clean relations shuffle nothing; columns measured as clean are not read.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart import constants as K
from reelmart.operators.marts import as_of

Pred = Callable[[Column], Column]  # as_of year column -> predicate

#: Kinds of check that a single row can fail.
IN_ROWS = ("not_null", "expression", "singular", "accepted_values")


def effective_year(as_of_year: int | None) -> int:
    """The clock year that the checks use: the given one, or this year."""
    return datetime.date.today().year if as_of_year is None else as_of_year


# ---------------------------------------------------------------- generic checks

def check_unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return (df.filter(~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, n_records) of the child's keys (not NULL) that the parent lacks.

    Child rows are counted per key first, map-side, so a key that holds a third of all
    rows is one row per task in the shuffle.
    """
    counts = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
              .agg(F.count(F.lit(1)).alias("n_records")))
    return counts.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    orphans = orphan_keys(child, column, parent, parent_column).select(F.col("key").alias(column))
    return child.join(orphans, column, "left_semi").select(F.col(column).alias("from_field"))


def check_expression(df: DataFrame, predicate: Column, where: Column | None = None) -> DataFrame:
    scoped = df.filter(where) if where is not None else df
    return scoped.filter(~predicate)


# ---------------------------------------------------------------- declarations

@dataclass(frozen=True)
class Check:
    check_id: str
    relation: str
    kind: str                      # unique | not_null | accepted_values | relationships | expression | singular
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    parent: tuple[str, str] | None = None
    passes: Pred | None = None     # expression checks: predicate that must hold
    where: Pred | None = None      # expression checks: rows in scope
    fails: Pred | None = None      # singular checks: predicate of a violating row
    columns: tuple = field(default=())  # singular checks: returned columns

    def violation(self, now: Column) -> Column:
        """Row-level predicate of a failing row (row-level kinds only)."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "expression":
            scope = self.where(now) if self.where else F.lit(True)
            return scope & ~self.passes(now)
        if self.kind == "singular":
            return self.fails(now)
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(list(self.values))
        raise ValueError(self.kind)


def _declared() -> list[Check]:
    c = F.col
    checks: list[Check] = []

    def unique(rel, col):
        checks.append(Check(f"unique_{rel}_{col}", rel, "unique", col))

    def not_null(rel, *cols):
        for col in cols:
            checks.append(Check(f"not_null_{rel}_{col}", rel, "not_null", col))

    def accepted(rel, col, values):
        checks.append(Check(f"accepted_values_{rel}_{col}", rel, "accepted_values", col, values=tuple(values)))

    def relationship(rel, col, parent, parent_col):
        checks.append(Check(f"relationships_{rel}_{col}", rel, "relationships", col, parent=(parent, parent_col)))

    def expression(rel, col, passes, where=None, severity="error"):
        checks.append(Check(f"expression_is_true_{rel}_{col}", rel, "expression", col, severity=severity,
                            passes=passes, where=where))

    # raw sources: declared keys
    for rel, key in (("raw_title_basics", "tconst"), ("raw_title_ratings", "tconst"),
                     ("raw_name_basics", "nconst")):
        unique(rel, key)
        not_null(rel, key)

    # staging
    unique("stg_title_basics", "title_id")
    not_null("stg_title_basics", "title_id", "title_type")
    accepted("stg_title_basics", "title_type", K.SUPPORTED_TITLE_TYPES)
    not_null("stg_title_basics", "primary_title")
    unique("stg_title_ratings", "title_id")
    not_null("stg_title_ratings", "title_id")
    relationship("stg_title_ratings", "title_id", "stg_title_basics", "title_id")
    not_null("stg_title_ratings", "average_rating", "num_votes")
    unique("stg_name_basics", "person_id")
    not_null("stg_name_basics", "person_id", "primary_name")
    not_null("stg_title_principals", "title_id")
    relationship("stg_title_principals", "title_id", "stg_title_basics", "title_id")
    not_null("stg_title_principals", "person_id")
    relationship("stg_title_principals", "person_id", "stg_name_basics", "person_id")
    not_null("stg_title_principals", "job_category")
    not_null("stg_title_akas", "title_id")
    relationship("stg_title_akas", "title_id", "stg_title_basics", "title_id")

    # dim_titles
    not_null("dim_titles", "title_id")
    unique("dim_titles", "title_id")
    not_null("dim_titles", "primary_title", "title_type")
    accepted("dim_titles", "title_type", K.SUPPORTED_TITLE_TYPES)
    not_null("dim_titles", "is_adult")
    accepted("dim_titles", "content_rating_category", [K.ADULT_CONTENT, K.GENERAL_AUDIENCE])
    expression("dim_titles", "start_year", lambda now: (c("start_year") >= 1800) & (c("start_year") <= now),
               severity="warn")
    expression("dim_titles", "end_year", lambda now: c("end_year") >= c("start_year"),
               where=lambda now: c("end_year").isNotNull() & c("start_year").isNotNull(), severity="warn")
    expression("dim_titles", "runtime_minutes",
               lambda now: (c("runtime_minutes") > 0) & (c("runtime_minutes") < 1000),
               where=lambda now: c("runtime_minutes").isNotNull(), severity="warn")
    accepted("dim_titles", "runtime_category",
             [K.RUNTIME_UNKNOWN, K.RUNTIME_SHORT, K.RUNTIME_STANDARD, K.RUNTIME_LONG, K.RUNTIME_EXTENDED])
    accepted("dim_titles", "content_category", [label for _, label in K.CONTENT_CATEGORIES] + [K.CONTENT_OTHER])
    expression("dim_titles", "genre_count", lambda now: c("genre_count") >= 0)
    accepted("dim_titles", "title_length_category", [K.TITLE_SHORT, K.TITLE_MEDIUM, K.TITLE_LONG])

    # dim_people
    not_null("dim_people", "person_id")
    unique("dim_people", "person_id")
    not_null("dim_people", "primary_name")
    expression("dim_people", "birth_year", lambda now: (c("birth_year") > 1800) & (c("birth_year") <= now),
               where=lambda now: c("birth_year").isNotNull(), severity="warn")
    expression("dim_people", "death_year", lambda now: c("death_year") > c("birth_year"),
               where=lambda now: c("death_year").isNotNull() & c("birth_year").isNotNull(), severity="warn")
    not_null("dim_people", "is_deceased")
    accepted("dim_people", "age_category", [K.AGE_UNKNOWN] + [label for _, label in K.AGE_LADDER] + [K.AGE_ELDER])
    not_null("dim_people", *K.ROLE_PATTERNS, "is_multi_role_professional")
    accepted("dim_people", "generation",
             [K.GENERATION_UNKNOWN, K.GENERATION_PRE_SILENT] + [label for _, _, label in K.GENERATIONS]
             + [K.GENERATION_ALPHA])

    # fact_ratings
    not_null("fact_ratings", "title_id")
    relationship("fact_ratings", "title_id", "dim_titles", "title_id")
    expression("fact_ratings", "average_rating",
               lambda now: (c("average_rating") >= 1.0) & (c("average_rating") <= 10.0),
               where=lambda now: c("average_rating").isNotNull())
    expression("fact_ratings", "num_votes", lambda now: c("num_votes") > 0,
               where=lambda now: c("num_votes").isNotNull())
    accepted("fact_ratings", "rating_category",
             [K.RATING_NOT_RATED] + [label for _, label in K.RATING_LADDER] + [K.RATING_OUTSTANDING])
    accepted("fact_ratings", "vote_volume_category",
             [K.VOTES_NONE] + [label for _, label in K.VOTE_LADDER] + [K.VOTES_MASSIVE])
    not_null("fact_ratings", "is_statistically_significant", "is_highly_rated_popular", "is_mainstream_success")
    accepted("fact_ratings", "rating_confidence",
             [K.CONFIDENCE_NONE] + [label for _, label in K.CONFIDENCE_LADDER] + [K.CONFIDENCE_TOP])
    accepted("fact_ratings", "success_category",
             [K.CRITICAL_ACCLAIM, K.POPULAR_SUCCESS, K.COMMERCIAL_SUCCESS, K.CRITICAL_FAILURE,
              K.HIGH_VISIBILITY, K.STANDARD_RELEASE])
    accepted("fact_ratings", "quality_popularity_quadrant", K.QUADRANTS)

    checks.extend(SINGULAR_CHECKS)
    return checks


# FIXED VALUES: the declared checks above, and the messages returned by the singular checks.
RATING_RANGE_MESSAGE = "Rating out of valid range (1-10)"
MOVIE_YEAR_MESSAGE = "Start year seems unreasonable for a movie/show"
RUNTIME_MESSAGE = "Runtime seems unreasonable"
BIRTH_YEAR_MESSAGE = "Birth year seems unreasonable"

_c = F.col
SINGULAR_CHECKS = [
    Check("rating_range", "stg_title_ratings", "singular", severity="error",
          fails=lambda now: (_c("average_rating") < 1.0) | (_c("average_rating") > 10.0),
          columns=("title_id", "average_rating", ("error_message", RATING_RANGE_MESSAGE))),
    Check("movie_years", "stg_title_basics", "singular", severity="warn",
          fails=lambda now: _c("start_year").isNotNull()
          & ((_c("start_year") > now + F.lit(5)) | (_c("start_year") < 1800)),
          columns=("title_id", "primary_title", "start_year", ("warning_message", MOVIE_YEAR_MESSAGE))),
    Check("runtime", "stg_title_basics", "singular", severity="warn",
          fails=lambda now: _c("runtime_minutes").isNotNull()
          & ((_c("runtime_minutes") > 600) | (_c("runtime_minutes") < 1)),
          columns=("title_id", "primary_title", "runtime_minutes", "title_type",
                   ("warning_message", RUNTIME_MESSAGE))),
    Check("birth_years", "stg_name_basics", "singular", severity="warn",
          fails=lambda now: _c("birth_year").isNotNull() & ((_c("birth_year") > now) | (_c("birth_year") < 1800)),
          columns=("person_id", "primary_name", "birth_year", ("warning_message", BIRTH_YEAR_MESSAGE))),
    Check("career_span", "dim_people", "singular", severity="error",
          fails=lambda now: (_c("potential_career_span_years") > 80)
          & _c("potential_career_span_years").isNotNull(),
          columns=("person_id", "primary_name", "birth_year", "death_year", "potential_career_span_years",
                   "age_or_current_age")),
    Check("rating_credibility", "fact_ratings", "singular", severity="error",
          fails=lambda now: (_c("average_rating") >= 8.0) & (_c("num_votes") < 100)
          & _c("average_rating").isNotNull() & _c("num_votes").isNotNull(),
          columns=("title_id", "average_rating", "num_votes", "rating_category")),
    Check("rating_consistency", "fact_ratings", "singular", severity="error",
          fails=lambda now: (_c("rating_category") == K.RATING_OUTSTANDING)
          & (_c("success_category") == K.CRITICAL_FAILURE)
          & _c("average_rating").isNotNull() & _c("popularity_score").isNotNull(),
          columns=("title_id", "average_rating", "num_votes", "popularity_score", "rating_category",
                   "success_category")),
]

DECLARED_CHECKS = _declared()


def layer_of(relation: str) -> str:
    """'sources', 'staging' or 'marts' for a relation name."""
    if relation.startswith("raw_"):
        return "sources"
    return "staging" if relation.startswith("stg_") else "marts"


def select_checks(layer: str | None = None, kinds: list[str] | None = None) -> list[Check]:
    """Declared checks of one layer and/or kinds (as a test runner selects them).

    ``kinds`` uses the check kinds; ``"generic"`` stands for every declared
    column check (all kinds except ``singular``).
    """
    wanted = set(kinds or [])
    if "generic" in wanted:
        wanted |= {"unique", "not_null", "accepted_values", "relationships", "expression"}
    return [chk for chk in DECLARED_CHECKS
            if (layer is None or layer_of(chk.relation) == layer) and (not wanted or chk.kind in wanted)]


def check_by_id(check_id: str) -> Check:
    for chk in DECLARED_CHECKS:
        if chk.check_id == check_id:
            return chk
    raise KeyError(check_id)


def run_check(check: Check, relations: dict[str, DataFrame], as_of_year: int | None = None) -> DataFrame:
    """Violating rows of one declared check."""
    df = relations[check.relation]
    now = as_of(as_of_year)
    if check.kind == "unique":
        return check_unique(df, check.column)
    if check.kind == "not_null":
        return check_not_null(df, check.column)
    if check.kind == "accepted_values":
        return check_accepted_values(df, check.column, list(check.values))
    if check.kind == "relationships":
        parent, parent_col = check.parent
        return check_relationships(df, check.column, relations[parent], parent_col)
    if check.kind == "expression":
        return check_expression(df, check.passes(now), check.where(now) if check.where else None)
    if check.kind == "singular":
        cols = [F.lit(c[1]).alias(c[0]) if isinstance(c, tuple) else F.col(c) for c in check.columns]
        return df.filter(check.fails(now)).select(*cols)
    raise ValueError(check.kind)


# ---------------------------------------------------------------- report

REPORT_COLUMNS = ["check_id", "relation", "column_name", "kind", "severity", "failures", "status"]


def _report_rows(checks: list[Check], counts: DataFrame) -> DataFrame:
    """``counts`` has (check_id, failures); attach the declared metadata."""
    meta = F.create_map(*[x for chk in checks for x in (F.lit(chk.check_id), F.array(
        F.lit(chk.relation), F.lit(chk.column), F.lit(chk.kind), F.lit(chk.severity)))])
    m = meta[F.col("check_id")]
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(m[3] == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return counts.select("check_id", m[0].alias("relation"), m[1].alias("column_name"), m[2].alias("kind"),
                         m[3].alias("severity"), F.col("failures").cast("bigint").alias("failures"),
                         status.alias("status"))


def _as_rows(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts as (check_id, failures) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check_id"), F.col(n).cast("long").alias("failures")) for n in names])
    return counts.select(F.inline(pairs))


def _row_level(df: DataFrame, checks: list[Check], now: Column) -> DataFrame:
    """(check_id, failures) of row-level checks: conditional counts in one pass."""
    return _as_rows(df.agg(*[F.count_if(chk.violation(now)).alias(chk.check_id) for chk in checks]), [chk.check_id for chk in checks])


def _bad_values(df: DataFrame, checks: list[Check], now: Column) -> DataFrame:
    """(check_id, value) of the failing rows of accepted-values checks; rows without one go before anything is built."""
    bad = [F.when(chk.violation(now), F.struct(F.lit(chk.check_id).alias("check_id"), F.col(chk.column).cast("string").alias("value"))) for chk in checks]
    any_bad = checks[0].violation(now)
    for chk in checks[1:]:
        any_bad = F.coalesce(any_bad, F.lit(False)) | F.coalesce(chk.violation(now), F.lit(False))
    return df.filter(any_bad).select(F.inline(F.filter(F.array(*bad), lambda x: x.isNotNull())))


def _key_columns(checks: list[Check]) -> list[tuple[str, str]]:
    """(relation, column) of every key that a unique or relationship check counts."""
    keys: dict[tuple[str, str], None] = {}
    for chk in checks:
        if chk.kind in ("unique", "relationships"):
            keys[chk.relation, chk.column] = None
        if chk.kind == "relationships":
            keys[chk.parent] = None
    return list(keys)


#: Counts side by side in a row of the census; a task holds as many rows as it meets keys.
SLOTS = 4


def _places(keys: list[tuple[str, str]], checks: list[Check]) -> list[tuple[int, int]]:
    """(part, slot) of every key column: columns that a relationship compares are in one part, and small sets share one."""
    sets = [{k} for k in keys]
    for chk in checks:
        if chk.kind == "relationships":
            ends = {(chk.relation, chk.column), chk.parent}
            met = [s for s in sets if s & ends]
            sets = [s for s in sets if not s & ends] + [set().union(*met)]
    parts: list[list] = []
    for s in sorted(sets, key=lambda s: (-len(s), min(keys.index(k) for k in s))):
        room = next((p for p in parts if len(p) + len(s) <= SLOTS), None)
        if room is None:
            parts.append(room := [])
        room += sorted(s, key=keys.index)
    at = {k: (i, j) for i, p in enumerate(parts) for j, k in enumerate(p)}
    return [at[k] for k in keys]


def key_census(relations: dict[str, DataFrame], keys: list[tuple[str, str]], places: list[tuple[int, int]] | None = None) -> DataFrame:
    """(key, n0, n1, ...): how often each key stands in each of the (relation, column) pairs ``keys``; NULL keys are left out.

    With ``places``, the (part, slot) of each pair, it is (part, key, n0, ...) with one row for each part that has the key and one count a slot.

    One aggregation over the narrow key columns of all relations. Counts are added up within
    each task first, so a key that holds a third of all rows is one row per task in the shuffle.
    A relation with several key columns is read once.
    """
    at = places or [(0, i) for i in range(len(keys))]
    of_relation: dict[str, list[int]] = {}
    for i, (rel, _) in enumerate(keys):
        of_relation.setdefault(rel, []).append(i)
    parts = []
    for rel, columns in of_relation.items():
        stacked = F.array(*[F.struct(F.lit(at[i][0]).alias("part"), F.lit(at[i][1]).alias("at"), F.col(keys[i][1]).cast("string").alias("key")) for i in columns])
        parts.append(relations[rel].select(F.inline(stacked)).filter(F.col("key").isNotNull()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    counts = [F.count_if(F.col("at") == i).alias(f"n{i}") for i in range(1 + max(slot for _, slot in at))]
    return out.groupBy(*(["part"] if places else []), "key").agg(*counts)


def _key_failures(census: DataFrame, keys: list[tuple[str, str]], checks: list[Check], places: list[tuple[int, int]]) -> DataFrame:
    """(check_id, failures) of unique and relationship checks from the census."""
    def failures(chk: Check) -> Column:
        part, slot = places[keys.index((chk.relation, chk.column))]
        here, n = F.col("part") == part, F.col(f"n{slot}")
        if chk.kind == "unique":
            return F.count_if(here & (n > 1))
        return F.sum(F.when(here & (F.col(f"n{places[keys.index(chk.parent)][1]}") == 0), n).otherwise(0))

    sums = census.agg(*[F.coalesce(failures(chk), F.lit(0)).alias(chk.check_id) for chk in checks])
    return _as_rows(sums, [chk.check_id for chk in checks])


def quality_report(relations: dict[str, DataFrame], checks: list[Check] | None = None,
                   as_of_year: int | None = None, measured: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """One row per check: (check_id, relation, column_name, kind, severity, failures, status).

    ``measured``: what was measured while relations were written (relation -> numbers by
    name, ``operators.measure``); numbers of another clock year are not used.
    """
    checks = checks if checks is not None else DECLARED_CHECKS
    now, year = as_of(as_of_year), effective_year(as_of_year)
    known = {rel: m for rel, m in (measured or {}).items() if m.get("as_of_year") == year}
    parts: list[DataFrame] = []
    settled: list[tuple[str, int]] = []
    values: list[DataFrame] = []
    by_relation: dict[str, list[Check]] = {}
    for chk in checks:
        by_relation.setdefault(chk.relation, []).append(chk)
    for rel, rel_checks in by_relation.items():
        have = known.get(rel, {})
        in_rows = [chk for chk in rel_checks if chk.kind in IN_ROWS]
        # a measured zero settles any check, a measured count all but those that count distinct values
        done = [chk for chk in in_rows if chk.check_id in have and (chk.kind != "accepted_values" or have[chk.check_id] == 0)]
        settled += [(chk.check_id, have[chk.check_id]) for chk in done]
        todo = [chk for chk in in_rows if chk not in done]
        rows, accepted = ([chk for chk in todo if (chk.kind == "accepted_values") == kind] for kind in (False, True))
        if rows:
            parts.append(_row_level(relations[rel], rows, now))
        if accepted:
            values.append(_bad_values(relations[rel], accepted, now))
            settled += [(chk.check_id, 0) for chk in accepted]  # plus the bad values below
    if values:
        bad = values[0]
        for v in values[1:]:
            bad = bad.unionByName(v)
        parts.append(bad.distinct().groupBy("check_id").agg(F.count(F.lit(1)).alias("failures")))
    by_key = [chk for chk in checks if chk.kind in ("unique", "relationships")]
    if by_key:
        keys = _key_columns(by_key)
        places = _places(keys, by_key)
        parts.append(_key_failures(key_census(relations, keys, places), keys, by_key, places))
    spark = next(iter(relations.values())).sparkSession if not parts else parts[0].sparkSession
    counts = spark.createDataFrame(settled, "check_id string, failures long")
    for p in parts:
        counts = counts.unionByName(p)
    # at most two rows a check: its zero and its bad values
    return _report_rows(checks, counts.groupBy("check_id").agg(F.sum("failures").alias("failures")))


def failed_checks(report: DataFrame) -> DataFrame:
    """Error-severity checks that returned rows (the ones that should stop a pipeline)."""
    return report.filter(F.col("status") == "fail")
