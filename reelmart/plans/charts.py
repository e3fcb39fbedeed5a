"""Dashboard datasets and headline counts.

The reference renders these with a plotting library on one machine; here they
stop at the (small) result DataFrame. Rendering is left to the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart import constants as K
from reelmart.functions import count_when, exact_avg, ladder
from reelmart.plans.analytics import MOVIE, TV_SERIES, _facts_of, _genre_stats, _movies


class EmptyResultError(ValueError):
    """A chart dataset that must have rows came back empty."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when ``df`` is empty (one ``limit(1)`` probe, no data to the driver)."""
    if df.isEmpty():
        raise EmptyResultError(f"the {what} dataset is empty")
    return df


# D1
def chart_movies_by_decade(titles: DataFrame, fact: DataFrame, first: int = 1920, last: int = 2020) -> DataFrame:
    t = _movies(titles.filter(F.col("decade").between(first, last)), "decade")
    f = _facts_of(fact, MOVIE).select("title_id", "average_rating", "is_highly_rated_popular")
    return (t.join(f, "title_id", "left")
            .groupBy("decade")
            .agg(F.count(F.lit(1)).alias("movie_count"),
                 exact_avg(F.col("average_rating")).cast("double").alias("avg_rating"),
                 count_when(F.col("is_highly_rated_popular")).alias("highly_rated_count"))
            .orderBy(F.col("decade").asc_nulls_last()))


# D2
def chart_genre_popularity(titles: DataFrame, fact: DataFrame, min_titles: int = 1000,
                           limit: int = 15) -> DataFrame:
    return (_genre_stats(titles, fact, min_titles)
            .orderBy(F.col("total_votes").desc_nulls_first(), F.col("genre").asc_nulls_last())
            .limit(limit)
            .select("genre", "title_count", F.round("_avg_rating", 2).cast("double").alias("avg_rating"),
                    "total_votes"))


# D3
def chart_quality_points(titles: DataFrame, fact: DataFrame, min_votes: int = 100, first: int = 1990,
                         last: int = 2020, limit: int = 2000) -> DataFrame:
    """Points of well-voted movies, most votes first; the top ``limit`` are taken on the fact, then joined to their titles."""
    order = [F.col("num_votes").desc_nulls_first(), F.col("title_id").asc_nulls_last()]
    top = (_facts_of(fact, MOVIE)
           .filter(F.col("average_rating").isNotNull() & (F.col("num_votes") >= min_votes) & F.col("decade").between(first, last))
           .select("title_id", "average_rating", "num_votes", "decade", "content_category", "success_category")
           .orderBy(*order).limit(limit))
    return (titles.select("title_id", "primary_title").join(F.broadcast(top), "title_id")  # at most ``limit`` rows
            .orderBy(*order)
            .select("primary_title", "average_rating", "num_votes", "decade", "content_category",
                    F.coalesce(F.col("success_category"), F.lit(K.AVERAGE_QUALITY)).alias("success_category")))


def runtime_group(runtime: Column) -> Column:
    """Runtime group of the chart; without a runtime the last one."""
    return ladder([(runtime <= bound, label) for bound, label in K.CHART_RUNTIME_GROUPS], K.CHART_RUNTIME_LONG)


# D4
def chart_runtime_groups(titles: DataFrame, first: int = 1960, last: int = 2020) -> DataFrame:
    runtime = F.col("runtime_minutes")
    t = titles.filter((F.col("content_category") == MOVIE) & F.col("decade").between(first, last)
                      & runtime.isNotNull())
    return (t.groupBy(F.col("decade"), runtime_group(runtime).alias("runtime_group"))
            .agg(F.count(F.lit(1)).alias("movie_count"))
            .orderBy(F.col("decade").asc_nulls_last()))


# D5
def chart_people_roles(people: DataFrame) -> DataFrame:
    role = ladder([(F.col(flag_), label) for flag_, label in K.CHART_PRIMARY_ROLES], K.CHART_ROLE_OTHER)
    any_role = F.col("is_actor") | F.col("is_director") | F.col("is_writer") | F.col("is_producer")
    return (people.filter((F.col("generation") != K.GENERATION_UNKNOWN) & any_role)
            .groupBy("generation", role.alias("primary_role"))
            .agg(F.count(F.lit(1)).alias("person_count"))
            .orderBy(F.col("generation").asc_nulls_last(), F.col("person_count").desc_nulls_first()))


# D6
def summary_stats(titles: DataFrame, people: DataFrame, fact: DataFrame) -> DataFrame:
    """Five headline counts as (metric, value); one aggregate pass per mart."""
    t = titles.agg(count_when(F.col("content_category") == MOVIE).alias("a"),
                   count_when(F.col("content_category") == TV_SERIES).alias("b")) \
        .selectExpr("stack(2, 'Total Movies', a, 'Total TV Series', b) as (metric, value)")
    p = people.agg(F.count(F.lit(1)).alias("a")).selectExpr("'Total People' as metric", "a as value")
    f = fact.agg(count_when(F.col("is_statistically_significant")).alias("a"),
                 count_when(F.col("is_highly_rated_popular")).alias("b")) \
        .selectExpr("stack(2, 'Ratings with 1000+ votes', a, 'Highly Rated & Popular', b) as (metric, value)")
    return t.unionByName(p).unionByName(f)


# D7 / end-of-run summary
def mart_row_counts(titles: DataFrame, people: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of the three headline marts as (table_name, row_count)."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
    return one(titles, "dim_titles").unionByName(one(people, "dim_people")).unionByName(one(fact, "fact_ratings"))


def dashboard_datasets(titles: DataFrame, people: DataFrame, fact: DataFrame
                       ) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All chart datasets and the errors of those that failed.

    As in the dashboard being rebuilt, one failing chart does not stop the
    others: the decade and quality-points charts fail when empty, their error
    is recorded, and only when no chart succeeds is that an error.
    """
    builders = {
        "movies_by_decade": lambda: require_rows(chart_movies_by_decade(titles, fact), "movies by decade"),
        "genre_popularity": lambda: chart_genre_popularity(titles, fact),
        "quality_points": lambda: require_rows(chart_quality_points(titles, fact), "quality vs popularity"),
        "runtime_groups": lambda: chart_runtime_groups(titles),
        "people_roles": lambda: chart_people_roles(people),
    }
    datasets: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for name, make in builders.items():
        try:
            datasets[name] = make()
        except Exception as exc:  # noqa: BLE001 - a failed chart is reported, the rest still build
            errors[name] = f"{type(exc).__name__}: {exc}"
    if not datasets:
        raise EmptyResultError(f"No chart datasets were created: {errors}")
    return datasets, errors


__all__ = [
    "dashboard_datasets",
    "EmptyResultError", "require_rows", "chart_movies_by_decade", "chart_genre_popularity",
    "chart_quality_points", "chart_runtime_groups", "chart_people_roles", "summary_stats",
    "mart_row_counts",
]
