"""The twelve analytical questions over the marts.

Every query projects to the few columns it needs before joining (Catalyst
prunes the Parquet scan to them), filters before the join (pushed into the
scan), aggregates with algebraic functions only (partial aggregation on the
map side, so a hot group such as ``content_category = 'Movie'`` costs one row
per task in the shuffle) and uses ``orderBy(...).limit(n)``, which plans as a
per-partition top-k. Ambiguous columns of the original SQL (copied into both
``fact_ratings`` and ``dim_titles``) resolve to the ``dim_titles`` side.

Ordering follows PostgreSQL: NULLs last ascending, first descending, and the
key of the table is the final tie-break so ``LIMIT`` is deterministic.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart import constants as K
from reelmart.functions import count_when, exact_avg, exact_pct, ladder, rounded_avg

MOVIE = "Movie"
TV_SERIES = "TV Series"


def _movies(titles: DataFrame, *cols: str) -> DataFrame:
    return titles.filter(F.col("content_category") == MOVIE).select("title_id", *cols)


def _facts_of(fact: DataFrame, category: str) -> DataFrame:
    """Ratings of titles in ``category``, selected on the fact side.

    ``fact_ratings.content_category`` is copied from ``dim_titles`` for the same
    ``title_id``, so "dimension row is a movie" and "fact row is a movie" agree
    on every joined pair. Repeating the dimension's filter on the fact side is
    therefore exact for inner joins and for dimension-preserving left joins. It
    lets both scans prune (both marts are stored partitioned by the category)
    and shrinks the fact side of the join.
    """
    return fact.filter(F.col("content_category") == category)


def _genre_rows(titles: DataFrame, fact: DataFrame) -> DataFrame:
    """(genre, average_rating, num_votes) per genre piece of each rated movie."""
    t = titles.filter(F.col("genres_raw").isNotNull() & (F.col("content_category") == MOVIE)) \
        .select("title_id", "genres_raw")
    f = _facts_of(fact, MOVIE).filter(F.col("num_votes").isNotNull()).select("title_id", "average_rating", "num_votes")
    pieces = F.split(F.when(F.col("genres_raw") != "", F.col("genres_raw")), ",", -1)
    return (t.join(f, "title_id")
            .select(F.explode(pieces).alias("piece"), "average_rating", "num_votes")
            .select(F.trim("piece").alias("genre"), "average_rating", "num_votes"))


def _genre_stats(titles: DataFrame, fact: DataFrame, min_titles: int) -> DataFrame:
    return (_genre_rows(titles, fact)
            .groupBy("genre")
            .agg(F.count(F.lit(1)).alias("title_count"),
                 exact_avg(F.col("average_rating")).alias("_avg_rating"),
                 F.sum("num_votes").cast("bigint").alias("total_votes"))
            .filter(F.col("title_count") >= min_titles))


# Q1
def top_rated_movies(fact: DataFrame, titles: DataFrame, min_rating: str = "8.0", limit: int = 20) -> DataFrame:
    """Q1: highest-rated significant movies, newest decade first; a global top ``limit``.

    All filters and sort keys are on the fact (its title context is a copy), so the top
    rows are taken there and only they meet the titles.
    """
    order = [F.col("decade").desc_nulls_first(), F.col("average_rating").desc_nulls_first(), F.col("title_id").asc_nulls_last()]
    top = (_facts_of(fact, MOVIE)
           .filter(F.col("is_statistically_significant") & F.col("decade").isNotNull()
                   & (F.col("average_rating") >= F.lit(Decimal(min_rating)).cast("decimal(3,1)")))
           .select("title_id", "decade", "average_rating", "num_votes", "success_category", "runtime_category")
           .orderBy(*order).limit(limit))
    return (titles.select("title_id", "primary_title").join(F.broadcast(top), "title_id")  # at most ``limit`` rows
            .orderBy(*order)
            .select("decade", "primary_title", "average_rating", "num_votes", "success_category",
                    "runtime_category"))


# Q2
def production_trends(titles: DataFrame, fact: DataFrame, min_decade: int = 1920) -> DataFrame:
    """Q2: movies per decade from ``min_decade`` with their average rating and runtime."""
    t = _movies(titles.filter(F.col("decade") >= min_decade), "decade", "runtime_minutes")
    f = _facts_of(fact, MOVIE).select("title_id", "average_rating", "is_highly_rated_popular")
    return (t.join(f, "title_id", "left")
            .groupBy("decade")
            .agg(F.count(F.lit(1)).alias("movie_count"),
                 exact_avg(F.col("average_rating")).cast("double").alias("avg_rating"),
                 count_when(F.col("is_highly_rated_popular")).alias("critically_acclaimed_count"),
                 F.avg("runtime_minutes").alias("avg_runtime"))
            .orderBy(F.col("decade").asc_nulls_last()))


# Q3
def genre_popularity(titles: DataFrame, fact: DataFrame, min_titles: int = 100, limit: int = 15) -> DataFrame:
    """Q3: genres of rated movies by total votes (genres with at least ``min_titles`` movies)."""
    per_movie = F.round(F.col("total_votes").cast("decimal(20,0)") / F.col("title_count").cast("decimal(20,0)"), 0)
    return (_genre_stats(titles, fact, min_titles)
            .orderBy(F.col("total_votes").desc_nulls_first(), F.col("genre").asc_nulls_last())
            .limit(limit)
            .select("genre", "title_count",
                    F.round("_avg_rating", 2).cast("double").alias("avg_rating"),
                    "total_votes",
                    per_movie.cast("double").alias("avg_votes_per_movie")))


# Q4
def professions_by_generation(people: DataFrame, min_people: int = 50) -> DataFrame:
    """Q4: people per generation and primary profession (groups of at least ``min_people``)."""
    return (people.filter(F.col("primary_profession").isNotNull()
                          & (F.col("generation") != K.GENERATION_UNKNOWN))
            .groupBy("generation", "primary_profession")
            .agg(F.count(F.lit(1)).alias("person_count"),
                 F.avg("age_or_current_age").alias("avg_age"),
                 count_when(F.col("is_multi_role_professional")).alias("multi_role_count"))
            .filter(F.col("person_count") >= min_people)
            .orderBy(F.col("generation").asc_nulls_last(), F.col("person_count").desc_nulls_first(),
                     F.col("primary_profession").asc_nulls_last()))


# Q5
def career_longevity(people: DataFrame, min_span: int = 60, limit: int = 20) -> DataFrame:
    """Q5: people with the longest potential careers (over ``min_span`` years)."""
    span = F.col("potential_career_span_years")
    return (people.filter(span.isNotNull() & (span > min_span) & (F.col("known_for_title_count") > 0))
            .orderBy(span.desc_nulls_first(), F.col("person_id").asc_nulls_last())
            .limit(limit)
            .select("primary_name", "primary_profession", "birth_year", "death_year",
                    "potential_career_span_years", "known_for_title_count", "generation"))


# Q6
def quality_quadrants(fact: DataFrame) -> DataFrame:
    """Q6: movies per quality/popularity quadrant, in quadrant order."""
    # ``decade`` on the fact is a copy of the title's, so no join is needed
    rank = ladder([(F.col("quality_popularity_quadrant") == q, i + 1) for i, q in enumerate(K.QUADRANTS)])
    return (_facts_of(fact, MOVIE)
            .groupBy("quality_popularity_quadrant")
            .agg(F.count(F.lit(1)).alias("movie_count"),
                 rounded_avg(F.col("average_rating"), 2).alias("avg_rating"),
                 rounded_avg(F.col("num_votes"), 0).alias("avg_votes"),
                 count_when(F.col("decade") >= 2010).alias("recent_movies"))
            .orderBy(rank.asc_nulls_last()))


# Q7
def runtime_evolution(titles: DataFrame, fact: DataFrame, min_decade: int = 1950) -> DataFrame:
    """Q7: movies per decade and runtime category from ``min_decade``."""
    t = _movies(titles.filter(F.col("decade").isNotNull() & F.col("runtime_minutes").isNotNull()
                              & (F.col("decade") >= min_decade)),
                "decade", "runtime_category", "runtime_minutes")
    f = _facts_of(fact, MOVIE).select("title_id", "average_rating")
    return (t.join(f, "title_id", "left")
            .groupBy("decade", "runtime_category")
            .agg(F.count(F.lit(1)).alias("movie_count"),
                 rounded_avg(F.col("runtime_minutes"), 1).alias("avg_runtime"),
                 rounded_avg(F.col("average_rating"), 2).alias("avg_rating"))
            .orderBy(F.col("decade").asc_nulls_last(), F.col("runtime_category").asc_nulls_last()))


# Q8
def adult_vs_general(fact: DataFrame) -> DataFrame:
    """Q8: rated movies by content rating category, which follows from the fact's copy of ``is_adult``."""
    category = F.when(F.col("is_adult"), F.lit(K.ADULT_CONTENT)).otherwise(F.lit(K.GENERAL_AUDIENCE))
    return (_facts_of(fact, MOVIE)
            .groupBy(category.alias("content_rating_category"))
            .agg(F.count(F.lit(1)).alias("title_count"),
                 rounded_avg(F.col("average_rating"), 2).alias("avg_rating"),
                 rounded_avg(F.col("num_votes"), 0).alias("avg_votes"),
                 count_when(F.col("is_statistically_significant")).alias("significant_ratings_count"),
                 count_when(F.col("success_category") == K.CRITICAL_ACCLAIM).alias("critically_acclaimed")))


# Q9
def long_running_series(titles: DataFrame, fact: DataFrame, min_years: int = 10, limit: int = 20) -> DataFrame:
    """Q9: TV series running ``min_years`` or more, longest first (unrated first on ties)."""
    dur = F.col("series_duration_years")
    t = titles.filter((F.col("content_category") == TV_SERIES) & dur.isNotNull() & (dur >= min_years)) \
        .select("title_id", "primary_title", "start_year", "end_year", "series_duration_years",
                "is_ongoing_series")
    f = _facts_of(fact, TV_SERIES).select("title_id", "average_rating", "num_votes")
    return (t.join(f, "title_id", "left")
            .orderBy(dur.desc_nulls_first(), F.col("average_rating").desc_nulls_first(),
                     F.col("title_id").asc_nulls_last())
            .limit(limit)
            .select("primary_title", "start_year", "end_year", "series_duration_years", "average_rating",
                    "num_votes", "is_ongoing_series"))


# Q10
def recent_vs_classic(titles: DataFrame, fact: DataFrame) -> DataFrame:
    """Q10: rated titles by recency flag and content category."""
    t = titles.select("title_id", "is_recent_title", "content_category")
    f = fact.filter(F.col("average_rating").isNotNull()) \
        .select("title_id", "average_rating", "is_highly_rated_popular", "success_category")
    era = F.when(F.col("is_recent_title"), F.lit(K.RECENT_LABEL)).otherwise(F.lit(K.CLASSIC_LABEL))
    return (t.join(f, "title_id")
            .groupBy("is_recent_title", "content_category")
            .agg(F.count(F.lit(1)).alias("title_count"),
                 rounded_avg(F.col("average_rating"), 2).alias("avg_rating"),
                 count_when(F.col("is_highly_rated_popular")).alias("highly_rated_popular"),
                 count_when(F.col("success_category") == K.CRITICAL_ACCLAIM).alias("critical_acclaim"))
            .select(era.alias("era"), "content_category", "title_count", "avg_rating",
                    "highly_rated_popular", "critical_acclaim")
            .orderBy(F.col("era").desc_nulls_first(), F.col("content_category").asc_nulls_last()))


# Q11
def data_completeness(titles: DataFrame, people: DataFrame, fact: DataFrame) -> DataFrame:
    """Three summary rows; column names come from the first branch (UNION ALL by position)."""
    names = ["table_name", "total_records", "has_title", "has_year", "has_runtime", "has_genres",
             "year_completeness_pct"]

    def branch(df: DataFrame, label: str, c1, c2, c3, c4, pct_part) -> DataFrame:
        total = F.count(F.lit(1))
        return df.agg(F.lit(label).alias(names[0]), total.alias(names[1]), c1.alias(names[2]),
                      c2.alias(names[3]), c3.alias(names[4]), c4.alias(names[5]),
                      exact_pct(pct_part, total).alias(names[6]))

    significant = count_when(F.col("is_statistically_significant"))
    return (branch(titles, "dim_titles", F.count("primary_title"), F.count("start_year"),
                   F.count("runtime_minutes"), F.count("genres_raw"), F.count("start_year"))
            .unionByName(branch(people, "dim_people", F.count("primary_name"), F.count("birth_year"),
                                F.count("professions_raw"), F.count("known_for_titles_raw"),
                                F.count("birth_year")))
            .unionByName(branch(fact, "fact_ratings", F.count("average_rating"), F.count("num_votes"),
                                F.count("title_id"), significant, significant)))


# Q12
def executive_metrics(titles: DataFrame, people: DataFrame, fact: DataFrame) -> DataFrame:
    """Seven headline counts as (metric_category, metric_name, metric_value text).

    One conditional-count pass per mart, unpivoted with ``stack``: three scans
    instead of the seven of a UNION ALL of filtered counts.
    """
    def stacked(df: DataFrame, metrics: list[tuple[str, str, object]]) -> DataFrame:
        aggs = [expr.cast("string").alias(f"m{i}") for i, (_, _, expr) in enumerate(metrics)]
        args = ", ".join(f"'{cat}', '{name}', m{i}" for i, (cat, name, _) in enumerate(metrics))
        return df.agg(*aggs).selectExpr(
            f"stack({len(metrics)}, {args}) as (metric_category, metric_name, metric_value)")

    return (stacked(titles, [
                ("Content Library", "Total Movies", count_when(F.col("content_category") == MOVIE)),
                ("Content Library", "Total TV Series", count_when(F.col("content_category") == TV_SERIES))])
            .unionByName(stacked(fact, [
                ("Quality Metrics", "Highly Rated & Popular", count_when(F.col("is_highly_rated_popular"))),
                ("Quality Metrics", "Critical Acclaim",
                 count_when(F.col("success_category") == K.CRITICAL_ACCLAIM)),
                ("Data Completeness", "Statistically Significant Ratings",
                 count_when(F.col("is_statistically_significant")))]))
            .unionByName(stacked(people, [
                ("People Database", "Total People", F.count(F.lit(1))),
                ("People Database", "Active Directors", count_when(F.col("is_director")))])))


def all_queries(titles: DataFrame, people: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    """The twelve questions with their reference parameters, keyed by name."""
    return {
        "top_rated_movies": top_rated_movies(fact, titles),
        "production_trends": production_trends(titles, fact),
        "genre_popularity": genre_popularity(titles, fact),
        "professions_by_generation": professions_by_generation(people),
        "career_longevity": career_longevity(people),
        "quality_quadrants": quality_quadrants(fact),
        "runtime_evolution": runtime_evolution(titles, fact),
        "adult_vs_general": adult_vs_general(fact),
        "long_running_series": long_running_series(titles, fact),
        "recent_vs_classic": recent_vs_classic(titles, fact),
        "data_completeness": data_completeness(titles, people, fact),
        "executive_metrics": executive_metrics(titles, people, fact),
    }
