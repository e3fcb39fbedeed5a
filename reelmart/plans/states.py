"""Mergeable partial aggregates of the decade and genre questions, stored with the marts.

Two small relations hold counts and exact sums, one row per combination of group values:

* ``title_states``: category, decade, runtime class, runtime group of the chart, recency
* ``genre_states``: genre piece of rated movies

They are computed per part (a set of titles with all their ratings) by one join and one
algebraic aggregation, and are published in the same manifest row as the marts. States of a
further part are appended (``append_states``): sums of sums are sums, so nothing old is read
again. The answers below add up whatever rows there are for a group, so their cost follows
the number of groups and parts, not of titles. Averages are one exact decimal division of
merged sums, and equal those of the questions over the marts.

Parts must not share titles, as the key checks of the load ensure. Titles and ratings are
one row a title; a null group value is a group of its own; an empty part adds no rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart import constants as K
from reelmart.functions import count_when
from reelmart.plans.analytics import MOVIE, _genre_rows
from reelmart.plans.charts import runtime_group
from reelmart.sources.store import Staged, new_part, publish_set, published, read_published

STATE_NAMES = ["title_states", "genre_states"]


def title_states(titles: DataFrame, fact: DataFrame) -> DataFrame:
    """Counts and sums of titles (rated or not) per category, decade, runtime class, runtime group and recency."""
    t = titles.select("title_id", "content_category", "decade", "runtime_category", "is_recent_title", "runtime_minutes")
    f = fact.select("title_id", "average_rating", "is_highly_rated_popular", "success_category")
    rated = F.col("average_rating").isNotNull()
    return (t.join(f, "title_id", "left")
            .groupBy("content_category", "decade", "runtime_category", "is_recent_title",
                     runtime_group(F.col("runtime_minutes")).alias("runtime_group"), F.col("runtime_minutes").isNotNull().alias("has_runtime"))
            .agg(F.count(F.lit(1)).alias("titles"),
                 F.sum(F.col("runtime_minutes").cast("bigint")).alias("runtime_sum"),
                 F.count("average_rating").alias("ratings"),
                 F.sum(F.col("average_rating").cast("decimal(20,1)")).cast("decimal(20,1)").alias("rating_sum"),
                 count_when(F.col("is_highly_rated_popular")).alias("popular"),
                 count_when(rated & F.col("is_highly_rated_popular")).alias("rated_popular"),
                 count_when(rated & (F.col("success_category") == K.CRITICAL_ACCLAIM)).alias("acclaimed")))


def genre_states(titles: DataFrame, fact: DataFrame) -> DataFrame:
    """Counts and sums of rated movies per genre piece."""
    return (_genre_rows(titles, fact).groupBy("genre")
            .agg(F.count(F.lit(1)).alias("titles"),
                 F.count("average_rating").alias("ratings"),
                 F.sum(F.col("average_rating").cast("decimal(20,1)")).cast("decimal(20,1)").alias("rating_sum"),
                 F.sum("num_votes").cast("bigint").alias("votes")))


def stage_states(titles: DataFrame, fact: DataFrame, root: str) -> list[Staged]:
    """Write the states of one part under ``root``; nothing is published."""
    def store(name: str, df: DataFrame) -> Staged:
        part = new_part(root, name)
        df.write.parquet(part)
        return Staged(name, (part,), df.sparkSession.read.parquet(part).count())

    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = [pool.submit(store, "title_states", title_states(titles, fact)), pool.submit(store, "genre_states", genre_states(titles, fact))]
        return [j.result() for j in jobs]


def append_states(spark: SparkSession, root: str, staged: list[Staged]) -> None:
    """Add the staged part to the published states, all tables at once."""
    found = published(spark, root)
    old = {s.table: found[s.table] for s in staged if s.table in found}
    publish_set(spark, root, "states", [
        Staged(s.table, (*(old[s.table].parts if s.table in old else ()), *s.parts), s.rows + (old[s.table].rows if s.table in old else 0)) for s in staged])


def read_states(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published states of ``root``."""
    found = published(spark, root)
    return {n: read_published(spark, found[n]) for n in STATE_NAMES if n in found}


def _average(total: Column, count: Column) -> Column:
    """Exact quotient of merged sums with 17 decimals; NULL without rows."""
    return F.try_divide(total.cast("decimal(20,1)"), count.cast("decimal(15,0)"))


def _movies(states: DataFrame) -> DataFrame:
    return states.filter(F.col("content_category") == MOVIE)


def _by_decade(states: DataFrame, popular: str) -> DataFrame:
    return (states.groupBy("decade")
            .agg(F.sum("titles").alias("movie_count"),
                 _average(F.sum("rating_sum"), F.sum("ratings")).cast("double").alias("avg_rating"),
                 F.sum("popular").alias(popular),
                 F.try_divide(F.sum("runtime_sum").cast("double"), F.sum(F.when(F.col("has_runtime"), F.col("titles")))).alias("avg_runtime"))
            .orderBy(F.col("decade").asc_nulls_last()))


# Q2
def production_trends(states: DataFrame, min_decade: int = 1920) -> DataFrame:
    return _by_decade(_movies(states).filter(F.col("decade") >= min_decade), "critically_acclaimed_count")


# D1
def chart_movies_by_decade(states: DataFrame, first: int = 1920, last: int = 2020) -> DataFrame:
    return _by_decade(_movies(states).filter(F.col("decade").between(first, last)), "highly_rated_count").drop("avg_runtime")


# Q7
def runtime_evolution(states: DataFrame, min_decade: int = 1950) -> DataFrame:
    return (_movies(states).filter(F.col("has_runtime") & (F.col("decade") >= min_decade))
            .groupBy("decade", "runtime_category")
            .agg(F.sum("titles").alias("movie_count"),
                 F.round(_average(F.sum("runtime_sum"), F.sum("titles")), 1).cast("double").alias("avg_runtime"),
                 F.round(_average(F.sum("rating_sum"), F.sum("ratings")), 2).cast("double").alias("avg_rating"))
            .orderBy(F.col("decade").asc_nulls_last(), F.col("runtime_category").asc_nulls_last()))


# D4
def chart_runtime_groups(states: DataFrame, first: int = 1960, last: int = 2020) -> DataFrame:
    return (_movies(states).filter(F.col("has_runtime") & F.col("decade").between(first, last))
            .groupBy("decade", "runtime_group").agg(F.sum("titles").alias("movie_count"))
            .orderBy(F.col("decade").asc_nulls_last()))


# Q10
def recent_vs_classic(states: DataFrame) -> DataFrame:
    era = F.when(F.col("is_recent_title"), F.lit(K.RECENT_LABEL)).otherwise(F.lit(K.CLASSIC_LABEL))
    return (states.groupBy("is_recent_title", "content_category")
            .agg(F.sum("ratings").alias("title_count"),
                 F.round(_average(F.sum("rating_sum"), F.sum("ratings")), 2).cast("double").alias("avg_rating"),
                 F.sum("rated_popular").alias("highly_rated_popular"),
                 F.sum("acclaimed").alias("critical_acclaim"))
            .filter(F.col("title_count") > 0)
            .select(era.alias("era"), "content_category", "title_count", "avg_rating", "highly_rated_popular", "critical_acclaim")
            .orderBy(F.col("era").desc_nulls_first(), F.col("content_category").asc_nulls_last()))


def _genres(states: DataFrame, min_titles: int, limit: int) -> DataFrame:
    return (states.groupBy("genre")
            .agg(F.sum("titles").alias("title_count"), _average(F.sum("rating_sum"), F.sum("ratings")).alias("_avg_rating"),
                 F.sum("votes").alias("total_votes"))
            .filter(F.col("title_count") >= min_titles)
            .orderBy(F.col("total_votes").desc_nulls_first(), F.col("genre").asc_nulls_last()).limit(limit)
            .withColumn("avg_rating", F.round("_avg_rating", 2).cast("double")))


# Q3
def genre_popularity(states: DataFrame, min_titles: int = 100, limit: int = 15) -> DataFrame:
    per_movie = F.round(F.col("total_votes").cast("decimal(20,0)") / F.col("title_count").cast("decimal(20,0)"), 0)
    return _genres(states, min_titles, limit).select("genre", "title_count", "avg_rating", "total_votes", per_movie.cast("double").alias("avg_votes_per_movie"))


# D2
def chart_genre_popularity(states: DataFrame, min_titles: int = 1000, limit: int = 15) -> DataFrame:
    return _genres(states, min_titles, limit).select("genre", "title_count", "avg_rating", "total_votes")


#: question -> (answer, the states it reads)
ANSWERS = {
    "production_trends": (production_trends, "title_states"),
    "genre_popularity": (genre_popularity, "genre_states"),
    "runtime_evolution": (runtime_evolution, "title_states"),
    "recent_vs_classic": (recent_vs_classic, "title_states"),
    "chart_movies_by_decade": (chart_movies_by_decade, "title_states"),
    "chart_genre_popularity": (chart_genre_popularity, "genre_states"),
    "chart_runtime_groups": (chart_runtime_groups, "title_states"),
}


def answer(states: dict[str, DataFrame], question: str, **parameters) -> DataFrame:
    """One question of ``ANSWERS`` from stored states."""
    fn, name = ANSWERS[question]
    return fn(states[name], **parameters)
