"""Star-schema marts: two dimensions, the ratings fact and the cast/crew bridge.

All derived columns are built-in column expressions (CASE ladders, string
and array functions), evaluated inside whole-stage codegen. The only shuffles
are the key joins of ``fact_ratings`` and ``bridge_cast_crew``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart import constants as K
from reelmart.functions import (
    at_least_ladder,
    below_ladder,
    comma_count_or_zero,
    comma_pieces,
    contains_any_ci,
    decade_of,
    flag,
    in_ladder,
    ladder,
)
from reelmart.operators.joins import ROW, unique_key_join, with_row
from reelmart.operators.staging import HotKeys, credit_columns


def as_of(as_of_year: int | None) -> Column:
    """The clock year used by age/recency rules (the session's current year unless pinned)."""
    return F.year(F.current_date()) if as_of_year is None else F.lit(int(as_of_year))


#: Lays out the rows of a mart before the columns that follow from them are added, so that these are not shuffled.
Deal = Callable[[DataFrame], DataFrame]


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


# ---------------------------------------------------------------- dim_titles

def dim_titles(stg: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """One row per supported title with 18 descriptive columns."""
    now = as_of(as_of_year)
    start, end = F.col("start_year"), F.col("end_year")
    runtime, ttype = F.col("runtime_minutes"), F.col("title_type")
    title_len = F.length("primary_title")
    return stg.select(
        "title_id",
        "primary_title",
        "original_title",
        "title_type",
        "is_adult",
        F.when(F.col("is_adult"), F.lit(K.ADULT_CONTENT)).otherwise(F.lit(K.GENERAL_AUDIENCE))
        .alias("content_rating_category"),
        "start_year",
        "end_year",
        decade_of(start).alias("decade"),
        (end - start + F.lit(1)).alias("series_duration_years"),
        "runtime_minutes",
        below_ladder(runtime, [(30, K.RUNTIME_SHORT), (90, K.RUNTIME_STANDARD), (180, K.RUNTIME_LONG)],
                     K.RUNTIME_EXTENDED, null_label=K.RUNTIME_UNKNOWN, inclusive=True)
        .alias("runtime_category"),
        in_ladder(ttype, K.CONTENT_CATEGORIES, K.CONTENT_OTHER).alias("content_category"),
        "genres_raw",
        comma_count_or_zero(F.col("genres_raw")).alias("genre_count"),
        flag(ttype.isin(K.SERIES_TYPES) & end.isNull()).alias("is_ongoing_series"),
        flag(start >= now - F.lit(K.RECENT_YEARS)).alias("is_recent_title"),
        title_len.alias("title_character_count"),
        below_ladder(title_len, [(20, K.TITLE_SHORT), (50, K.TITLE_MEDIUM)], K.TITLE_LONG, inclusive=True)
        .alias("title_length_category"),
    )


# ---------------------------------------------------------------- dim_people

def dim_people(stg: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """One row per named person with 24 descriptive columns."""
    now = as_of(as_of_year)
    birth, death = F.col("birth_year"), F.col("death_year")
    profs, name = F.col("professions_raw"), F.col("primary_name")
    space = F.instr(name, " ")
    age_now = now - birth
    generation = ladder(
        [(birth.isNull(), K.GENERATION_UNKNOWN)]
        + [(birth.between(lo, hi), label) for lo, hi, label in K.GENERATIONS]
        + [(birth > K.GENERATION_ALPHA_AFTER, K.GENERATION_ALPHA)],
        K.GENERATION_PRE_SILENT)
    return stg.select(
        "person_id",
        "primary_name",
        "birth_year",
        "death_year",
        ladder([(death.isNotNull(), death - birth), (birth.isNotNull(), age_now)])
        .cast("int").alias("age_or_current_age"),
        death.isNotNull().alias("is_deceased"),
        decade_of(birth).alias("birth_decade"),
        decade_of(death).alias("death_decade"),
        ladder([(birth.isNull(), K.AGE_UNKNOWN)] + [(age_now < bound, label) for bound, label in K.AGE_LADDER],
               K.AGE_ELDER).alias("age_category"),
        "professions_raw",
        comma_count_or_zero(profs).alias("profession_count"),
        F.trim(F.split_part(profs, F.lit(","), F.lit(1))).alias("primary_profession"),
        *[contains_any_ci(profs, needles).alias(name_) for name_, needles in K.ROLE_PATTERNS.items()],
        flag(comma_pieces(profs) > 1).alias("is_multi_role_professional"),
        "known_for_titles_raw",
        comma_count_or_zero(F.col("known_for_titles_raw")).alias("known_for_title_count"),
        F.length(name).alias("name_character_count"),
        F.when(space > 0, F.trim(F.substring(name, F.lit(1), space - F.lit(1)))).otherwise(name)
        .alias("first_name"),
        F.when(space > 0, F.trim(F.substring(name, space + F.lit(1), F.length(name)))).alias("last_name"),
        (F.coalesce(death, now) - birth).cast("int").alias("potential_career_span_years"),
        generation.alias("generation"),
    )


# ---------------------------------------------------------------- fact_ratings

TITLE_CONTEXT_FOR_RATINGS = ["title_id", "title_type", "content_category", "start_year", "decade",
                             "runtime_category", "is_adult"]


def fact_ratings(stg: DataFrame, titles: DataFrame, as_of_year: int | None = None, deal: Deal = _as_is) -> DataFrame:
    """One row per rating with title context (kept NULL for titles not in the dimension).

    The join is on ``title_id``, which is unique on both sides, so key skew cannot occur.
    """
    now = as_of(as_of_year)
    context = titles.select(*TITLE_CONTEXT_FOR_RATINGS)
    joined = deal(unique_key_join(stg, context, "title_id", "left", hashed=True))
    rating, votes = F.col("average_rating"), F.col("num_votes")
    start = F.col("start_year")
    hr_rating, hr_votes = K.HIGHLY_RATED
    ms_rating, ms_votes = K.MAINSTREAM_SUCCESS
    q_rating, q_votes = K.QUADRANT_SPLIT
    return joined.select(
        "title_id",
        "average_rating",
        "num_votes",
        *TITLE_CONTEXT_FOR_RATINGS[1:],
        below_ladder(rating, K.RATING_LADDER, K.RATING_OUTSTANDING, null_label=K.RATING_NOT_RATED)
        .alias("rating_category"),
        below_ladder(votes, K.VOTE_LADDER, K.VOTES_MASSIVE, null_label=K.VOTES_NONE)
        .alias("vote_volume_category"),
        flag(votes >= K.SIGNIFICANT_VOTES).alias("is_statistically_significant"),
        flag((rating >= hr_rating) & (votes >= hr_votes)).alias("is_highly_rated_popular"),
        flag((rating >= ms_rating) & (votes >= ms_votes)).alias("is_mainstream_success"),
        F.when(rating.isNotNull() & votes.isNotNull(),
               rating.cast("double") * F.log10(F.greatest(votes, F.lit(1)).cast("double")))
        .alias("popularity_score"),
        ladder([(votes.isNull() | (votes == 0), K.CONFIDENCE_NONE)]
               + [(votes < bound, label) for bound, label in K.CONFIDENCE_LADDER], K.CONFIDENCE_TOP)
        .alias("rating_confidence"),
        F.when(rating.isNotNull(), at_least_ladder(rating, K.PERCENTILE_TIERS, K.PERCENTILE_BOTTOM))
        .alias("rating_percentile_tier"),
        ladder([
            (rating >= 8.0, K.CRITICAL_ACCLAIM),
            ((rating >= 7.0) & (votes >= 50000), K.POPULAR_SUCCESS),
            ((rating >= 6.0) & (votes >= 10000), K.COMMERCIAL_SUCCESS),
            ((rating < 4.0) & (votes >= 5000), K.CRITICAL_FAILURE),
            (votes >= 100000, K.HIGH_VISIBILITY),
        ], K.STANDARD_RELEASE).alias("success_category"),
        ladder([
            (votes.isNull() | (votes == 0), F.lit(0.0)),
            (start.isNotNull(), votes.cast("double") / F.greatest(now - start + F.lit(1), F.lit(1)).cast("double")),
        ], votes.cast("double")).alias("annual_vote_rate"),
        ladder([
            ((rating >= q_rating) & (votes >= q_votes), K.QUADRANT_HH),
            ((rating >= q_rating) & (votes < q_votes), K.QUADRANT_HL),
            ((rating < q_rating) & (votes >= q_votes), K.QUADRANT_LH),
        ], K.QUADRANT_LL).alias("quality_popularity_quadrant"),
    )


# ---------------------------------------------------------------- bridge_cast_crew

TITLE_CONTEXT_FOR_CREDITS = ["title_id", "title_type", "content_category", "start_year", "decade", "is_adult"]
PERSON_CONTEXT_FOR_CREDITS = ["person_id", "primary_name", "age_category", "generation"]


def _bridge_columns(joined: DataFrame) -> DataFrame:
    category, ordering = F.col("job_category"), F.col("ordering")
    content, start = F.col("content_category"), F.col("start_year")
    media = ladder([(content == src, dst) for src, dst in K.MEDIA_TYPES], content)
    return joined.select(
        "title_id", "person_id", "ordering",
        "job_category", "job_title", "character_names",
        "title_type", "content_category", "start_year", "decade", "is_adult",
        "primary_name", "age_category", "generation",
        in_ladder(category, K.ROLE_DEPARTMENTS, K.DEPARTMENT_OTHER).alias("role_department"),
        below_ladder(ordering, K.CREDIT_LADDER, K.CREDIT_BACKGROUND, null_label=K.CREDIT_UNSPECIFIED,
                     inclusive=True).alias("credit_importance"),
        F.when(category.isin(K.ACTING_CATEGORIES) & F.col("character_names").isNotNull(),
               comma_pieces(F.col("character_names"))).otherwise(F.lit(0)).alias("character_count"),
        media.alias("media_type"),
        below_ladder(start, K.ERA_LADDER, K.ERA_STREAMING, null_label=K.ERA_UNKNOWN).alias("industry_era"),
    )


def bridge_cast_crew(stg_principals: DataFrame, titles: DataFrame, people: DataFrame,
                     hot: HotKeys | None = None) -> DataFrame:
    """Credits LEFT JOIN title context LEFT JOIN person context (not deduplicated)."""
    return _bridge_columns(_credit_context(stg_principals, titles, people, "left", hot))


def _credit_context(credits: DataFrame, titles: DataFrame, people: DataFrame, how: str, hot: HotKeys | None) -> DataFrame:
    """Credits joined to title context on title_id, then to person context on person_id.

    Both are shuffle joins at scale; hot titles and people are salted (see ``operators.joins``).
    """
    t = titles.select(*TITLE_CONTEXT_FOR_CREDITS)
    p = people.select(*PERSON_CONTEXT_FOR_CREDITS)
    hot = hot or {}
    if any(h is not None for h in hot.values()):
        credits = with_row(credits)
    joined = unique_key_join(credits, t, "title_id", how, hot.get("title_id"))
    return unique_key_join(joined, p, "person_id", how, hot.get("person_id"))


def bridge_cast_crew_from_raw(raw_principals: DataFrame, titles: DataFrame, people: DataFrame,
                              hot: HotKeys | None = None, deal: Deal = _as_is) -> DataFrame:
    """Same rows as ``bridge_cast_crew(stg_title_principals(...), titles, people)`` in two joins.

    ``dim_titles`` holds exactly the supported-type titles and ``dim_people``
    exactly the named people, each once. So "semi-join on the key set, then
    left-join the dimension" equals an inner join with the dimension: the
    staging semi-joins and the context joins collapse from four shuffles of
    the credits to two. Only valid for dimensions built from the same raw
    tables as the credits' staging filter (``pipeline.build`` guarantees it).
    """
    return _bridge_columns(deal(_credit_context(credit_columns(raw_principals), titles, people, "inner", hot).drop(ROW)))
