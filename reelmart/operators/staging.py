"""Staging: typed, renamed and filtered views over the raw tables.

The raw tables already hold NULL where the file had ``\\N`` (the load turns
the marker into NULL), so staging is plain casts. Casts are ANSI: a value that
is not an integer fails the job instead of silently becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.constants import SUPPORTED_TITLE_TYPES
from reelmart.functions import ladder
from reelmart.operators.joins import semi_join, with_row


def _bool_flag(col: str):
    """'1' -> true, '0' -> false, anything else NULL."""
    c = F.col(col)
    return ladder([(c == "1", True), (c == "0", False)], F.lit(None).cast("boolean"))


def supported_titles_filter(raw_title_basics: DataFrame) -> DataFrame:
    return raw_title_basics.filter(F.col("titletype").isin(SUPPORTED_TITLE_TYPES))


def named_people_filter(raw_name_basics: DataFrame) -> DataFrame:
    name = F.col("primaryname")
    return raw_name_basics.filter(name.isNotNull() & (F.trim(name) != ""))


def supported_title_keys(raw_title_basics: DataFrame) -> DataFrame:
    """Key set ``title_id`` of titles of a supported type (unique: tconst is a key)."""
    return supported_titles_filter(raw_title_basics).select(F.col("tconst").alias("title_id"))


def named_people_keys(raw_name_basics: DataFrame) -> DataFrame:
    """Key set ``person_id`` of people with a non-blank name (unique: nconst is a key)."""
    return named_people_filter(raw_name_basics).select(F.col("nconst").alias("person_id"))


def stg_title_basics(raw: DataFrame) -> DataFrame:
    return supported_titles_filter(raw).select(
        F.col("tconst").alias("title_id"),
        F.col("titletype").alias("title_type"),
        F.col("primarytitle").alias("primary_title"),
        F.col("originaltitle").alias("original_title"),
        _bool_flag("isadult").alias("is_adult"),
        F.col("startyear").cast("int").alias("start_year"),
        F.col("endyear").cast("int").alias("end_year"),
        F.col("runtimeminutes").cast("int").alias("runtime_minutes"),
        F.col("genres").alias("genres_raw"),
    )


def stg_title_ratings(raw: DataFrame) -> DataFrame:
    """No filter: ratings of unsupported titles stay (the relationship check flags them)."""
    return raw.select(
        F.col("tconst").alias("title_id"),
        F.col("averagerating").cast("decimal(3,1)").alias("average_rating"),
        F.col("numvotes").cast("int").alias("num_votes"),
    )


def stg_name_basics(raw: DataFrame) -> DataFrame:
    return named_people_filter(raw).select(
        F.col("nconst").alias("person_id"),
        F.col("primaryname").alias("primary_name"),
        F.col("birthyear").cast("int").alias("birth_year"),
        F.col("deathyear").cast("int").alias("death_year"),
        F.col("primaryprofession").alias("professions_raw"),
        F.col("knownfortitles").alias("known_for_titles_raw"),
    )


def credit_columns(raw: DataFrame) -> DataFrame:
    """Typed, renamed credit columns of raw ``title_principals`` (no filter)."""
    return raw.select(
        F.col("tconst").alias("title_id"),
        F.col("nconst").alias("person_id"),
        F.col("ordering").cast("int").alias("ordering"),
        F.col("category").alias("job_category"),
        F.col("job").alias("job_title"),
        F.col("characters").alias("character_names"),
    )


#: Hot keys by column, as ``find_hot_keys`` gives them.
HotKeys = dict[str, DataFrame | None]


def stg_title_principals(raw: DataFrame, raw_title_basics: DataFrame, raw_name_basics: DataFrame,
                         hot: HotKeys | None = None) -> DataFrame:
    """Credits whose title is supported and whose person is named (two semi-joins on narrow key sets).

    ``hot``: hot titles and people of the credits, whose rows are then salted.
    """
    hot = hot or {}
    credits = credit_columns(raw)
    columns = credits.columns
    if any(h is not None for h in hot.values()):
        credits = with_row(credits)
    credits = semi_join(credits, supported_title_keys(raw_title_basics), "title_id", hot.get("title_id"), hashed=True)
    return semi_join(credits, named_people_keys(raw_name_basics), "person_id", hot.get("person_id")).select(*columns)


def aka_columns(raw: DataFrame) -> DataFrame:
    """Typed, renamed columns of raw ``title_akas`` (no filter)."""
    return raw.select(
        F.col("titleid").alias("title_id"),
        F.col("ordering").cast("int").alias("ordering"),
        F.col("title").alias("alternative_title"),
        F.col("region").alias("region_code"),
        F.col("language").alias("language_code"),
        F.col("types").alias("title_types_raw"),
        F.col("attributes").alias("attributes_raw"),
        _bool_flag("isoriginaltitle").alias("is_original_title"),
    )


def stg_title_akas(raw: DataFrame, raw_title_basics: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Alternative titles of supported titles; ``hot``: hot titles, whose rows are then salted."""
    akas, hot_titles = aka_columns(raw), (hot or {}).get("title_id")
    columns = akas.columns
    if hot_titles is not None:
        akas = with_row(akas)
    return semi_join(akas, supported_title_keys(raw_title_basics), "title_id", hot_titles, hashed=True).select(*columns)
