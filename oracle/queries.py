"""Oracle SQL per registered query (DuckDB dialect), keyed like ``queries()``.

Written from the rules of each question: one base relation of titles with their ratings,
``filter`` counts, and one conditional pass where a question reports several counts.
"""

from __future__ import annotations

from oracle.duckdb_sql import r6, round_avg, round_pct, round_ratio, text, with_warehouse

W = with_warehouse

STAGING_AND_MARTS = {name: W(f"select * from {name}") for name in (
    "stg_title_basics", "stg_title_ratings", "stg_name_basics", "stg_title_principals", "stg_title_akas",
    "dim_titles", "dim_people", "bridge_cast_crew")}

_ROUNDED = f"replace ({r6('popularity_score')} as popularity_score, {r6('annual_vote_rate')} as annual_vote_rate)"
STAGING_AND_MARTS["fact_ratings"] = W(f"select * {_ROUNDED} from fact_ratings")

# every title with its rating, if it has one; the fact's copies of title columns are left out
_BASE = """
base AS (
  select t.*, f.title_id is not null as has_rating, f.average_rating as stars, f.num_votes as votes, f.success_category as success,
    f.is_statistically_significant as significant, f.is_highly_rated_popular as acclaimed, f.quality_popularity_quadrant as quadrant
  from dim_titles t left join fact_ratings f using (title_id)
),
movies AS (select * from base where content_category = 'Movie')"""


def _q(body: str) -> str:
    return W(f", {_BASE}\n{body}")


STARS = round_avg("stars", 2, scale=1)

_GENRES = f"""
genres AS (
  select genre, count(*) as title_count, {STARS} as avg_rating, cast(sum(votes) as bigint) as total_votes
  from (select trim(unnest(string_split(nullif(genres_raw, ''), ','))) as genre, stars, votes from movies where votes is not null)
  group by all
)"""


def _professions(least: int) -> str:
    return W(f"""
select generation, primary_profession, count(*) as person_count, {r6('avg(age_or_current_age)')} as avg_age,
  count(*) filter (is_multi_role_professional) as multi_role_count
from dim_people where generation <> 'Unknown Generation' and primary_profession is not null
group by all having person_count >= {least}""")


def _counts(relation: str, rows: list[tuple], *columns: str) -> str:
    """One pass over ``relation``; a row for each (labels..., condition)."""
    aggregates = ", ".join(f"count(*) filter ({r[-1]}) as n{i}" for i, r in enumerate(rows))
    structs = ", ".join("{" + ", ".join(f"'{c}': {text(v)}" for c, v in zip(columns[:-1], r)) + f", '{columns[-1]}': n{i}" + "}" for i, r in enumerate(rows))
    return f"select unnest([{structs}], recursive := true) from (select {aggregates} from {relation})"


SAMPLE = {
    "top_rated_movies": _q("""
select decade, primary_title, stars as average_rating, votes as num_votes, success as success_category, runtime_category
from movies where significant and stars >= 8 and decade is not null
order by decade desc, stars desc, title_id limit 20"""),
    "production_trends": _q(f"""
select decade, count(*) as movie_count, {r6('avg(stars)')} as avg_rating,
  count(*) filter (acclaimed) as critically_acclaimed_count, {r6('avg(runtime_minutes)')} as avg_runtime
from movies where decade >= 1920 group by decade"""),
    "genre_popularity": _q(f""", {_GENRES}
select *, {round_ratio('total_votes', 'title_count', 0)} as avg_votes_per_movie
from genres where title_count >= 100 order by total_votes desc, genre limit 15"""),
    "professions_by_generation": _professions(50),
    "professions_by_generation_all": _professions(1),
    "professions_by_generation_min20": _professions(20),
    "career_longevity": W("""
select primary_name, primary_profession, birth_year, death_year, potential_career_span_years, known_for_title_count, generation
from dim_people where known_for_title_count > 0 and potential_career_span_years > 60
order by potential_career_span_years desc, person_id limit 20"""),
    "quality_quadrants": _q(f"""
select quadrant as quality_popularity_quadrant, count(*) as movie_count, {STARS} as avg_rating, {round_avg('votes', 0)} as avg_votes,
  count(*) filter (decade >= 2010) as recent_movies
from movies where has_rating group by quadrant"""),
    "runtime_evolution": _q(f"""
select decade, runtime_category, count(*) as movie_count, {round_avg('runtime_minutes', 1)} as avg_runtime, {STARS} as avg_rating
from movies where runtime_minutes is not null and decade >= 1950 group by all"""),
    "adult_vs_general": _q(f"""
select content_rating_category, count(*) as title_count, {STARS} as avg_rating, {round_avg('votes', 0)} as avg_votes,
  count(*) filter (significant) as significant_ratings_count, count(*) filter (success = 'Critical Acclaim') as critically_acclaimed
from movies where has_rating group by all"""),
    "long_running_series": _q("""
select primary_title, start_year, end_year, series_duration_years, stars as average_rating, votes as num_votes, is_ongoing_series
from base where series_duration_years >= 10 and content_category = 'TV Series'
order by series_duration_years desc, stars desc nulls first, title_id limit 20"""),
    "recent_vs_classic": _q(f"""
select if(is_recent_title, 'Recent (2020+)', 'Classic (Pre-2020)') as era, content_category, count(*) as title_count, {STARS} as avg_rating,
  count(*) filter (acclaimed) as highly_rated_popular, count(*) filter (success = 'Critical Acclaim') as critical_acclaim
from base where stars is not null group by all"""),
    "data_completeness": W("\nunion all by name\n".join(f"""
select '{table}' as table_name, n as total_records, a as has_title, b as has_year, c as has_runtime, d as has_genres,
  {round_pct(part, 'n')} as year_completeness_pct
from (select count(*) as n, count({w}) as a, count({x}) as b, count({y}) as c, count({z}) as d from {table})"""
        for table, w, x, y, z, part in (
            ("dim_titles", "primary_title", "start_year", "runtime_minutes", "genres_raw", "b"),
            ("dim_people", "primary_name", "birth_year", "professions_raw", "known_for_titles_raw", "b"),
            ("fact_ratings", "average_rating", "num_votes", "title_id", "nullif(is_statistically_significant, false)", "d")))),
    "executive_metrics": W("select * replace (cast(metric_value as varchar) as metric_value) from (" + " union all ".join(
        _counts(relation, rows, "metric_category", "metric_name", "metric_value") for relation, rows in (
            ("dim_titles", [("Content Library", "Total Movies", "content_category = 'Movie'"),
                            ("Content Library", "Total TV Series", "content_category = 'TV Series'")]),
            ("fact_ratings", [("Quality Metrics", "Highly Rated & Popular", "is_highly_rated_popular"),
                              ("Quality Metrics", "Critical Acclaim", "success_category = 'Critical Acclaim'"),
                              ("Data Completeness", "Statistically Significant Ratings", "is_statistically_significant")]),
            ("dim_people", [("People Database", "Total People", "true"), ("People Database", "Active Directors", "is_director")]))) + ")"),
}

CHARTS = {
    "chart_movies_by_decade": _q(f"""
select decade, count(*) as movie_count, {r6('avg(stars)')} as avg_rating, count(*) filter (acclaimed) as highly_rated_count
from movies where decade between 1920 and 2020 group by decade"""),
    "chart_genre_popularity": _q(f""", {_GENRES}
select * from genres where title_count >= 1000 order by total_votes desc, genre limit 15"""),
    "chart_quality_points": _q("""
select primary_title, stars as average_rating, votes as num_votes, decade, content_category,
  coalesce(success, 'Average Quality') as success_category
from movies where votes >= 100 and stars is not null and decade between 1990 and 2020
order by votes desc, title_id limit 2000"""),
    "chart_runtime_groups": _q("""
select decade, if(runtime_minutes > 180, 'Long (over 180 min)', if(runtime_minutes > 90, 'Medium (91-180 min)', 'Short (90 min or less)'))
  as runtime_group, count(*) as movie_count
from movies where decade between 1960 and 2020 and runtime_minutes is not null group by all"""),
    "chart_people_roles": W("""
select generation, role as primary_role, count(*) as person_count
from (select generation, list_filter(
        [if(is_actor, 'Actor', null), if(is_director, 'Director', null), if(is_writer, 'Writer', null), if(is_producer, 'Producer', null)],
        lambda x: x is not null)[1] as role
      from dim_people where generation <> 'Unknown Generation')
where role is not null group by all"""),
    "summary_stats": W(" union all ".join(_counts(relation, rows, "metric", "value") for relation, rows in (
        ("dim_titles", [("Total Movies", "content_category = 'Movie'"), ("Total TV Series", "content_category = 'TV Series'")]),
        ("dim_people", [("Total People", "true")]),
        ("fact_ratings", [("Ratings with 1000+ votes", "is_statistically_significant"), ("Highly Rated & Popular", "is_highly_rated_popular")])))),
    "mart_row_counts": W(" union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in ("dim_titles", "dim_people", "fact_ratings"))),
}
CHARTS["sql_top_rated_movies"] = SAMPLE["top_rated_movies"]
