"""Oracle SQL, written directly in DuckDB's dialect.

These are independent SQL restatements of the warehouse (staging, marts,
queries and checks) used to cross-check the DataFrame implementation. The
raw layer reuses the fixture SQL (the same text feeds both engines). The
clock is pinned with ``AS_OF`` on both sides.

DuckDB differences handled here (see SURVEY §7.4): ``/`` is float division,
``length`` and ``year`` are BIGINT, ``string_split('')`` has one piece,
``avg`` of a decimal is DOUBLE. Rounded averages therefore use exact
integer arithmetic: round-half-away-from-zero of ``S / n`` at ``d`` digits is
``sign(S) * ((2*|S|*10^d + n) // (2*n))``.
"""

from __future__ import annotations

from reelmart.sources.synthetic import raw_sql_for_duckdb

AS_OF = 2024


def _raw_ctes() -> str:
    parts = []
    for table in ("title_basics", "title_ratings", "name_basics", "title_principals", "title_akas"):
        parts.append(f"raw_{table} AS ({raw_sql_for_duckdb(table)})")
    return ",\n".join(parts)


# FIXED VALUES: type list, labels and thresholds of the warehouse, as (bound, label) steps.
TYPES = ["movie", "short", "tvEpisode", "tvMiniSeries", "tvMovie", "tvSeries", "tvShort", "tvSpecial", "video", "videoGame"]
RUNTIME = [(30, "Short (≤30 min)"), (90, "Standard (31-90 min)"), (180, "Long (91-180 min)")]
CONTENT = {"Movie": ["movie", "tvMovie"], "TV Series": ["tvSeries", "tvMiniSeries"], "TV Episode": ["tvEpisode"],
           "Short Film": ["short", "tvShort"], "TV Special": ["tvSpecial"], "Video": ["video"], "Video Game": ["videoGame"]}
TITLE_LENGTH = [(20, "Short Title"), (50, "Medium Title")]
AGE = [(30, "Young (Under 30)"), (50, "Mid-Career (30-49)"), (70, "Veteran (50-69)")]
GENERATION = [(1927, "Pre-Silent Generation"), (1945, "Silent Generation"), (1964, "Baby Boomers"), (1980, "Generation X"),
              (1996, "Millennials"), (2012, "Generation Z")]
RATING = [(3.0, "Poor (< 3.0)"), (5.0, "Below Average (3.0-4.9)"), (7.0, "Average (5.0-6.9)"), (8.0, "Good (7.0-7.9)"),
          (9.0, "Excellent (8.0-8.9)")]
VOTES = [(100, "Minimal (< 100)"), (1000, "Low (100-999)"), (10000, "Moderate (1K-9K)"), (100000, "High (10K-99K)"),
         (1000000, "Very High (100K-999K)")]
CONFIDENCE = [(1, "No Confidence"), (10, "Very Low Confidence"), (100, "Low Confidence"), (1000, "Medium Confidence"),
              (10000, "High Confidence")]
TIERS = [(8.5, "Top 1%"), (8.0, "Top 5%"), (7.5, "Top 10%"), (7.0, "Top 25%"), (6.0, "Top 50%")]
SUCCESS = [("rated >= 8.0", "Critical Acclaim"), ("rated >= 7.0 and voted >= 50000", "Popular Success"),
           ("rated >= 6.0 and voted >= 10000", "Commercial Success"), ("rated < 4.0 and voted >= 5000", "Critical Failure"),
           ("voted >= 100000", "High Visibility")]
DEPARTMENTS = {"Acting": ["actor", "actress"], "Directing": ["director"], "Writing": ["writer"],
               "Producing": ["producer", "executive producer"], "Music": ["composer", "music_department"],
               "Cinematography": ["cinematographer", "camera_department"], "Editing": ["editor"]}
CREDIT = [(3, "Lead/Principal"), (10, "Supporting"), (50, "Featured")]
MEDIA = {"Film": ["Movie"], "Television": ["TV Series"], "Episode": ["TV Episode"]}
ERA = [(1950, "Golden Age (Pre-1950)"), (1970, "Classic Era (1950-1969)"), (1990, "Modern Era (1970-1989)"),
       (2010, "Digital Era (1990-2009)")]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values: list[str]) -> str:
    return ", ".join(text(v) for v in values)


def steps(col: str, table: list, op: str, otherwise: str, null: str | None = None) -> str:
    """First step whose bound ``col op bound`` meets."""
    arms = [f"when {col} {op} {bound} then {text(label)}" for bound, label in table]
    if null is not None:
        arms.insert(0, f"when {col} is null then {text(null)}")
    return f"case {' '.join(arms)} else {text(otherwise)} end"


def groups(col: str, table: dict[str, list[str]], otherwise: str) -> str:
    """Label of the list that holds ``col``."""
    return f"case {' '.join(f'when {col} in ({listed(v)}) then {text(k)}' for k, v in table.items())} else {otherwise} end"


def says(col: str, *needles: str) -> str:
    """Whether a text holds one of the words, case-blind; false for NULL."""
    return "coalesce(" + " or ".join(f"contains(lower({col}), {text(n)})" for n in needles) + ", false)"


SUPPORTED = listed(TYPES)


def _pieces(col: str) -> str:
    """Number of comma-separated pieces: NULL for NULL and for the empty string."""
    return f"len(string_split(nullif({col}, ''), ','))"


def _counted(col: str) -> str:
    return f"cast(if({col} is null, 0, {_pieces(col)}) as integer)"


def _decade(col: str) -> str:
    return f"cast({col} - ({col} % 10 + 10) % 10 as integer)"


STAGING = f"""
stg_title_basics AS (
  SELECT tconst AS title_id, titletype AS title_type, primarytitle AS primary_title,
         originaltitle AS original_title,
         CASE WHEN isadult = '1' THEN true WHEN isadult = '0' THEN false ELSE NULL END AS is_adult,
         cast(startyear AS integer) AS start_year, cast(endyear AS integer) AS end_year,
         cast(runtimeminutes AS integer) AS runtime_minutes, genres AS genres_raw
  FROM raw_title_basics WHERE titletype IN ({SUPPORTED})
),
stg_title_ratings AS (
  SELECT tconst AS title_id, cast(averagerating AS decimal(3,1)) AS average_rating,
         cast(numvotes AS integer) AS num_votes
  FROM raw_title_ratings
),
stg_name_basics AS (
  SELECT nconst AS person_id, primaryname AS primary_name, cast(birthyear AS integer) AS birth_year,
         cast(deathyear AS integer) AS death_year, primaryprofession AS professions_raw,
         knownfortitles AS known_for_titles_raw
  FROM raw_name_basics WHERE primaryname IS NOT NULL AND trim(primaryname) <> ''
),
stg_title_principals AS (
  SELECT tconst AS title_id, nconst AS person_id, cast(ordering AS integer) AS ordering,
         category AS job_category, job AS job_title, characters AS character_names
  FROM raw_title_principals
  WHERE tconst IN (SELECT tconst FROM raw_title_basics WHERE titletype IN ({SUPPORTED}))
    AND nconst IN (SELECT nconst FROM raw_name_basics WHERE primaryname IS NOT NULL AND trim(primaryname) <> '')
),
stg_title_akas AS (
  SELECT titleid AS title_id, cast(ordering AS integer) AS ordering, title AS alternative_title,
         region AS region_code, language AS language_code, types AS title_types_raw,
         attributes AS attributes_raw,
         CASE WHEN isoriginaltitle = '1' THEN true WHEN isoriginaltitle = '0' THEN false ELSE NULL END
           AS is_original_title
  FROM raw_title_akas
  WHERE titleid IN (SELECT tconst FROM raw_title_basics WHERE titletype IN ({SUPPORTED}))
)"""

MARTS = f"""
dim_titles AS (
  select *, if(coalesce(is_adult, false), 'Adult Content', 'General Audience') as content_rating_category,
    {_decade('start_year')} as decade,
    end_year - start_year + 1 as series_duration_years,
    {steps('runtime_minutes', RUNTIME, '<=', 'Extended (>180 min)', 'Unknown')} as runtime_category,
    {groups('title_type', CONTENT, "'Other'")} as content_category,
    {_counted('genres_raw')} as genre_count,
    title_type in ({listed(CONTENT['TV Series'])}) and end_year is null as is_ongoing_series,
    coalesce(start_year >= {AS_OF - 5}, false) as is_recent_title,
    cast(length(primary_title) as integer) as title_character_count,
    {steps('length(primary_title)', TITLE_LENGTH, '<=', 'Long Title')} as title_length_category
  from stg_title_basics
),
dim_people AS (
  select p.* exclude (gap), {_decade('birth_year')} as birth_decade, {_decade('death_year')} as death_decade,
    death_year is not null as is_deceased,
    cast(if(death_year is null, {AS_OF}, death_year) - birth_year as integer) as age_or_current_age,
    cast(coalesce(death_year, {AS_OF}) - birth_year as integer) as potential_career_span_years,
    {steps(f'{AS_OF} - birth_year', AGE, '<', 'Elder (70+)', 'Unknown')} as age_category,
    {steps('birth_year', GENERATION, '<=', 'Generation Alpha', 'Unknown Generation')} as generation,
    {_counted('professions_raw')} as profession_count,
    trim(string_split(professions_raw, ',')[1]) as primary_profession,
    {says('professions_raw', 'actor', 'actress')} as is_actor, {says('professions_raw', 'director')} as is_director,
    {says('professions_raw', 'writer')} as is_writer, {says('professions_raw', 'producer')} as is_producer,
    {says('professions_raw', 'composer')} as is_composer,
    coalesce({_pieces('professions_raw')} > 1, false) as is_multi_role_professional,
    {_counted('known_for_titles_raw')} as known_for_title_count,
    cast(length(primary_name) as integer) as name_character_count,
    if(gap = 0, primary_name, trim(left(primary_name, gap - 1))) as first_name,
    if(gap = 0, null, trim(substr(primary_name, gap + 1))) as last_name
  from (select *, instr(primary_name, ' ') as gap from stg_name_basics) p
),
rated AS (
  select r.title_id, r.average_rating, r.num_votes, r.average_rating as rated, r.num_votes as voted,
    t.title_type, t.content_category, t.start_year, t.decade, t.runtime_category, t.is_adult
  from stg_title_ratings r left join dim_titles t using (title_id)
),
fact_ratings AS (
  select * exclude (rated, voted),
    {steps('rated', RATING, '<', 'Outstanding (9.0+)', 'Not Rated')} as rating_category,
    {steps('voted', VOTES, '<', 'Massive (1M+)', 'No Votes')} as vote_volume_category,
    {steps('coalesce(voted, 0)', CONFIDENCE, '<', 'Very High Confidence')} as rating_confidence,
    if(rated is null, null, {steps('rated', TIERS, '>=', 'Bottom 50%')}) as rating_percentile_tier,
    case {' '.join(f'when {c} then {text(v)}' for c, v in SUCCESS)} else 'Standard Release' end as success_category,
    coalesce(voted >= 1000, false) as is_statistically_significant,
    coalesce(rated >= 8.0 and voted >= 10000, false) as is_highly_rated_popular,
    coalesce(rated >= 7.0 and voted >= 100000, false) as is_mainstream_success,
    cast(rated as double) * log10(cast(if(voted < 1, 1, voted) as double)) as popularity_score,
    cast(coalesce(voted, 0) as double) / greatest({AS_OF + 1} - coalesce(start_year, {AS_OF}), 1) as annual_vote_rate,
    case when rated >= 7.0 and voted is not null then 'High Quality, ' || if(voted >= 10000, 'High', 'Low')
         when rated < 7.0 and voted >= 10000 then 'Low Quality, High' else 'Low Quality, Low' end || ' Popularity'
      as quality_popularity_quadrant
  from rated
),
bridge_cast_crew AS (
  select c.*, t.title_type, t.content_category, t.start_year, t.decade, t.is_adult, w.primary_name, w.age_category, w.generation,
    {groups('c.job_category', DEPARTMENTS, "'Other'")} as role_department,
    {steps('c.ordering', CREDIT, '<=', 'Background', 'Unspecified')} as credit_importance,
    cast(if(c.job_category in ({listed(DEPARTMENTS['Acting'])}) and c.character_names is not null, {_pieces('c.character_names')}, 0) as integer)
      as character_count,
    {groups('t.content_category', MEDIA, 't.content_category')} as media_type,
    {steps('t.start_year', ERA, '<', 'Streaming Era (2010+)', 'Unknown Era')} as industry_era
  from stg_title_principals c left join dim_titles t using (title_id) left join dim_people w using (person_id)
)"""


def with_warehouse(query: str, **replaced: str) -> str:
    """Prefix ``query`` with the raw, staging and mart CTEs.

    ``raw_<table>="select ... from given"`` replaces a raw table; ``given`` is the original one.
    """
    raw = _raw_ctes()
    for name, sql in replaced.items():
        raw = raw.replace(f"{name} AS (", f"{name}_given AS (") + f",\n{name} AS ({sql.replace('given', name + '_given')})"
    return f"WITH {raw},\n{STAGING},\n{MARTS}\n{query}"


def round_avg(expr: str, digits: int, scale: int = 0) -> str:
    """Exact ROUND(AVG(expr), digits) for an expression with ``scale`` decimals, as DOUBLE."""
    s = f"sum(cast(round({expr} * {10 ** scale}) AS hugeint))" if scale else f"sum(cast({expr} AS hugeint))"
    n = f"nullif(count({expr}), 0)"
    m, d = 10 ** digits, 10 ** scale
    num = f"(2 * abs({s}) * {m} + {n} * {d}) // (2 * {n} * {d})"
    return f"cast(sign({s}) * {num} AS double) / {float(m)}"


def round_ratio(num: str, den: str, digits: int = 0) -> str:
    """Exact ROUND(num / den, digits) for non-negative integers, as DOUBLE."""
    m = 10 ** digits
    return f"cast((2 * cast({num} AS hugeint) * {m} + nullif({den}, 0)) // (2 * nullif({den}, 0)) AS double) / {float(m)}"


def round_pct(part: str, whole: str, digits: int = 1) -> str:
    """Exact ROUND(100.0 * part / whole, digits) for non-negative counts, as DOUBLE."""
    return round_ratio(f"100 * ({part})", whole, digits)


def r6(expr: str) -> str:
    return f"round({expr}, 6)"
