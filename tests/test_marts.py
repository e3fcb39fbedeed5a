"""Boundary rows for every staging and mart rule (FIXTURES §3)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmart.operators import marts as M
from reelmart.operators import staging as S
from reelmart.sources.catalog import raw_schema

AS_OF = 2024


def _raw_titles(spark, rows):
    cols = raw_schema("title_basics").fieldNames()
    full = [tuple(list(r) + [None] * (len(cols) - len(r))) for r in rows]
    return spark.createDataFrame(full, raw_schema("title_basics"))


def _stg_titles(spark, rows):
    schema = "title_id string, title_type string, primary_title string, original_title string, is_adult boolean, " \
             "start_year int, end_year int, runtime_minutes int, genres_raw string"
    return spark.createDataFrame(rows, schema)


def _title(title_id="t", title_type="movie", primary_title="x", is_adult=False, start=None, end=None,
           runtime=None, genres=None):
    return (title_id, title_type, primary_title, primary_title, is_adult, start, end, runtime, genres)


def _dim_titles(spark, rows):
    return {r.title_id: r for r in M.dim_titles(_stg_titles(spark, rows), AS_OF).collect()}


def test_title_type_filter_and_flags(spark):
    types = ["movie", "short", "tvEpisode", "tvMiniSeries", "tvMovie", "tvSeries", "tvShort", "tvSpecial",
             "video", "videoGame", "tvPilot", None]
    raw = _raw_titles(spark, [(f"t{i}", t, "p", "o", ["1", "0", "2", None][i % 4]) for i, t in enumerate(types)])
    out = {r.title_id: r for r in S.stg_title_basics(raw).collect()}
    assert set(out) == {f"t{i}" for i in range(10)}
    assert [out[f"t{i}"].is_adult for i in range(4)] == [True, False, None, None]


def test_name_filter(spark):
    raw = spark.createDataFrame([("n1", None), ("n2", ""), ("n3", "   "), ("n4", "A")],
                                "nconst string, primaryname string") \
        .selectExpr("nconst", "primaryname", "null as birthyear", "null as deathyear",
                    "null as primaryprofession", "null as knownfortitles")
    assert [r.person_id for r in S.stg_name_basics(raw).collect()] == ["n4"]


def test_ratings_cast_and_no_filter(spark):
    raw = spark.createDataFrame([("tt1", "7.25", "10"), ("zz", None, None)], raw_schema("title_ratings"))
    rows = {r.title_id: r for r in S.stg_title_ratings(raw).collect()}
    assert rows["tt1"].average_rating == Decimal("7.3") and rows["tt1"].num_votes == 10
    assert rows["zz"].average_rating is None


def test_bad_integer_fails_the_job(spark):
    raw = _raw_titles(spark, [("t1", "movie", "p", "o", "0", "19x5")])
    with pytest.raises(Exception):
        S.stg_title_basics(raw).collect()


def test_decade_runtime_and_length_ladders(spark):
    rows = [_title("a", start=1899, runtime=None), _title("b", start=1900, runtime=0),
            _title("c", start=1999, runtime=30), _title("d", start=2000, runtime=31),
            _title("e", start=None, runtime=90), _title("f", runtime=91), _title("g", runtime=180),
            _title("h", runtime=181)]
    d = _dim_titles(spark, rows)
    assert [d[k].decade for k in "abcde"] == [1890, 1900, 1990, 2000, None]
    assert [d[k].runtime_category for k in "abcdefgh"] == [
        "Unknown", "Short (≤30 min)", "Short (≤30 min)", "Standard (31-90 min)", "Standard (31-90 min)",
        "Long (91-180 min)", "Long (91-180 min)", "Extended (>180 min)"]
    lengths = _dim_titles(spark, [_title("p", primary_title="x" * 20), _title("q", primary_title="x" * 21),
                                  _title("r", primary_title="x" * 50), _title("s", primary_title="x" * 51),
                                  _title("t", primary_title=None)])
    assert [lengths[k].title_length_category for k in "pqrst"] == [
        "Short Title", "Medium Title", "Medium Title", "Long Title", "Long Title"]
    assert lengths["t"].title_character_count is None


def test_genre_count_and_series_flags(spark):
    d = _dim_titles(spark, [
        _title("a", genres=None), _title("b", genres=""), _title("c", genres="a"), _title("d", genres="a,b,"),
        _title("s1", title_type="tvSeries", start=2000, end=None), _title("s2", title_type="tvSeries", start=2000,
                                                                         end=2009),
        _title("m", title_type="movie", end=None), _title("n", is_adult=None)])
    assert [d[k].genre_count for k in "abcd"] == [0, None, 1, 3]
    assert (d["s1"].is_ongoing_series, d["s2"].is_ongoing_series, d["m"].is_ongoing_series) == (True, False, False)
    assert d["s2"].series_duration_years == 10
    assert d["n"].content_rating_category == "General Audience"
    assert d["s1"].content_category == "TV Series" and d["m"].content_category == "Movie"


def test_recent_title(spark):
    d = _dim_titles(spark, [_title("a", start=AS_OF - 6), _title("b", start=AS_OF - 5), _title("c", start=AS_OF + 1),
                            _title("d", start=None)])
    assert [d[k].is_recent_title for k in "abcd"] == [False, True, True, False]


def _people(spark, rows):
    schema = "person_id string, primary_name string, birth_year int, death_year int, professions_raw string, " \
             "known_for_titles_raw string"
    return {r.person_id: r for r in M.dim_people(spark.createDataFrame(rows, schema), AS_OF).collect()}


def test_age_generation_and_names(spark):
    years = [1927, 1928, 1945, 1946, 1964, 1965, 1980, 1981, 1996, 1997, 2012, 2013, None]
    p = _people(spark, [(f"g{i}", "Ann", y, None, None, None) for i, y in enumerate(years)])
    assert [p[f"g{i}"].generation for i in range(len(years))] == [
        "Pre-Silent Generation", "Silent Generation", "Silent Generation", "Baby Boomers", "Baby Boomers",
        "Generation X", "Generation X", "Millennials", "Millennials", "Generation Z", "Generation Z",
        "Generation Alpha", "Unknown Generation"]
    ages = [29, 30, 49, 50, 69, 70]
    a = _people(spark, [(f"a{x}", "Ann", AS_OF - x, None, None, None) for x in ages])
    assert [a[f"a{x}"].age_category for x in ages] == [
        "Young (Under 30)", "Mid-Career (30-49)", "Mid-Career (30-49)", "Veteran (50-69)", "Veteran (50-69)",
        "Elder (70+)"]
    lives = _people(spark, [("bd", "Ann", 1900, 1980, None, None), ("b", "Ann", 1950, None, None, None),
                            ("d", "Ann", None, 1980, None, None), ("n", "Ann", None, None, None, None)])
    assert [lives[k].age_or_current_age for k in ("bd", "b", "d", "n")] == [80, AS_OF - 1950, None, None]
    assert [lives[k].potential_career_span_years for k in ("bd", "b", "d", "n")] == [80, AS_OF - 1950, None, None]
    assert lives["d"].is_deceased and not lives["b"].is_deceased
    names = _people(spark, [("1", "Ann", None, None, None, None), ("2", "Ann Lee", None, None, None, None),
                            ("3", "Ann  Van Lee", None, None, None, None), ("4", " Ann", None, None, None, None)])
    assert [(names[k].first_name, names[k].last_name) for k in "1234"] == [
        ("Ann", None), ("Ann", "Lee"), ("Ann", "Van Lee"), ("", "Ann")]


def test_role_flags(spark):
    p = _people(spark, [("a", "A", None, None, "Actor", None), ("b", "B", None, None, "actress", None),
                        ("c", "C", None, None, "art_director", None), ("d", "D", None, None, "casting_director", None),
                        ("e", "E", None, None, None, None), ("f", "F", None, None, " producer , Actor", None)])
    assert p["a"].is_actor and p["b"].is_actor and not p["c"].is_actor
    assert p["c"].is_director and p["d"].is_director
    assert not any([p["e"].is_actor, p["e"].is_director, p["e"].is_multi_role_professional])
    assert p["e"].profession_count == 0 and p["e"].primary_profession is None
    assert p["f"].primary_profession == "producer" and p["f"].is_multi_role_professional


def _facts(spark, rows, titles=None):
    stg = spark.createDataFrame([(k, None if r is None else Decimal(str(r)), v) for k, r, v in rows],
                                "title_id string, average_rating decimal(3,1), num_votes int")
    dims = M.dim_titles(_stg_titles(spark, titles or [_title("none")]), AS_OF)
    return {r.title_id: r for r in M.fact_ratings(stg, dims, AS_OF).collect()}


def test_rating_and_vote_ladders(spark):
    ratings = [2.9, 3.0, 4.9, 5.0, 6.9, 7.0, 7.9, 8.0, 8.9, 9.0, None]
    f = _facts(spark, [(f"r{i}", r, 1) for i, r in enumerate(ratings)])
    assert [f[f"r{i}"].rating_category for i in range(len(ratings))] == [
        "Poor (< 3.0)", "Below Average (3.0-4.9)", "Below Average (3.0-4.9)", "Average (5.0-6.9)",
        "Average (5.0-6.9)", "Good (7.0-7.9)", "Good (7.0-7.9)", "Excellent (8.0-8.9)", "Excellent (8.0-8.9)",
        "Outstanding (9.0+)", "Not Rated"]
    votes = [None, 0, 9, 10, 99, 100, 999, 1000, 9999, 10000, 99999, 100000, 999999, 1000000]
    v = _facts(spark, [(f"v{i}", 5.0, x) for i, x in enumerate(votes)])
    assert [v[f"v{i}"].vote_volume_category for i in range(len(votes))] == [
        "No Votes", "Minimal (< 100)", "Minimal (< 100)", "Minimal (< 100)", "Minimal (< 100)", "Low (100-999)",
        "Low (100-999)", "Moderate (1K-9K)", "Moderate (1K-9K)", "High (10K-99K)", "High (10K-99K)",
        "Very High (100K-999K)", "Very High (100K-999K)", "Massive (1M+)"]
    assert [v[f"v{i}"].rating_confidence for i in range(len(votes))] == [
        "No Confidence", "No Confidence", "Very Low Confidence", "Low Confidence", "Low Confidence",
        "Medium Confidence", "Medium Confidence", "High Confidence", "High Confidence", "Very High Confidence",
        "Very High Confidence", "Very High Confidence", "Very High Confidence", "Very High Confidence"]
    tiers = [5.9, 6.0, 7.0, 7.5, 8.0, 8.5, None]
    t = _facts(spark, [(f"t{i}", r, 1) for i, r in enumerate(tiers)])
    assert [t[f"t{i}"].rating_percentile_tier for i in range(len(tiers))] == [
        "Bottom 50%", "Top 50%", "Top 25%", "Top 10%", "Top 5%", "Top 1%", None]


def test_success_quadrant_and_scores(spark):
    cases = [(8.0, 1), (7.0, 50000), (6.0, 10000), (3.9, 5000), (5.0, 100000), (5.0, 1), (None, 100000),
             (None, None)]
    f = _facts(spark, [(f"s{i}", r, v) for i, (r, v) in enumerate(cases)])
    assert [f[f"s{i}"].success_category for i in range(len(cases))] == [
        "Critical Acclaim", "Popular Success", "Commercial Success", "Critical Failure", "High Visibility",
        "Standard Release", "High Visibility", "Standard Release"]
    quads = [(7.0, 10000), (7.0, 9999), (6.9, 10000), (6.9, 9999), (None, 10000)]
    q = _facts(spark, [(f"q{i}", r, v) for i, (r, v) in enumerate(quads)])
    assert [q[f"q{i}"].quality_popularity_quadrant for i in range(len(quads))] == [
        "High Quality, High Popularity", "High Quality, Low Popularity", "Low Quality, High Popularity",
        "Low Quality, Low Popularity", "Low Quality, Low Popularity"]
    p = _facts(spark, [("a", 8.0, 1000), ("b", 8.0, 0), ("c", None, 10), ("d", 8.0, None)])
    assert p["a"].popularity_score == pytest.approx(24.0) and p["b"].popularity_score == 0.0
    assert p["c"].popularity_score is None and p["d"].popularity_score is None
    assert p["a"].is_statistically_significant and not p["d"].is_statistically_significant


def test_annual_vote_rate_and_context(spark):
    titles = [_title("old", start=2015), _title("future", start=AS_OF + 3), _title("nostart", start=None)]
    f = _facts(spark, [("old", 5.0, 100), ("future", 5.0, 100), ("nostart", 5.0, 100), ("zero", 5.0, 0),
                       ("null", 5.0, None), ("orphan", 5.0, 7)], titles)
    assert f["old"].annual_vote_rate == pytest.approx(10.0)
    assert f["future"].annual_vote_rate == pytest.approx(100.0)
    assert f["nostart"].annual_vote_rate == pytest.approx(100.0)
    assert f["zero"].annual_vote_rate == 0.0 and f["null"].annual_vote_rate == 0.0
    assert f["orphan"].content_category is None and f["orphan"].annual_vote_rate == pytest.approx(7.0)


def test_bridge_rules(spark):
    credits = spark.createDataFrame(
        [("t1", "p1", None, "actor", None, '["A","B"]'), ("t1", "p1", 3, "actor", None, None),
         ("t1", "p1", 4, "director", None, "x,y"), ("t1", "p1", 10, "producer", None, None),
         ("t1", "p1", 11, "self", None, None), ("t1", "p1", 50, "executive producer", None, None),
         ("t1", "p1", 51, None, None, None), ("t1", "p1", 51, None, None, None)],
        "title_id string, person_id string, ordering int, job_category string, job_title string, "
        "character_names string")
    titles = M.dim_titles(_stg_titles(spark, [_title("t1", title_type="tvEpisode", start=1949)]), AS_OF)
    people = M.dim_people(spark.createDataFrame([("p1", "Ann", 1950, None, None, None)],
                                                "person_id string, primary_name string, birth_year int, "
                                                "death_year int, professions_raw string, "
                                                "known_for_titles_raw string"), AS_OF)
    rows = M.bridge_cast_crew(credits, titles, people).orderBy("ordering").collect()
    assert len(rows) == 8  # not deduplicated
    assert [r.credit_importance for r in rows] == ["Unspecified", "Lead/Principal", "Supporting", "Supporting",
                                                   "Featured", "Featured", "Background", "Background"]
    assert [r.role_department for r in rows] == ["Acting", "Acting", "Directing", "Producing", "Other",
                                                 "Producing", "Other", "Other"]
    assert [r.character_count for r in rows][:3] == [2, 0, 0]
    assert rows[0].media_type == "Episode" and rows[0].industry_era == "Golden Age (Pre-1950)"


def test_industry_era_and_media_type(spark):
    years = [None, 1949, 1950, 1969, 1970, 1989, 1990, 2009, 2010]
    titles = M.dim_titles(_stg_titles(spark, [_title(f"t{i}", title_type="short", start=y)
                                              for i, y in enumerate(years)]), AS_OF)
    credits = spark.createDataFrame([(f"t{i}", "p", 1, "actor", None, None) for i in range(len(years))],
                                    "title_id string, person_id string, ordering int, job_category string, "
                                    "job_title string, character_names string")
    people = M.dim_people(spark.createDataFrame([("p", "Ann", None, None, None, None)],
                                                "person_id string, primary_name string, birth_year int, "
                                                "death_year int, professions_raw string, "
                                                "known_for_titles_raw string"), AS_OF)
    got = {r.title_id: r for r in M.bridge_cast_crew(credits, titles, people).collect()}
    assert [got[f"t{i}"].industry_era for i in range(len(years))] == [
        "Unknown Era", "Golden Age (Pre-1950)", "Classic Era (1950-1969)", "Classic Era (1950-1969)",
        "Modern Era (1970-1989)", "Modern Era (1970-1989)", "Digital Era (1990-2009)", "Digital Era (1990-2009)",
        "Streaming Era (2010+)"]
    assert got["t0"].media_type == "Short Film"


def test_role_department_for_every_listed_category(spark):
    cats = ["actor", "actress", "director", "writer", "producer", "executive producer", "composer",
            "music_department", "cinematographer", "camera_department", "editor", "self", None]
    credits = spark.createDataFrame([("t1", "p", i, c, None, None) for i, c in enumerate(cats)],
                                    "title_id string, person_id string, ordering int, job_category string, "
                                    "job_title string, character_names string")
    titles = M.dim_titles(_stg_titles(spark, [_title("t1")]), AS_OF)
    people = M.dim_people(spark.createDataFrame([("p", "Ann", None, None, None, None)],
                                                "person_id string, primary_name string, birth_year int, "
                                                "death_year int, professions_raw string, "
                                                "known_for_titles_raw string"), AS_OF)
    got = {r.ordering: r.role_department for r in M.bridge_cast_crew(credits, titles, people).collect()}
    assert [got[i] for i in range(len(cats))] == [
        "Acting", "Acting", "Directing", "Writing", "Producing", "Producing", "Music", "Music", "Cinematography",
        "Cinematography", "Editing", "Other", "Other"]


def test_columns_that_follow_from_a_row_are_added_after_its_layout(spark):
    seen = []

    def deal(rows):
        seen.append(rows.columns)
        return rows.repartition(2)

    titles = M.dim_titles(spark.createDataFrame([], "title_id string, title_type string, primary_title string, original_title string, is_adult boolean, "
                                                    "start_year int, end_year int, runtime_minutes int, genres_raw string"), AS_OF)
    stg = spark.createDataFrame([("tt1", 9, 5000)], "title_id string, average_rating int, num_votes int").withColumn("average_rating", F.col("average_rating").cast("decimal(3,1)"))
    out = M.fact_ratings(stg, titles, AS_OF, deal)
    assert out.count() == 1 and len(seen) == 1
    assert not {"rating_category", "success_category", "annual_vote_rate"} & set(seen[0])
