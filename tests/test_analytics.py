"""Query semantics on hand rows: NULL order, genre explode, thresholds, union shapes."""

from decimal import Decimal

from reelmart.operators import marts as M
from reelmart.plans import analytics as A
from reelmart.plans import charts as C

AS_OF = 2024
TITLE_SCHEMA = ("title_id string, title_type string, primary_title string, original_title string, "
                "is_adult boolean, start_year int, end_year int, runtime_minutes int, genres_raw string")


def _marts(spark, titles, ratings):
    dims = M.dim_titles(spark.createDataFrame(titles, TITLE_SCHEMA), AS_OF)
    stg = spark.createDataFrame([(k, None if r is None else Decimal(str(r)), v) for k, r, v in ratings],
                                "title_id string, average_rating decimal(3,1), num_votes int")
    return dims, M.fact_ratings(stg, dims, AS_OF)


def test_long_running_series_puts_null_rating_first(spark):
    titles = [("s1", "tvSeries", "A", "A", False, 1990, 2005, 30, None),
              ("s2", "tvSeries", "B", "B", False, 1990, 2005, 30, None),
              ("s3", "tvSeries", "C", "C", False, 1990, 2010, 30, None),
              ("s4", "tvSeries", "D", "D", False, 1990, 1995, 30, None)]
    dims, fact = _marts(spark, titles, [("s1", 7.0, 10), ("s3", 5.0, 10)])
    rows = A.long_running_series(dims, fact).collect()
    assert [r.primary_title for r in rows] == ["C", "B", "A"]  # 21 years, then 16 with NULL rating first


def test_genre_explode_trims_and_skips_empty(spark):
    titles = [(f"m{i}", "movie", "T", "T", False, 2000, None, 90, g)
              for i, g in enumerate(["Comedy, Romance", "Comedy", "", None, "Drama,"])]
    dims, fact = _marts(spark, titles, [(f"m{i}", 7.0, 100 * (i + 1)) for i in range(5)])
    got = {r.genre: (r.title_count, r.total_votes) for r in A.genre_popularity(dims, fact, min_titles=1).collect()}
    assert got == {"Comedy": (2, 300), "Romance": (1, 100), "Drama": (1, 500), "": (1, 500)}


def test_rounded_average_is_exact_half_away(spark):
    titles = [(f"m{i}", "movie", "T", "T", False, 2000, None, 90, None) for i in range(20)]
    # 19 x 7.1 and 1 x 7.4 -> exact mean 7.115 -> 7.12 (a float average would give 7.11)
    ratings = [(f"m{i}", 7.1, 10) for i in range(19)] + [("m19", 7.4, 10)]
    dims, fact = _marts(spark, titles, ratings)
    row = A.adult_vs_general(fact).collect()[0]
    assert row.avg_rating == 7.12 and row.title_count == 20


def test_executive_metrics_and_completeness_shapes(spark):
    titles = [("m1", "movie", "T", "T", False, 2000, None, 90, None),
              ("s1", "tvSeries", "S", "S", False, None, None, None, None)]
    dims, fact = _marts(spark, titles, [("m1", 8.5, 20000)])
    people = M.dim_people(spark.createDataFrame([("p1", "Ann", 1950, None, "director", None)],
                                                "person_id string, primary_name string, birth_year int, "
                                                "death_year int, professions_raw string, "
                                                "known_for_titles_raw string"), AS_OF)
    metrics = {r.metric_name: r.metric_value for r in A.executive_metrics(dims, people, fact).collect()}
    assert metrics == {"Total Movies": "1", "Total TV Series": "1", "Highly Rated & Popular": "1",
                       "Critical Acclaim": "1", "Total People": "1", "Active Directors": "1",
                       "Statistically Significant Ratings": "1"}
    comp = {r.table_name: r for r in A.data_completeness(dims, people, fact).collect()}
    assert comp["dim_titles"].year_completeness_pct == 50.0 and comp["dim_people"].has_title == 1
    summary = {r.metric: r.value for r in C.summary_stats(dims, people, fact).collect()}
    assert summary["Total Movies"] == 1 and summary["Ratings with 1000+ votes"] == 1


def test_quadrant_order_and_empty_chart_error(spark):
    titles = [(f"m{i}", "movie", "T", "T", False, 2015, None, 90, None) for i in range(4)]
    dims, fact = _marts(spark, titles, [("m0", 6.0, 1), ("m1", 9.0, 20000), ("m2", 6.0, 20000), ("m3", 8.0, 1)])
    order = [r.quality_popularity_quadrant for r in A.quality_quadrants(fact).collect()]
    assert order == ["High Quality, High Popularity", "High Quality, Low Popularity",
                     "Low Quality, High Popularity", "Low Quality, Low Popularity"]
    empty = C.chart_quality_points(dims.limit(0), fact)
    try:
        C.require_rows(empty, "quality points")
        raise AssertionError("expected EmptyResultError")
    except C.EmptyResultError:
        pass


def test_dashboard_datasets_require_rows(spark):
    titles = [("m1", "movie", "T", "T", False, 1995, None, 90, "Drama")]
    dims, fact = _marts(spark, titles, [("m1", 7.0, 500)])
    people = M.dim_people(spark.createDataFrame([("p1", "Ann", 1950, None, "actor", None)],
                                                "person_id string, primary_name string, birth_year int, "
                                                "death_year int, professions_raw string, "
                                                "known_for_titles_raw string"), AS_OF)
    sets, errors = C.dashboard_datasets(dims, people, fact)
    assert errors == {} and sets["quality_points"].count() == 1
    sets, errors = C.dashboard_datasets(dims.filter("decade < 1900"), people, fact)
    assert set(errors) == {"movies_by_decade", "quality_points"}  # empty charts fail, the rest still build
    assert "people_roles" in sets and "genre_popularity" in sets
