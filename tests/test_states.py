"""Stored partial aggregates: merged answers equal those of the questions over the marts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelmart.operators import marts as M
from reelmart.plans import analytics as A
from reelmart.plans import charts as C
from reelmart.plans import states as S
from reelmart.sources.store import published

TITLES = ("title_id string, title_type string, primary_title string, original_title string, is_adult boolean, start_year int, end_year int, "
          "runtime_minutes int, genres_raw string")


@pytest.fixture(scope="module")
def marts(spark):
    """Movies and series of many decades; some without year, runtime, genre, rating or votes."""
    titles, ratings = [], []
    for i in range(400):
        year = None if i % 17 == 0 else 1890 + (i * 7) % 135
        runtime = None if i % 13 == 0 else (i * 11) % 240
        genres = [None, "", "Drama", "Drama, Comedy", "Comedy,", "War"][i % 6]
        titles.append((f"tt{i:04d}", "movie" if i % 5 else "tvSeries", f"T{i}", f"T{i}", False, year, None, runtime, genres))
        if i % 4:
            ratings.append((f"tt{i:04d}", None if i % 23 == 0 else Decimal(i * 3 % 91 + 10) / 10, None if i % 29 == 0 else (i * 977) % 60_000))
    dims = M.dim_titles(spark.createDataFrame(titles, TITLES), 2024).cache()
    return dims, M.fact_ratings(spark.createDataFrame(ratings, "title_id string, average_rating decimal(3,1), num_votes int"), dims, 2024).cache()


def _part(marts, condition):
    return [m.filter(condition) for m in marts]


QUESTIONS = {
    "production_trends": (A.production_trends, {}),
    "genre_popularity": (A.genre_popularity, {"min_titles": 2}),
    "runtime_evolution": (A.runtime_evolution, {}),
    "recent_vs_classic": (A.recent_vs_classic, {}),
    "chart_movies_by_decade": (C.chart_movies_by_decade, {}),
    "chart_genre_popularity": (C.chart_genre_popularity, {"min_titles": 2}),
    "chart_runtime_groups": (lambda titles, fact: C.chart_runtime_groups(titles), {}),
}


def test_appended_parts_answer_like_the_marts(spark, marts, tmp_dir):
    number = F.substring("title_id", 3, 9).cast("int")
    for k in (0, 1, 2):
        S.append_states(spark, tmp_dir, S.stage_states(*_part(marts, number % 3 == k), tmp_dir))
    S.append_states(spark, tmp_dir, S.stage_states(*_part(marts, F.lit(False)), tmp_dir))  # an empty part adds nothing
    assert len(published(spark, tmp_dir)["title_states"].parts) == 4
    states = S.read_states(spark, tmp_dir)
    assert set(QUESTIONS) == set(S.ANSWERS)
    for question, (fn, parameters) in QUESTIONS.items():
        want, got = fn(*marts, **parameters), S.answer(states, question, **parameters)
        assert got.columns == want.columns
        rows = lambda df: sorted(map(repr, df.collect()))
        assert rows(got) == rows(want) and got.count(), question


def test_answers_read_states_only(spark, marts, tmp_dir):
    S.append_states(spark, tmp_dir, S.stage_states(*marts, tmp_dir))
    plan = S.answer(S.read_states(spark, tmp_dir), "production_trends")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 1


def test_states_of_no_titles(spark, marts, tmp_dir):
    S.append_states(spark, tmp_dir, S.stage_states(*_part(marts, F.lit(False)), tmp_dir))
    states = S.read_states(spark, tmp_dir)
    assert all(S.answer(states, q).count() == 0 for q in S.ANSWERS)
