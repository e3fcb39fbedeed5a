"""Brute force: fact_ratings' derived columns against a plain-Python statement of the rules."""

import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelmart.operators import marts as M

AS_OF = 2024


def _rules(rating, votes, start):
    def below(x, steps, top):
        for bound, label in steps:
            if x < bound:
                return label
        return top

    r = rating
    cat = "Not Rated" if r is None else below(r, [(3, "Poor (< 3.0)"), (5, "Below Average (3.0-4.9)"),
                                                  (7, "Average (5.0-6.9)"), (8, "Good (7.0-7.9)"),
                                                  (9, "Excellent (8.0-8.9)")], "Outstanding (9.0+)")
    vol = "No Votes" if votes is None else below(votes, [(100, "Minimal (< 100)"), (1000, "Low (100-999)"),
                                                         (10000, "Moderate (1K-9K)"), (100000, "High (10K-99K)"),
                                                         (1000000, "Very High (100K-999K)")], "Massive (1M+)")
    ge = lambda a, b: a is not None and a >= b  # noqa: E731 - NULL comparisons are false
    lt = lambda a, b: a is not None and a < b
    if ge(r, 8):
        success = "Critical Acclaim"
    elif ge(r, 7) and ge(votes, 50000):
        success = "Popular Success"
    elif ge(r, 6) and ge(votes, 10000):
        success = "Commercial Success"
    elif lt(r, 4) and ge(votes, 5000):
        success = "Critical Failure"
    elif ge(votes, 100000):
        success = "High Visibility"
    else:
        success = "Standard Release"
    if not votes:
        rate = 0.0
    elif start is not None:
        rate = votes / max(AS_OF - start + 1, 1)
    else:
        rate = float(votes)
    if ge(r, 7) and ge(votes, 10000):
        quad = "High Quality, High Popularity"
    elif ge(r, 7) and lt(votes, 10000):
        quad = "High Quality, Low Popularity"
    elif lt(r, 7) and ge(votes, 10000):
        quad = "Low Quality, High Popularity"
    else:
        quad = "Low Quality, Low Popularity"
    tier = None if r is None else next((lab for b, lab in [(Decimal("8.5"), "Top 1%"), (8, "Top 5%"),
                                                           (Decimal("7.5"), "Top 10%"), (7, "Top 25%"),
                                                           (6, "Top 50%")] if r >= b), "Bottom 50%")
    score = None if r is None or votes is None else float(r) * math.log10(max(votes, 1))
    return dict(rating_category=cat, vote_volume_category=vol, success_category=success,
                annual_vote_rate=rate, quality_popularity_quadrant=quad, rating_percentile_tier=tier,
                popularity_score=score, is_statistically_significant=ge(votes, 1000),
                is_highly_rated_popular=ge(r, 8) and ge(votes, 10000),
                is_mainstream_success=ge(r, 7) and ge(votes, 100000))


ratings = st.one_of(st.none(), st.integers(0, 100).map(lambda t: Decimal(t) / 10))
votes = st.one_of(st.none(), st.sampled_from([0, 1, 9, 99, 100, 999, 1000, 4999, 5000, 9999, 10000, 49999,
                                              50000, 99999, 100000, 999999, 1000000]), st.integers(0, 3_000_000))
starts = st.one_of(st.none(), st.integers(1880, AS_OF + 3))


def test_fact_rules_match_brute_force(spark):
    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(ratings, votes, starts), min_size=1, max_size=60))
    def check(rows):
        data = [(f"t{i}", r, v, s) for i, (r, v, s) in enumerate(rows)]
        stg = spark.createDataFrame([(k, r, v) for k, r, v, _ in data],
                                    "title_id string, average_rating decimal(3,1), num_votes int")
        titles = M.dim_titles(spark.createDataFrame(
            [(k, "movie", "T", "T", False, s, None, 90, None) for k, _, _, s in data],
            "title_id string, title_type string, primary_title string, original_title string, is_adult boolean, "
            "start_year int, end_year int, runtime_minutes int, genres_raw string"), AS_OF)
        got = {r.title_id: r.asDict() for r in M.fact_ratings(stg, titles, AS_OF).collect()}
        for k, r, v, s in data:
            want = _rules(r, v, s)
            row = got[k]
            for col, val in want.items():
                if isinstance(val, float):
                    assert math.isclose(row[col], val, rel_tol=1e-12, abs_tol=1e-12), (k, col, row[col], val)
                else:
                    assert row[col] == val, (k, col, r, v, row[col], val)

    check()


def _people_rules(name, birth, death, profs):
    def pieces(s):
        return None if s == "" else len(s.split(","))

    gen = "Unknown Generation"
    if birth is not None:
        gen = next((lab for lo, hi, lab in [(1928, 1945, "Silent Generation"), (1946, 1964, "Baby Boomers"),
                                             (1965, 1980, "Generation X"), (1981, 1996, "Millennials"),
                                             (1997, 2012, "Generation Z")] if lo <= birth <= hi),
                   "Generation Alpha" if birth > 2012 else "Pre-Silent Generation")
    if birth is None:
        agecat = "Unknown"
    else:
        age = AS_OF - birth
        agecat = ("Young (Under 30)" if age < 30 else "Mid-Career (30-49)" if age < 50
                  else "Veteran (50-69)" if age < 70 else "Elder (70+)")
    if death is not None:
        age_now = None if birth is None else death - birth
    else:
        age_now = None if birth is None else AS_OF - birth
    space = name.find(" ")
    low = (profs or "").lower()
    return dict(
        generation=gen, age_category=agecat, age_or_current_age=age_now,
        potential_career_span_years=None if birth is None else (death if death is not None else AS_OF) - birth,
        first_name=name[:space].strip(" ") if space >= 0 else name,
        last_name=name[space + 1:].strip(" ") if space >= 0 else None,
        name_character_count=len(name),
        profession_count=0 if profs is None else pieces(profs),
        primary_profession=None if profs is None else profs.split(",")[0].strip(" "),
        is_actor=profs is not None and ("actor" in low or "actress" in low),
        is_director=profs is not None and "director" in low,
        is_multi_role_professional=profs is not None and (pieces(profs) or 0) > 1,
        birth_decade=None if birth is None else birth // 10 * 10,
    )


names = st.text(st.sampled_from(["A", "b", " ", "é", "-"]), min_size=1, max_size=10)
profs = st.one_of(st.none(), st.lists(st.sampled_from(["Actor", "actress", "art_director", "writer", " producer ",
                                                       "", "soundtrack"]), max_size=4).map(",".join))
years = st.one_of(st.none(), st.integers(1790, 2030))


def test_people_rules_match_brute_force(spark):
    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(names, years, years, profs), min_size=1, max_size=60))
    def check(rows):
        data = [(f"p{i}", n, b, d, p, None) for i, (n, b, d, p) in enumerate(rows)]
        df = spark.createDataFrame(data, "person_id string, primary_name string, birth_year int, death_year int, "
                                         "professions_raw string, known_for_titles_raw string")
        got = {r.person_id: r.asDict() for r in M.dim_people(df, AS_OF).collect()}
        for k, n, b, d, p, _ in data:
            for col, val in _people_rules(n, b, d, p).items():
                assert got[k][col] == val, (k, col, n, b, d, p, got[k][col], val)

    check()
