"""Planted violations: every one of the 73 declared checks returns rows when its rule is broken."""

from decimal import Decimal

from pyspark.sql import types as T

from reelmart.operators import quality as Q
from reelmart.plans.pipeline import build_from_driver_tables

SF = "/root/testdata/sf0.001"

# Values that break each non-generic check (applied to one real row of the relation).
MUTATIONS = {
    "expression_is_true_dim_titles_start_year": {"start_year": 1700},
    "expression_is_true_dim_titles_end_year": {"start_year": 2000, "end_year": 1990},
    "expression_is_true_dim_titles_runtime_minutes": {"runtime_minutes": 0},
    "expression_is_true_dim_titles_genre_count": {"genre_count": -1},
    "expression_is_true_dim_people_birth_year": {"birth_year": 1700},
    "expression_is_true_dim_people_death_year": {"birth_year": 1950, "death_year": 1940},
    "expression_is_true_fact_ratings_average_rating": {"average_rating": Decimal("0.5")},
    "expression_is_true_fact_ratings_num_votes": {"num_votes": 0},
    "rating_range": {"average_rating": Decimal("0.5")},
    "movie_years": {"start_year": 1700},
    "runtime": {"runtime_minutes": 700},
    "birth_years": {"birth_year": 1700},
    "career_span": {"potential_career_span_years": 90},
    "rating_credibility": {"average_rating": Decimal("8.5"), "num_votes": 10},
    "rating_consistency": {"average_rating": Decimal("9.5"), "popularity_score": 1.0,
                           "rating_category": "Outstanding (9.0+)", "success_category": "Critical Failure"},
}


def _planted_rows(check, base: dict) -> list[dict]:
    if check.kind == "unique":
        return [dict(base), dict(base)]
    row = dict(base)
    if check.kind == "not_null":
        row[check.column] = None
    elif check.kind == "accepted_values":
        row[check.column] = "__not_accepted__"
    elif check.kind == "relationships":
        row[check.column] = "zz_orphan"
    else:
        row.update(MUTATIONS[check.check_id])
    return [row]


def test_every_declared_check_fires_on_planted_rows(spark):
    real = build_from_driver_tables(spark, SF, as_of_year=2024).relations()
    by_relation: dict[str, list] = {}
    for chk in Q.DECLARED_CHECKS:
        by_relation.setdefault(chk.relation, []).append(chk)
    fired = {}
    for rel, checks in by_relation.items():
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in real[rel].schema])
        base = real[rel].limit(1).collect()[0].asDict()
        rows = [r for chk in checks for r in _planted_rows(chk, base)]
        planted = spark.createDataFrame([tuple(r[f] for f in schema.names) for r in rows], schema)
        relations = dict(real)
        relations[rel] = planted
        for r in Q.quality_report(relations, checks=checks, as_of_year=2024).collect():
            fired[r.check_id] = r.failures
    assert len(fired) == 73
    assert {cid: n for cid, n in fired.items() if n < 1} == {}
