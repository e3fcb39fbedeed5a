"""Checks return exactly the violating rows; the report counts them and assigns status."""

from decimal import Decimal

from pyspark.sql import functions as F

from reelmart.operators import quality as Q


def test_unique_ignores_null_and_finds_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert [(r.unique_field, r.n_records) for r in Q.check_unique(df, "k").collect()] == [("a", 2)]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("x",), ("bad",), ("bad",), (None,)], "v string")
    assert [(r.value_field, r.n_records) for r in Q.check_accepted_values(df, "v", ["x"]).collect()] == [("bad", 2)]


def test_relationships_null_passes_orphan_fails(spark):
    child = spark.createDataFrame([("a",), ("z",), (None,), ("z",)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    got = sorted(r.from_field for r in Q.check_relationships(child, "k", parent, "k").collect())
    assert got == ["z", "z"]


def test_expression_null_passes(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "n int")
    assert Q.check_expression(df, F.col("n") > 0).count() == 1


def test_rating_consistency_on_hand_row(spark):
    fact = spark.createDataFrame(
        [("t1", Decimal("9.5"), 10, 9.5, "Outstanding (9.0+)", "Critical Failure"),
         ("t2", Decimal("9.5"), 10, None, "Outstanding (9.0+)", "Critical Failure"),
         ("t3", Decimal("9.5"), 10, 9.5, "Outstanding (9.0+)", "Critical Acclaim")],
        "title_id string, average_rating decimal(3,1), num_votes int, popularity_score double, "
        "rating_category string, success_category string")
    rows = Q.run_check(Q.check_by_id("rating_consistency"), {"fact_ratings": fact}).collect()
    assert [r.title_id for r in rows] == ["t1"]


def test_declared_check_counts():
    kinds = {}
    for chk in Q.DECLARED_CHECKS:
        kinds[chk.kind] = kinds.get(chk.kind, 0) + 1
    assert len(Q.DECLARED_CHECKS) == 73
    assert kinds == {"unique": 8, "not_null": 32, "accepted_values": 13, "relationships": 5, "expression": 8,
                     "singular": 7}


def test_report_status(spark):
    ratings = spark.createDataFrame([("t1", Decimal("0.5"), 0), ("t1", Decimal("5.0"), None)],
                                    "title_id string, average_rating decimal(3,1), num_votes int")
    checks = [Q.check_by_id(c) for c in ("unique_stg_title_ratings_title_id", "not_null_stg_title_ratings_num_votes",
                                          "rating_range")]
    report = {r.check_id: (r.failures, r.status) for r in
              Q.quality_report({"stg_title_ratings": ratings}, checks=checks).collect()}
    assert report == {"unique_stg_title_ratings_title_id": (1, "fail"),
                      "not_null_stg_title_ratings_num_votes": (1, "fail"), "rating_range": (1, "fail")}
    warn = [Q.check_by_id("birth_years")]
    people = spark.createDataFrame([("p", "A", 1700)], "person_id string, primary_name string, birth_year int")
    row = Q.quality_report({"stg_name_basics": people}, checks=warn, as_of_year=2024).collect()[0]
    assert (row.failures, row.status, row.severity) == (1, "warn", "warn")


def test_select_checks_by_layer_and_kind():
    staging = Q.select_checks(layer="staging")
    marts = Q.select_checks(layer="marts")
    sources = Q.select_checks(layer="sources")
    assert len(sources) == 6 and len(staging) == 20 + 4 and len(marts) == 40 + 3  # declared + singular
    assert len(staging) + len(marts) + len(sources) == 73
    assert len(Q.select_checks(kinds=["generic"])) == 66
    assert len(Q.select_checks(kinds=["singular"])) == 7
    assert {c.relation for c in Q.select_checks(layer="marts", kinds=["singular"])} == {"dim_people", "fact_ratings"}
