"""Salted unique-key joins equal plain joins, including with one key holding a third of the rows."""

import pytest
from pyspark.sql import functions as F

from reelmart.operators.joins import ROW, find_hot_keys, semi_join, unique_key_join, with_row


@pytest.fixture()
def skewed(spark):
    # 300 rows: key k0 holds 100 (a third), including 40 identical copies; NULL keys too.
    rows = [("k0", i % 60, "x") for i in range(100)] + [(f"k{i % 50 + 1}", i, "y") for i in range(190)] \
        + [(None, i, "z") for i in range(10)]
    left = spark.createDataFrame(rows, "key string, n int, tag string")
    right = spark.createDataFrame([(f"k{i}", f"v{i}") for i in range(0, 40)], "key string, v string")
    return left, right


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("numbered", [True, False])
def test_salted_join_matches_plain(spark, skewed, how, numbered):
    left, right = skewed
    hot = find_hot_keys(left, ["key"], 1 / 30)["key"]
    salted = unique_key_join(with_row(left) if numbered else left, right, "key", how, hot)
    plain = left.join(right, "key", how)
    assert _sorted(salted.select(*plain.columns)) == _sorted(plain)


def test_hot_keys_are_bounded_by_their_share(spark, skewed):
    left, _ = skewed
    hot = find_hot_keys(left.withColumn("n2", F.col("n") % 2), ["key", "n2"], 0.1)
    assert {r.key: r._salts for r in hot["key"].collect()} == {"k0": 4}  # a third of the rows; NULL is never hot
    assert {r.n2 for r in hot["n2"].collect()} == {0, 1}
    assert find_hot_keys(left, ["key"], 0.5)["key"] is None  # nothing hot: plain join


def test_identical_rows_of_a_hot_key_spread_over_the_salts(spark, tmp_dir):
    spark.range(1000).select(F.lit("k").alias("key")).write.parquet(f"{tmp_dir}/rows")
    numbered = with_row(spark.read.parquet(f"{tmp_dir}/rows"))
    salts = numbered.select(F.pmod(F.col(ROW), F.lit(10)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 10 and max(r["count"] for r in salts) < 200
    again = numbered.select(F.sum(F.col(ROW).cast("decimal(38,0)"))).first()[0]
    assert again == numbered.select(F.sum(F.col(ROW).cast("decimal(38,0)"))).first()[0]  # stable when run again


def test_salted_plan_and_plain_plan(spark, skewed):
    left, right = skewed
    hot = find_hot_keys(left, ["key"], 0.1)["key"]
    assert "_salt" in unique_key_join(left, right, "key", "inner", hot)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in unique_key_join(left, right, "key", "left")._jdf.queryExecution().optimizedPlan().toString()


def test_semi_join_keeps_left_columns(spark, skewed):
    left, right = skewed
    out = semi_join(left, right, "key", find_hot_keys(left, ["key"], 0.1)["key"])
    assert out.columns == left.columns
    assert out.count() == left.join(right, "key", "left_semi").count()


def test_bridge_with_a_title_holding_a_third_of_credits(spark):
    from reelmart.operators import marts as M

    credits = spark.createDataFrame(
        [("hot", f"p{i % 7}", i, "actor", None, None) for i in range(100)]
        + [(f"t{i % 40}", f"p{i % 7}", i, "writer", None, None) for i in range(200)],
        "title_id string, person_id string, ordering int, job_category string, job_title string, "
        "character_names string")
    titles = M.dim_titles(spark.createDataFrame(
        [("hot", "movie", "H", "H", False, 2000, None, 90, None)]
        + [(f"t{i}", "short", "T", "T", False, 1990, None, 10, None) for i in range(40)],
        "title_id string, title_type string, primary_title string, original_title string, is_adult boolean, "
        "start_year int, end_year int, runtime_minutes int, genres_raw string"), 2024)
    people = M.dim_people(spark.createDataFrame(
        [(f"p{i}", f"N {i}", 1970, None, "actor", None) for i in range(7)],
        "person_id string, primary_name string, birth_year int, death_year int, professions_raw string, "
        "known_for_titles_raw string"), 2024)
    hot = find_hot_keys(credits, ["title_id", "person_id"], 0.05)
    salted = M.bridge_cast_crew(credits, titles, people, hot)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    plain = M.bridge_cast_crew(credits, titles, people)
    assert _sorted(salted) == _sorted(plain)
    assert salted.filter("title_id = 'hot'").count() == 100


def test_salts_are_the_same_however_rows_are_dealt(spark, tmp_dir):
    """Also after a shuffle whose order is not fixed: a row that a task deals again gets its old salt."""
    spark.range(500).select(F.lit("k").alias("key"), (F.col("id") % 7).alias("n"), "id").repartition(3).write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    plain = _sorted(with_row(rows.select("key", "n", "id").filter("n < 6")))
    for parts in (2, 5):
        assert _sorted(with_row(rows.repartition(parts).select("key", "n", "id").filter("n < 6"))) == plain
    assert len({r[3] for r in plain}) == len(plain)
    made = spark.range(20).select(F.col("id").alias("key"))  # no file below: by value
    assert _sorted(with_row(made)) == _sorted(with_row(made.repartition(3)))


def test_salts_of_derived_credits_are_stable(spark):
    from reelmart.operators.staging import credit_columns
    from reelmart.sources.synthetic import raw_sources

    credits = credit_columns(raw_sources(spark, "/root/testdata/sf0.001")["title_principals"])
    assert _sorted(with_row(credits)) == _sorted(with_row(credits.repartition(5)))


def test_filters_of_kept_keys_stand_below_the_shuffle(spark, tmp_dir):
    """The runtime Bloom filters of supported titles and named people fire on stored sources of any size of key set."""
    from reelmart.plans.pipeline import build
    from reelmart.sources.synthetic import raw_sources

    raw = {}
    for name, df in raw_sources(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{tmp_dir}/{name}")
        raw[name] = spark.read.parquet(f"{tmp_dir}/{name}")
    plain = {n: _sorted(build(raw, as_of_year=2024, hot_share=None)[n]) for n in ("stg_title_principals", "stg_title_akas", "bridge_cast_crew")}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for share, filters in ((None, 2), (0.005, 1)):
            wh = build(raw, as_of_year=2024, hot_share=share)
            for name, want in (("stg_title_principals", filters), ("stg_title_akas", 1), ("bridge_cast_crew", filters)):
                plan = wh[name]._jdf.queryExecution().optimizedPlan().toString()
                assert plan.count("might_contain") >= want, (name, share)
                assert _sorted(wh[name]) == plain[name]
        kept = build(raw, as_of_year=2024, hot_share=None)["stg_title_akas"]
        written = kept._jdf.queryExecution().executedPlan()
        kept.collect()
        assert "might_contain" in written.toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hashed_semi_join_does_not_sort_the_large_side(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)], "key string, v int")
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    hot = spark.createDataFrame([("a", 2)], "key string, _salts int")
    for h in (None, hot):
        out = semi_join(left, keys, "key", h, hashed=True)
        assert sorted(r.v for r in out.collect()) == [1, 2, 3]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_staged_credits_and_titles_are_joined_by_hash(spark):
    from reelmart.operators import staging as S

    basics = spark.createDataFrame([("tt1", "movie"), ("tt2", "unknown")], "tconst string, titletype string")
    akas = spark.createDataFrame([("tt1", "1"), ("tt2", "1"), ("tt9", "1")], "titleid string, ordering string")
    akas = akas.selectExpr("*", *[f"cast(null as string) {c}" for c in ("title", "region", "language", "types", "attributes", "isoriginaltitle")])
    out = S.stg_title_akas(akas, basics)
    assert [r.title_id for r in out.collect()] == ["tt1"]
    assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
