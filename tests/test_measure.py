"""Measured writes, the key census, key ranges, and marts that are published together."""

import json

import pytest
from pyspark.sql import functions as F

from reelmart.operators import quality as Q
from reelmart.operators.measure import ROWS, Measure
from reelmart.operators.ranges import RangeBounds, find_bounds
from reelmart.plans import pipeline as P
from reelmart.sources import store

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    wh = P.build_from_driver_tables(spark, SF, as_of_year=2024, hot_share=None)
    root = str(tmp_path_factory.mktemp("measured"))
    marts = P.materialize(spark, wh, f"{root}/marts")
    staged = P.materialize_staging(spark, wh, f"{root}/staging", ["stg_title_principals", "stg_title_akas"])
    relations = wh.relations()
    relations.update(staged)
    relations.update(marts)
    return root, relations, {**marts.measured, **staged.measured}


def test_measured_numbers_are_those_of_a_scan(stored):
    _, relations, measured = stored
    assert set(measured) == {*P.MART_NAMES, "stg_title_principals", "stg_title_akas"}
    for name, numbers in measured.items():
        assert numbers[ROWS] == relations[name].count() and numbers["as_of_year"] == 2024
        for chk in Measure(name, 2024).checks:
            assert numbers[chk.check_id] == relations[name].filter(chk.violation(F.lit(2024))).count(), chk.check_id


def test_report_from_measurements_equals_the_report_from_scans(spark, stored):
    root, relations, measured = stored
    plain = Q.quality_report(relations, as_of_year=2024)
    assert _rows(Q.quality_report(relations, as_of_year=2024, measured=measured)) == _rows(plain)
    # as another session finds them
    again = P.read_marts(spark, f"{root}/marts")
    assert again.measured == {n: measured[n] for n in P.MART_NAMES}
    other_year = {n: {**m, "as_of_year": 1999, **{c: 10**6 for c in m if c not in (ROWS, "as_of_year")}} for n, m in measured.items()}
    assert _rows(Q.quality_report(relations, as_of_year=2024, measured=other_year)) == _rows(plain)


def test_measured_relations_are_read_for_their_keys_only(stored):
    _, relations, measured = stored
    marts = {n: relations[n] for n in P.MART_NAMES}
    checks = [c for c in Q.DECLARED_CHECKS if c.relation in marts and c.kind != "relationships"]
    clean = [c for c in checks if c.kind != "accepted_values" or not measured[c.relation][c.check_id]]
    plan = Q.quality_report(marts, clean, 2024, measured)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    read = [{c.split("#")[0] for c in line.split("FileScan parquet [")[1].split("]")[0].split(",")} for line in scans]
    assert sorted(min(r - {"content_category"}) for r in read) == ["person_id", "title_id"] and all(len(r - {"content_category"}) == 1 for r in read)


def test_report_exchanges(spark, stored):
    _, relations, measured = stored
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        wh = {n: df for n, df in relations.items() if n.startswith(("dim_", "fact_", "bridge_", "stg_title_principals", "stg_title_akas"))}
        checks = [c for c in Q.DECLARED_CHECKS if c.relation in wh and (c.parent is None or c.parent[0] in wh)]
        plan = Q.quality_report(wh, checks, 2024, measured)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 6
        whole = Q.quality_report(relations, Q.DECLARED_CHECKS, 2024, measured)._jdf.queryExecution().executedPlan().toString()
        stored_only = whole.count("Exchange")
        assert stored_only <= 12 + 2  # the two staging views that are not stored repeat no join
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_census_counts_every_key_once(spark):
    a = spark.createDataFrame([("x", "p"), ("x", None), (None, "q"), ("y", "p")], "k string, m string")
    b = spark.createDataFrame([("x",), ("z",), ("z",)], "k string")
    got = _rows(Q.key_census({"a": a, "b": b}, [("a", "k"), ("a", "m"), ("b", "k")]))
    assert got == [("p", 0, 2, 0), ("q", 0, 1, 0), ("x", 2, 0, 1), ("y", 1, 0, 0), ("z", 0, 0, 2)]


def test_empty_relations(spark, stored, tmp_dir):
    _, relations, _ = stored
    empty = {n: df.limit(0) for n, df in relations.items()}
    assert {r.failures for r in Q.quality_report(empty, as_of_year=2024).collect()} == {0}
    measure = Measure("dim_titles", 2024)
    P.write_mart(relations["dim_titles"].limit(0), f"{tmp_dir}/none", ["title_id"], ["content_category"], measure=measure)
    assert measure.result[ROWS] == 0


# ---------------------------------------------------------------- ranges

def _files(spark, path, key):
    df = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n"))
    return sorted((r.lo, r.hi, r.n) for r in df.collect())


def test_files_span_ranges_and_a_hot_key_is_split(spark, tmp_dir):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "k0500").otherwise(F.format_string("k%04d", F.col("id") % 1000)).alias("key"), "id")
    bounds = find_bounds(rows, ranges=12)
    bounds.deal(rows, "key").sortWithinPartitions("key").write.parquet(f"{tmp_dir}/laid")
    files = _files(spark, f"{tmp_dir}/laid", "key")
    assert sum(n for _, _, n in files) == 6000 and len(files) == 12
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))  # in key order, sharing a hot key at most
    assert max(n for _, _, n in files) < 2.2 * 6000 / 12 and sum(lo <= "k0500" <= hi for lo, hi, _ in files) >= 4


def test_ranges_of_few_many_and_no_keys(spark):
    assert find_bounds(spark.createDataFrame([], "key string")).cuts == ()
    assert find_bounds(spark.createDataFrame([(None,), (None,)], "key string")).cuts == ()
    small = spark.createDataFrame([("b",), ("a",)], "key string")
    assert find_bounds(small, ranges=100).cuts == ("b",)
    sampled = find_bounds(spark.range(50_000).select(F.format_string("%06d", "id").alias("key")), sample=2_000)
    assert sampled.ranges == 4 and all(abs(int(c) - 12_500 * (i + 1)) < 1_500 for i, c in enumerate(sampled.cuts))


@pytest.mark.parametrize("cuts", [(), ("b",), ("b", "b"), ("b", "d", "d", "d", "f"), ("a", "c", "e", "g", "i", "k", "m")])
def test_range_of_a_key(spark, cuts):
    bounds = RangeBounds(cuts)
    rows = spark.createDataFrame([(k, i) for k in ["", "a", "b", "bb", "c", "d", "e", "f", "g", "z", None] for i in range(12)], "key string, i int")
    for r in rows.select("key", bounds.range_of(F.col("key"), F.xxhash64("i")).alias("at")).collect():
        low, high = ([c for c in cuts if c <= r.key], [c for c in cuts if c < r.key]) if r.key is not None else ([], [])
        width = len(low) - len(high)
        assert (len(low) - max(width - 1, 0) <= r.at <= len(low)) if r.key is not None else r.at == 0


# ---------------------------------------------------------------- publication

def test_a_failure_between_marts_leaves_the_old_set_whole(spark, tmp_dir, monkeypatch):
    wh = P.build_from_driver_tables(spark, SF, as_of_year=2024, hot_share=None)
    P.materialize(spark, wh, tmp_dir)
    before = {n: df.inputFiles() for n, df in P.read_marts(spark, tmp_dir).items()}
    monkeypatch.setattr(P.M, "bridge_cast_crew_from_raw", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.materialize(spark, wh, tmp_dir)
    monkeypatch.undo()
    assert {n: df.inputFiles() for n, df in P.read_marts(spark, tmp_dir).items()} == before
    P.materialize(spark, wh, tmp_dir)
    after = {n: df.inputFiles() for n, df in P.read_marts(spark, tmp_dir).items()}
    assert all(not set(before[n]) & set(after[n]) for n in P.MART_NAMES)
    assert len(store.unreferenced_parts(spark, tmp_dir)) == 4


def test_one_row_publishes_a_set_and_tables_can_still_be_published_alone(spark, tmp_dir):
    one = store.Staged("a", ("p1",), 3, None, json.dumps({"rows": 3}))
    store.publish_set(spark, tmp_dir, "both", [one, store.Staged("b", ("p2",), 4)])
    store.publish(spark, tmp_dir, "b", ["p2", "p3"], 9)
    found = store.published(spark, tmp_dir)
    assert found["a"].measured == {"rows": 3} and found["b"].parts == ("p2", "p3") and found["b"].measured == {}
    store.publish_set(spark, tmp_dir, "both", [store.Staged("a", ("p4",), 1), store.Staged("b", ("p5",), 1)])
    assert [store.published(spark, tmp_dir)[t].parts for t in "ab"] == [("p4",), ("p5",)]
    assert store.unreferenced_parts(spark, tmp_dir) == ["p1", "p2", "p3"]


def test_census_holds_few_counts_a_row(spark):
    keys = Q._key_columns(Q.DECLARED_CHECKS)
    places = Q._places(keys, Q.DECLARED_CHECKS)
    assert len(set(places)) == len(keys) and max(slot for _, slot in places) < Q.SLOTS < len(keys)
    for chk in Q.DECLARED_CHECKS:
        if chk.kind == "relationships":
            assert places[keys.index((chk.relation, chk.column))][0] == places[keys.index(chk.parent)][0]
    a = spark.createDataFrame([("x", "y"), ("x", None), (None, "z")], "k string, m string")
    b = spark.createDataFrame([("x",), ("w",), ("w",)], "k string")
    got = sorted(tuple(r) for r in Q.key_census({"a": a, "b": b}, [("a", "k"), ("a", "m"), ("b", "k")], [(0, 0), (1, 0), (0, 1)]).collect())
    assert got == [(0, "w", 0, 2), (0, "x", 2, 1), (1, "y", 1, 0), (1, "z", 1, 0)]


def test_report_of_keys_that_repeat_are_null_or_lack_a_parent(spark):
    rels = {"p": spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"),
            "c": spark.createDataFrame([("a", "b"), ("z", "b"), ("z", None), (None, "q")], "k string, m string"),
            "u": spark.createDataFrame([("a",), ("a",), ("y",)], "k string")}
    checks = [Q.Check("up", "p", "unique", "k"), Q.Check("uu", "u", "unique", "k"), Q.Check("uc", "c", "unique", "k"),
              Q.Check("rk", "c", "relationships", "k", parent=("p", "k")), Q.Check("rm", "c", "relationships", "m", parent=("p", "k")),
              Q.Check("ru", "u", "relationships", "k", parent=("c", "k"))]
    got = {r.check_id: r.failures for r in Q.quality_report(rels, checks).collect()}
    assert got == {"up": 1, "uu": 1, "uc": 1, "rk": 2, "rm": 1, "ru": 1}
