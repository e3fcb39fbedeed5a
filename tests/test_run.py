"""End to end: driver tables -> COPY-text landing files -> raw -> marts -> quality gate."""

import os
import shutil

import pytest

from reelmart.constants import SOURCE_FILES
from reelmart.plans.pipeline import QualityGateError, export_csv, run
from reelmart.sources.synthetic import raw_sources
from reelmart.sources.tsv import write_copy_text

SF = "/root/testdata/sf0.001"


def _landing(spark, tmp_dir):
    raw = raw_sources(spark, SF)
    landing = f"{tmp_dir}/landing"
    for file_name, table in SOURCE_FILES.items():
        write_copy_text(raw[table].coalesce(1), f"{tmp_dir}/parts/{table}", table)
        part = [p for p in os.listdir(f"{tmp_dir}/parts/{table}") if p.endswith(".csv")][0]
        os.makedirs(landing, exist_ok=True)
        shutil.copy(f"{tmp_dir}/parts/{table}/{part}", f"{landing}/{file_name}")
    return landing, raw


def test_run_end_to_end(spark, tmp_dir):
    landing, raw = _landing(spark, tmp_dir)
    with pytest.raises(QualityGateError, match="not_null_dim_titles_is_adult"):
        run(spark, landing, f"{tmp_dir}/wh", as_of_year=2024)
    # second run: raw already loaded, so nothing is reloaded; gate off
    result = run(spark, landing, f"{tmp_dir}/wh", as_of_year=2024, fail_on_error=False)
    assert result.load is None
    counts = {r.table_name: r.row_count for r in result.counts.collect()}
    assert counts["dim_titles"] == raw["title_basics"].filter(
        "titletype in ('movie','short','tvEpisode','tvMiniSeries','tvMovie','tvSeries','tvShort',"
        "'tvSpecial','video','videoGame')").count()
    statuses = {r.status for r in result.report.collect()}
    assert statuses == {"pass", "warn", "fail"}
    export_csv(result.counts, f"{tmp_dir}/counts_csv")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/counts_csv")
    assert back.columns == ["table_name", "row_count"] and back.count() == 3
    exported = run(spark, landing, f"{tmp_dir}/wh", as_of_year=2024, fail_on_error=False,
                   export_dir=f"{tmp_dir}/exports").exported
    assert len(exported) == 12
    trends = spark.read.option("header", True).csv(f"{tmp_dir}/exports/production_trends")
    assert trends.columns[:2] == ["decade", "movie_count"] and trends.count() > 0


def test_cli_run_and_report(spark, tmp_dir, capsys):
    from reelmart.__main__ import main

    landing, _ = _landing(spark, tmp_dir)
    assert main(["run", "--landing", landing, "--root", f"{tmp_dir}/cli", "--as-of-year", "2024"]) == 1
    assert main(["run", "--landing", landing, "--root", f"{tmp_dir}/cli", "--as-of-year", "2024",
                 "--no-fail"]) == 0
    assert main(["report", "--root", f"{tmp_dir}/cli"]) == 0
    out = capsys.readouterr().out
    assert "dim_titles" in out and "not_null_dim_titles_is_adult" in out


def test_bucketed_raw_layer_removes_the_title_shuffles(spark, tmp_dir):
    from reelmart.plans.pipeline import build
    from reelmart.sources.ingest import load_raw, read_raw

    landing, raw = _landing(spark, tmp_dir)
    load_raw(spark, landing, f"{tmp_dir}/braw", buckets=4)
    bucketed = build(read_raw(spark, f"{tmp_dir}/braw"), as_of_year=2024, hot_share=None)
    plain = build(raw, as_of_year=2024)
    for name in ("bridge_cast_crew", "fact_ratings", "dim_titles"):
        a = sorted((tuple(r) for r in bucketed[name].collect()), key=repr)
        b = sorted((tuple(r) for r in plain[name].select(*bucketed[name].columns).collect()), key=repr)
        assert a == b, name
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        def exchanges(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        fresh = build(read_raw(spark, f"{tmp_dir}/braw"), as_of_year=2024, hot_share=None)
        # title joins read matching buckets; the people side is bucketed too, so only the
        # credits are shuffled, once, by person (4 exchanges without bucketing)
        assert exchanges(fresh["bridge_cast_crew"]) == 1
        assert exchanges(fresh.staging["stg_title_principals"]) == 1
        assert exchanges(fresh.staging["stg_title_akas"]) == 0
        assert exchanges(fresh["fact_ratings"]) == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_the_caller_says_which_tables_are_bucketed(spark, tmp_dir):
    from reelmart.plans.pipeline import build
    from reelmart.sources.ingest import load_raw, read_raw
    from reelmart.sources.store import published

    landing, raw = _landing(spark, tmp_dir)
    load_raw(spark, landing, f"{tmp_dir}/some", buckets={"title_basics": 4, "name_basics": 4})
    found = published(spark, f"{tmp_dir}/some")
    assert {t for t, p in found.items() if p.catalog_table} == {"title_basics", "name_basics"}
    wh = build(read_raw(spark, f"{tmp_dir}/some"), as_of_year=2024)
    plain = build(raw, as_of_year=2024)
    a = sorted((tuple(r) for r in wh["bridge_cast_crew"].collect()), key=repr)
    assert a == sorted((tuple(r) for r in plain["bridge_cast_crew"].collect()), key=repr)


def test_a_failed_check_leaves_the_old_marts(spark, tmp_dir):
    """Only what passes the gate is published; readers keep the last good marts."""
    from reelmart.plans.pipeline import read_marts

    landing, _ = _landing(spark, tmp_dir)
    root = f"{tmp_dir}/gate"
    with pytest.raises(QualityGateError):
        run(spark, landing, root, as_of_year=2024)
    assert read_marts(spark, f"{root}/marts") == {}
    run(spark, landing, root, as_of_year=2024, fail_on_error=False)
    good = read_marts(spark, f"{root}/marts")
    n = {k: v.count() for k, v in good.items()}
    with pytest.raises(QualityGateError):
        run(spark, landing, root, as_of_year=2030)
    assert {k: v.count() for k, v in good.items()} == n  # still readable
    assert {k: v.inputFiles() for k, v in read_marts(spark, f"{root}/marts").items()} == {k: v.inputFiles() for k, v in good.items()}


def test_run_bucketed_matches_run_plain(spark, tmp_dir):
    landing, _ = _landing(spark, tmp_dir)
    plain = run(spark, landing, f"{tmp_dir}/plain", as_of_year=2024, fail_on_error=False)
    plain_counts = sorted(tuple(r) for r in plain.counts.collect())
    plain_report = sorted((r.check_id, r.failures) for r in plain.report.collect())
    bucketed = run(spark, landing, f"{tmp_dir}/bucketed", as_of_year=2024, fail_on_error=False, buckets=4)
    assert sorted(tuple(r) for r in bucketed.counts.collect()) == plain_counts
    assert sorted((r.check_id, r.failures) for r in bucketed.report.collect()) == plain_report
    for name in ("fact_ratings", "bridge_cast_crew"):
        a = sorted((tuple(r) for r in bucketed.marts[name].collect()), key=repr)
        b = sorted((tuple(r) for r in plain.marts[name].select(*bucketed.marts[name].columns).collect()), key=repr)
        assert a == b, name
