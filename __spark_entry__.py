"""

Every registered query builds the warehouse from the driver's parquet tables
in ``sf_dir`` (raw sources -> staging -> marts, all lazy) and runs one
operator or question over the whole tables. The clock year used by the
age/recency rules is pinned to ``AS_OF_YEAR`` on both sides. Double columns
that are not rounded by the query itself are rounded to 6 decimals on both
sides, because the two engines may differ in the last bit of a float.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reelmart.operators import quality as Q  # noqa: E402
from reelmart.plans import analytics as A  # noqa: E402
from reelmart.plans import charts as C  # noqa: E402
from reelmart.plans import states as ST  # noqa: E402
from reelmart.plans.pipeline import build, build_from_driver_tables, export_csv, materialize, materialize_staging, read_marts  # noqa: E402
from reelmart.session import scratch_path  # noqa: E402
from reelmart import constants as K  # noqa: E402
from reelmart.sources import ingest as I  # noqa: E402
from reelmart.sources.catalog import file_for  # noqa: E402
from reelmart.sources.synthetic import raw_sources  # noqa: E402
from reelmart.sources.tsv import read_copy_text, write_copy_text  # noqa: E402
from reelmart.streaming.landing import append_new_landing_files  # noqa: E402

try:  # the training-data operators are optional: without their folder everything else still works
    import corpus_pipeline  # noqa: E402
    from reelmart.llm import queries as LLM  # noqa: E402
except ModuleNotFoundError as err:
    if err.name not in ("reelmart.llm", "corpus_pipeline"):
        raise
    LLM = None

AS_OF_YEAR = 2024
FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


def _wh(spark: SparkSession, sf_dir: str):
    return build_from_driver_tables(spark, sf_dir, as_of_year=AS_OF_YEAR)


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _staging(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _wh(spark, sf_dir).staging[name]


def _mart(name: str, *float_cols: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _r6(_wh(spark, sf_dir).marts[name], *float_cols)


def _tf(fn, *float_cols: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    """Query over (titles, fact)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        return _r6(fn(wh["dim_titles"], wh["fact_ratings"], **kw), *float_cols)
    return run


def _ft(fn, *float_cols: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    """Query over (fact, titles)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        return _r6(fn(wh["fact_ratings"], wh["dim_titles"], **kw), *float_cols)
    return run


def _fact(fn) -> Callable[[SparkSession, str], DataFrame]:
    """Query over the ratings fact."""
    return lambda spark, sf_dir: fn(_wh(spark, sf_dir)["fact_ratings"])


def _p(fn, *float_cols: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    """Query over people."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _r6(fn(_wh(spark, sf_dir)["dim_people"], **kw), *float_cols)
    return run


def _t(fn, **kw) -> Callable[[SparkSession, str], DataFrame]:
    """Query over titles."""
    return lambda spark, sf_dir: fn(_wh(spark, sf_dir)["dim_titles"], **kw)


def _tpf(fn) -> Callable[[SparkSession, str], DataFrame]:
    """Query over (titles, people, fact)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        return fn(wh["dim_titles"], wh["dim_people"], wh["fact_ratings"])
    return run


def _check(check_id: str) -> Callable[[SparkSession, str], DataFrame]:
    """Violating rows of one declared check."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Q.run_check(Q.check_by_id(check_id), _wh(spark, sf_dir).relations(), as_of_year=AS_OF_YEAR)
    return run


def _quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quality_report(_wh(spark, sf_dir).relations(), as_of_year=AS_OF_YEAR)


def _load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.load_audit(raw_sources(spark, sf_dir))


def _raw_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.raw_key_violations(raw_sources(spark, sf_dir))


def _tsv_round_trip(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """Write a raw table as a COPY-text landing file, then read it back with the loader."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"landing-{table}")
        write_copy_text(raw_sources(spark, sf_dir)[table], path, table)
        return read_copy_text(spark, path, table)
    return run


def _parity(key: str, n: int, of: int):
    return F.regexp_extract(F.col(key), "[0-9]+", 0).cast("int") % n == of


def _stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the ratings as COPY-text files, append them with the exactly-once stream, read the published table."""
    root = scratch_path(spark, "stream")
    write_copy_text(raw_sources(spark, sf_dir)["title_ratings"], f"{root}/landing", "title_ratings")
    append_new_landing_files(spark, f"{root}/landing", "title_ratings", f"{root}/raw", f"{root}/checkpoint", file_glob="part-*")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _append_over_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the ratings by a full load, a third by the stream, a third by a batch append; all rows must be back."""
    root, ratings = scratch_path(spark, "append"), raw_sources(spark, sf_dir)["title_ratings"]
    thirds = [ratings.filter(_parity("tconst", 3, k)) for k in range(3)]
    for k in (0, 2):
        write_copy_text(thirds[k], f"{root}/landing{k}/title.ratings.tsv", "title_ratings")
    write_copy_text(thirds[1], f"{root}/stream", "title_ratings")
    I.load_raw(spark, f"{root}/landing0", f"{root}/raw")
    append_new_landing_files(spark, f"{root}/stream", "title_ratings", f"{root}/raw", f"{root}/checkpoint", file_glob="part-*")
    I.load_raw(spark, f"{root}/landing2", f"{root}/raw", mode="append")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _foreign_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose first line differs from the declared names, with a data row that equals them."""
    path, ratings = scratch_path(spark, "header"), raw_sources(spark, sf_dir)["title_ratings"]
    row = spark.range(1).select(*[F.lit(c).alias(c) for c in ratings.columns])
    write_copy_text(ratings.unionByName(row).toDF("Id", "Stars", "Ballots"), path)
    return read_copy_text(spark, path, "title_ratings")


def _broken(df: DataFrame, path: str) -> None:
    """A landing file with all rows of ``df`` and one short row."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("\\N")) for c in df.columns])
    df.select(line.alias("value")).unionByName(df.sparkSession.range(1).select(F.lit("short").alias("value"))).coalesce(1).write.text(path)


def _refresh_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh with a bad row must leave the table as it was loaded before."""
    root, ratings = scratch_path(spark, "refresh"), raw_sources(spark, sf_dir)["title_ratings"]
    write_copy_text(ratings, f"{root}/good/title.ratings.tsv", "title_ratings")
    I.load_raw(spark, f"{root}/good", f"{root}/raw")
    _broken(ratings, f"{root}/bad/title.ratings.tsv")
    I.load_raw(spark, f"{root}/bad", f"{root}/raw")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _load_if_empty_recovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load whose titles failed is made up by the next guarded load."""
    root, raw = scratch_path(spark, "recover"), raw_sources(spark, sf_dir)
    write_copy_text(raw["title_ratings"], f"{root}/bad/title.ratings.tsv", "title_ratings")
    _broken(raw["title_basics"], f"{root}/bad/title.basics.tsv")
    I.load_if_empty(spark, f"{root}/bad", f"{root}/raw")
    for table in ("title_ratings", "title_basics"):
        write_copy_text(raw[table], f"{root}/good/{file_for(table)}", table)
    I.load_if_empty(spark, f"{root}/good", f"{root}/raw")
    return I.read_raw(spark, f"{root}/raw")["title_basics"]


def _append_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends over a loaded half: one with a key of the older part, which must be refused whole, and a clean one."""
    root, ratings = scratch_path(spark, "collision"), raw_sources(spark, sf_dir)["title_ratings"]
    old, new = ratings.filter(_parity("tconst", 2, 0)), ratings.filter(_parity("tconst", 2, 1))
    twice = new.unionByName(old.orderBy("tconst").limit(1).withColumn("numvotes", F.lit("1")))
    for name, rows in (("old", old), ("twice", twice), ("new", new)):
        write_copy_text(rows, f"{root}/{name}/title.ratings.tsv", "title_ratings")
    I.load_raw(spark, f"{root}/old", f"{root}/raw")
    I.load_raw(spark, f"{root}/twice", f"{root}/raw", mode="append")
    I.load_raw(spark, f"{root}/new", f"{root}/raw", mode="append")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _blank_line_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh from a file with a line of white space only must leave the table as it was loaded before."""
    root, ratings = scratch_path(spark, "blank"), raw_sources(spark, sf_dir)["title_ratings"]
    write_copy_text(ratings, f"{root}/good/title.ratings.tsv", "title_ratings")
    I.load_raw(spark, f"{root}/good", f"{root}/raw")
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("\\N")) for c in ratings.columns])
    blank = spark.range(1).select(F.lit(" \t ").alias("value"))
    ratings.filter(_parity("tconst", 2, 0)).select(line.alias("value")).unionByName(blank).coalesce(1).write.text(f"{root}/bad/title.ratings.tsv")
    I.load_raw(spark, f"{root}/bad", f"{root}/raw")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _header_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landing file's data holds a line equal to its header, and the loader keeps it."""
    root, ratings = scratch_path(spark, "twins"), raw_sources(spark, sf_dir)["title_ratings"]
    row = spark.range(1).select(*[F.lit(c).alias(c) for c in ratings.columns])
    write_copy_text(ratings.unionByName(row), f"{root}/landing/title.ratings.tsv", "title_ratings")
    I.load_raw(spark, f"{root}/landing", f"{root}/raw")
    return I.read_raw(spark, f"{root}/raw")["title_ratings"]


def _load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load says of each file: two good ones, a bad one and two that are missing."""
    root, raw = scratch_path(spark, "summary"), raw_sources(spark, sf_dir)
    for table in ("title_ratings", "name_basics"):
        write_copy_text(raw[table], f"{root}/landing/{file_for(table)}", table)
    _broken(raw["title_basics"], f"{root}/landing/title.basics.tsv")
    done = I.load_raw(spark, f"{root}/landing", f"{root}/raw")
    return spark.createDataFrame([(r.file_name, r.table, r.loaded, r.rows) for r in done], "file_name string, table_name string, loaded boolean, row_count long")


def _raw_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all raw tables under a root after a load and a reset, and of another root that was only loaded."""
    root, raw = scratch_path(spark, "reset"), raw_sources(spark, sf_dir)
    write_copy_text(raw["title_ratings"], f"{root}/landing/title.ratings.tsv", "title_ratings")
    for side in ("reset", "kept"):
        I.load_raw(spark, f"{root}/landing", f"{root}/{side}")
    I.reset_raw(spark, f"{root}/reset")
    audits = [I.audit_raw(spark, f"{root}/{side}").withColumn("root", F.lit(side)) for side in ("reset", "kept")]
    return audits[0].unionByName(audits[1])


def _report_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report over stored marts and big staging views, from what their writes measured."""
    wh, root = _wh(spark, sf_dir), scratch_path(spark, "measured")
    marts = materialize(spark, wh, f"{root}/marts")
    staged = materialize_staging(spark, wh, f"{root}/staging", ["stg_title_principals", "stg_title_akas"])
    relations = wh.relations()
    relations.update(staged)
    relations.update(marts)
    return Q.quality_report(relations, as_of_year=AS_OF_YEAR, measured={**marts.measured, **staged.measured})


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with padding, quotes and commas, exported as CSV and read back."""
    path, titles = scratch_path(spark, "csv"), _wh(spark, sf_dir)["dim_titles"]
    odd = F.concat(F.lit("  "), "primary_title", F.lit(' says "hi", or so  ')).alias("primary_title")
    export_csv(titles.filter(F.col("primary_title").isNotNull()).select("title_id", odd), path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


def _marts_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts stored and published; the ratings fact as a reader finds it."""
    root = scratch_path(spark, "marts")
    materialize(spark, _wh(spark, sf_dir), root)
    return _r6(read_marts(spark, root)["fact_ratings"], "popularity_score", "annual_vote_rate")


def _from_states(question: str, *float_cols: str) -> Callable[[SparkSession, str], DataFrame]:
    """A question answered from stored partial aggregates: those of the even titles, with those of the odd ones appended."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh, root = _wh(spark, sf_dir), scratch_path(spark, "states")
        for k in range(2):
            part = [wh[name].filter(_parity("title_id", 2, k)) for name in ("dim_titles", "fact_ratings")]
            ST.append_states(spark, root, ST.stage_states(*part, root))
        return _r6(ST.answer(ST.read_states(spark, root), question), *float_cols)
    return run


def _bridge_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge with a third of all credits on one title: the salted path."""
    raw = dict(raw_sources(spark, sf_dir))
    hot = F.when(_parity("tconst", 3, 0), F.lit("tt0000003")).otherwise(F.col("tconst"))
    raw["title_principals"] = raw["title_principals"].withColumn("tconst", hot)
    return build(raw, as_of_year=AS_OF_YEAR)["bridge_cast_crew"]


def _sql_top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 typed as SQL over the named views."""
    _wh(spark, sf_dir).create_views(["dim_titles", "fact_ratings"])
    return spark.sql("""
        select t.decade, t.primary_title, r.average_rating, r.num_votes, r.success_category, t.runtime_category
        from fact_ratings r join dim_titles t using (title_id)
        where r.is_statistically_significant and t.content_category = 'Movie' and t.decade is not null and r.average_rating >= 8.0
        order by t.decade desc, r.average_rating desc, title_id limit 20""")


def _unique_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _wh(spark, sf_dir)["stg_title_basics"]
    return Q.check_unique(titles.unionByName(titles.filter(_parity("title_id", 97, 0))), "title_id")


def _accepted_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = Q.check_by_id("accepted_values_dim_titles_title_type")
    titles = _wh(spark, sf_dir)["dim_titles"]
    bad = F.when(_parity("title_id", 89, 0), F.upper("title_type")).otherwise(F.col("title_type"))
    return Q.run_check(check, {"dim_titles": titles.withColumn("title_type", bad)})


def _consistency_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _r6(_wh(spark, sf_dir)["fact_ratings"], "popularity_score")
    planted = (F.col("rating_category") == K.RATING_OUTSTANDING) & _parity("title_id", 2, 0)
    bad = F.when(planted, F.lit(K.CRITICAL_FAILURE)).otherwise(F.col("success_category"))
    return Q.run_check(Q.check_by_id("rating_consistency"), {"fact_ratings": fact.withColumn("success_category", bad)})


def _keys_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dict(raw_sources(spark, sf_dir))
    r = raw["title_ratings"]
    no_key = r.filter(_parity("tconst", 101, 0)).withColumn("tconst", F.lit(None).cast("string"))
    raw["title_ratings"] = r.unionByName(r.filter(_parity("tconst", 97, 0))).unionByName(no_key)
    return I.raw_key_violations(raw)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: movie production trend by decade (Q2) on sf0.001."""
    return queries()["production_trends"](spark, FLAGSHIP_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = {**LLM.queries(), "pipeline": corpus_pipeline.run} if LLM else {}
    return extra | {
        # staging
        "stg_title_basics": _staging("stg_title_basics"),
        "stg_title_ratings": _staging("stg_title_ratings"),
        "stg_name_basics": _staging("stg_name_basics"),
        "stg_title_principals": _staging("stg_title_principals"),
        "stg_title_akas": _staging("stg_title_akas"),
        # marts
        "dim_titles": _mart("dim_titles"),
        "dim_people": _mart("dim_people"),
        "fact_ratings": _mart("fact_ratings", "popularity_score", "annual_vote_rate"),
        "bridge_cast_crew": _mart("bridge_cast_crew"),
        # sample questions
        "top_rated_movies": _ft(A.top_rated_movies),
        "production_trends": _tf(A.production_trends, "avg_rating", "avg_runtime"),
        "genre_popularity": _tf(A.genre_popularity),
        "professions_by_generation": _p(A.professions_by_generation, "avg_age"),
        "professions_by_generation_all": _p(A.professions_by_generation, "avg_age", min_people=1),
        "professions_by_generation_min20": _p(A.professions_by_generation, "avg_age", min_people=20),
        "career_longevity": _p(A.career_longevity),
        "quality_quadrants": _fact(A.quality_quadrants),
        "runtime_evolution": _tf(A.runtime_evolution),
        "adult_vs_general": _fact(A.adult_vs_general),
        "long_running_series": _tf(A.long_running_series),
        "recent_vs_classic": _tf(A.recent_vs_classic),
        "data_completeness": _tpf(A.data_completeness),
        "executive_metrics": _tpf(A.executive_metrics),
        # dashboard datasets
        "chart_movies_by_decade": _tf(C.chart_movies_by_decade, "avg_rating"),
        "chart_genre_popularity": _tf(C.chart_genre_popularity),
        "chart_quality_points": _tf(C.chart_quality_points),
        "chart_runtime_groups": _t(C.chart_runtime_groups),
        "chart_people_roles": _p(C.chart_people_roles),
        "summary_stats": _tpf(C.summary_stats),
        "mart_row_counts": _tpf(C.mart_row_counts),
        # data-quality checks (one representative per generic kind, every singular check, the report)
        "check_unique": _check("unique_stg_title_basics_title_id"),
        "check_not_null": _check("not_null_dim_titles_is_adult"),
        "check_accepted_values": _check("accepted_values_dim_titles_title_type"),
        "check_relationships": _check("relationships_stg_title_ratings_title_id"),
        "check_expression": _check("expression_is_true_dim_titles_start_year"),
        "check_rating_range": _check("rating_range"),
        "check_movie_years": _check("movie_years"),
        "check_runtime": _check("runtime"),
        "check_birth_years": _check("birth_years"),
        "check_career_span": _check("career_span"),
        "check_rating_credibility": _check("rating_credibility"),
        "check_rating_consistency": _check("rating_consistency"),
        "check_unique_planted": _unique_planted,
        "check_accepted_values_planted": _accepted_planted,
        "check_rating_consistency_planted": _consistency_planted,
        "quality_report": _quality_report,
        "quality_report_measured": _report_measured,
        # ingestion
        "load_audit": _load_audit,
        "raw_key_violations": _raw_key_violations,
        "tsv_round_trip": _tsv_round_trip("name_basics"),
        "tsv_round_trip_credits": _tsv_round_trip("title_principals"),
        "stream_append_ratings": _stream_append,
        "tsv_foreign_header": _foreign_header,
        "load_refresh_after_failure": _refresh_after_failure,
        "append_over_loaded": _append_over_loaded,
        "load_if_empty_recovers": _load_if_empty_recovers,
        "append_key_collision": _append_collision,
        "landing_blank_line_refused": _blank_line_refused,
        "landing_header_twins": _header_twins,
        "load_summary": _load_summary,
        "raw_reset": _raw_reset,
        "raw_key_violations_planted": _keys_planted,
        # storage and access
        "marts_stored_round_trip": _marts_stored,
        "csv_export_round_trip": _csv_export,
        "states_production_trends": _from_states("production_trends", "avg_rating", "avg_runtime"),
        "states_genre_popularity": _from_states("genre_popularity"),
        "states_runtime_evolution": _from_states("runtime_evolution"),
        "states_recent_vs_classic": _from_states("recent_vs_classic"),
        "states_chart_movies_by_decade": _from_states("chart_movies_by_decade", "avg_rating"),
        "states_chart_genre_popularity": _from_states("chart_genre_popularity"),
        "states_chart_runtime_groups": _from_states("chart_runtime_groups"),
        "bridge_skewed": _bridge_skewed,
        "sql_top_rated_movies": _sql_top_rated,
    }


def oracle_sql() -> dict[str, str]:
    from oracle.checks import CHECKS, INGEST
    from oracle.queries import CHARTS, SAMPLE, STAGING_AND_MARTS

    out: dict[str, str] = {}
    for part in (STAGING_AND_MARTS, SAMPLE, CHARTS, CHECKS, INGEST):
        out.update(part)
    out.update({f"states_{question}": out[question] for question in ST.ANSWERS})  # the same answers
    if LLM:
        out.update(LLM.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
