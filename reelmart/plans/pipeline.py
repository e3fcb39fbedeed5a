"""End-to-end build: raw sources -> staging -> marts, lazily or stored.

``build`` composes the transformations as DataFrames in dependency order
(sources -> staging -> dims -> fact and bridge); nothing runs until an
action. ``stage_marts`` writes the marts as Parquet parts and returns DataFrames that read
them back, so each downstream query starts from a short lineage (and survives lost
executors without recomputing the joins); ``publish_marts`` makes them the marts of a root
(``sources.store``). ``run`` publishes only what passed the quality gate.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.operators import marts as M
from reelmart.operators import staging as S
from reelmart.operators.joins import HOT_SHARE, find_hot_keys
from reelmart.operators.measure import ROWS, Measure, StoredTables
from reelmart.operators.ranges import RangeBounds, find_bounds
from reelmart.session import scratch_path
from reelmart.sources.store import Staged, database_of, new_part, publish, publish_set, published, read_published
from reelmart.sources.synthetic import raw_sources

MART_NAMES = ["dim_titles", "dim_people", "fact_ratings", "bridge_cast_crew"]

# Sort key per mart on write: clusters rows so Parquet min/max statistics
# prune key lookups and later joins read co-located keys.
MART_SORT_KEYS = {
    "dim_titles": ["title_id"],
    "dim_people": ["person_id"],
    "fact_ratings": ["title_id"],
    "bridge_cast_crew": ["title_id", "person_id"],
}


class LazyTables(dict):
    """Name -> DataFrame, where a value may be a zero-argument builder run on first access.

    Relations that may be salted look for hot keys first (one sketch pass), so they are
    built when someone asks for them; all other tables are plain lazy DataFrames.
    """

    def __getitem__(self, name: str) -> DataFrame:
        value = super().__getitem__(name)
        if callable(value) and not isinstance(value, DataFrame):
            value = value()
            super().__setitem__(name, value)
        return value

    def items(self):
        return [(k, self[k]) for k in self.keys()]

    def values(self):
        return [self[k] for k in self.keys()]


@dataclass
class Warehouse:
    raw: dict[str, DataFrame]
    staging: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    as_of_year: int | None = None
    #: () -> hot titles and people of the credits; one sketch pass on first call, shared by staging and bridge
    hot_credits: object = field(default=lambda: None)

    def relations(self) -> dict[str, DataFrame]:
        """Every relation by name: ``raw_<table>``, staging views and marts."""
        out = LazyTables({f"raw_{name}": df for name, df in self.raw.items()})
        out.update(dict.items(self.staging))  # keep deferred builders deferred
        out.update(dict.items(self.marts))
        return out

    def __getitem__(self, name: str) -> DataFrame:
        for layer in (self.marts, self.staging, self.raw):
            if name in layer:
                return layer[name]
        raise KeyError(name)

    def create_views(self, names: list[str] | None = None) -> None:
        """Temporary views of staging and marts under their names, for SQL text."""
        for name in names or [*self.staging, *self.marts]:
            self[name].createOrReplaceTempView(name)


# The large, row-heavy sources: every credit and every alternative title.
LARGE_SOURCES = ("title_principals", "title_akas")


def build(raw: dict[str, DataFrame], as_of_year: int | None = None, hot_share: float | None = HOT_SHARE,
          fuse_bridge: bool = True, spread_partitions: int | None = None) -> Warehouse:
    """Lazy warehouse over the given raw tables.

    With ``fuse_bridge`` the bridge joins the raw credits straight to the
    dimensions (two shuffles instead of four; see ``bridge_cast_crew_from_raw``).
    Keys with more than ``hot_share`` of the credits or alternative titles are salted in
    staging and bridge (None: never). ``spread_partitions`` deals the two large sources
    over that many tasks first, for inputs stored in fewer files than there are cores.
    """
    if spread_partitions:
        raw = {name: df.repartition(spread_partitions) if name in LARGE_SOURCES else df for name, df in raw.items()}

    @cache
    def hot_credits() -> S.HotKeys:
        return find_hot_keys(S.credit_columns(raw["title_principals"]), ["title_id", "person_id"], hot_share) if hot_share else {}

    @cache
    def hot_akas() -> S.HotKeys:
        return find_hot_keys(S.aka_columns(raw["title_akas"]).select("title_id"), ["title_id"], hot_share) if hot_share else {}

    stg = LazyTables({
        "stg_title_basics": S.stg_title_basics(raw["title_basics"]),
        "stg_title_ratings": S.stg_title_ratings(raw["title_ratings"]),
        "stg_name_basics": S.stg_name_basics(raw["name_basics"]),
        "stg_title_principals": lambda: S.stg_title_principals(raw["title_principals"], raw["title_basics"], raw["name_basics"], hot_credits()),
        "stg_title_akas": lambda: S.stg_title_akas(raw["title_akas"], raw["title_basics"], hot_akas()),
    })
    titles = M.dim_titles(stg["stg_title_basics"], as_of_year)
    people = M.dim_people(stg["stg_name_basics"], as_of_year)
    fact = M.fact_ratings(stg["stg_title_ratings"], titles, as_of_year)
    if fuse_bridge:
        def bridge() -> DataFrame:
            return M.bridge_cast_crew_from_raw(raw["title_principals"], titles, people, hot_credits())
    else:
        def bridge() -> DataFrame:
            return M.bridge_cast_crew(stg["stg_title_principals"], titles, people, hot_credits())
    return Warehouse(raw=raw, staging=stg,
                     marts=LazyTables({"dim_titles": titles, "dim_people": people, "fact_ratings": fact,
                                       "bridge_cast_crew": bridge}),
                     as_of_year=as_of_year, hot_credits=hot_credits)


def build_from_driver_tables(spark: SparkSession, sf_dir: str, as_of_year: int | None = None,
                             hot_share: float | None = HOT_SHARE, spread_partitions: int | None = None) -> Warehouse:
    return build(raw_sources(spark, sf_dir), as_of_year=as_of_year, hot_share=hot_share, spread_partitions=spread_partitions)


# Directory partitioning per mart: most title-level questions filter on
# content_category (mostly 'Movie'), so dim_titles and fact_ratings are split by
# it and those scans read one directory (PartitionFilters in the plan).
MART_PARTITIONS = {
    "dim_titles": ["content_category"],
    "fact_ratings": ["content_category"],
}


def write_mart(df: DataFrame, path: str, sort_keys: list[str], partition_by: list[str] | None = None,
               bounds: RangeBounds | None = None, measure: Measure | None = None, dealt: bool = False) -> None:
    """Write ``df`` as Parquet: dealt by ranges of the first sort key (``dealt``: it is already), sorted within each file.

    The range gives each file a narrow span of keys; sorting by the folder column first
    leaves the writer nothing to sort anew. At most one file per range and folder. The
    ranges come from ``bounds`` (default: found in ``df``'s own key column), so the plan of
    ``df`` runs once, in the write, where ``measure`` also takes its numbers.
    """
    folders = partition_by or []
    if not dealt:
        df = (bounds or find_bounds(df.select(*sort_keys))).deal(df, sort_keys[0])
    laid = df.sortWithinPartitions(*folders, *sort_keys)
    writer = (measure.on(laid) if measure else laid).write.mode("overwrite")
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def write_bucketed_mart(df: DataFrame, path: str, table: str, buckets: int, sort_keys: list[str],
                        partition_by: list[str] | None = None, measure: Measure | None = None) -> None:
    """Store ``df`` at ``path`` as an external catalog table bucketed and sorted by its join key.

    Marts bucketed on the same key with the same bucket count join without a
    shuffle on either side (the plan shows ``Bucketed: true`` scans feeding a
    sort-merge join with no Exchange), which removes the per-query shuffle of
    ``fact_ratings`` and ``dim_titles`` from every title-level question. One task writes a
    bucket, so there are at most buckets x folders files.
    """
    folders = partition_by or []
    laid = df.repartition(buckets, sort_keys[0]).sortWithinPartitions(*folders, *sort_keys)
    writer = (measure.on(laid) if measure else laid).write.mode("overwrite").format("parquet")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.bucketBy(buckets, sort_keys[0]).sortBy(*sort_keys).option("path", path).saveAsTable(table)


@dataclass(frozen=True)
class StagedMart:
    name: str
    part: str
    frame: DataFrame
    catalog_table: str | None = None
    measured: dict[str, int] = field(default_factory=dict)

    def staged(self) -> Staged:
        return Staged(self.name, (self.part,), self.measured[ROWS], self.catalog_table, json.dumps(self.measured))


def key_columns(wh: Warehouse, name: str) -> DataFrame:
    """The sort-key columns of a mart from the narrowest source that has them; enough to find its ranges."""
    if name == "dim_titles":
        return wh.staging["stg_title_basics"].select("title_id")
    if name == "dim_people":
        return wh.staging["stg_name_basics"].select("person_id")
    if name == "fact_ratings":
        return wh.staging["stg_title_ratings"].select("title_id")
    return S.credit_columns(wh.raw["title_principals"]).select("title_id", "person_id", "ordering")


def stage_marts(spark: SparkSession, wh: Warehouse, root: str, names: list[str] | None = None, buckets: int | None = None,
                database: str | None = None, parallel: int = 2) -> dict[str, StagedMart]:
    """Write the named marts (default: all) as new parts under ``root`` and read them back; nothing is published.

    Dimensions are written first, and a fact or bridge written with them is built from the
    stored ones, so each mart is computed once. With ``buckets`` the marts
    become external tables in ``database`` (default: one named after the root): titles, ratings and credits bucketed
    by ``title_id`` and people by ``person_id``, all with the same bucket count,
    so joins on those keys need no shuffle. ``parallel`` independent marts are
    written at once (the counterpart of running independent models on threads). Row
    counts and row-level checks are measured in the writes.
    """
    names = names or MART_NAMES
    database = database or database_of(root)
    if buckets:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    # what the layout needs to know comes from narrow key columns and waits for nothing
    ahead = ThreadPoolExecutor(max_workers=4)
    bounds = {} if buckets else {n: ahead.submit(find_bounds, key_columns(wh, n)) for n in names}
    if "bridge_cast_crew" in names:
        ahead.submit(wh.hot_credits)

    def store(name: str, make: Callable[[M.Deal], DataFrame]) -> StagedMart:
        """``make``: the mart, whose rows it passes through the given layout before it adds the columns that follow from them."""
        part, measure = new_part(root, name), Measure(name, wh.as_of_year)
        if buckets:
            table, df = f"{database}.{name}_{part.rsplit('/', 1)[-1]}", make(lambda rows: rows)
            write_bucketed_mart(df, part, table, buckets, MART_SORT_KEYS[name], MART_PARTITIONS.get(name), measure)
            return StagedMart(name, part, spark.table(table).select(*df.columns), table, measure.result)
        order = [*MART_PARTITIONS.get(name, []), *MART_SORT_KEYS[name]]

        def deal(rows: DataFrame) -> DataFrame:
            rows = bounds[name].result().deal(rows, MART_SORT_KEYS[name][0])
            return rows.sortWithinPartitions(*order) if set(order) <= set(rows.columns) else rows  # else sorted in the write

        df = make(deal)
        write_mart(df, part, MART_SORT_KEYS[name], MART_PARTITIONS.get(name), measure=measure, dealt=True)
        return StagedMart(name, part, spark.read.parquet(part).select(*df.columns), None, measure.result)

    out: dict[str, StagedMart] = {}
    # Two waves of independent writes, each submitted from driver threads so the
    # jobs run side by side on the cluster: the dimensions, then fact and bridge
    # (which read the stored dimensions).
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        make = {"dim_titles": lambda deal: M.dim_titles(deal(wh.staging["stg_title_basics"]), wh.as_of_year),
                "dim_people": lambda deal: M.dim_people(deal(wh.staging["stg_name_basics"]), wh.as_of_year)}
        dims = {name: pool.submit(store, name, make[name]) for name in make if name in names}
        out.update({name: f.result() for name, f in dims.items()})
        titles, people = (out[n].frame if n in out else wh.marts[n] for n in ("dim_titles", "dim_people"))
        later = {}
        if "fact_ratings" in names:
            later["fact_ratings"] = pool.submit(
                store, "fact_ratings", lambda deal: M.fact_ratings(wh.staging["stg_title_ratings"], titles, wh.as_of_year, deal))
        if "bridge_cast_crew" in names:
            later["bridge_cast_crew"] = pool.submit(
                store, "bridge_cast_crew", lambda deal: M.bridge_cast_crew_from_raw(wh.raw["title_principals"], titles, people, wh.hot_credits(), deal))
        out.update({name: f.result() for name, f in later.items()})
    ahead.shutdown()
    return {n: out[n] for n in names}


def publish_marts(spark: SparkSession, root: str, staged: dict[str, StagedMart], states: list[Staged] | None = None) -> None:
    """Make the staged parts (and the partial aggregates taken from them) the marts of ``root``, all at once."""
    publish_set(spark, root, "marts", [*[m.staged() for m in staged.values()], *(states or [])])


def read_marts(spark: SparkSession, root: str) -> StoredTables:
    """The published marts of ``root``."""
    found = published(spark, root)
    return StoredTables({n: read_published(spark, found[n]) for n in MART_NAMES if n in found}, {n: found[n].measured for n in MART_NAMES if n in found})


def materialize(spark: SparkSession, wh: Warehouse, root: str | None = None, names: list[str] | None = None,
                buckets: int | None = None, database: str | None = None, parallel: int = 2) -> StoredTables:
    """Stage and publish marts under ``root`` (default: a fresh folder in the checkpoint dir) and read them back."""
    root = (root or scratch_path(spark, "marts")).rstrip("/")
    staged = stage_marts(spark, wh, root, names, buckets, database, parallel)
    publish_marts(spark, root, staged)
    return StoredTables({n: m.frame for n, m in staged.items()}, {n: m.measured for n, m in staged.items()})


def materialize_staging(spark: SparkSession, wh: Warehouse, root: str, names: list[str],
                        parallel: int = 2) -> StoredTables:
    """Write the named staging views as Parquet under ``root`` (``parallel`` at a time) and read them back."""
    def store(name: str) -> tuple[DataFrame, dict[str, int]]:
        path, measure = new_part(root, name), Measure(name, wh.as_of_year)
        measure.on(wh.staging[name]).write.parquet(path)
        return spark.read.parquet(path), measure.result

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(store, name) for name in names}
        stored = {name: f.result() for name, f in futures.items()}
    return StoredTables({n: df for n, (df, _) in stored.items()}, {n: m for n, (_, m) in stored.items()})


def export_csv(df: DataFrame, path: str) -> None:
    """``\\copy (query) TO file CSV HEADER``: standard CSV with a header line; quotes are doubled, spaces kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def export_results(results: dict[str, DataFrame], out_dir: str, parallel: int = 4) -> list[str]:
    """Write each (small) query result as CSV with a header under ``out_dir/<name>``; returns the paths."""
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in results}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(export_csv, df, paths[name]) for name, df in results.items()]:
            f.result()
    return list(paths.values())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table: one count job per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    """Error-severity data-quality checks returned rows."""


@dataclass
class RunResult:
    load: list | None
    marts: dict[str, DataFrame]
    report: DataFrame
    counts: DataFrame
    exported: list[str] | None = None


def run(spark: SparkSession, landing_dir: str, root: str, as_of_year: int | None = None, fail_on_error: bool = True,
        buckets: int | None = None, export_dir: str | None = None, raw_buckets: int | dict[str, int] | None = None,
        spread_partitions: int | None = None) -> RunResult:
    """Load (only if a raw table is empty), build, check and then publish the warehouse under ``root``.

    ``root`` should be on shared storage (a cluster's ``spark.checkpoint.dir``
    or a warehouse bucket); ``root/raw``, ``root/staging``, ``root/marts`` and
    ``root/quality_report`` are written. Unlike the reference's runner, failing
    error-severity checks stop the run (``fail_on_error``) before anything is published:
    readers keep the marts of the last good run. ``buckets`` stores the marts co-bucketed
    on their join keys, ``raw_buckets`` (default: ``buckets``) the raw layer (see
    ``load_raw`` and ``stage_marts``); ``export_dir`` also writes the twelve question
    results as CSV.
    """
    from reelmart.operators.quality import DECLARED_CHECKS, failed_checks, quality_report
    from reelmart.plans.states import ANSWERS, answer, read_states, stage_states
    from reelmart.sources.ingest import load_if_empty, raw_measured, read_raw, require_all_loaded

    root = root.rstrip("/")
    load = load_if_empty(spark, landing_dir, f"{root}/raw", buckets=buckets if raw_buckets is None else raw_buckets)
    if load is not None:
        require_all_loaded(load)
    wh = build(read_raw(spark, f"{root}/raw"), as_of_year=as_of_year, spread_partitions=spread_partitions)
    # Staging is a view, but the checks read the two big staging relations
    # several times (null pass, relationship anti-joins): store them once.
    # Marts and staging storage are independent, so both are submitted at once from driver threads.
    with ThreadPoolExecutor(max_workers=2) as pool:
        marts_job = pool.submit(stage_marts, spark, wh, f"{root}/marts", None, buckets)
        staging_job = pool.submit(materialize_staging, spark, wh, f"{root}/staging", ["stg_title_principals", "stg_title_akas"])
        staged_marts, staged = marts_job.result(), staging_job.result()
    marts = {n: m.frame for n, m in staged_marts.items()}
    relations = wh.relations()
    relations.update(staged)
    relations.update(marts)
    measured = {**staged.measured, **{n: m.measured for n, m in staged_marts.items()}, **raw_measured(spark, f"{root}/raw")}
    report_path = new_part(root, "quality_report")
    quality_report(relations, as_of_year=as_of_year, measured=measured).write.parquet(report_path)
    report = spark.read.parquet(report_path)
    publish(spark, root, "quality_report", [report_path], len(DECLARED_CHECKS))
    if fail_on_error and not failed_checks(report).isEmpty():
        names = [r.check_id for r in failed_checks(report).select("check_id").collect()]  # one row a declared check
        raise QualityGateError(f"error-severity checks failed: {', '.join(names)}")
    publish_marts(spark, f"{root}/marts", staged_marts, stage_states(marts["dim_titles"], marts["fact_ratings"], f"{root}/marts"))
    # counted while they were written
    counts = spark.createDataFrame([(k, staged_marts[k].measured[ROWS]) for k in ("dim_titles", "dim_people", "fact_ratings")], "table_name string, row_count long")
    exported = None
    if export_dir:
        from reelmart.plans.analytics import all_queries

        results, states = all_queries(marts["dim_titles"], marts["dim_people"], marts["fact_ratings"]), read_states(spark, f"{root}/marts")
        results |= {q: answer(states, q) for q in results if q in ANSWERS}
        exported = export_results(results, export_dir)
    return RunResult(load=load, marts=marts, report=report, counts=counts, exported=exported)


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """The newest quality report under ``root``."""
    return read_published(spark, published(spark, root)["quality_report"])
