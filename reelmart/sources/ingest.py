"""Loading landing files into the raw layer, with audit and key enforcement.

* ``load_raw``: each landing file that exists is read once and written as a staged
  Parquet part, rows being counted in the write; keys are checked on that part, and only
  then is it published (``sources.store``). Full refresh by default, ``mode="append"`` adds
  a part. A missing or bad file is reported, the other files still load, and what was
  published before a failure stays readable.
* Key index: the key check writes the part's distinct keys as ``KEY_BUCKETS`` folders by a
  hash of the key. An append looks its keys up in the buckets they fall into, in the
  indexes of the older parts; the parts themselves are not read.
* ``raw_key_violations``: NULL or duplicated primary keys of the raw tables
  that declare one; ``load_raw`` refuses to publish a table that has any.
* ``load_audit``: (table_name, row_count, has_data) per raw table; 0 for one that is
  missing or cannot be read.
* ``load_if_empty``: load only when a raw table is absent or empty.
* ``reset_raw``: publish the raw tables empty, with their declared schemas.
* ``load_append``: the incremental test load: all files must exist; rows are
  appended and counted (see also the exactly-once ``streaming.landing``).

Row counts are taken in the writes or are distributed aggregates; only small audit
results reach the driver.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelmart.constants import RAW_KEYS, SOURCE_FILES
from reelmart.operators.measure import ROWS, Measure
from reelmart.sources.catalog import raw_schema
from reelmart.sources.store import Published, database_of, new_part, publish, published, read_published
from reelmart.sources.tsv import BLANK_LINE, HEADER, header_rows, path_exists, read_copy_text, scan_landing

# Column each raw table is bucketed by when the raw layer is co-partitioned: the
# title key for everything about titles, the person key for people.
RAW_BUCKET_KEYS = {
    "title_basics": "tconst",
    "title_ratings": "tconst",
    "title_akas": "titleid",
    "title_principals": "tconst",
    "name_basics": "nconst",
}


#: Folders of a key index; an append of few keys reads few of them.
KEY_BUCKETS = 64
KEY_INDEX = "key_index"


class KeyViolationError(ValueError):
    """A raw table has NULL or duplicated primary-key values."""


class BlankLineError(ValueError):
    """A landing file has lines of white space only."""


class LoadFailedError(RuntimeError):
    """At least one landing file did not load."""


@dataclass
class LoadResult:
    file_name: str
    table: str
    loaded: bool
    message: str = ""
    rows: int = 0


def raw_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, key_value, n_records, problem) for NULL or repeated declared keys."""
    parts = []
    for table, key in RAW_KEYS.items():
        if table not in tables:
            continue
        counts = (tables[table].groupBy(F.col(key).alias("key_value"))
                  .agg(F.count(F.lit(1)).alias("n_records")))
        bad = counts.filter(F.col("key_value").isNull() | (F.col("n_records") > 1)).select(
            F.lit(table).alias("table_name"), "key_value", "n_records",
            F.when(F.col("key_value").isNull(), F.lit("null key")).otherwise(F.lit("duplicate key"))
            .alias("problem"))
        parts.append(bad)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, has_data): one counting aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("has_data"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_raw(spark: SparkSession, raw_root: str) -> DataFrame:
    """``load_audit`` of all declared tables under ``raw_root``; a missing or unreadable one counts 0 rows."""
    rows = []
    for table in SOURCE_FILES.values():
        try:
            n = _published_table(spark, raw_root, table).count()
        except Exception:  # noqa: BLE001 - whatever keeps a table from being read makes it empty for the audit
            n = 0
        rows.append((table, n, n > 0))
    return spark.createDataFrame(rows, "table_name string, row_count long, has_data boolean")


def _published_table(spark: SparkSession, raw_root: str, table: str) -> DataFrame:
    return read_published(spark, published(spark, raw_root)[table])


def read_landing(spark: SparkSession, landing_dir: str) -> tuple[dict[str, DataFrame], list[LoadResult]]:
    """Lazy raw DataFrames for the landing files that exist, and a status per file."""
    tables: dict[str, DataFrame] = {}
    results: list[LoadResult] = []
    for file_name, table in SOURCE_FILES.items():
        path = f"{landing_dir.rstrip('/')}/{file_name}"
        if not path_exists(spark, path):
            results.append(LoadResult(file_name, table, False, f"File not found: {path}"))
            continue
        tables[table] = read_copy_text(spark, path, table)
        results.append(LoadResult(file_name, table, True))
    return tables, results


def load_raw(spark: SparkSession, landing_dir: str, raw_root: str, mode: str = "overwrite",
             enforce_keys: bool = True, parallel: int = 2,
             buckets: int | dict[str, int] | None = None, database: str | None = None) -> list[LoadResult]:
    """Load every landing file into its raw table under ``raw_root``.

    Each table is written by distributed jobs; ``parallel`` files are loaded at
    once from driver threads (they are independent). A failure (bad field
    count, blank line, key violation) marks that file failed; the other files still load
    and the table keeps the data published before.

    With ``buckets`` (one count for all tables, or a count per table) the raw layer is
    co-partitioned: those tables are stored as external tables of ``database`` (default:
    one named after the root) bucketed by their title or person key
    (``RAW_BUCKET_KEYS``), so the staging semi-joins on title and the bridge's
    title join read matching buckets without a shuffle (one shuffle at load
    instead of one per use). A bucket is scanned by one task: leave tables whose key has
    hot values (many credits or aliases of one title) out of ``buckets``.
    """
    _, results = read_landing(spark, landing_dir)
    counts = dict.fromkeys(SOURCE_FILES.values(), buckets) if isinstance(buckets, int) else dict(buckets or {})
    database = database or database_of(raw_root)
    if counts:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def load_one(res: LoadResult) -> LoadResult:
        if not res.loaded:
            return res
        source = f"{landing_dir.rstrip('/')}/{res.file_name}"
        try:
            n = load_files(spark, source, raw_root, res.table, mode, enforce_keys, counts.get(res.table), database)
            return LoadResult(res.file_name, res.table, n > 0, f"{n} rows" if n else f"{res.table} is empty after the load", n)
        except Exception as exc:  # noqa: BLE001 - one failed file must not stop the others
            return LoadResult(res.file_name, res.table, False, f"{type(exc).__name__}: {exc}")

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(load_one, results))


def load_files(spark: SparkSession, path: str | list[str], raw_root: str, table: str, mode: str = "overwrite", enforce_keys: bool = True,
               buckets: int | None = None, database: str | None = None, part_name: str | None = None) -> int:
    """``load_table`` of landing files, which are read once; a file with a blank line is refused (``BlankLineError``)."""
    rows, headers = scan_landing(spark, path, table)
    try:
        return load_table(spark, rows, raw_root, table, mode, enforce_keys, buckets, database, part_name, headers)
    except Exception as exc:
        if BLANK_LINE in str(exc):
            raise BlankLineError(f"{table}: a landing file has lines of white space only") from exc
        raise


def load_table(spark: SparkSession, df: DataFrame, raw_root: str, table: str, mode: str = "overwrite", enforce_keys: bool = True,
               buckets: int | None = None, database: str | None = None, part_name: str | None = None,
               headers: dict[str, int] | None = None) -> int:
    """Stage ``df`` as a part, check it, publish it; the number of rows it added.

    The source is read once: rows are counted (and raw checks measured) in the write. Keys
    are checked on the staged part and against the key indexes of older parts. A part name
    that is already published (a batch that is run again) adds nothing. ``headers``: ``df``
    is from ``scan_landing``; as many of its marked rows as there are headers are no rows.
    """
    before = published(spark, raw_root).get(table)
    part = new_part(raw_root, table, part_name)
    old = before if before and mode == "append" else None
    if old and part in old.parts:
        return 0
    catalog_table = f"{database}.{table}_{part.rsplit('/', 1)[-1]}" if buckets else None
    measured, repeats = _write_part(df, part, table, buckets, catalog_table, headers)
    for text, copies in repeats.items():  # data lines that equal a header
        more, _ = _write_part(header_rows(spark, text, copies, table), part, table, buckets, catalog_table, None, "append")
        measured = {k: v if k == "as_of_year" else v + more[k] for k, v in measured.items()}
    rows = measured[ROWS]
    note: dict = {ROWS: rows} if old else dict(measured)
    if table in RAW_KEYS:
        index = f"{raw_root.rstrip('/')}/{table}_keys/{part.rsplit('/', 1)[-1]}"
        bad = write_key_index(spark.read.parquet(part), RAW_KEYS[table], index)
        older = _key_indexes(spark, old, raw_root, table) if old else []
        if enforce_keys and (bad or older and not colliding_keys(spark, older, index).isEmpty()):
            raise KeyViolationError(f"{table}: primary key {RAW_KEYS[table]} is NULL or repeated")
        note[KEY_INDEX] = [*older, index]
    publish(spark, raw_root, table, [*(old.parts if old else ()), part], rows + (old.rows if old else 0),
            None if old else catalog_table, json.dumps(note), before)
    return rows


def _write_part(df: DataFrame, part: str, table: str, buckets: int | None, catalog_table: str | None, headers: dict[str, int] | None,
                mode: str = "overwrite") -> tuple[dict[str, int], dict[str, int]]:
    """Write one part; what was measured in the write, and header text -> data lines that equal it."""
    laid, seen = df, Observation()
    if buckets:
        key = RAW_BUCKET_KEYS[table]
        laid = df.repartition(buckets, key).sortWithinPartitions(key)  # one task per bucket, so one file per bucket
    if headers:
        laid = laid.observe(seen, *[F.count_if(F.col(HEADER) == i).alias(f"h{i}") for i in range(len(headers))])
    if HEADER in laid.columns:
        laid = laid.filter(F.col(HEADER).isNull()).drop(HEADER)
    measure = Measure(f"raw_{table}")
    writer = measure.on(laid).write.mode(mode)
    if buckets:
        writer.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", part).saveAsTable(catalog_table)
    else:
        writer.parquet(part)
    counts = seen.get if headers else {}
    repeats = {text: counts[f"h{i}"] - files for i, (text, files) in enumerate((headers or {}).items())}
    return measure.result, {text: n for text, n in repeats.items() if n > 0}


def write_key_index(rows: DataFrame, key: str, path: str) -> int:
    """Store the distinct keys of ``rows`` in ``KEY_BUCKETS`` folders by a hash of the key; the number of NULL or repeated keys."""
    seen = Observation()
    bucket = F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS)).cast("int")
    keys = rows.select(F.col(key).alias("key")).withColumn("bucket", bucket)
    # all rows of a bucket are in one task, which then counts its keys without another shuffle
    counted = keys.repartition("bucket").groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n_records"))
    (counted.sortWithinPartitions("bucket", "key")
            .observe(seen, F.count_if(F.col("key").isNull() | (F.col("n_records") > 1)).alias("bad"))
            .select("key", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path))
    return seen.get.get("bad", 0)


def _read_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    # each index is a root of its own, so its folders are its buckets; an index without keys has no folder
    parts = [spark.read.schema("key string, bucket int").option("basePath", p).parquet(p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def colliding_keys(spark: SparkSession, older: list[str], index: str) -> DataFrame:
    """Keys of ``index`` that an older index holds; only buckets that ``index`` has keys in are read."""
    new = _read_index(spark, [index])
    buckets = [r.bucket for r in new.select("bucket").distinct().collect()]  # KEY_BUCKETS at most
    old = _read_index(spark, older).filter(F.col("bucket").isin(buckets))
    return old.join(new, ["bucket", "key"], "left_semi").select("key")


def _key_indexes(spark: SparkSession, before: Published, raw_root: str, table: str) -> list[str]:
    """Key indexes of the published parts; a table published without them gets one now."""
    held = before.measured.get(KEY_INDEX)
    if held is None:
        held = [f"{raw_root.rstrip('/')}/{table}_keys/before-{before.seq}"]
        write_key_index(read_published(spark, before), RAW_KEYS[table], held[0])
    return held


def raw_measured(spark: SparkSession, raw_root: str) -> dict[str, dict[str, int]]:
    """What was measured while the published raw tables were written, by relation name; appended tables are left out."""
    return {f"raw_{t}": p.measured for t, p in published(spark, raw_root).items() if len(p.parts) == 1}


def load_append(spark: SparkSession, landing_dir: str, raw_root: str) -> int:
    """Append every landing file to the raw tables and return the number of rows appended.

    All five files must exist before anything is loaded (``LoadFailedError``
    otherwise); a file that fails to load counts as 0 rows and the others still load.
    """
    missing = [f for f in SOURCE_FILES if not path_exists(spark, f"{landing_dir.rstrip('/')}/{f}")]
    if missing:
        raise LoadFailedError(f"Missing landing files: {', '.join(missing)}")
    return sum(r.rows for r in load_raw(spark, landing_dir, raw_root, mode="append") if r.loaded)


def require_all_loaded(results: list[LoadResult]) -> None:
    failed = [r.file_name for r in results if not r.loaded]
    if failed:
        raise LoadFailedError(f"{len(failed)}/{len(results)} files failed to load: {', '.join(failed)}")


def read_raw(spark: SparkSession, raw_root: str) -> dict[str, DataFrame]:
    """The published raw tables of this root; bucketed ones keep their bucketing."""
    found = published(spark, raw_root)
    return {t: read_published(spark, found[t]) for t in SOURCE_FILES.values() if t in found}


def reset_raw(spark: SparkSession, raw_root: str) -> None:
    """Publish every raw table empty, with its declared all-text schema."""
    for table in SOURCE_FILES.values():
        load_table(spark, spark.createDataFrame([], raw_schema(table)), raw_root, table)


def raw_is_empty(spark: SparkSession, raw_root: str) -> bool:
    """True when any declared raw table is missing or has no rows."""
    found = published(spark, raw_root)
    return any(t not in found or not found[t].rows for t in SOURCE_FILES.values())


def load_if_empty(spark: SparkSession, landing_dir: str, raw_root: str, buckets: int | dict[str, int] | None = None) -> list[LoadResult] | None:
    """Load the landing files only when a raw table is missing or empty (so a load that failed half-way is made up)."""
    if raw_is_empty(spark, raw_root):
        return load_raw(spark, landing_dir, raw_root, buckets=buckets)
    return None
