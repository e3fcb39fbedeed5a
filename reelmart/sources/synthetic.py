"""Synthetic raw sources derived from the driver's parquet tables.

The reference ships no data, so its five landing files are derived from the
driver tables: titles and ratings from ``orders``, people from ``customer``,
credits and alternative titles from ``lineitem``. The SQL text is a fixture
(see FIXTURES.md §2); it runs unchanged in Spark (tables passed as DataFrame
parameters) and in DuckDB (tables as views), which is what the oracles use.

The result has the shape of the *loaded* raw tables: every column text, the
``\\N`` marker already turned into NULL, as the COPY load does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# FIXED VALUES: fixture SQL for the five raw sources (placeholders name driver tables).
RAW_TITLE_BASICS_SQL = """
select 'tt' || lpad(cast(k as string), 7, '0') as tconst,
  case k % 14 when 3 then 'tvSeries' when 4 then 'tvMiniSeries' when 5 then 'tvEpisode' when 6 then 'short' when 7 then 'tvShort'
    when 8 then 'tvSpecial' when 9 then 'video' when 10 then 'videoGame' when 11 then 'tvMovie' when 12 then 'tvPilot' else 'movie' end as titletype,
  case k % 5 when 0 then rpad('Long Title ' || cast(k as string), 55, 'x') when 1 then rpad('Medium Title ' || cast(k as string), 30, 'y') else 'Title ' || cast(k as string) end as primarytitle,
  'Title ' || cast(k as string) as originaltitle,
  case when k % 31 = 0 then null when k % 29 = 0 then '1' else '0' end as isadult,
  case when k % 23 = 0 then null when k % 227 = 0 then '1750' else cast(1890 + (k * 37) % 137 as string) end as startyear,
  case when k % 14 in (3, 4) and k % 53 = 0 then '1885' when k % 14 in (3, 4) and k % 3 <> 0 and k % 23 <> 0 then cast(1890 + (k * 37) % 137 + k % 30 as string) end as endyear,
  case when k % 17 = 0 then null when k % 211 = 0 then '700' when k % 223 = 0 then '0' else cast((k * 13) % 240 + 1 as string) end as runtimeminutes,
  case when k % 19 = 0 then null when k % 6 = 0 then 'Drama' when k % 6 = 1 then 'Comedy,Drama' when k % 6 = 2 then 'Action,Adventure,Sci-Fi'
    when k % 6 = 3 then 'Documentary' when k % 6 = 4 then 'Comedy, Romance' else 'Horror,Thriller' end as genres
from (select o_orderkey as k from {orders}) t
"""

RAW_TITLE_RATINGS_SQL = """
select 'tt' || lpad(cast(k as string), 7, '0') as tconst,
  case when k % 97 = 0 then null when k % 199 = 0 then '0.5' else cast(cast(floor(m / 10) as int) as string) || '.' || cast(m % 10 as string) end as averagerating,
  case when k % 89 = 0 then null when k % 9 = 0 then cast(k % 10 as string) when k % 9 = 1 then cast(10 + k % 90 as string)
    when k % 9 = 2 then cast(100 + k % 900 as string) when k % 9 = 3 then cast(1000 + k % 9000 as string)
    when k % 9 = 4 then cast(10000 + k % 90000 as string) when k % 9 = 5 then cast(100000 + k % 900000 as string)
    when k % 9 = 6 then cast(1000000 + k % 1000000 as string) when k % 9 = 7 then cast(5000 + k % 5000 as string) else cast(50000 + k % 50000 as string) end as numvotes
from (select o_orderkey as k, 10 + (o_orderkey * 31) % 91 as m from {orders} where o_orderkey % 7 <> 0) t
"""

RAW_NAME_BASICS_SQL = """
select 'nm' || lpad(cast(c as string), 7, '0') as nconst,
  case when c % 41 = 0 then null when c % 43 = 0 then '  ' when c % 37 = 0 then 'Mononym' || cast(c as string)
    when c % 5 = 0 then c_mktsegment || ' Van Der ' || cast(c as string) else c_mktsegment || ' N' || cast(c as string) end as primaryname,
  case when c % 11 = 0 then null when c % 101 = 0 then '1790' when c % 103 = 0 then '2090' else cast(1915 + (c * 53) % 110 as string) end as birthyear,
  case when c % 3 = 0 and c % 11 <> 0 and (c * 53) % 110 < 45 then cast(1915 + (c * 53) % 110 + 35 + c % 50 as string) end as deathyear,
  case when c % 13 = 0 then null when c % 8 = 0 then 'actor' when c % 8 = 1 then 'actress,producer' when c % 8 = 2 then 'director,writer,producer'
    when c % 8 = 3 then 'writer' when c % 8 = 4 then 'composer,soundtrack' when c % 8 = 5 then 'art_director' when c % 8 = 6 then 'editor' else ' producer , Actor' end as primaryprofession,
  case when c % 15 = 0 then null when c % 2 = 0 then 'tt0000001' else 'tt0000001,tt0000002,tt0000003' end as knownfortitles
from (select c_custkey as c, c_mktsegment from {customer}) t
"""

RAW_TITLE_PRINCIPALS_SQL = """
select 'tt' || lpad(cast(l_orderkey as string), 7, '0') as tconst,
  case when l_partkey % 50 = 0 then null else cast(l_linenumber * (1 + l_partkey % 12) as string) end as ordering,
  'nm' || lpad(cast(l_partkey as string), 7, '0') as nconst,
  case (l_partkey + l_linenumber) % 11 when 0 then 'actor' when 1 then 'actress' when 2 then 'director' when 3 then 'writer' when 4 then 'producer'
    when 5 then 'composer' when 6 then 'cinematographer' when 7 then 'editor' when 8 then 'self' when 9 then 'actor' else 'archive_footage' end as category,
  case when (l_partkey + l_linenumber) % 11 = 4 then 'executive' end as job,
  case when (l_partkey + l_linenumber) % 11 = 0 then '["Hero"]' when (l_partkey + l_linenumber) % 11 = 1 then '["Hero","Narrator"]' end as characters
from {lineitem}
"""

RAW_TITLE_AKAS_SQL = """
select 'tt' || lpad(cast(case when l_partkey % 20 = 0 then l_orderkey + 5000000 else l_orderkey end as string), 7, '0') as titleid,
  cast(l_linenumber as string) as ordering, 'Alt ' || cast(l_partkey as string) as title,
  case l_suppkey % 4 when 0 then null when 1 then 'US' when 2 then 'JP' else 'FR' end as region,
  case l_suppkey % 3 when 0 then 'en' when 1 then 'ja' end as language,
  case l_linenumber % 2 when 0 then 'imdbDisplay' end as types, case when l_linenumber = 3 then 'literal title' end as attributes,
  case when l_linenumber = 1 then '1' when l_linenumber = 7 then null else '0' end as isoriginaltitle
from {lineitem}
"""

RAW_SQL = {
    "title_basics": (RAW_TITLE_BASICS_SQL, "orders"),
    "title_ratings": (RAW_TITLE_RATINGS_SQL, "orders"),
    "name_basics": (RAW_NAME_BASICS_SQL, "customer"),
    "title_principals": (RAW_TITLE_PRINCIPALS_SQL, "lineitem"),
    "title_akas": (RAW_TITLE_AKAS_SQL, "lineitem"),
}


def raw_sql_for_duckdb(table: str) -> str:
    """Fixture SQL with plain table names (driver tables registered as views)."""
    text, driver = RAW_SQL[table]
    return text.format(**{driver: driver})


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One raw source as an all-text DataFrame, derived lazily from the driver table."""
    text, driver = RAW_SQL[table]
    return spark.sql(text, **{driver: read_driver_table(spark, sf_dir, driver)})


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five raw sources, keyed by raw table name."""
    return {table: raw_table(spark, sf_dir, table) for table in RAW_SQL}
