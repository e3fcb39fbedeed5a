"""Operator 4, line dedup: winnowing over line hashes.

A document is the sequence of its non-blank lines (trimmed for comparison). Its windows
are every ``window`` neighbouring lines; a line of ``long_words`` words or more is also a
window of its own, and a document with fewer lines is one window as a whole. Winnowing
selects the smallest line hash of each window as its fingerprint, so any repeated run of
``window`` lines (or one long line) is certain to share one.

1. Fingerprint positions are counted by hash; hashes at one position only go.
2. Windows with a fingerprint left are joined by their own key (two 64-bit hashes over all
   their lines), and the first place of each key, by (id, line), is kept.
3. Every later place matches; neighbouring matches join up in both directions to maximal
   runs, and the lines of these runs are deleted.

So a line goes if and only if it is part of a window that stood earlier, in a smaller id
or higher up in the same document. Counts and first places are aggregated map-side; a
line that a third of all documents share is one row a task there, and its later places
are split by the skew join. The rest of the text, blank lines included, stays as it is.

Defined cases: null texts stay null and empty ones empty, with no lines; rows with equal
ids are the same place, so copies of one row are treated alike; a null id sorts first;
an empty table gives an empty result; extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.session import scratch_path

WINDOW, LONG_WORDS = 2, 10
_BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    """(p, a, b, long): place among all lines, two hashes, and whether it is long; non-blank lines only."""
    trimmed = F.transform(F.split(text, "\n"), lambda x, p: F.struct(p.alias("p"), F.btrim(x, F.lit(_BLANK)).alias("s")))
    return F.filter(trimmed, lambda x: x["s"] != "")


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """(id, th, at, places, k1, k2, anchor, fp) of every window; (id, th) names a row, th being a hash of its text."""
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.coalesce(text, F.lit("")).alias("t"))
    keyed = F.transform(_lines(F.col("t")), lambda x: F.struct(
        x["p"].alias("p"), F.xxhash64(F.lit(1), x["s"]).alias("a"), F.xxhash64(F.lit(2), x["s"]).alias("b"),
        (F.regexp_count(x["s"], F.lit(r"[^ \t\r\x0b\x0c]+")) >= long_words).alias("long")))
    numbered = F.transform(keyed, lambda x, i: F.struct(*[x[f].alias(f) for f in ("p", "a", "b", "long")], i.alias("i")))
    d = d.select("id", "th", numbered.alias("k")).filter(F.size("k") > 0)
    n = F.size("k")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))), lambda i: F.slice(F.col("k"), i, window))
    single = F.transform(F.filter("k", lambda x: x["long"]), lambda x: F.array(x))
    d = d.select("id", "th", F.explode(F.array_union(runs, single) if window > 1 else runs).alias("w"))
    # the smallest hash of the window, the last of equal ones
    least = F.array_min(F.transform("w", lambda x: F.struct(x["a"].alias("fp"), (-x["p"]).alias("p"))))
    return d.select("id", "th", F.col("w")[0]["p"].alias("at"), F.transform("w", lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p"))).alias("places"),
                    F.xxhash64(F.lit(3), F.col("w.a"), F.col("w.b")).alias("k1"), F.xxhash64(F.lit(4), F.col("w.b"), F.col("w.a")).alias("k2"),
                    (-least["p"]).alias("anchor"), least["fp"].alias("fp"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS) -> DataFrame:
    """(id, th, gone): lines to delete, as (i, p), number among the non-blank lines and place; documents that have any."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "lines")
    line_windows(docs, id_col, text_col, window, long_words).write.parquet(path)
    w = spark.read.parquet(path)
    # 1. a fingerprint counts once per selected line
    marks = w.groupBy("fp").agg(F.min(F.struct("id", "anchor")).alias("lo"), F.max(F.struct("id", "anchor")).alias("hi"))
    marks = marks.filter(~F.col("lo").eqNullSafe(F.col("hi"))).select("fp")
    # 2. the first place of each window that is left
    w = w.join(marks, "fp", "left_semi").select("id", "th", "at", "places", "k1", "k2")
    place = F.struct("id", "at")
    first = w.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") < F.col("last"))
    # 3. later places, joined up by document
    later = w.join(first.select("k1", "k2", "first"), ["k1", "k2"]).filter(F.col("first") < place)
    return (later.select("id", "th", F.explode("places").alias("p")).groupBy("id", "th")
            .agg(F.sort_array(F.collect_set("p")).alias("gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, long_words: int = LONG_WORDS,
                info_col: str = "lines") -> DataFrame:
    """``docs`` with ``text`` as it is left, and a struct column ``info_col`` (total, removed, runs), which replaces one of that name."""
    gone = repeated_lines(docs, id_col, text_col, window, long_words).hint("shuffle_hash")
    # the other columns travel in one struct, so their names meet no other
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    d = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    text = F.col("text")
    d = d.join(gone, F.col("key").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("th")), "left")
    none = F.col("gone").isNull()
    d = d.withColumn("all", F.split(text, "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("gone.p"))
    left = F.array_join(F.transform(stay, lambda p: F.col("all")[p]), "\n")
    # a run starts where the number is not one more than the one before
    number = F.col("gone.i")
    starts = F.size(F.filter(F.arrays_zip(number.alias("a"), F.concat(F.array(F.lit(-2)), number).alias("b")),
                             lambda z: z["a"].isNotNull() & (z["a"] != z["b"] + 1)))
    total = F.coalesce(F.size(_lines(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long")
    info = F.struct(total.alias("total"),
                    F.when(none, 0).otherwise(F.size("gone")).cast("long").alias("removed"),
                    F.when(none, 0).otherwise(starts).cast("long").alias("runs")).alias(info_col)
    out = {c: F.col(f"row.`{c}`") for c in docs.columns if c != text_col} | {text_col: F.when(none, text).otherwise(left).alias(text_col)}
    shown = [info if c.lower() == info_col.lower() else out[c] for c in docs.columns]
    return d.select(*shown, *([] if info_col.lower() in (c.lower() for c in docs.columns) else [info]))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left."""
    d = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", F.col("lines.total").alias("n_lines"), F.col("lines.removed").alias("n_removed"),
                    F.col("lines.runs").alias("n_runs"), "text")


OP4_SQL = r"""
with l as (
  select doc_id, p, trim(x, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) as s, x
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as x,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as p from documents)
), k as (
  select *, row_number() over (partition by doc_id order by p) as i, count(*) over (partition by doc_id) as n,
    lead(s) over (partition by doc_id order by p) as s2, lead(p) over (partition by doc_id order by p) as p2,
    len(regexp_extract_all(s, '[^ \t\r\x0b\x0c]+')) >= 10 as long
  from l where s <> ''
), w as (
  select doc_id, p, p2, [s, s2] as g from k where s2 is not null
  union all select doc_id, p, null, [s] from k where n = 1 or long
), f as (
  select *, row_number() over (partition by g order by doc_id, p) as r from w
), gone as (
  select distinct doc_id, p from (select doc_id, p from f where r > 1 union all select doc_id, p2 from f where r > 1 and p2 is not null)
), runs as (
  select doc_id, count(*) as n_runs from (
    select k.doc_id, g.p is not null as a, lead(g.p is not null) over (partition by k.doc_id order by k.p) as b
    from k left join gone g on g.doc_id = k.doc_id and g.p = k.p)
  where a and not coalesce(b, false) group by 1
), t as (
  select l.doc_id, count(*) filter (where s <> '') as n_lines, count(g.p) as n_removed,
    coalesce(string_agg(x, chr(10) order by l.p) filter (where g.p is null), '') as text
  from l left join gone g on g.doc_id = l.doc_id and g.p = l.p group by 1
)
select t.doc_id, n_lines, n_removed, coalesce(n_runs, 0) as n_runs, case when d.text is null then null else t.text end as text
from t left join runs using (doc_id) join documents d using (doc_id)
"""
