"""Operator 2, MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates.

Documents are linked when the Jaccard similarity of their sets of five-word shingles is
at least ``percent`` / 100 (0.80 by default); the result is their connected components.

1. Each whole text becomes its shingle set (64-bit hashes), one-permutation minima with
   optimal densification, and band keys. Documents with the same set (128-bit hash) are
   one class, named by its smallest id, so copies are never paired.
2. Classes meet in banded buckets. A bucket's star joins each member to its smallest one:
   members - 1 candidate edges, never all pairs.
3. Candidates whose sizes allow the similarity are confirmed on the full sets, which are
   made for candidate documents only.
4. Components come from the confirmed links. A bucket is open if its star left members of
   two components or more besides its centre. Its members are then told apart by what
   differs from the centre c: with D(x) = the shingles in one of x and c only, x and y differ
   in |D(x)| + |D(y)| - 2 |D(x) & D(y)| shingles, so the similarity asks for a number of
   common differences, which is known from sizes alone (``_differences``). In a group of
   near copies all share the text and few share their edits, so this finds the few
   where whole sets would find all pairs. Prefix filtering on the differences, rarest
   first, yields every pair that can reach the similarity. Members that meet on such a
   shingle and are in different components are compared, in rounds of eight times as many
   centres per shingle, until every member outside the shingle's largest component has
   been a centre. There is no other end, so no link between two documents of one bucket
   is lost.

With 32 bands of 6 bins, two sets of similarity 0.85 share no bucket with probability 3e-7,
two of 0.80 with 6e-5. The cost of step 4 is quadratic only in documents that share rare
differences from one centre, stay under the similarity and are in different components.

Hot buckets and hot centres: counts and centres are aggregated map-side, joins are plain
equi-joins that the adaptive skew join splits, and nothing needs a bucket in one task.

Defined cases: a null or empty text, or one without words, has no shingles and is linked
with nothing; fewer than five words are one shingle; rows of one id count as one
document; rows with a null id are linked with nothing, have a null component and are
kept; repeated rows are repeated in the result; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from reelmart.session import scratch_path

from .arrowmap import map_texts
from .graph import components
from .shingles import WORDS, band_keys, one_permutation, set_hash, shingle_sets

PERCENT, BANDS, ROWS, STEP, PAIRS = 80, 32, 6, 8, 16


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, s1, s2, bands): set size, set hash and band keys of every whole text."""
    def fn(raw, offsets):
        sets = shingle_sets(raw, offsets, words)
        keys = band_keys(one_permutation(sets, bands * rows), rows)
        s1, s2 = set_hash(sets)
        return [np.array([len(s) for s in sets], np.int64), s1, s2, _lists(keys.ravel(), np.full(len(sets), bands))]

    fields = [StructField("n", LongType()), StructField("s1", LongType()), StructField("s2", LongType()), StructField("bands", ArrayType(LongType()))]
    return map_texts(docs, id_col, text_col, fields, fn)


def full_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, shingles): the whole set of every text."""
    def fn(raw, offsets):
        sets = shingle_sets(raw, offsets, words)
        return [_lists(np.concatenate([*sets, np.zeros(0, np.uint64)]), np.array([len(s) for s in sets]))]

    return map_texts(docs, id_col, text_col, [StructField("shingles", ArrayType(LongType()))], fn)


def confirm(edges: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The edges (u, v, ...) whose full sets have at least that similarity."""
    a = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    e = edges.join(a, "u").join(b, "v").select(*edges.columns, both.alias("i"), (F.size("a") + F.size("b")).alias("t"))
    return e.filter(F.col("i") * 100 >= (F.col("t") - F.col("i")) * percent).select(*edges.columns)


def _stars(rows: DataFrame, keep) -> DataFrame:
    """(key, id, n, centre) of the buckets for which ``keep`` holds; rows: (key, id, n, component)."""
    star = rows.groupBy("key").agg(F.min(F.struct("id", "n")).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    star = star.filter(keep).select("key", "c")
    return rows.join(star, "key").select("key", "id", "n", "c")


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _in_components(rows: DataFrame, comp: DataFrame | None, name: str = "component") -> DataFrame:
    """``rows`` with the component of each id (its own id without links)."""
    if comp is None:
        return rows.withColumn(name, F.col("id"))
    own = comp.select(F.col("node").alias("id"), F.col("component").alias("__own"))
    return rows.join(own, "id", "left").withColumn(name, F.coalesce("__own", "id")).drop("__own")


def _open_members(stars: DataFrame, comp: DataFrame | None) -> DataFrame:
    """(c, id) of the members, besides the centre, of every bucket in which they have two components or more."""
    left = _in_components(stars.filter(F.col("id") != F.col("c.id")).select("key", "id", F.col("c.id").alias("c")), comp)
    open_ = left.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    return left.join(open_, "key", "left_semi").select("c", "id").distinct()


def _differences(members: DataFrame, sets: DataFrame, comp: DataFrame | None, percent: int) -> DataFrame:
    """(key, id, n, side, size, rank, most, component) of the shingles by which members of one centre can find each other.

    Two sets x, y differ in |D(x)| + |D(y)| - 2 o shingles, where o are the common differences
    from the centre c, and reach the similarity p / 100 if that is at most h (|x| + |y|) with
    h = (100 - p) / (100 + p). Two members of c's component need no comparison, and one
    outside it, y, is not linked with c: |D(y)| > h (|y| + |c|). So

    * o > (|D(x)| + h (|c| - |x|)) / 2 for any x with a partner outside c's component;
    * o >= |D(y)| - h (|x| + |y|) for y with a partner inside (as o <= |D(x)|), with |x| <= 100 |y| / p.

    Differences that no other member of the centre has cannot be common; the others are
    ordered by how many have them, and a partner shares one of the first s - o + 1 of s. Side:
    0 for pairs outside, in keys of their own; otherwise 1 inside, 2 outside the component.
    """
    centre = sets.select(F.col("id").alias("c"), F.col("shingles").alias("of_c"))
    both = members.join(sets, "id").join(centre, "c")
    mine, ours = F.array_except("shingles", "of_c"), F.array_except("of_c", "shingles")
    d = both.select("c", "id", F.size("shingles").cast("long").alias("n"), F.size("of_c").cast("long").alias("m"), F.concat(mine, ours).alias("d"))
    d = _in_components(d, comp).withColumn("size", F.size("d").cast("long"))
    d = _in_components(d.withColumnRenamed("id", "x").withColumn("id", F.col("c")), comp, "home").drop("id").withColumnRenamed("x", "id")
    h, w = 100 - percent, 100 + percent
    other = F.floor(((w * F.col("size")) + h * (F.col("m") - F.col("n"))) / (2 * w)) + 1
    largest = F.floor(F.col("n") * 100 / percent)
    inside = F.greatest(F.ceil((w * F.col("size") - h * (F.col("n") + largest)) / w), F.lit(1))
    out = F.col("component") != F.col("home")
    needs = F.when(out, F.array(F.struct(F.lit(0).alias("side"), other.alias("o")), F.struct(F.lit(2).alias("side"), inside.alias("o")))) \
        .otherwise(F.array(F.struct(F.lit(1).alias("side"), other.alias("o"))))
    rows = d.select("c", "id", "n", "size", "component", needs.cast("array<struct<side:int,o:bigint>>").alias("needs"), F.explode("d").alias("shingle"))
    shared = rows.join(rows.groupBy("c", "shingle").agg(F.count("*").alias("f")).filter("f > 1"), ["c", "shingle"])
    of_set = Window.partitionBy("c", "id")
    shared = shared.withColumn("rank", F.row_number().over(of_set.orderBy("f", "shingle"))).withColumn("most", F.max("rank").over(of_set))
    kept = shared.select("c", "id", "n", "size", "component", "shingle", "rank", "most", F.explode("needs").alias("need")).select(
        "c", "id", "n", "size", "component", "shingle", "rank", "most", "need.*").filter(F.col("rank") <= F.col("most") - F.col("o") + 1)
    return kept.select(F.xxhash64("c", "shingle", F.col("side") == 0).alias("key"), "id", "n", "side", "size", "rank", "most", "component")


def _within_reach(percent: int) -> Column:
    """Whether two members that meet on a shingle can have enough common differences: those up to it and those behind it.

    Columns n, size, rank, most of one and m, size2, rank2, most2 of the other.
    """
    c, h, w = F.col, 100 - percent, 100 + percent
    common = F.least("rank", "rank2") + F.least(c("most") - c("rank"), c("most2") - c("rank2"))
    return 2 * w * common >= w * (c("size") + c("size2")) - h * (c("n") + c("m"))


def _rounds(rows: DataFrame) -> DataFrame:
    """The rows (key, id, component, ...) of the keys with two components or more, with ``members``, how many there are
    of the key, and ``level``, the round as a centre: null in the largest component."""
    parts = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    keys = parts.groupBy("key").agg(F.sum("size").alias("members"), F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("top"))
    rows = rows.join(keys.filter("parts > 1"), "key")
    place = F.pmod(F.xxhash64("id", "key"), F.lit(1 << 40)) * F.col("members") / F.lit(float(1 << 40))  # 0 to the number of members
    level = F.when(place < 1, 0).otherwise(F.floor(F.log(float(STEP), F.greatest(place, F.lit(1.0)))) + 1).cast("int")
    return rows.withColumn("level", F.when(F.col("component") != F.col("top.component"), level)).drop("parts", "top")


def _levels(prefixes: DataFrame, comp: DataFrame | None) -> DataFrame:
    """The rows, with their ``level``, of the keys with two components or more; level: the round as a centre, null in the largest component."""
    return _rounds(_in_components(prefixes, comp)).select(*prefixes.columns, "level")


def _renamed(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """(component, name) of the components of ``rows`` that ``comp`` has merged into others: of each merged set, the one with the
    most rows keeps its name and is not listed, so as few rows as can be change theirs."""
    into = comp.select(F.col("node").alias("component"), F.col("component").alias("into"))
    sizes = rows.groupBy("component").agg(F.count("*").alias("rows")).join(into, "component")
    largest = sizes.groupBy("into").agg(F.max(F.struct("rows", "component"))["component"].alias("name"))
    return sizes.join(largest, "into").filter("component <> name").select("component", "name")


def _merged_keys(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(key) of the rows whose component is in ``names`` (component, name)."""
    return rows.join(names, "component", "left_semi").select("key").distinct()


def _still_open(rows: DataFrame, keys: DataFrame, names: DataFrame) -> DataFrame:
    """The rows of ``keys``, with the components that ``names`` has renamed, as far as a key still has two components or more."""
    mine = rows.join(keys, "key", "left_semi")
    parts = mine.select("key", "component").distinct().join(names, "component", "left").select("key", "component", F.coalesce("name", "component").alias("now"))
    two = parts.groupBy("key").agg(F.min("now").alias("lo"), F.max("now").alias("hi")).filter("lo < hi").select("key")
    now = mine.join(two, "key", "left_semi").join(names, "component", "left")
    return now.withColumn("component", F.coalesce("name", "component")).select(*rows.columns)


def _met(rows: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """(u, v, lo, hi) of the members and centres (both as in ``_rounds``) of one key whose sizes and ranks allow the similarity;
    lo and hi are their components."""
    centres = centres.select("key", F.col("id").alias("v"), F.col("n").alias("m"), F.col("component").alias("other"),
                             F.col("side").alias("facing"), *[F.col(x).alias(f"{x}2") for x in ("size", "rank", "most")])
    met = (F.col("component") != F.col("other")) & ((F.col("side") == 0) | (F.col("side") != F.col("facing")))
    pairs = rows.join(centres, "key").filter(met & _alike(F.col("n"), F.col("m"), percent) & _within_reach(percent))
    return pairs.select(F.least("id", "v").alias("u"), F.greatest("id", "v").alias("v"),
                        F.least("component", "other").alias("lo"), F.greatest("component", "other").alias("hi"))


def _with_merged(comp: DataFrame | None, merged: DataFrame | None) -> DataFrame | None:
    """``comp`` (node, component) with its components, and ids without links, merged by ``merged`` (node, component), whose nodes are such."""
    if comp is None or merged is None:
        return comp if merged is None else merged
    into = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    now = comp.join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return now.unionByName(merged.join(comp, "node", "left_anti").select("node", "component"))


def _by_round(rows: DataFrame) -> list[list[int]]:
    """The levels of ``rows`` in order, those of one round together: as many as make at most ``PAIRS`` pairs a row, or one level that makes more."""
    sizes = rows.groupBy("level").agg(F.count("*").alias("rows"), F.sum("members").alias("pairs")).collect()
    most, room, rounds = PAIRS * sum(x.rows for x in sizes), 0, []
    for level, pairs in sorted((x.level, x.pairs) for x in sizes if x.level is not None):
        if rounds and pairs <= room:
            rounds[-1].append(level)
        else:
            rounds.append([level])
            room = most
        room -= pairs
    return rounds


def _closed(members: DataFrame, sets: DataFrame, comp: DataFrame | None, percent: int, path: str) -> DataFrame | None:
    """The components (node, component) with all links between members (c, id) of one centre; ``comp``: those known so far.

    The rows carry their component, so a round looks at no others than those of keys with as
    many members as make such a round. They are written once. The links of a round are taken
    as edges between components; only those that they join are put together, and the members
    get theirs at the end. After a round that has found links, only the keys in which
    components have merged are made anew, without those that have become one component; the
    other keys stay as they are.
    """
    spark = sets.sparkSession
    _differences(members, sets, comp, percent).write.parquet(f"{path}/prefixes")
    _rounds(spark.read.parquet(f"{path}/prefixes")).write.parquet(f"{path}/levels")
    rows = spark.read.parquet(f"{path}/levels")
    rounds = _by_round(rows)
    enough = [F.col("members") >= (STEP ** (levels[0] - 1) if levels[0] else 0) for levels in rounds]  # a round reads only keys with members enough for it
    joined = touched = again = None  # the components that links have joined; the keys made anew and their rows
    for at, levels in enumerate(rounds):
        name, now = levels[0], F.col("level").isin(levels)
        centres = rows.filter(now)
        if touched is None:
            pairs = _met(rows.filter(enough[at]), centres, percent)
        else:
            pairs = _met(rows.filter(enough[at]), centres.join(touched, "key", "left_anti"), percent)
            pairs = pairs.unionByName(_met(again.filter(enough[at]), again.filter(now), percent))
        pairs.dropDuplicates(["u", "v"]).write.parquet(f"{path}/edges-{name}")
        confirm(spark.read.parquet(f"{path}/edges-{name}"), sets, percent).write.parquet(f"{path}/links-{name}")
        found = spark.read.parquet(f"{path}/links-{name}")
        if not found.isEmpty():
            found = found.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            if joined is not None:
                found = found.unionByName(joined.select(F.col("node").alias("u"), F.col("component").alias("v")))
            joined = components(found, f"{path}/components-{name}")
            if at + 1 < len(rounds):
                left = rows.filter(enough[at + 1])
                _renamed(left, joined).write.parquet(f"{path}/names-{name}")
                names = spark.read.parquet(f"{path}/names-{name}")
                _merged_keys(left, names).write.parquet(f"{path}/merged-{name}")
                touched = spark.read.parquet(f"{path}/merged-{name}")
                _still_open(left, touched, names).write.parquet(f"{path}/again-{name}")
                again = spark.read.parquet(f"{path}/again-{name}")
    return _with_merged(comp, joined)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = WORDS,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document; ``kept`` marks the smallest id of a component."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "minhash")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signatures(src, "id", "text", words, bands, rows).write.parquet(f"{path}/signatures")
    sig = spark.read.parquet(f"{path}/signatures")
    linkable = sig.filter("n > 0 and id is not null")
    linkable.groupBy("n", "s1", "s2", "bands").agg(F.min("id").alias("id")).write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")

    bucket_rows = classes.select(F.explode("bands").alias("key"), "id", "n", F.col("id").alias("component"))
    _stars(bucket_rows, F.col("lo") < F.col("hi")).write.parquet(f"{path}/stars-1")
    stars = spark.read.parquet(f"{path}/stars-1")
    wanted = stars.select("id").distinct()  # shuffled at every size, so that small runs show what large ones cost
    full_sets(src.join(wanted.hint("shuffle_hash"), "id", "left_semi"), "id", "text", words).write.parquet(f"{path}/sets")
    sets = spark.read.parquet(f"{path}/sets")

    edges = stars.filter((F.col("id") != F.col("c.id")) & _alike(F.col("n"), F.col("c.n"), percent))
    edges.select(F.col("id").alias("u"), F.col("c.id").alias("v")).distinct().write.parquet(f"{path}/edges")
    confirm(spark.read.parquet(f"{path}/edges"), sets, percent).write.parquet(f"{path}/links")
    links = spark.read.parquet(f"{path}/links")
    comp = None if links.isEmpty() else components(links, f"{path}/components")
    _open_members(stars, comp).write.parquet(f"{path}/open")
    members = spark.read.parquet(f"{path}/open")
    if not members.isEmpty():
        comp = _closed(members, sets, comp, percent, path)

    named = classes.select("n", "s1", "s2", F.col("id").alias("class_id"))
    if comp is not None:
        named = named.join(comp.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("class_id", F.coalesce("component", "class_id"))
    out = sig.select("id", "n", "s1", "s2").join(named.select("n", "s1", "s2", "class_id"), ["n", "s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: components of all documents at similarity 0.85 over five-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")
