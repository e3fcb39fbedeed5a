"""Operator 6, document fingerprints: SimHash with permuted block tables.

``fingerprints``: every word pair (two neighbouring lower-cased words; also each word
alone, at a smaller weight) is a term. A term's weight is its kind's weight times
1 + ln(occurrences); its 64-bit hash, expanded to ``BITS`` signed bits, votes with that
weight. The sign of each bit's sum is that bit of the fingerprint (hex string). Only
vectors of ``BITS`` sums are kept per document; texts are read whole.

``near_fingerprints``: all documents whose fingerprints differ in at most ``radius``
bits. The fingerprint is cut into ``blocks`` blocks; any two within the radius agree on
at least ``blocks - radius`` of them, so one table per choice of that many blocks, keyed
by those blocks (the permuted prefix), holds every such pair in one bucket. Equal
fingerprints are one class first, so copies never multiply. Within a bucket, pairs come
from a self-join on the key; each pair is confirmed on the whole fingerprints. Its result
is all pairs of a group, so it is meant for small radii.

``near_groups``: the same tables without all pairs. Links are pairs of classes that share
a bucket and differ in at most ``reach`` bits; as buckets hold every pair within
``radius``, none of these is missed, and most pairs between radius and reach are found
too. The result names each class by the smallest id reachable over links. Each bucket is
first a few stars around members chosen by hashes of their ids, and the confirmed edges
give components. Members of a bucket that are still in different components are then
compared, each of those outside the bucket's largest component with the members of other
components: a few of them first, whose links join up, and then the rest. So a group of
near copies costs a few edges a member and table, and no link is lost. Members of one
bucket that are further than ``reach`` from all others stay outside, and each of these is
compared with the whole bucket.

Likeness of two fingerprints: cos(pi * differing bits / BITS), below 0 counts as 0: the
estimated cosine of the term vectors.

Defined cases: a null or empty text (or one without words) has the fingerprint "" and is
like another empty one only (1.0, else 0.0); equal texts have equal fingerprints;
repeated rows count as rows; an empty table gives an empty result. Rows with a null id give
no class its name, but are in the class of their fingerprint if it has one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from reelmart.session import scratch_path

from .arrowmap import map_texts, visible
from .graph import components
from .minhash import _in_components, _levels
from .words import LOWER, NOT_SPACE, buffers, mix, slices, word_hashes

BITS = 256
#: Tables of ``near_groups``: one per block, which holds every pair within RADIUS bits. Texts of 150 to 2,000 words with one
#: word changed differ in 8 bits (median; 15 at the 95th percentile, 26 at most), unrelated ones in 101 or more.
RADIUS, BLOCKS, REACH = 9, 10, 24
#: Members of a bucket that all others are compared with first.
CENTRES = 4
PAIR_WEIGHT, WORD_WEIGHT = 1.0, 0.25
_VOTE_ROWS = 1 << 14


def _votes(terms: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    """Signed bit sums of one document's distinct terms."""
    out = np.zeros(bits)
    for a in range(0, len(terms), _VOTE_ROWS):
        t, w = terms[a:a + _VOTE_ROWS], weights[a:a + _VOTE_ROWS]
        wide = np.stack([mix(t + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1))) for k in range(bits // 64)], axis=1)
        signs = np.unpackbits(wide.view(np.uint8), axis=1)
        out += 2.0 * (w @ signs.astype(np.float32)) - w.sum()
    return out


def _fingerprint_slice(raw: np.ndarray, offsets: np.ndarray, bits: int) -> list[str]:
    h, doc = word_hashes(LOWER[raw], offsets, NOT_SPACE)
    n = len(offsets) - 1
    at = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for d in range(n):
        w = h[at[d]:at[d + 1]]
        if not len(w):
            out.append("")
            continue
        words, n_words = np.unique(w, return_counts=True)
        terms, weights = words, WORD_WEIGHT * (1 + np.log(n_words))
        if len(w) > 1:
            pairs, n_pairs = np.unique(mix(w[:-1] * np.uint64(3) + w[1:]), return_counts=True)
            terms = np.concatenate([words, pairs])
            weights = np.concatenate([weights, PAIR_WEIGHT * (1 + np.log(n_pairs))])
        out.append(np.packbits(_votes(terms, weights.astype(np.float32), bits) > 0).tobytes().hex())
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, fingerprint): ``bits`` bits as lower-case hex, "" for a text without words. ``bits`` is a multiple of 64."""
    return map_texts(docs, id_col, text_col, [StructField("fingerprint", StringType())],
                     lambda raw, offsets: [_fingerprint_slice(raw, offsets, bits)])


def differing_bits(a: Column, b: Column, bits: int = BITS) -> Column:
    """Hamming distance of two fingerprints in hex (null if one is empty)."""
    step = 15  # hex digits that fit in a signed long
    digits = bits // 4
    parts = [F.bit_count(F.conv(F.substring(a, i + 1, step), 16, 10).cast("long")
                         .bitwiseXOR(F.conv(F.substring(b, i + 1, step), 16, 10).cast("long"))) for i in range(0, digits, step)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.when((a != "") & (b != ""), total)


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """0 to 1; equal fingerprints give 1."""
    cosine = F.greatest(F.lit(0.0), F.cos(F.lit(np.pi / bits) * differing_bits(a, b, bits)))
    return F.when(a == b, 1.0).otherwise(F.coalesce(cosine, F.lit(0.0)))


def _table_keys(radius: int, blocks: int, bits: int) -> Column:
    """The keys of ``fingerprint`` in all tables, one table per choice of blocks - radius blocks."""
    if not 0 <= radius < blocks <= bits // 4:
        raise ValueError("radius < blocks <= bits / 4 is needed")
    digits = bits // 4
    cuts = [digits * k // blocks for k in range(blocks + 1)]
    block = [F.substring("fingerprint", cuts[k] + 1, cuts[k + 1] - cuts[k]) for k in range(blocks)]
    return F.array(*[F.xxhash64(F.lit(t), *[block[k] for k in keep]) for t, keep in enumerate(combinations(range(blocks), blocks - radius))])


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int = 5, id_col: str = "doc_id",
                      fp_col: str = "fingerprint", bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of all documents within ``radius`` bits.

    ``members``: (id, fingerprint, class_id), class_id the smallest id of that fingerprint.
    ``pairs``: (class_a, class_b, distance) with class_a < class_b, between classes.
    Empty fingerprints take no part.
    """
    p = prints.select(F.col(id_col), F.col(fp_col).alias("fingerprint")).filter(F.col("fingerprint") != "")
    classes = p.groupBy("fingerprint").agg(F.min(id_col).alias("class_id"))
    members = p.join(classes, "fingerprint").select(id_col, "fingerprint", "class_id")
    rows = classes.select("class_id", F.explode(_table_keys(radius, blocks, bits)).alias("key"))
    a, b = rows.alias("a"), rows.alias("b")
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.class_id") < F.col("b.class_id"))
    pairs = a.join(b, same).select(F.col("a.class_id").alias("class_a"), F.col("b.class_id").alias("class_b")).distinct()
    pairs = pairs.join(classes.select(F.col("class_id").alias("class_a"), F.col("fingerprint").alias("fa")), "class_a")
    pairs = pairs.join(classes.select(F.col("class_id").alias("class_b"), F.col("fingerprint").alias("fb")), "class_b")
    pairs = (pairs.select("class_a", "class_b", differing_bits(F.col("fa"), F.col("fb"), bits).cast("int").alias("distance"))
             .filter(F.col("distance") <= radius))
    return pairs, members


def _linked(edges: DataFrame, classes: DataFrame, reach: int, bits: int) -> DataFrame:
    """The edges (u, v) of at most ``reach`` differing bits."""
    e = edges.join(classes.select(F.col("class_id").alias("u"), F.col("fingerprint").alias("a")), "u")
    e = e.join(classes.select(F.col("class_id").alias("v"), F.col("fingerprint").alias("b")), "v")
    return e.filter(differing_bits(F.col("a"), F.col("b"), bits) <= reach).select("u", "v")


def near_groups(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, reach: int = REACH, id_col: str = "doc_id",
                fp_col: str = "fingerprint", bits: int = BITS) -> DataFrame:
    """(fingerprint, class_id, near_id) of every fingerprint that is not empty.

    class_id is the smallest id with that fingerprint, near_id the smallest one that links
    lead to, itself included. A link joins two classes that share one of the tables' buckets
    and differ in at most ``reach`` bits.
    """
    if reach < radius:
        raise ValueError("radius <= reach is needed")
    spark, path = prints.sparkSession, scratch_path(prints.sparkSession, "simhash-near")
    p = prints.select(F.col(id_col).alias("class_id"), F.col(fp_col).alias("fingerprint")).filter("fingerprint <> '' and class_id is not null")
    p.groupBy("fingerprint").agg(F.min("class_id").alias("class_id")).write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    rows = classes.select(F.explode(_table_keys(radius, blocks, bits)).alias("key"), F.col("class_id").alias("id"))
    shared = rows.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last")).filter("least < last").select("key")
    rows.join(shared, "key").write.parquet(f"{path}/buckets")
    buckets = spark.read.parquet(f"{path}/buckets")

    def joined(links: DataFrame, comp: DataFrame | None, step: str) -> DataFrame | None:
        links.write.parquet(f"{path}/links-{step}")
        links = spark.read.parquet(f"{path}/links-{step}")
        if links.isEmpty():
            return comp
        if comp is not None:
            links = links.unionByName(comp.select(F.col("node").alias("u"), F.col("component").alias("v")))
        return components(links, f"{path}/components-{step}")

    centres = buckets.groupBy("key").agg(*[F.min(F.struct(F.xxhash64(F.lit(t), "id").alias("h"), "id"))["id"].alias(f"c{t}") for t in range(CENTRES)])
    stars = buckets.join(centres, "key").select(F.col("id").alias("u"), F.explode(F.array(*[f"c{t}" for t in range(CENTRES)])).alias("v"))
    stars = stars.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    comp = joined(_linked(stars, classes, reach, bits), None, "stars")
    # what is left are buckets of several components
    words = F.array(*[F.conv(F.substring("fingerprint", 8 * k + 1, 8), 16, 10).cast("long") for k in range(bits // 32)])
    _levels(buckets, comp).join(classes.select(F.col("class_id").alias("id"), words.alias("f")), "id").write.parquet(f"{path}/open")
    left = spark.read.parquet(f"{path}/open")
    apart = F.aggregate(F.zip_with("f", "g", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    for step, mine in enumerate(("level <= 1", "level > 1")):  # a few of each bucket first, then all others that are still outside
        now = _in_components(left, comp)
        some = now.filter(mine).select(F.col("key").alias("at"), F.col("id").alias("v"), F.col("component").alias("other"), F.col("f").alias("g"))
        # compared inside the join, so only links come out of it
        met = now.join(some, (F.col("key") == F.col("at")) & (F.col("component") != F.col("other")) & (apart <= reach))
        comp = joined(met.select(F.least("id", "v").alias("u"), F.greatest("id", "v").alias("v")).distinct(), comp, str(step))
    if comp is None:
        return classes.select("fingerprint", "class_id", F.col("class_id").alias("near_id"))
    named = _in_components(classes.withColumnRenamed("class_id", "id"), comp, "near_id")
    return named.select("fingerprint", F.col("id").alias("class_id"), "near_id")


def _edited(texts: list[str], followers: list[str]) -> list[bytes]:
    """Each text with its last floor(n/2) code points replaced by as many first ones of its follower (or all it has)."""
    return [(t[:len(t) - len(t) // 2] + f[:len(t) // 2]).encode() for t, f in zip(texts, followers)]


def _of_texts(data: list[bytes], bits: int) -> list[str]:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    return _fingerprint_slice(np.frombuffer(b"".join(data), np.uint8), offsets, bits)


_EDIT_SCHEMA = "kind int, pid int, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string, text string"


def _edit_rows(kind, pid, ids, texts, prints, followers, follower_prints, bits):
    edited = _edited(texts, followers)
    return [pa.array([kind] * len(texts), pa.int32()), pa.array([pid] * len(texts), pa.int32()),
            pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array(prints, pa.string()), pa.array(_of_texts(edited, bits), pa.string()), pa.array(follower_prints, pa.string()),
            pa.nulls(len(texts), pa.string()), ids]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint) per document.

    Documents are dealt by ranges of the id and sorted (equal ids by text), so each task
    sees followers in order and texts are shuffled once. The last document of a partition
    follows up with the first of the next one that has rows: these two per partition are
    matched in a second small step, on partition numbers only.
    """
    visible(docs.sparkSession)
    id_kind = docs.schema[id_col].dataType.simpleString()
    ordered = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", "text"))
    columns = [c.split()[0] for c in _EDIT_SCHEMA.split(", ")] + ["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, held = TaskContext.get().partitionId(), None
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for a, b in slices(offsets):
                cut = offsets[a:b + 1]
                part = raw[cut[0]:cut[-1]]
                prints = _fingerprint_slice(part, cut - cut[0], bits)
                data, at = part.tobytes(), (cut - cut[0]).tolist()
                texts = [data[x:y].decode() for x, y in zip(at, at[1:])]
                ids = batch.column(0).slice(a, b - a)
                if held is None:  # the first document of this partition follows the partition before
                    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([pid], pa.int32()), pa.nulls(1, pa.int64()),
                                                      pa.nulls(1, pa.string()), pa.array(prints[:1], pa.string()), pa.nulls(1, pa.string()),
                                                      pa.nulls(1, pa.string()), pa.array(texts[:1], pa.string()), ids.slice(0, 1)], names=columns)
                else:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, prints = [held[1], *texts], [held[2], *prints]
                k = len(texts) - 1
                if k:
                    yield pa.RecordBatch.from_arrays(_edit_rows(2, pid, ids.slice(0, k), texts[:-1], prints[:-1], texts[1:], prints[1:], bits), names=columns)
                held = (ids.slice(k, 1), texts[-1], prints[-1])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([pid], pa.int32()), pa.nulls(1, pa.int64()),
                                              pa.nulls(1, pa.string()), pa.array([held[2]], pa.string()), pa.nulls(1, pa.string()),
                                              pa.nulls(1, pa.string()), pa.array([held[1]], pa.string()), held[0]], names=columns)

    path = scratch_path(docs.sparkSession, "simhash-edited")
    ordered.mapInArrow(run, f"{_EDIT_SCHEMA}, id {id_kind}").write.parquet(path)
    made = docs.sparkSession.read.parquet(path)
    # two rows a partition: which partition's first document follows this one's last
    numbers = made.filter("kind = 0").select("pid")
    follows = numbers.select("pid", F.lead("pid").over(Window.orderBy("pid")).alias("after"), F.min("pid").over(Window.partitionBy()).alias("least"))
    follows = follows.select("pid", F.coalesce("after", "least").alias("after"))
    firsts = made.filter("kind = 0").select(F.col("pid").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    lasts = made.filter("kind = 1").join(follows, "pid").join(firsts, "after").select("id", "text", "fingerprint", "next_text", "next_print")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, prints, after, after_prints = (batch.column(i).to_pylist() for i in range(1, 5))
            yield pa.RecordBatch.from_arrays(_edit_rows(2, 0, batch.column(0), text, prints, after, after_prints, bits), names=columns)

    wanted = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    closed = lasts.mapInArrow(close, f"{_EDIT_SCHEMA}, id {id_kind}")
    return made.filter("kind = 2").select(*wanted).unionByName(closed.select(*wanted)).withColumnRenamed("id", id_col)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of each text and its edited text, their likeness, and the group of near fingerprints.

    class_id, near_id: see ``near_groups``; a document without words is on its own.
    """
    e = edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    near = near_groups(e).withColumnRenamed("fingerprint", "of")
    e = e.join(near, F.col("fingerprint") == F.col("of"), "left")
    return e.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                    F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("near_id", "doc_id").alias("near_id"))
