"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, mixing, tokens.

STAGES are run in order by ``run``; each result is written as Parquet to the shared
folder and reread as the next stage's ``docs``, so a lost executor repeats one stage at
most. All stages but the last return the columns of ``documents``. Nulls, empty tables and
repeated rows: as the operators' own docstrings say; a null text is kept as null until the
last stage, which gives it no tokens. Extra columns of any name pass through, but for
``n_tokens``, ``ids`` and ``decoded_sha256``, which the last stage replaces.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField

from reelmart.llm import bpe, lines, minhash, mixing, quality
from reelmart.llm.arrowmap import add_from_texts
from reelmart.session import scratch_path


def _free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents whose score is under ``quality.CUT`` go. Trained as the registered query trains."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, keep=~quality.held_out(F.col("doc_id")))
    score = _free_name(docs, "score")
    scored = add_from_texts(docs, "text", [StructField(score, DoubleType())], quality.scorer(model))
    return scored.filter(F.col(score) >= quality.CUT).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later repeated runs of lines go; a document of which nothing is left goes with them."""
    info = _free_name(docs, "lines")
    d = lines.dedup_lines(docs, info_col=info)
    removed = F.col(f"{info}.removed")
    d = d.filter((removed == 0) | (removed < F.col(f"{info}.total")))
    size = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return d.withColumn("n_chars", size).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of near-duplicates (similarity 0.80 or more) the smallest doc_id stays."""
    others = minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def sample_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents drawn by their calibrated probabilities (smoothed source, language and topic targets)."""
    return mixing.sample(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-pair encoding and decoding: all columns, the number of tokens, the packed ids and the digest of the text decoded from them."""
    both = bpe.round_trip(bpe.default_path())

    def fn(raw, offsets):
        n_tokens, ids, decoded = both(raw, offsets)
        return [n_tokens, ids, [hashlib.sha256(t.encode()).hexdigest() for t in decoded]]

    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded_sha256", StringType())]
    docs = docs.drop(*[f.name for f in fields])
    return add_from_texts(docs, "text", fields, fn, bpe.SLICE_BYTES)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("minhash", keep_one_of_each),
    ("mixing", sample_to_targets),
    ("bpe", tokenize),
]

#: A trained classifier, hash draws and byte-pair merges cannot be expressed in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
