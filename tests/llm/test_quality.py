import zlib

import numpy as np
from pyspark.sql import functions as F

from reelmart.llm.quality import CUT, MEASURES, fit, held_out, op5_quality, score, text_features, train

from .cases import edge_rows, prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """Judged on the fold that training never sees."""
    got = op5_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 50
    assert (got.predicted == got.quality).mean() > 0.95
    good, bad = got[got.quality == 1].score, got[got.quality == 0].score
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.98
    assert ((got.score >= CUT) == (got.predicted == 1)).all()


def test_rows_scores_and_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op5_quality(spark, SF).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_only_the_text_counts(spark, documents):
    """Other columns, ids and names cannot change a score; equal texts score alike."""
    good = [(i, prose(i, 120)) for i in range(1, 40)]
    bad = [(100 + i, f"w{i} " * 60) for i in range(1, 40)]
    labels = spark.createDataFrame([(i, 1, 0, "x") for i, _ in good] + [(i, 0, 0, "x") for i, _ in bad] + [(None, 1, 0, "x"), (1, None, 0, "x")],
                                   "doc_id long, quality int, toxic int, score string")
    docs = documents(good + bad)
    model = train(docs, labels)
    rows = edge_rows()
    a = score(documents(rows), model).collect()
    b = score(documents([(None if i is None else i + 10_000, t) for i, t in rows]).withColumn("score", F.lit("clash")), model).collect()
    assert sorted(r.score for r in a) == sorted(r.score for r in b) and len(a) == len(rows)
    of = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert min(of[i] for i, _ in good) >= CUT > max(of[i] for i, _ in bad)


def test_without_both_labels(spark, documents):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    docs = documents([(1, "a text"), (2, None)])
    assert train(docs, labels) is None
    assert [r.score for r in score(docs, None).collect()] == [0.5, 0.5]
    assert score(documents([]), None).count() == 0
    assert fit(np.zeros((0, 3)), np.zeros(0)) is None


def test_measures_of_empty_and_small_texts(spark, documents, clashing):
    got = {r.doc_id: dict(zip(MEASURES, r.features)) for r in text_features(clashing(documents([(1, None), (2, ""), (3, "A a\nA a")]))).collect()}
    assert got[1] == got[2] and got[1]["log_words"] == 0
    assert got[3]["distinct"] == 0.25 and got[3]["repeats"] == 0.75 and got[3]["distinct_lines"] == 0.5


def test_held_out_is_crc32(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
