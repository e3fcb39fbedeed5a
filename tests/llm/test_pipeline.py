import hashlib
import zlib

import numpy as np

import corpus_pipeline as P
from reelmart.llm import bpe, mixing

from .cases import edge_rows, prose
from .test_lines import _brute as lines_brute
from .test_minhash import _brute as groups_brute
from .test_minhash import _set


def _tables(spark, documents, path):
    rows = [(i, prose(i, 40 + i % 60)) for i in range(150)]
    rows += [(200 + i, f"w{i} " * 50) for i in range(30)]
    rows += [(300, rows[3][1]), (301, rows[4][1] + " more"), (302, None), (303, "")]
    documents(rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(150)] + [(200 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_stages_against_brute_force(spark, documents, tmp_dir):
    _tables(spark, documents, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns = docs.columns
    held = []
    for name, stage in P.STAGES:
        before = docs.collect()
        out = f"{tmp_dir}/{name}"
        stage(spark, docs, tmp_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        held.append((name, before, docs.collect()))
        assert name == "bpe" or docs.columns == columns
    by = {name: (b, a) for name, b, a in held}

    before, after = by["quality"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone >= {i for i in range(200, 230) if zlib.crc32(str(i).encode()) % 5} and not gone & set(range(150))

    before, after = by["line_dedup"]
    want = {i: (n, g, t) for i, n, g, _, t in lines_brute([(r.doc_id, r.text) for r in before])}
    assert {str(r.doc_id): r.text for r in after} == {i: t for i, (n, g, t) in want.items() if not g or g < n}
    assert all(r.text is None or r.n_chars == len(r.text) for r in after)

    before, after = by["minhash"]
    assert {r.doc_id for r in after} == {i for i, _, _, kept in groups_brute([(r.doc_id, r.text) for r in before]) if kept}

    before, after = by["mixing"]
    kept = {r.doc_id for r in mixing.mix(spark.read.parquet(f"{tmp_dir}/minhash")).filter("kept").collect()}
    assert {r.doc_id for r in after} == kept and kept

    before, after = by["bpe"]
    t = bpe.tokenizer(bpe.default_path())
    assert {r.doc_id: bytes(r.ids) for r in after} == {r.doc_id: t.encode([r.text or ""])[0] for r in before}
    assert all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in after)


def test_run_is_the_stages_in_order(spark, documents, tmp_dir):
    _tables(spark, documents, tmp_dir)
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "minhash", "mixing", "bpe"]
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
    assert sorted(map(str, P.run(spark, tmp_dir).collect())) == sorted(map(str, docs.collect()))


def test_empty_tables(spark, documents, tmp_dir):
    documents([]).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert P.run(spark, tmp_dir).count() == 0


def test_line_dedup_keeps_documents_without_repeats(spark, documents):
    rows = [(1, "one\ntwo"), (2, "three\nfour"), (3, "one\ntwo"), (4, ""), (5, None)]
    got = {r.doc_id for r in P.drop_repeated_lines(spark, documents(rows), "").collect()}
    assert got == {1, 2, 4, 5}



def test_near_dedup_links_from_similarity_080(spark, documents):
    rows = []
    for g, t in enumerate((17, 18, 19, 20, 21, 30)):  # 200 words, the last t others: (196 - t) / (196 + t)
        words = [f"g{g}w{k}" for k in range(200)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:-t] + [f"g{g}x{k}" for k in range(t)]))]
    alike = [len(_set(a[1]) & _set(b[1])) / len(_set(a[1]) | _set(b[1])) for a, b in zip(rows[::2], rows[1::2])]
    assert [0.80 <= x < 0.85 for x in alike] == [True] * 5 + [False]
    got = {r.doc_id for r in P.keep_one_of_each(spark, documents(rows), "").collect()}
    assert got == {i for i, _, _, kept in groups_brute(rows, 80) if kept} == {0, 2, 4, 6, 8, 10, 11}


def test_ids_are_decoded(spark, documents):
    rows = [*edge_rows(), (900, "漢字 <|endoftext|> é\r\n\ttabs  and   spaces")]
    t, got = bpe.tokenizer(bpe.default_path()), P.tokenize(spark, documents(rows), "").collect()
    assert len(got) == len(rows)
    assert all(r.decoded_sha256 == hashlib.sha256(t.decode(bytes(r.ids)).encode()).hexdigest() for r in got)
    assert len({r.decoded_sha256 for r in got}) > 30  # texts, not one constant


def test_names_that_clash(spark, documents, tmp_dir):
    from pyspark.sql import functions as F

    _tables(spark, documents, tmp_dir)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    names = ["__score", "score", "__lines", "Lines", "kept", "__p", "row", "ids", "n_tokens", "decoded_sha256"]
    odd = docs.withColumns({c: F.lit(7) for c in names})
    for name, stage in P.STAGES:
        want = {r.doc_id for r in stage(spark, docs, tmp_dir).select("doc_id").collect()}
        got = stage(spark, odd, tmp_dir)
        got.write.parquet(f"{tmp_dir}/odd-{name}")
        rows = spark.read.parquet(f"{tmp_dir}/odd-{name}").collect()
        assert {r.doc_id for r in rows} == want
        assert name == "bpe" or (got.columns == odd.columns and all(r[c] == 7 for r in rows for c in names))
        assert all(r[c] == 7 for r in rows for c in names[:7])
