import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmart.llm import topk
from reelmart.llm.topk import op9_top_k, quantise, top_k


def _brute(rows, k, is_query):
    v = [(i, [math.floor(256 * float(x)) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in v:
        if is_query(q):
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:k]
            out += [(q, i, -x) for x, i in s]
    return sorted(out)


def _rows(n, d, seed, spread):
    r = np.random.default_rng(seed)
    rows = [(i, (r.normal(size=d) * r.lognormal(0, spread)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n // 3)]  # one vector that many rows share
    rows += [(5000, None), (5001, [None] * d), (5002, [float("nan")] + [0.0] * (d - 1)), (5003, [float("inf")] * d), (None, [1.0] * d), (5050, []), (5100, [0.0] * d)]
    return rows


@pytest.mark.parametrize("spread,blocks", [(0.0, 64), (1.5, 64), (0.3, 10_000)])
def test_against_brute_force(spark, spread, blocks):
    rows = _rows(300, 12, 4, spread)
    df = spark.createDataFrame([(i, e, "clash", 1.0) for i, e in rows], "vec_id long, embedding array<float>, v string, norm double").repartition(4)
    v = quantise(df)
    got = top_k(v, v.filter(F.col("id") % 50 == 0), k=5, block_rows=blocks, query_rows=3)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, 5, lambda i: i % 50 == 0)


def test_large_integers_are_exact(spark):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1e6, 1e6) for _ in range(6)]) for i in range(60)]
    v = quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = top_k(v, v.filter("id < 5"), k=3, block_rows=16)
    assert sorted(tuple(x) for x in got.collect()) == _brute(rows, 3, lambda i: i < 5)


def test_the_bound_prunes_most_pairs():
    """Vectors in a low-dimensional space: partial sums settle nearly everything."""
    r = np.random.default_rng(0)
    basis = np.linalg.qr(r.normal(size=(16, 16)))[0]
    x = np.floor(256 * (r.normal(size=(2000, 16)) * np.r_[10, 5, 2, 1, np.full(12, 0.02)]) @ basis.T).astype(np.int64)
    turn = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    q, ids = x[:20], np.arange(2000)
    thr = np.sort(q @ x.T, axis=1)[:, -5].astype(float)
    a, b, s = topk._tile(ids[:20], q, thr, ids, x, np.ascontiguousarray(turn), 5)
    want = {(int(i), int(j)) for i in range(20) for j in ids if i != j and (q[i] @ x[j]) >= thr[i]}
    assert set(zip(a.tolist(), b.tolist())) <= {(i, int(j)) for i in range(20) for j in ids}
    assert {(i, j) for i, j in want if (q[i] @ x[j]) > thr[i]} <= set(zip(a.tolist(), b.tolist()))


def test_query_few_candidates_and_empty_table(spark, tmp_dir):
    schema = "vec_id long, embedding array<float>, label int"
    spark.createDataFrame([(0, [1.0, 0.5], 1), (50, [0.5, 1.0], 1), (51, [1.0, 1.0], 2)], schema).write.parquet(f"{tmp_dir}/embeddings.parquet")
    got = sorted(tuple(r) for r in op9_top_k(spark, tmp_dir).collect())
    assert got == [(0, 1, 51, 256 * 256 + 128 * 256), (0, 2, 50, 2 * 256 * 128), (50, 1, 51, 256 * 256 + 128 * 256), (50, 2, 0, 2 * 256 * 128)]
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_dir}/embeddings.parquet")
    assert op9_top_k(spark, tmp_dir).count() == 0


def test_vectors_are_not_copied_for_each_query_and_block(spark):
    """What is shuffled follows the table, not queries x blocks."""
    r = np.random.default_rng(7)
    rows = [(i, e) for i, e in enumerate(r.normal(size=(3000, 64)).astype(np.float32).tolist())]
    v = quantise(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).localCheckpoint()
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorList(True).apply(0).totalShuffleWrite()

    before = shuffled()
    got = top_k(v, v.filter(F.col("id") % 10 == 0), k=5, block_rows=64, query_rows=16)
    assert got.count() == 1500
    assert 0 < shuffled() - before < 3 * 3000 * 64 * 4


def test_repeated_query_ids_and_ties(spark):
    """Rows of one id are one query; equal scores go to the smaller id, whichever block has it."""
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 10))
    for scale in (1, 1000, 3e5):
        x = (base[r.integers(0, 40, 500)] * scale).tolist()
        rows = [(int(i) % 180, e) for i, e in zip(r.permutation(500), x)]
        v = quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
        got = top_k(v, v.filter(F.col("id") % 9 == 0), k=4, block_rows=32, query_rows=2)
        ints = [(i, [math.floor(256 * y) for y in e]) for i, e in rows]
        want = []
        for q in range(0, 180, 9):
            s = sorted((-sum(y * z for y, z in zip(a, b)), i) for j, a in ints if j == q for i, b in ints if i != q)[:4]
            want += [(q, i, -y) for y, i in s]
        assert sorted(tuple(y) for y in got.collect()) == sorted(want)


def test_bounds_of_single_precision_lose_nothing():
    """Distinct directions, thresholds met exactly by other rows, over several blocks."""
    r = np.random.default_rng(5)
    x = r.normal(size=(4000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int16)
    x[2000:2600] = x[:600]
    ids = r.permutation(4000).astype(np.int64)
    turn = np.ascontiguousarray(np.linalg.eigh((x.astype(float).T @ x))[1][:, ::-1])
    q = topk._Side(ids[:300], x[:300], turn)
    best = topk._Best(q, 5)
    for a in range(0, 4000, 1000):
        topk._scan(q, best, topk._Side(ids[a:a + 1000], x[a:a + 1000], turn))
    score = x[:300].astype(np.int64) @ x.astype(np.int64).T
    want = []
    for n in range(300):
        order = np.lexsort((ids, -score[n]))
        want += [(int(ids[n]), int(ids[j]), int(score[n, j])) for j in order[order != n][:5]]
    assert sorted(zip(*(y.tolist() for y in best.rows()))) == sorted(want)


def test_quantise_takes_whole_finite_vectors(spark):
    rows = [(1, [0.5, -0.5]), (2, []), (3, None), (4, [1.0, None]), (5, [math.inf]), (6, [float("nan"), 1.0]), (None, [1.0]), (7, [1e300, -1e300]), (8, [-0.001])]
    got = {r.id: (r.v, r.norm) for r in quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert set(got) == {1, 2, 7, 8}
    assert got[1] == ([128, -128], math.sqrt(2) * 128) and got[2] == ([], 0.0)
    assert got[7][0] == [2**63 - 1, -2**63] and got[8] == ([-1], 1.0)
