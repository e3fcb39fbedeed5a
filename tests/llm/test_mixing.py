import pytest

from reelmart.llm.mixing import RakingError, calibrate, mix, op1_mixing, rake, sample

from .cases import edge_rows, prose


def _brute(cells, goals, sweeps=200):
    """Plain iterative proportional fitting of {cell: tokens}."""
    w = dict.fromkeys(cells, 1.0)
    total = sum(cells.values())
    for _ in range(sweeps):
        for d, goal in enumerate(goals):
            now = {}
            for c, t in cells.items():
                now[c[d]] = now.get(c[d], 0) + t * w[c]
            for c in cells:
                w[c] *= goal[c[d]] * total / now[c[d]] if now[c[d]] else 1
    return w


def test_rake_against_brute_force(spark):
    cells = {(s, g, t): 100 * (i + 1) + 7 * j + 3 * k * i for i, s in enumerate("abc") for j, g in enumerate("xy") for k, t in enumerate("pq") if (i, j, k) != (2, 1, 1)}
    goals = [{"a": 0.5, "b": 0.3, "c": 0.2}, {"x": 0.4, "y": 0.6}, {"p": 0.7, "q": 0.3}]
    df = spark.createDataFrame([(*c, t) for c, t in cells.items()], "source string, lang string, topic string, tokens long")
    targets = {d: spark.createDataFrame([(v, 2 * x) for v, x in g.items()], "value string, share double") for d, g in zip(("source", "lang", "topic"), goals)}
    got = {(r.source, r.lang, r.topic): r.weight for r in rake(df, targets, tolerance=1e-9).collect()}
    want = _brute(cells, goals)
    for c in cells:
        assert got[c] == pytest.approx(want[c], rel=1e-4)


def test_marginals_probabilities_and_draw(spark, documents, clashing):
    rows = [(i, prose(i, 5 + i % 40)) for i in range(600)]
    docs = clashing(documents(rows))
    got = mix(docs, alpha=0.5).toPandas()
    assert len(got) == len(rows) and got.probability.max() == pytest.approx(1.0) and got.probability.min() > 0
    for dim in ("source", "lang", "topic"):
        share = got.groupby(dim).n_tokens.sum() ** 0.5
        raked = (got.weight * got.n_tokens).groupby(got[dim]).sum()
        assert (raked / raked.sum()).to_dict() == pytest.approx((share / share.sum()).to_dict(), rel=1e-3)
    assert got.kept.sum() == pytest.approx(got.probability.sum(), abs=5 * (got.probability * (1 - got.probability)).sum() ** 0.5 + 1)
    again = mix(docs.repartition(7), alpha=0.5).toPandas()
    assert set(again[again.kept].doc_id) == set(got[got.kept].doc_id)
    other = mix(docs, alpha=0.5, seed=3).toPandas()
    assert set(other[other.kept].doc_id) != set(got[got.kept].doc_id)


def test_sample_keeps_what_mix_keeps(spark, documents):
    docs = documents([(i, prose(i, 30)) for i in range(200)])
    kept = {r.doc_id for r in mix(docs).filter("kept").collect()}
    s = sample(docs)
    assert s.columns == docs.columns and {r.doc_id for r in s.collect()} == kept


def test_a_value_without_target_is_never_drawn(spark, documents):
    docs = documents([(i, prose(i, 30)) for i in range(60)])
    only = {"source": spark.createDataFrame([("s0", 1.0)], "value string, share double")}
    got = mix(docs, only).filter("kept").collect()
    assert got and {r.source for r in got} == {"s0"}


def test_edge_rows_and_empty_table(spark, documents, clashing, tmp_dir):
    rows = edge_rows()
    got = mix(clashing(documents(rows))).collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == len((t or "").split()) for r in got for i, t in rows if i == r.doc_id and i not in (40, 51, None))
    assert all(r.lang == "" for r in got if r.doc_id and r.doc_id % 3 == 0)
    documents([]).write.parquet(f"{tmp_dir}/documents.parquet")
    assert op1_mixing(spark, tmp_dir).count() == 0 and sample(documents([])).count() == 0


def test_no_python_in_the_plan(spark, documents):
    plan = mix(documents([(1, "a"), (2, "b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _cells(spark, cells):
    return spark.createDataFrame([(*c, t) for c, t in cells.items()], "source string, lang string, topic string, tokens long")


def _targets(spark, goals):
    return {d: spark.createDataFrame(list(g.items()), "value string, share double") for d, g in goals.items()}


def _brute_bounded(cells, goals, bound, sweeps=4000):
    """Raking in which each value's factor is found by bisection on the bounded weights."""
    u, total = dict.fromkeys(cells, 1.0), sum(cells.values())
    for _ in range(sweeps // 100):
        for d, goal in enumerate(goals):
            for v, share in goal.items():
                own = [c for c in cells if c[d] == v]
                lo, hi = 0.0, 1e6
                for _ in range(100):
                    f = (lo + hi) / 2
                    low = sum(cells[c] * min(bound, u[c] * f) for c in own) < share * total
                    lo, hi = (f, hi) if low else (lo, f)
                for c in own:
                    u[c] *= hi
    return {c: min(bound, x) for c, x in u.items()}


def test_bounded_raking_against_brute_force(spark):
    cells = {("a", "x", "p"): 400, ("a", "y", "p"): 30, ("b", "x", "p"): 100, ("b", "y", "q"): 200, ("c", "x", "q"): 5,
             ("c", "y", "p"): 60, ("a", "x", "q"): 90, ("c", "y", "q"): 20, ("c", "x", "p"): 30}
    goals = {"source": {"a": 0.53, "b": 0.335, "c": 0.135}, "lang": {"x": 0.62, "y": 0.38}, "topic": {"p": 0.62, "q": 0.38}}
    free = {(r.source, r.lang, r.topic): r.weight for r in rake(_cells(spark, cells), _targets(spark, goals)).collect()}
    bound = 1.2
    assert max(free.values()) > bound
    got = {(r.source, r.lang, r.topic): r.weight for r in rake(_cells(spark, cells), _targets(spark, goals), tolerance=1e-7, max_rounds=200, max_weight=bound).collect()}
    assert max(got.values()) <= bound
    assert got == pytest.approx(_brute_bounded(cells, list(goals.values()), bound), rel=1e-3)
    for d, goal in enumerate(goals.values()):
        for v, share in goal.items():
            assert sum(t * got[c] for c, t in cells.items() if c[d] == v) / sum(cells.values()) == pytest.approx(share, rel=1e-5)


def test_targets_that_cannot_be_met_raise(spark):
    cells = _cells(spark, {("a", "x", "p"): 100, ("b", "y", "p"): 100, ("b", "x", "q"): 100})
    with pytest.raises(RakingError) as err:  # all of a is in x
        rake(cells, _targets(spark, {"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.3, "y": 0.7}}))
    assert err.value.residual > 0.01
    with pytest.raises(RakingError):  # the only cell of y has gone with b
        rake(cells, _targets(spark, {"source": {"a": 1.0}, "lang": {"x": 0.5, "y": 0.5}}))
    with pytest.raises(RakingError):  # the bound is too low for a
        rake(cells, _targets(spark, {"source": {"a": 0.8, "b": 0.2}}), max_weight=2.0)


def test_smoothed_targets_that_conflict_are_moved_toward_the_corpus(spark):
    # source a and language x are the same documents, but smooth to different shares
    cells = {("a", "x", "p"): 1000, **{(f"s{i}", "y", "q"): 100 for i in range(10)}}
    got = {(r.source, r.lang, r.topic): r.weight for r in calibrate(_cells(spark, cells), alpha=0.5).collect()}
    assert got == pytest.approx(dict.fromkeys(cells, 1.0), rel=1e-3)


def test_one_odd_cell_does_not_thin_the_corpus(spark):
    plain = {(s, g, t): 10_000 for s in "ab" for g in "xy" for t in "pq"}
    kept = []
    for size in (1, 1000):
        cells = {c: n * size for c, n in plain.items()} | {("odd", "zz", "p"): 10}
        raked = calibrate(_cells(spark, cells), alpha=0.5).collect()
        assert max(r.weight for r in raked) <= 2.0
        kept.append(sum(r.tokens * r.weight for r in raked) / sum(cells.values()) / max(r.weight for r in raked))
    assert min(kept) >= 0.5 and kept[1] == pytest.approx(kept[0], rel=0.05)


def test_sample_with_clashing_names(spark, documents):
    from pyspark.sql import functions as F

    docs = documents([(i, prose(i, 30)) for i in range(40)])
    odd = docs.withColumns({c: F.lit(1) for c in ("__p", "__cell", "row", "cell", "probability", "weight", "tokens", "topic", "id", "a.b")})
    got = sample(odd)
    assert got.columns == odd.columns and {r.doc_id for r in got.collect()} == {r.doc_id for r in sample(docs).collect()}
