import random
import re
from collections import Counter

import numpy as np
import pytest

from reelmart.llm.graph import components
from reelmart.llm.minhash import near_duplicates, op2_minhash
from reelmart.llm.shingles import one_permutation, shingle_sets
from reelmart.session import scratch_path

from .cases import edge_rows, prose


def _set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _brute(rows, percent=85):
    sets = [(i, _set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str)


def _rows():
    r = random.Random(2)
    rows = edge_rows()
    passage = prose(77, 60)
    for g in range(12):  # chains of near copies, and documents that only share a passage
        words = prose(500 + g, 150).split(" ")
        for k in range(6):
            words[r.randrange(len(words))] = f"new{g}x{k}"
            rows.append((1000 + 10 * g + k, " ".join(words)))
        rows.append((2000 + g, passage + " " + prose(600 + g, 25)))
    return rows


def test_against_brute_force(spark, documents, clashing):
    rows = _rows()
    got = near_duplicates(clashing(documents(rows))).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == _brute(rows)


def test_lower_threshold(spark, documents):
    rows = _rows()
    got = near_duplicates(documents(rows), percent=80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == _brute(rows, 80)


def test_nothing_to_link_and_empty_table(spark, documents, tmp_dir):
    rows = [(1, None), (2, "a b c"), (3, "other words here"), (None, "a b c")]
    got = sorted((tuple(r) for r in near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 1, 2, True), (3, 1, 3, True), (None, 1, None, True)], key=str)
    documents([]).write.parquet(f"{tmp_dir}/documents.parquet")
    assert op2_minhash(spark, tmp_dir).count() == 0


def test_equal_minima_estimate_the_similarity():
    r = np.random.default_rng(1)
    for size in (20, 200, 2000):
        both = r.integers(0, 2**63, size * 9 // 10, dtype=np.uint64)
        sets = [np.unique(np.r_[both, r.integers(0, 2**63, size // 20, dtype=np.uint64)]) * np.uint64(2) for _ in range(2)]
        m = one_permutation(sets, 2048)
        want = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        assert (m[0] == m[1]).mean() == pytest.approx(want, abs=0.12 if size == 20 else 0.05)


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    hub = [(1000 + i, 900) for i in range(50)]
    df = spark.createDataFrame([*path, *hub, (5, 5)], "u long, v long")
    got = {r.node: r.component for r in components(df, scratch_path(spark, "cc")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 900 for i in range(50)} | {900: 900}


def test_no_link_within_a_bucket_is_lost(spark, documents):
    # one band of one bin: most groups meet in the bucket of the shared passage's minimum, where one star links one group only
    rows, passage = [], prose(77, 80)
    for g in range(60):
        words = [f"g{g}w{k}" for k in range(60)]
        rows += [(2 * g, " ".join([passage, *words])), (2 * g + 1, " ".join([passage, *words, "tail"]))]
    texts = [t.encode() for _, t in rows]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    least = one_permutation(shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets), 1)[:, 0].tolist()
    assert max(Counter(least).values()) > 20
    sets = [_set(t) for _, t in rows]
    want = [(2 * g + 1, 2 * g) for g in range(60) if least[2 * g] == least[2 * g + 1]]
    assert all(100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a, b in want)
    got = near_duplicates(documents(rows), percent=85, bands=1, rows=1).filter("not kept").collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == want


def test_differences_from_a_centre_find_every_link(spark):
    """Sets made by random edits of a centre, of other centres, of each other: all links that can join components are found."""
    import random
    import tempfile

    from reelmart.llm import minhash as M

    r = random.Random(11)
    for percent in (80, 85):
        base = list(range(100))
        sets = {0: set(base)}
        for i in range(1, 160):
            start = set(sets[r.choice(list(sets))] if r.random() < 0.5 else base)
            for _ in range(r.randrange(0, 14)):
                if r.random() < 0.5 and len(start) > 5:
                    start.discard(r.choice(sorted(start)))
                else:
                    start.add(r.choice([r.randrange(100, 130), 1000 + r.randrange(10**6)]))
            sets[i] = start
        alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        known = {i: (0 if alike(0, i) else i) for i in sets}  # the star's links
        want = dict(known)
        changed = True
        while changed:
            changed = False
            for a in sets:
                for b in sets:
                    if want[a] != want[b] and alike(a, b):
                        lo = min(want[a], want[b])
                        gone = max(want[a], want[b])
                        want = {i: lo if c == gone else c for i, c in want.items()}
                        changed = True
        frame = spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "id long, shingles array<long>")
        members = spark.createDataFrame([(0, i) for i in sets if i], "c long, id long")
        comp = spark.createDataFrame([(i, 0) for i, c in known.items() if c == 0], "node long, component long")
        got = {i: i for i in sets} | {x.node: x.component for x in M._closed(members, frame, comp, percent, tempfile.mkdtemp()).collect()}
        assert got == want and len(set(want.values())) < len(set(known.values()))


def test_rounds_without_links_do_not_go_through_all_rows_again(spark, monkeypatch):
    """Members that share rare differences but are too far apart: several rounds, no link, and no lookup of components in any of them."""
    import tempfile

    from reelmart.llm import minhash as M

    base = set(range(100))
    sets = {0: base} | {i: base | set(range(1000, 1008)) | set(range(10_000 * i, 10_000 * i + 26)) for i in range(1, 71)}
    sets[71] = sets[70] | {5}
    frame = spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "id long, shingles array<long>")
    members = spark.createDataFrame([(0, i) for i in sets if i], "c long, id long")
    calls, lookup = [], M._in_components
    monkeypatch.setattr(M, "_in_components", lambda rows, *a: calls.append(rows.columns) or lookup(rows, *a))
    rounds, check = [], M.confirm
    monkeypatch.setattr(M, "confirm", lambda *a: rounds.append(1) or check(*a))
    comp = M._closed(members, frame, None, 80, tempfile.mkdtemp())
    assert len(rounds) >= 3 and len(calls) == 2
    assert {x.node: x.component for x in comp.collect()} == {70: 70, 71: 70} if comp is not None else False


def test_links_of_a_round_leave_the_rows_of_other_keys_as_they_are(spark):
    """200 members that share differences and stay apart, and a few pairs of other centres: the first round's links touch the pairs' rows only."""
    import os
    import tempfile

    from reelmart.llm import minhash as M

    base = set(range(100))
    sets = {0: base} | {i: base | set(range(1000, 1008)) | set(range(10_000 * i, 10_000 * i + 26)) for i in range(1, 201)}
    members = [(0, i) for i in range(1, 201)]
    for k in range(4):  # two alike and one apart, which shares ten differences with them
        c = 1000 + 10 * k
        own = range(10_000 * c, 10_000 * c + 100)
        sets[c] = set(own)
        sets[c + 1] = {*own, *range(own[0] + 200, own[0] + 234)}
        sets[c + 2] = {*sets[c + 1], own[0] + 300}
        sets[c + 3] = {*own, *range(own[0] + 200, own[0] + 210), *range(own[0] + 400, own[0] + 424)}
        members += [(c, c + x) for x in (1, 2, 3)]
    frame = spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "id long, shingles array<long>")
    path = tempfile.mkdtemp()
    comp = M._closed(spark.createDataFrame(members, "c long, id long"), frame, None, 80, path)
    assert {x.node: x.component for x in comp.collect()} == {1000 + 10 * k + x: 1001 + 10 * k for k in range(4) for x in (1, 2)}
    written = {x: spark.read.parquet(f"{path}/{x}").count() for x in os.listdir(path) if not x.startswith("components")}
    assert written["links-0"] and "edges-2" in written
    again = {x: n for x, n in written.items() if x not in ("prefixes", "levels") and not x.startswith(("edges", "links"))}
    assert sum(again.values()) < 0.3 * written["levels"]


def test_levels_of_few_pairs_share_a_round(spark, monkeypatch):
    """Twelve members that share differences, two of them alike only among themselves and a chain over three: one round finds all links."""
    import os
    import tempfile

    from reelmart.llm import minhash as M

    base = set(range(100))
    apart = lambda i: base | set(range(1000, 1008)) | set(range(10_000 * i, 10_000 * i + 26))
    sets = {0: base} | {i: apart(i) for i in range(1, 11)}
    sets[11] = sets[10] | {5_000_011}
    sets[12] = (sets[11] | set(range(7000, 7010))) - set(range(100_000, 100_010))
    frame = spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], "id long, shingles array<long>")
    members = spark.createDataFrame([(0, i) for i in sets if i], "c long, id long")
    rounds, check, path = [], M.confirm, tempfile.mkdtemp()
    monkeypatch.setattr(M, "confirm", lambda *a: rounds.append(1) or check(*a))
    known = spark.createDataFrame([(8, 8), (9, 8), (900, 900), (901, 900)], "node long, component long")
    comp = M._closed(members, frame, known, 80, path)
    assert len(spark.read.parquet(f"{path}/levels").filter("level is not null").select("level").distinct().collect()) > 1
    assert len(rounds) == 1 and not [x for x in os.listdir(path) if x.startswith(("names", "merged", "again"))]
    assert {x.node: x.component for x in comp.collect()} == {8: 8, 9: 8, 900: 900, 901: 900, 10: 10, 11: 10, 12: 10}


def test_merged_components_reach_all_their_nodes(spark):
    """Links are taken as edges between components: nodes of the merged ones, linked ids without a component and all others come out right."""
    from reelmart.llm.minhash import _with_merged

    comp = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (7, 7), (8, 7)], "node long, component long")
    merged = spark.createDataFrame([(1, 0), (5, 0), (0, 0), (9, 4), (4, 4)], "node long, component long")
    got = sorted((x.node, x.component) for x in _with_merged(comp, merged).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (4, 4), (5, 0), (6, 0), (7, 7), (8, 7), (9, 4)]
    assert _with_merged(None, None) is None and _with_merged(comp, None) is comp and _with_merged(None, merged) is merged


def test_components_make_no_step_over_stars(spark):
    import os

    path = scratch_path(spark, "cc")
    df = spark.createDataFrame([(1, 5), (6, 1), (1, 6), (3, 9), (8, 8)], "u long, v long")
    assert {r.node: r.component for r in components(df, path).collect()} == {1: 1, 5: 1, 6: 1, 3: 3, 9: 3}
    assert len([x for x in os.listdir(path.removeprefix("file:")) if not x.startswith(".")]) == 1
    assert components(spark.createDataFrame([], "u long, v long"), scratch_path(spark, "cc")).count() == 0
