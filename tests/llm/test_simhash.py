import hashlib

import pytest

import numpy as np

from reelmart.llm.simhash import (BITS, PAIR_WEIGHT, WORD_WEIGHT, differing_bits, edited_fingerprints, fingerprints, likeness, near_fingerprints,
                                  near_groups, op6_simhash)
from reelmart.llm.words import LOWER, NOT_SPACE, mix, word_hashes

from .cases import edge_rows, prose


def test_equal_texts_equal_fingerprints_and_defined_cases(spark, documents, clashing):
    rows = edge_rows()
    got = [(r.doc_id, r.fingerprint) for r in fingerprints(clashing(documents(rows))).collect()]
    assert len(got) == len(rows)
    by_id = dict(got)
    assert by_id[1] == by_id[2] == by_id[3] == ""
    assert by_id[4] == by_id[5] and by_id[10] == by_id[11] == by_id[40] and len(by_id[10]) == 64
    assert by_id[10] != by_id[12]


def test_likeness(spark):
    a, b = "f" * 64, "f" * 63 + "e"
    rows = [(a, a), (a, b), (a, "0" * 64), ("", ""), (a, "")]
    from pyspark.sql import functions as F

    got = spark.createDataFrame(rows, "a string, b string").select(
        differing_bits(F.col("a"), F.col("b")).alias("d"), likeness(F.col("a"), F.col("b")).alias("l")).collect()
    assert [r.d for r in got] == [0, 1, 256, None, None]
    assert got[0].l == 1.0 and 0.99 < got[1].l < 1.0 and [r.l for r in got[2:]] == [0.0, 1.0, 0.0]


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 5)])
def test_near_fingerprints_against_brute_force(spark, radius, blocks):
    import random

    r = random.Random(3)
    prints = []
    for k in range(30):
        base = r.getrandbits(256)
        for j in range(4):
            x = base
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(256)
            prints.append((k * 10 + j, f"{x:064x}"))
    prints += [(1000, prints[0][1]), (1001, prints[0][1]), (1002, ""), (1003, "")]
    pairs, members = near_fingerprints(spark.createDataFrame(prints, "doc_id long, fingerprint string"), radius, blocks)
    first = {}
    for i, p in prints:
        if p:
            first[p] = min(i, first.get(p, i))
    assert {(m.doc_id, m.class_id) for m in members.collect()} == {(i, first[p]) for i, p in prints if p}
    want = {(min(a, b), max(a, b), d) for p, a in first.items() for q, b in first.items() if p < q
            if (d := (int(p, 16) ^ int(q, 16)).bit_count()) <= radius}
    assert {tuple(x) for x in pairs.collect()} == want


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_texts(spark, documents, parts):
    rows = [(i, t) for i, t in edge_rows() if i is not None]
    got = edited_fingerprints(documents(rows, parts)).collect()
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)


def test_query_separates_edited_from_next(spark, documents, tmp_dir):
    documents([(i, prose(i, 200)) for i in range(40)] + [(50, prose(50, 200)), (51, prose(50, 200))]).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in op6_simhash(spark, tmp_dir).collect()}
    assert min(r.near_edited for r in got.values()) > 0.3
    assert got[50].near_next == 1.0
    documents([]).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert op6_simhash(spark, tmp_dir).count() == 0
    documents([(1, "only one here")]).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert op6_simhash(spark, tmp_dir).first().near_next == 1.0


def _groups(prints, radius, blocks, reach):
    """Brute force: classes, links between all that share a table's key, smallest id reachable."""
    from itertools import combinations

    first = {}
    for i, p in prints:
        if p and i is not None:
            first[p] = min(i, first.get(p, i))
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    near = {i: i for i in first.values()}

    def root(i):
        while near[i] != i:
            i = near[i]
        return i

    for (p, a), (q, b) in combinations(first.items(), 2):
        agree = sum(p[x:y] == q[x:y] for x, y in zip(cuts, cuts[1:]))
        if agree >= blocks - radius and (int(p, 16) ^ int(q, 16)).bit_count() <= reach:
            a, b = root(a), root(b)
            near[max(a, b)] = min(a, b)
    return {(p, i, root(i)) for p, i in first.items()}


@pytest.mark.parametrize("radius,blocks,reach", [(9, 10, 24), (2, 4, 12), (3, 4, 3)])
def test_near_groups_against_brute_force(spark, radius, blocks, reach):
    import random

    r, prints = random.Random(radius), []
    for k in range(12):
        base = r.getrandbits(256)
        for j in range(14):  # steps of a walk: neighbours are near, distant ones are not
            prints.append((k * 100 + r.randrange(90) * 1000 + j, f"{base:064x}"))
            for _ in range(r.randint(0, 8)):
                base ^= 1 << r.randrange(256)
    # one hot bucket: the first block equal, stars around the smallest id, groups that it does not reach
    head = r.getrandbits(64) << 192
    for k in range(6):
        base = head | r.getrandbits(192)
        prints += [(200_000 + 10 * j + k, f"{base ^ (r.getrandbits(2) << (7 * j)):064x}") for j in range(12)]
    prints += [(5, prints[0][1]), (6, ""), (None, prints[3][1]), (None, "0" * 64), prints[9]]
    got = near_groups(spark.createDataFrame(prints, "doc_id long, fingerprint string"), radius, blocks, reach)
    assert {tuple(x) for x in got.collect()} == _groups(prints, radius, blocks, reach)


def test_query_groups_near_copies_and_nothing_else(spark, documents, tmp_dir):
    import random

    r, rows = random.Random(1), []
    for k in range(60):
        words = [f"w{r.randrange(3000)}" for _ in range(300)]
        rows.append((2 * k, " ".join(words)))
        words[r.randrange(300)] = "changed"
        rows.append((2 * k + 1, " ".join(words)))
    rows += [(500, None), (501, ""), (502, rows[0][1]), (None, rows[2][1]), (None, None)]
    documents(rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = [(x.doc_id, x.class_id, x.near_id) for x in op6_simhash(spark, tmp_dir).collect()]
    assert len(got) == len(rows)
    near = {i: n for i, _, n in got if i is not None}
    assert sum(near[2 * k + 1] == 2 * k for k in range(60)) >= 54 and all(near[2 * k] == 2 * k for k in range(60))
    assert near[500] == 500 and near[501] == 501 and near[502] == 0 and (None, 2, 2) in got and (None, None, None) in got


def test_weighted_vote_against_plain_sums(spark, documents):
    text = "one two two three one two \u00e9t\u00e9 one"
    raw = np.frombuffer(text.encode(), np.uint8)
    h, _ = word_hashes(LOWER[raw], np.array([0, len(raw)]), NOT_SPACE)
    terms = [(int(x), WORD_WEIGHT) for x in h] + [(int(x), PAIR_WEIGHT) for x in mix(h[:-1] * np.uint64(3) + h[1:])]
    sums = [0.0] * BITS
    for term, weight in set(terms):
        wide = b"".join(int(mix(np.array([(term + 0x9E3779B97F4A7C15 * (k + 1)) % 2**64], np.uint64))[0]).to_bytes(8, "little") for k in range(BITS // 64))
        for i in range(BITS):
            sums[i] += weight * (1 + np.log(terms.count((term, weight)))) * (1 if wide[i // 8] >> (7 - i % 8) & 1 else -1)
    want = bytes(sum((sums[8 * b + i] > 0) << (7 - i) for i in range(8)) for b in range(BITS // 8)).hex()
    assert fingerprints(documents([(1, text)])).first().fingerprint == want
