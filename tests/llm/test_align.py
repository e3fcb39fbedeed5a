import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmart.llm import align as A

from .cases import edge_rows


def _plain(ea, eb):
    """Groups and overlapping pairs from the sets of ends."""
    groups, links, i, j = [], [], 0, 0
    common = sorted(set(ea) & set(eb))
    for end in common:
        x, y = ea.index(end) + 1, eb.index(end) + 1
        groups.append((range(i, x), range(j, y)))
        i, j = x, y
    for x, (s, e) in enumerate(zip([0, *ea], ea)):
        for y, (t, f) in enumerate(zip([0, *eb], eb)):
            if max(s, t) < min(e, f):
                links.append((x, y))
    return groups, links


def test_runs_and_groups_equal_sets_of_ends():
    r = random.Random(3)
    for _ in range(300):
        n = r.randrange(1, 60)
        ea = sorted({*r.sample(range(1, n + 1), r.randrange(0, n)), n})
        eb = sorted({*(ea if r.random() < 0.7 else []), *r.sample(range(1, n + 1), r.randrange(0, n // 4 + 1)), n} - set(r.sample(range(1, n), r.randrange(0, n // 6 + 1)) if n > 1 else []))
        run_a, run_b, run_n, odd_a, odd_b, la, lb = A.align(ea, eb)
        groups, links = _plain(ea, eb)
        starts = sorted([(a + k, b + k) for a, b, m in zip(run_a, run_b, run_n) for k in range(m)] + list(zip(odd_a, odd_b)))
        assert starts == [(g[0][0], g[1][0]) for g in groups]
        assert sorted([(a + k, b + k) for a, b, m in zip(run_a, run_b, run_n) for k in range(m)] + list(zip(la, lb))) == sorted(links)


def test_one_to_one_stretches_are_jumped():
    class Counted(list):
        looks = 0

        def __getitem__(self, k):
            Counted.looks += 1
            return list.__getitem__(self, k)

    ends = list(range(1, 100_001))
    out = A.align(Counted(ends), Counted(ends))
    assert out[:3] == ([0], [0], [100_000]) and Counted.looks < 120


@pytest.fixture(scope="module")
def tools():
    return A.tokenizers_of(*A.default_paths())


def test_fast_and_library_encodings_agree(tools):
    a = tools[0]
    r = random.Random(9)
    texts = [" " + "".join(chr(c) for c in range(k, min(k + 24, 0x240))) for k in range(0, 0x240, 24)]
    texts += [" " + "".join(chr(c) + chr(d) for d in (0x20, 0x41, 0x31, 0x21, 0x0A)) for c in range(0x240)]
    texts += ["".join(chr(r.choice([r.randrange(0x240), r.randrange(32, 127), 32, 10])) for _ in range(r.randrange(1, 200))) for _ in range(500)]
    texts += [" <|endoftext|> x", " " * 3000 + "x", " " + "a" * 5000, " don't I'LL we're", "\n" * 500 + "\t\r\n \x85\xa0"]
    assert a.fast is not None
    fast = [list(x) for x in a.encode(texts, [True] * len(texts))]
    assert fast == [list(x) for x in a.encode(texts, [False] * len(texts))]


def _brute(rows, tools):
    a, b = tools[0], tools[1]
    held, of_pair = [], defaultdict(int)
    for doc_id, text in rows:
        ids = None
        if text:
            ia, ib = list(a.slow.encode(" " + text, add_special_tokens=False).ids), b.encode([text])[0]
            want = (" " + text).encode()
            if b"".join(a.bytes[i] for i in ia) == want == b"".join(b.bytes[i] for i in ib):
                groups, links, s, t, i, j, ea, eb = [], Counter(), 0, 0, 0, 0, 0, 0
                ga, gb = [], []
                while i < len(ia) or j < len(ib):  # byte by byte through the next token end
                    if ea <= eb and i < len(ia):
                        ea, i = ea + len(a.bytes[ia[i]]), i + 1
                        ga.append(i - 1)
                    else:
                        eb, j = eb + len(b.bytes[ib[j]]), j + 1
                        gb.append(j - 1)
                    if ea == eb:
                        groups.append((ga, gb))
                        ga, gb = [], []
                ends_a, ends_b = np.cumsum([len(a.bytes[x]) for x in ia]), np.cumsum([len(b.bytes[x]) for x in ib])
                for end in sorted({*ends_a.tolist(), *ends_b.tolist()}):  # every piece between ends is one overlap
                    links[ia[int(np.searchsorted(ends_a, end))], ib[int(np.searchsorted(ends_b, end))]] += 1
                ids = (len(ia), len(ib), groups, links, ia, ib)
                for p in links:
                    of_pair[p] += 1
        held.append((doc_id, ids))
    top = defaultdict(int)
    for (x, _), n in of_pair.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, ids in held:
        if ids is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links, ia, ib = ids
        spelt = ";".join(",".join(str(ia[i]) for i in x) + "|" + ",".join(str(ib[j]) for j in y) for x, y in groups)
        out.append((doc_id, na, nb, len(groups), sum(links.values()), sum(c for p, c in links.items() if of_pair[p] == top[p[0]]),
                    sum(of_pair[p] * c for p, c in links.items()), hashlib.sha256(spelt.encode()).hexdigest()))
    return sorted(map(str, out))


def _got(df):
    return sorted(str((r[0], r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect())


ROWS = edge_rows() + [(700, "x▁y"), (701, "<s>a</s> <0x41> <unk>"), (702, "Straße über ça été, niño! 漢字 \U0001F600\U0001F468"), (703, "͸ unassigned"),
                      (704, "tab\there\r\n  two  spaces \xa0end "), (705, " lead"), (706, "ﬁ é é")]


def test_query_equals_brute_force(spark, documents, tmp_path, tools):
    documents(ROWS, 4).write.parquet(str(tmp_path / "documents.parquet"))
    assert _got(A.op12_align(spark, str(tmp_path))) == _brute(ROWS, tools)


def test_many_small_slices_and_clashing_columns(spark, documents, clashing, tools):
    df = clashing(documents(ROWS)).withColumns({c: F.lit("mine") for c in ("slice", "pair", "n_a", "links", "table", "best")})
    aligned = A.align_documents(df, slice_bytes=500)
    assert aligned.select("slice").distinct().count() > 20
    assert _got(A.with_counts(aligned, A.pair_counts(aligned))) == _brute(ROWS, tools)


def test_empty_tables(spark, documents):
    aligned = A.align_documents(documents([]))
    assert A.with_counts(aligned, A.pair_counts(aligned)).collect() == []
    aligned = A.align_documents(documents([(1, None), (2, "")]))
    assert _got(A.with_counts(aligned, A.pair_counts(aligned))) == ["(1, 0, 0, 0, 0, 0, 0, '')", "(2, 0, 0, 0, 0, 0, 0, '')"]
