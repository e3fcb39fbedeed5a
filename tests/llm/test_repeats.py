import hashlib
import random
import re

import numpy as np
import pytest

from reelmart.llm.packing import pack, unpack, unpack_all
from reelmart.llm.repeats import op3_repeats, repeated_spans

from .cases import edge_rows, prose


def _brute(rows, length=50):
    """Strings judged on the input: covered by one that also starts in a smaller id."""
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, x in data:
        if i is not None:
            for a in range(len(x) - length + 1):
                w = x[a:a + length]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, x in data:
        mask = bytearray(len(x))
        for a in range(len(x) - length + 1):
            if i is not None and first[x[a:a + length]] < i:
                mask[a:a + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(mask))]
        out.append((str(i), len(x), spans, bytes(c for c, m in zip(x, mask) if not m)))
    return sorted(out)


def _rows():
    r = random.Random(4)
    rows = [(i, t) for i, t in edge_rows() if i not in (20, 21)] + [(20, prose(99, 3000)), (21, "x" + prose(99, 3000) + " tail")]
    passages = [prose(800 + k, 30) for k in range(5)]
    for i in range(60):
        cut = [p[r.randrange(20):len(p) - r.randrange(20)] for p in r.sample(passages, 2)]
        rows.append((300 + i, prose(900 + i, 15) + cut[0] + prose(1000 + i, r.randrange(4)) + cut[1]))
    rows += [(500, "é" * 60), (501, "zé" + "é" * 40), (502, "q" * 49), (503, "q" * 49), (504, "r" * 50), (505, "r" * 51), (506, "ab" * 40), (507, "b" + "ab" * 30)]
    return rows


@pytest.mark.parametrize("bucket_bytes,length,gram", [(1 << 20, 50, 20), (2000, 50, 20), (5000, 30, 8)])
def test_against_brute_force(spark, documents, clashing, bucket_bytes, length, gram):
    rows = _rows()
    got = repeated_spans(clashing(documents(rows)), length=length, gram=gram, bucket_bytes=bucket_bytes).collect()
    have = sorted((str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got)
    assert have == _brute(rows, length)


def test_query_digests_and_empty_table(spark, documents, tmp_dir):
    long = prose(5, 40)
    documents([(1, long), (2, "new start " + long), (3, None)]).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in op3_repeats(spark, tmp_dir).collect()}
    assert (got[1].n_removed, got[1].n_spans, got[1].kept_sha256) == (0, 0, hashlib.sha256(long.encode()).hexdigest())
    assert (got[2].n_removed, got[2].n_spans, got[2].kept_sha256) == (len(long.encode()), 1, hashlib.sha256(b"new start ").hexdigest())
    assert (got[3].n_bytes, got[3].n_removed, got[3].kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
    documents([]).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    assert op3_repeats(spark, tmp_dir).count() == 0


def test_packing_round_trip():
    r = np.random.default_rng(2)
    arrays = [r.integers(0, 2**63, 100, dtype=np.uint64), r.integers(-2**62, 2**62, 7), np.zeros(0, np.int32), r.integers(0, 255, 33).astype(np.uint8), np.array([True, False])]
    kinds = [np.uint64, np.int64, np.int32, np.uint8, np.bool_]
    for a, b in zip(arrays, unpack(pack(*arrays), *kinds)):
        assert a.dtype == b.dtype and (a == b).all()
    assert [len(x) for x in unpack_all([], np.uint64, np.int32)] == [0, 0]
