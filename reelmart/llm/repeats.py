"""Operator 3, suffix-array style dedup of repeated byte strings by prefix-free parsing.

Every byte that is covered by a string of ``LENGTH`` bytes which also starts in a
document with a smaller id is removed.

Parsing. A rolling hash of ``GRAM`` bytes is taken at every position. The trigger of a
string of LENGTH bytes is its gram of smallest hash (the first of equal ones), so equal
strings have the same trigger at the same offset wherever they stand. Neighbouring starts
with one trigger form a phrase; a phrase is the text of all their strings, and phrases
overlap by LENGTH - 1 bytes. Every string lies in exactly one phrase, so matches never
need two phrases joined, and the dictionary of distinct phrases (grouped by trigger) with
the parse (where each phrase stands) holds all of the text's strings. In highly
repetitive text the dictionary is much smaller than the text.

1. Trigger hashes are dealt by range; those found in one document only are dropped.
2. Documents (dealt by a hash of the row) parse again and keep phrases whose trigger is
   left. A phrase already seen in a smaller id of the same bucket is settled there; the
   first of each kind goes, with its text, to the range of its trigger.
3. In each range the dictionary is put together. A phrase that a smaller id holds whole is
   settled. Where one trigger has several phrases, all their strings (the suffixes of the
   phrases cut to LENGTH) are put in order, equal ones next to each other, and compared
   byte by byte with the first: the smallest id of each string decides.
4. The spans go back to the documents, are united and cut out.

Between the steps only packed arrays are shuffled: hashes (1), the spans, phrases of
shared triggers (3) and the texts (2, 4). A trigger that a third of all documents share
is one entry per input batch and bucket there. Any order of the strings serves, as only
equality matters here, so the order used is that of their hashes.

Defined cases: null texts count as empty; texts under LENGTH bytes lose nothing; rows of
one id are never smaller than each other; rows with a null id lose nothing and match
nothing; repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored. Ids are integers. Texts are whole, however long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowmap import visible
from .packing import pack, unpack, unpack_all
from .words import U64, buffers, mix, prefix_hash, slices, span_hash

LENGTH, GRAM = 50, 20
#: Bytes of text in a bucket of documents, and in a range of trigger hashes.
BUCKET_BYTES = 8 << 20
#: Text that is hashed at once, text whose triggers are sorted at once, and strings that are put in order at once.
_SLICE, _BATCH, _WINDOWS = 1 << 19, 8 << 20, 1 << 19
_LOW = U64(0xFFFFFFFF)


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    m, n = x, 1
    while n * 2 <= width:
        m, n = np.minimum(m[:-n], m[n:]), n * 2
    return np.minimum(m[:-(width - n)], m[width - n:]) if n < width else m


def parse(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Phrases of some documents: (trigger hash, document, first start, last start, trigger position, prefix hash).

    Starts and positions are within ``raw``.
    """
    z = np.zeros(0, np.int64)
    n = len(raw)
    if n < length:
        return np.zeros(0, U64), z, z, z, z, None
    prefix = prefix_hash(raw)
    at = np.arange(n - gram + 1)
    h = span_hash(prefix, at, at + gram)
    least = _slide_min((h & ~_LOW) | at.astype(U64), length - gram + 1)
    # starts whose string stays inside its document
    size = np.diff(offsets)
    room = np.maximum(size - length + 1, 0)
    doc = np.repeat(np.arange(len(size)), room)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room) + np.repeat(offsets[:-1], room)
    if not len(start):
        return np.zeros(0, U64), z, z, z, z, None
    trigger = (least[start] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1])])
    last = np.r_[new[1:], len(start)] - 1
    # triggers are small hashes by choice; mixed again, they fill all ranges evenly
    return mix(h[trigger[new]]), doc[new], start[new], start[last], trigger[new], prefix


def _range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of hashes, in ascending order."""
    return ((h >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def _cuts(sorted_numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, begin, end) of each run."""
    if not len(sorted_numbers):
        z = np.zeros(0, np.int64)
        return z, z, z
    begin = np.flatnonzero(np.r_[True, sorted_numbers[1:] != sorted_numbers[:-1]])
    return sorted_numbers[begin], begin, np.r_[begin[1:], len(sorted_numbers)]


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    kinds = {"range": pa.int64(), "kind": pa.int32(), "bucket": pa.int64(), "data": pa.binary()}
    return pa.table({c: pa.array([r[i] for r in rows], kinds[c]) for i, c in enumerate(names)})


_SHUFFLED = ("range", "kind", "bucket", "data")
_RETURNED = ("bucket", "data")


def _trigger_rows(h: np.ndarray, row: np.ndarray, buckets: int, ranges: int) -> list[tuple]:
    """Step 1 of a batch: an entry per hash for its range, and hashes of two documents straight back to their buckets."""
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    if not len(h):
        return []
    begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    lo, hi = np.minimum.reduceat(row, begin), np.maximum.reduceat(row, begin)
    several = lo != hi
    kinds = h[begin]
    home = np.where(several, -1, np.mod(lo, buckets)).astype(np.int32)
    out = [(int(r), 0, None, pack(kinds[a:b], home[a:b])) for r, a, b in zip(*_cuts(_range_of(kinds, ranges)))]
    inside = np.repeat(several, np.diff(np.r_[begin, len(h)]))
    back, hash_ = np.mod(row[inside], buckets), h[inside]
    order = np.lexsort((hash_, back))
    back, hash_ = back[order], hash_[order]
    for b, a, z in zip(*_cuts(back)):
        out.append((int(b) % ranges, 1, int(b), pack(np.unique(hash_[a:z]))))
    return out


def _shared_triggers(table: pa.Table) -> list[tuple]:
    """Step 1 of a range: hashes of two documents or more, for the buckets that gave them."""
    kind, bucket, data = (table[c].to_pylist() for c in ("kind", "bucket", "data"))
    out = [(b, d) for k, b, d in zip(kind, bucket, data) if k == 1]
    h, home = unpack_all([d for k, d in zip(kind, data) if k == 0], U64, np.int32)
    order = np.argsort(h, kind="stable")
    h, home = h[order], home[order]
    _, begin, end = _cuts(h)
    if len(h):
        shared = (end - begin > 1) | (home[begin] < 0)
        keep = np.repeat(shared, end - begin) & (home >= 0)
        h, home = h[keep], home[keep]
        order = np.lexsort((h, home))
        h, home = h[order], home[order]
        out += [(int(b), pack(h[a:z])) for b, a, z in zip(*_cuts(home.astype(np.int64)))]
    return out


def _gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all spans, end to end."""
    total = int(size.sum())
    at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    return raw[at]


def _unite(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return start[new], end[np.r_[new[1:], len(start)] - 1]


def _phrase_rows(docs: list[tuple], shared: np.ndarray, bucket: int, ranges: int, length: int, gram: int) -> list[tuple]:
    """Step 2 of a bucket. docs: (ids, has id, rows, offsets, bytes)."""
    got: list[list] = [[] for _ in range(7)]
    pieces: list[_Piece] = []
    slots = _slots(docs)
    for ids, has, rows, offsets, raw in docs:
        for a, b in slices(offsets, _SLICE):
            cut = offsets[a:b + 1] - offsets[a]
            part = raw[offsets[a]:offsets[b]]
            h, doc, first, last, trigger, prefix = parse(part, cut, length, gram)
            if not len(h) or not len(shared):
                continue
            at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
            keep = (shared[at] == h) & has[a:b][doc]
            h, doc, first, last, trigger = (x[keep] for x in (h, doc, first, last, trigger))
            if not len(h):
                continue
            size = last - first + length
            content = _content(prefix, first, size, trigger - first)
            for x, v in zip(got, (h, content, ids[a:b][doc], np.searchsorted(slots, rows[a:b][doc]), first - cut[doc], last - first + 1, trigger - first)):
                x.append(v)
            pieces.append(_Piece(part, first, size))
    if not pieces:
        return []
    h, content, ids, slot, first, windows, lead = (np.concatenate(x) for x in got)
    piece = np.repeat(np.arange(len(pieces)), [len(p.start) for p in pieces])
    within = np.concatenate([np.arange(len(p.start)) for p in pieces])
    order = np.lexsort((ids, content, h))
    h, content, ids, slot, first, windows, lead, piece, within = (x[order] for x in (h, content, ids, slot, first, windows, lead, piece, within))
    begin = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (content[1:] != content[:-1])])
    group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(h)]))
    later = ids > ids[begin][group]
    out = []
    if later.any():  # settled: a smaller id of this bucket has the whole phrase
        out.append((bucket % ranges, 1, bucket, _spans_blob(slot[later], first[later], first[later] + windows[later] + length - 1)))
    # first of its kind: text and places to the range of the trigger
    text = [pieces[p].bytes(w) for p, w in zip(piece[begin].tolist(), within[begin].tolist())]
    g_range = _range_of(h[begin], ranges)
    mine = ~later
    o_group, o_slot, o_first = group[mine], slot[mine], first[mine]
    for r, a, z in zip(*_cuts(g_range)):
        lo, hi = np.searchsorted(o_group, [a, z])
        gb = begin[a:z]
        out.append((int(r), 0, bucket, pack(
            h[gb], ids[gb], windows[gb].astype(np.int32), lead[gb].astype(np.int32), np.frombuffer(b"".join(text[a:z]), np.uint8),
            (o_group[lo:hi] - a).astype(np.int32), o_slot[lo:hi].astype(np.int32), o_first[lo:hi].astype(np.int64))))
    return out


def _slots(docs: list[tuple]) -> np.ndarray:
    """The rows of a bucket in order; a row's place there names it inside the bucket."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(d[2] for d in docs)]))


def _content(prefix: np.ndarray, first: np.ndarray, size: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Hash of a phrase's text and of where its trigger stands in it."""
    return span_hash(prefix, first, first + size) + mix(lead.astype(U64))


class _Piece:
    """Phrase texts of one slice, cut out when wanted."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.raw, self.start, self.size = raw, start.tolist(), size.tolist()

    def bytes(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.start[i] + self.size[i]].tobytes()


def _spans_blob(slots: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """Spans by slot, those of one slot united."""
    order = np.lexsort((start, slots))
    slots, start, end = slots[order], start[order], end[order]
    r, s, e = [], [], []
    for slot, a, z in zip(*_cuts(slots)):
        x, y = _unite(start[a:z], end[a:z])
        r.append(np.full(len(x), slot, np.int64))
        s.append(x)
        e.append(y - x)
    cat = lambda v: np.concatenate([np.zeros(0, np.int64), *v])
    return pack(cat(r), cat(s), cat(e))


def _string_runs(h, lead, windows, ids, raw, begin, length):
    """Step 3, several phrases to a trigger: (phrase, first window, last window) runs of strings that a smaller id has."""
    phrase = np.repeat(np.arange(len(h)), windows)
    j = np.arange(len(phrase)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = begin[phrase] + j
    key = mix(span_hash(prefix_hash(raw), start, start + length) + mix(h[phrase] + (lead[phrase] - j).astype(U64)))
    order = np.lexsort((ids[phrase], key))
    k = key[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    head = np.repeat(head, np.diff(np.r_[head, len(k)]))
    first = order[head]
    gone = ids[phrase[first]] < ids[phrase[order]]
    at = np.flatnonzero(gone)
    same = np.ones(len(at), bool)
    for c in range(length):  # byte by byte against the first of the equal ones
        same &= raw[start[order[at]] + c] == raw[start[first[at]] + c]
    removed = np.zeros(len(phrase), bool)
    removed[order[at[same]]] = True
    on = np.flatnonzero(removed)
    if not len(on):
        return on, on, on
    new = np.flatnonzero(np.r_[True, (np.diff(on) > 1) | (phrase[on[1:]] != phrase[on[:-1]])])
    last = np.r_[new[1:], len(on)] - 1
    return phrase[on[new]], j[on[new]], j[on[last]]


def _dictionary_rows(table: pa.Table, length: int) -> list[tuple]:
    """Step 3 of a range: spans for the buckets."""
    kind, bucket, data = (table[c].to_pylist() for c in ("kind", "bucket", "data"))
    out = [(b, d) for k, b, d in zip(kind, bucket, data) if k == 1]
    parts = [unpack(d, U64, np.int64, np.int32, np.int32, np.uint8, np.int32, np.int32, np.int64) for k, d in zip(kind, data) if k == 0]
    if not parts:
        return out
    h, ids, windows, lead, raw = (np.concatenate([p[i] for p in parts]) for i in range(5))
    shift = np.cumsum([0, *(len(p[0]) for p in parts)])
    o_group = np.concatenate([p[5] + s for p, s in zip(parts, shift)])
    o_slot, o_first = (np.concatenate([p[i] for p in parts]) for i in (6, 7))
    o_home = np.repeat([b for k, b in zip(kind, bucket) if k == 0], [len(p[5]) for p in parts])
    windows, lead = windows.astype(np.int64), lead.astype(np.int64)
    size = windows + length - 1
    begin = np.cumsum(size) - size
    content = _content(prefix_hash(raw), begin, size, lead)
    order = np.lexsort((ids, content, h))
    sh, sc = h[order], content[order]
    kind_begin = np.flatnonzero(np.r_[True, (sh[1:] != sh[:-1]) | (sc[1:] != sc[:-1])])
    kind_of = np.repeat(np.arange(len(kind_begin)), np.diff(np.r_[kind_begin, len(sh)]))
    first_id = ids[order[kind_begin]]
    later = np.zeros(len(h), bool)
    later[order] = ids[order] > first_id[kind_of]
    g, a, z = [np.flatnonzero(later)], [np.zeros(int(later.sum()), np.int64)], [windows[later] - 1]
    kind_no = np.zeros(len(h), np.int64)
    kind_no[order] = kind_of
    # one phrase of each kind, where its trigger has several kinds
    rep = order[kind_begin]
    _, tb, te = _cuts(h[rep])
    some = np.repeat(te - tb > 1, te - tb)
    rep = rep[some]
    total = np.cumsum(windows[rep])
    lo = 0
    while lo < len(rep):  # whole triggers at a time, about _WINDOWS strings
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + _WINDOWS, side="right"))
        hi = min(max(hi, lo + 1), len(rep))
        while hi < len(rep) and h[rep[hi]] == h[rep[hi - 1]]:
            hi += 1
        part = rep[lo:hi]
        text = _gather(raw, begin[part], size[part])
        p, x, y = _string_runs(h[part], lead[part], windows[part], ids[part], text, np.cumsum(size[part]) - size[part], length)
        # every phrase of that kind and of the same first id stands for its representative
        same = np.flatnonzero(~later & np.isin(kind_no, kind_no[part[p]])) if len(p) else np.zeros(0, np.int64)
        by_kind = np.argsort(kind_no[same], kind="stable")
        same = same[by_kind]
        left, right = np.searchsorted(kind_no[same], kind_no[part[p]]), np.searchsorted(kind_no[same], kind_no[part[p]], side="right")
        n = right - left
        pick = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
        g.append(same[pick])
        a.append(np.repeat(x, n))
        z.append(np.repeat(y, n))
        lo = hi
    g, a, z = np.concatenate(g), np.concatenate(a), np.concatenate(z)
    # to every place of the phrase
    by = np.argsort(o_group, kind="stable")
    o_group, o_slot, o_first, o_home = o_group[by], o_slot[by], o_first[by], o_home[by]
    left, right = np.searchsorted(o_group, g), np.searchsorted(o_group, g, side="right")
    n = right - left
    pick = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
    slot, start, end = o_slot[pick].astype(np.int64), o_first[pick] + np.repeat(a, n), o_first[pick] + np.repeat(z, n) + length
    home = o_home[pick]
    order = np.argsort(home, kind="stable")
    slot, start, end, home = slot[order], start[order], end[order], home[order]
    out += [(int(b), _spans_blob(slot[x:y], start[x:y], end[x:y])) for b, x, y in zip(*_cuts(home))]
    return out


_DOC = (np.int64, np.bool_, np.int64, np.int64, np.uint8)


def _packed_documents(src: DataFrame, buckets: int) -> DataFrame:
    """(bucket, data): documents of a batch, by bucket."""
    def run(batches):
        for batch in batches:
            raw, offsets = buffers(batch.column(2))
            has = np.asarray(batch.column(0).is_valid())
            ids = batch.column(0).fill_null(0).to_numpy()
            rows = batch.column(1).to_numpy()
            home = np.mod(rows, buckets)
            order = np.argsort(home, kind="stable")
            out = []
            for b, a, z in zip(*_cuts(home[order])):
                d = order[a:z]
                size = offsets[d + 1] - offsets[d]
                out.append((int(b), pack(ids[d], has[d], rows[d], np.r_[0, np.cumsum(size)], _gather(raw, offsets[d], size))))
            yield from _rows(out, _RETURNED).to_batches()

    return src.mapInArrow(run, "bucket long, data binary")


def _by_bucket(docs: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    return docs.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(fn, schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_bytes, spans, kept): maximal removed runs (start, end) in bytes, and the bytes that are left."""
    visible(docs.sparkSession)
    if not 0 < gram <= length:
        raise ValueError("0 < gram <= length is needed")
    id_, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    src = docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("row"), text.alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = ranges = max(1, math.ceil(total / bucket_bytes))
    shuffled = "`range` long, kind int, bucket long, data binary"

    def triggers(batches):
        for batch in batches:
            raw, offsets = buffers(batch.column(2))
            has, rows = np.asarray(batch.column(0).is_valid()), batch.column(1).to_numpy()
            for lo, hi in slices(offsets, _BATCH):
                hs, rs = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
                for a, b in slices(offsets[lo:hi + 1] - offsets[lo], _SLICE):
                    a, b = a + lo, b + lo
                    h, doc, *_ = parse(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], length, gram)
                    known = has[a:b][doc]
                    hs.append(h[known])
                    rs.append(rows[a:b][doc[known]])
                yield from _rows(_trigger_rows(np.concatenate(hs), np.concatenate(rs), buckets, ranges), _SHUFFLED).to_batches()

    def shared(table: pa.Table) -> pa.Table:
        return _rows(_shared_triggers(table), _RETURNED)

    def phrases(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([], _SHUFFLED)
        known = np.unique(unpack_all(right["data"].to_pylist(), U64)[0])
        parsed = [unpack(d, *_DOC) for d in left["data"].to_pylist()]
        return _rows(_phrase_rows(parsed, known, left["bucket"][0].as_py(), ranges, length, gram), _SHUFFLED)

    def dictionary(table: pa.Table) -> pa.Table:
        return _rows(_dictionary_rows(table, length), _RETURNED)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        slot, start, size = unpack_all(right["data"].to_pylist(), np.int64, np.int64, np.int64)
        order = np.argsort(slot, kind="stable")
        slot, start, size = slot[order], start[order], size[order]
        out: list[tuple] = []
        docs = [unpack(d, *_DOC) for d in left["data"].to_pylist()]
        slots = _slots(docs)
        for ids, has, rows, offsets, raw in docs:
            mine = np.searchsorted(slots, rows)
            lo, hi = np.searchsorted(slot, mine), np.searchsorted(slot, mine, side="right")
            for i in range(len(rows)):
                text_ = raw[offsets[i]:offsets[i + 1]]
                s, e = _unite(start[lo[i]:hi[i]], start[lo[i]:hi[i]] + size[lo[i]:hi[i]])
                if len(s):
                    edge = np.r_[0, np.stack([s, e], 1).ravel(), len(text_)]
                    kept = b"".join(text_[x:y].tobytes() for x, y in edge.reshape(-1, 2).tolist())
                else:
                    kept = text_.tobytes()
                out.append((int(ids[i]) if has[i] else None, len(text_), [{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())], kept))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": pa.array([o[0] for o in out], pa.int64()), "n_bytes": pa.array([o[1] for o in out], pa.int64()),
                         "spans": pa.array([o[2] for o in out], span), "kept": pa.array([o[3] for o in out], pa.binary())})

    left = src.mapInArrow(triggers, shuffled).groupBy("range").applyInArrow(shared, "bucket long, data binary")
    found = _by_bucket(_packed_documents(src, buckets), left, phrases, shuffled)
    spans = found.groupBy("range").applyInArrow(dictionary, "bucket long, data binary")
    schema = "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return _by_bucket(_packed_documents(src, buckets), spans, cut, schema).withColumnRenamed("id", id_col)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what is removed from every document, as digests."""
    r = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return r.select("doc_id", "n_bytes",
                    F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
