"""Operator 12, cross-tokenizer alignment by diagonal run skipping.

``align_documents`` encodes every text by two tokenizers, A (byte-level BPE) and B (pieces
with byte fallback; it puts a space before the text, so A gets space + text), and cuts the
tokens into groups wherever tokens of both end at the same byte. ``align`` works on the two
arrays of token ends: while the ends agree at the current index shift it probes ahead with
doubling, then halving, lengths and so jumps whole one-to-one stretches; where they differ
it walks the two arrays to their next common end, notes the overlapping pairs on the way
and goes on at the new shift. Documents end in both arrays, so a slice of many documents is
one pair of arrays.

``pair_counts`` counts in how many documents each linked id pair stands. Tasks work in
slices of whole documents (about ``SLICE_BYTES``): a slice emits its distinct pairs once,
with their document counts, so only (slice, pair) rows are shuffled, never links. The totals
come back to each slice the same way, and ``with_counts`` adds up links of documents from
the slice's own table. The one thing broadcast is the highest count of each A id, at most
one row an entry of the vocabulary. A pair that stands everywhere is one row a slice.

Text below U+0240 is encoded for A by tiktoken with the same vocabulary and word pattern (a
vocabulary whose ids are not in merge order is left to the tokenizers library, as are other
texts, whose character classes depend on the library's Unicode tables); a test holds the two
equal. Tokenizer paths are parameters.

Defined cases: a text that is null, empty, or not given back byte for byte by A's and B's
token bytes has no tokens: zeros and an empty ``groups_sha256``; equal texts and repeated
rows count once each as documents; a document of any length is read whole; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from reelmart.session import scratch_path

from .arrowmap import visible
from .packing import pack, unpack
from .words import buffers, slices

SLICE_BYTES = 8 << 20  # documents that share a table of pairs
STEP_BYTES = 1 << 20  # documents encoded and aligned at once
#: FIXED VALUE: the word pattern of byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LEAD_LIMIT = 0xC9  # lead byte of U+0240; all lower code points have lower bytes
_PAIR_SHIFT = 24  # pair = A id << 24 | B id
_DOC_SHIFT = 48  # A ids are below 2**24, and a step has fewer than 2**15 documents


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each visible character of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteTokenizer:
    """Tokenizer A: ids of texts (special strings as plain text) and the bytes of each id."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_padding()
        self.slow.no_truncation()
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_of_symbol()
        self.bytes: list[bytes] = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        special = {t["content"] for t in spec["added_tokens"]}
        for entry, i in spec["model"]["vocab"].items():
            self.bytes[i] = entry.encode() if entry in special else bytes(byte[c] for c in entry)
        self.fast = self._fast(spec, special)

    def _fast(self, spec: dict, special: set[str]):
        """tiktoken over the same vocabulary, if ids follow the order of the merges."""
        vocab = spec["model"]["vocab"]
        pre = spec.get("pre_tokenizer") or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ids = [vocab.get(a + b, -1) for a, b in merges]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
        if not plain or ids != list(range(256, 256 + len(ids))):
            return None
        import tiktoken

        ranks = {self.bytes[i]: i for entry, i in vocab.items() if entry not in special}
        return tiktoken.Encoding("byte-level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str], simple: list[bool]) -> list:
        """Ids of each text, as an array or list."""
        out: list = [None] * len(texts)
        for i, t in enumerate(texts):
            if simple[i] and self.fast is not None:
                out[i] = self.fast.encode_to_numpy(t, disallowed_special=())
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.slow.encode_batch([texts[i] for i in rest], add_special_tokens=False) if rest else ()):
            out[i] = e.ids
        return out


class PieceTokenizer:
    """Tokenizer B: sentencepiece ids and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Bytes:
    """The bytes of all entries of a table in one array."""

    def __init__(self, table: list[bytes]) -> None:
        self.size = np.array([len(x) for x in table], np.int64)
        self.start = np.r_[0, np.cumsum(self.size)[:-1]]
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def same(self, tokens: np.ndarray, counts: np.ndarray, want: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Whether each document's tokens spell its bytes ``want[cuts[i]:cuts[i + 1]]``."""
        doc = np.repeat(np.arange(len(counts)), counts)
        size = self.size[tokens]
        good = np.bincount(doc, size, len(counts)).astype(np.int64) == np.diff(cuts)
        keep = good[doc]
        spelt = self.data[_expand(self.start[tokens[keep]], size[keep])]
        at = _expand(cuts[:-1][good], np.diff(cuts)[good])
        wrong = np.searchsorted(cuts, at[spelt != want[at]], side="right") - 1
        good[wrong] = False
        return good


@lru_cache(maxsize=4)
def tokenizers_of(path_a: str, path_b: str) -> tuple[ByteTokenizer, PieceTokenizer, Bytes, Bytes, Bytes]:
    """Both tokenizers, the bytes of their ids, and the four spellings of ids in a digest: ``a,`` ``a|`` ``b,`` ``b;``."""
    a, b = ByteTokenizer(path_a), PieceTokenizer(path_b)
    spelled = [b"%d%s" % (i, mark) for table, marks in ((a, (b",", b"|")), (b, (b",", b";"))) for mark in marks for i in range(len(table.bytes))]
    return a, b, Bytes(a.bytes), Bytes(b.bytes), Bytes(spelled)


def align(ea: list[int], eb: list[int]) -> tuple[list, list, list, list, list, list, list]:
    """One-to-one runs and irregular groups of two ascending lists of ends with the same last end.

    (run starts in a, in b, run lengths, group starts in a, in b, overlapping pairs of the
    irregular groups as positions in a and in b).
    """
    run_a, run_b, run_n, odd_a, odd_b, link_a, link_b = [], [], [], [], [], [], []
    i = j = 0
    n = len(ea)
    while i < n:
        x, y = ea[i], eb[j]
        if x == y:
            p, q, step = i + 1, j + 1, 1
            while (some := ea[p:p + step]) and some == eb[q:q + step]:
                p += len(some)
                q += len(some)
                step += step
            while step > 1:
                step >>= 1
                if (some := ea[p:p + step]) and some == eb[q:q + step]:
                    p += len(some)
                    q += len(some)
            run_a.append(i)
            run_b.append(j)
            run_n.append(p - i)
            i, j = p, q
            if i == n:
                break
            x, y = ea[i], eb[j]
        odd_a.append(i)
        odd_b.append(j)
        while True:
            link_a.append(i)
            link_b.append(j)
            if x < y:
                i += 1
                x = ea[i]
            elif y < x:
                j += 1
                y = eb[j]
            else:
                break
        i += 1
        j += 1
    return run_a, run_b, run_n, odd_a, odd_b, link_a, link_b


def _expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All members of the ranges [start, start + length)."""
    return np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())


class Step:
    """Alignment of some whole documents."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, tools) -> None:
        a, b, bytes_a, bytes_b, spelled = tools
        n = len(offsets) - 1
        docs = np.flatnonzero(offsets[1:] > offsets[:-1])  # an empty text has no tokens
        wide = np.r_[0, np.cumsum(raw >= _LEAD_LIMIT)]
        simple = (wide[offsets[1:]] == wide[offsets[:-1]])[docs].tolist()
        # the documents as " " + text, end to end
        want = np.insert(raw, offsets[docs], 0x20)
        cuts = np.r_[offsets[docs], offsets[-1]] + np.arange(len(docs) + 1)
        data = want.tobytes()
        text = [data[s:e].decode() for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        both = []
        for ids, table in ((a.encode(text, simple), bytes_a), (b.encode([t[1:] for t in text]), bytes_b)):
            count = np.array([len(x) for x in ids], np.int64)
            token = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in ids)])
            both.append((token, count, table.same(token, count, want, cuts)))
        (token_a, count_a, good), (token_b, count_b, good_b) = both
        good &= good_b
        token_a, token_b = token_a[np.repeat(good, count_a)], token_b[np.repeat(good, count_b)]
        docs, count_a, count_b = docs[good], count_a[good], count_b[good]
        run_a, run_b, run_n, odd_a, odd_b, link_a, link_b = (
            np.array(x, np.int64) for x in align(np.cumsum(bytes_a.size[token_a]).tolist(), np.cumsum(bytes_b.size[token_b]).tolist()))
        one_a, one_b = _expand(run_a, run_n), _expand(run_b, run_n)
        first_a, first_b = np.sort(np.r_[one_a, odd_a]), np.sort(np.r_[one_b, odd_b])  # groups, in order
        link_a, link_b = np.r_[one_a, link_a], np.r_[one_b, link_b]
        doc_a = np.repeat(np.arange(len(docs)), count_a)
        zeros = np.zeros((4, n), np.int64)
        zeros[0, docs], zeros[1, docs] = count_a, count_b
        zeros[2, docs] = np.bincount(doc_a[first_a], minlength=len(docs))
        zeros[3, docs] = np.bincount(doc_a[link_a], minlength=len(docs))
        self.n_a, self.n_b, self.n_groups, self.n_links = zeros
        # distinct pairs of each document, and how often it links them
        key = (docs[doc_a[link_a]] << _DOC_SHIFT) | (token_a[link_a] << _PAIR_SHIFT) | token_b[link_b]
        key, self.times = np.unique(key, return_counts=True)
        self.pair = key & ((1 << _DOC_SHIFT) - 1)
        self.n_pairs = np.bincount(key >> _DOC_SHIFT, minlength=n)
        self.digests = [""] * n
        self._spell(docs, token_a, token_b, first_a, first_b, count_a, count_b, spelled, len(a.bytes), len(b.bytes))

    def _spell(self, docs, token_a, token_b, first_a, first_b, count_a, count_b, spelled, all_a, all_b) -> None:
        """Digests of ``a1,a2|b1;a3|b2,b3``: every group's A ids, then its B ids, each id with the mark behind it."""
        end_a, end_b = np.append(first_a, len(token_a))[1:], np.append(first_b, len(token_b))[1:]
        n_a, n_b = end_a - first_a, end_b - first_b
        flat = np.empty(len(token_a) + len(token_b), np.int64)
        mark = token_a.copy()
        mark[end_a - 1] += all_a
        flat[np.arange(len(token_a)) + np.repeat(first_b, n_a)] = mark
        mark = token_b + 2 * all_a
        mark[end_b - 1] += all_b
        flat[np.arange(len(token_b)) + np.repeat(end_a, n_b)] = mark
        size = spelled.size[flat]
        text = spelled.data[_expand(spelled.start[flat], size)].tobytes()
        cuts = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(count_a + count_b)]].tolist()
        for d, i, j in zip(docs.tolist(), cuts, cuts[1:]):
            self.digests[d] = hashlib.sha256(text[i:j - 1]).hexdigest()


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
                    slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Two kinds of rows, stored: a document (``id``, counts, ``groups_sha256``, ``links``: its distinct pairs as places in the
    slice's table, with how often each is linked) and a slice (``table``: its distinct pairs with their document counts)."""
    spark = docs.sparkSession
    visible(spark)
    a, b = default_paths()
    paths = (path_a or a, path_b or b)
    schema = StructType([StructField("slice", StringType()), StructField("id", docs.select(id_col).schema[0].dataType),
                         *[StructField(c, LongType()) for c in _COUNTS], StructField("groups_sha256", StringType()),
                         StructField("links", BinaryType()), StructField("table", BinaryType())])
    arrow = to_arrow_schema(schema)

    def emit(name: str, ids: list[pa.Array], steps: list[Step]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([s.pair for s in steps])
        times = np.concatenate([s.times for s in steps]).astype(np.uint32)
        cuts = np.r_[0, np.cumsum(np.concatenate([s.n_pairs for s in steps]))].tolist()
        pairs, place, count = np.unique(every, return_inverse=True, return_counts=True)
        place = place.astype(np.uint32)
        links = [pack(np.diff(place[i:j], prepend=np.uint32(0)), times[i:j]) if j > i else None for i, j in zip(cuts, cuts[1:])]
        columns = [pa.array([name] * len(links)), pa.concat_arrays(ids).cast(arrow.field("id").type)]
        columns += [pa.array(np.concatenate([getattr(s, c) for s in steps])) for c in _COUNTS]
        columns += [pa.array([d for s in steps for d in s.digests]), pa.array(links, pa.binary()), pa.nulls(len(links), pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if len(pairs):
            row = {"slice": name, "table": pack(pairs, count.astype(np.int64))}
            yield pa.RecordBatch.from_pylist([row], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers_of(*paths)
        task, number, held, ids, steps = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for i, j in slices(offsets, min(STEP_BYTES, slice_bytes)):
                j_all = j
                while i < j_all:  # the pair keys hold 2**15 documents
                    j = min(j_all, i + (1 << 15))
                    cut = offsets[i:j + 1]
                    steps.append(Step(raw[cut[0]:cut[-1]], cut - cut[0], tools))
                    ids.append(batch.column(0).slice(i, j - i))
                    held += int(cut[-1] - cut[0]) + 64 * (j - i)
                    i = j
                    if held >= slice_bytes:
                        yield from emit(f"{task}-{number}", ids, steps)
                        number, held, ids, steps = number + 1, 0, [], []
        if steps:
            yield from emit(f"{task}-{number}", ids, steps)

    path = scratch_path(spark, "aligned")
    (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
         .mapInArrow(run, schema).write.option("compression", "zstd").parquet(path))
    return spark.read.parquet(path)


def _slice_pairs(aligned: DataFrame) -> DataFrame:
    """(slice, pair, n): the tables of all slices as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, table in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pairs, n = unpack(table, np.int64, np.int64)
                for i in range(0, len(pairs), 100_000):
                    part = pairs[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(part), pa.array(n[i:i + 100_000])], names=["slice", "pair", "n"])

    return aligned.filter(F.col("table").isNotNull()).select("slice", "table").mapInArrow(run, "slice string, pair long, n long")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    total = _slice_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("n"))
    path = scratch_path(aligned.sparkSession, "pair-counts")
    total.withColumn("a", F.shiftright("pair", _PAIR_SHIFT)).write.parquet(path)
    total = aligned.sparkSession.read.parquet(path)
    top = total.groupBy("a").agg(F.max("n").alias("top"))  # at most a row an entry of A's vocabulary
    return total.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Every document with ``n_best`` and ``count_sum`` over its links."""
    back = _slice_pairs(aligned).select("slice", "pair").join(counts, "pair").select("slice", "pair", F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("n"))
    docs = aligned.filter(F.col("table").isNull()).drop("table")
    schema = StructType([docs.schema["id"], *[StructField(c, LongType()) for c in (*_COUNTS, "n_best", "count_sum")], StructField("groups_sha256", StringType())])
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pair, n = (right.column(c).to_numpy() for c in ("pair", "n"))
        n = n[np.argsort(pair)]  # places in a slice's table follow the pairs; a best one is negative
        best, sums = [], []
        for links in left.column("links").to_pylist():
            if links is None:
                best.append(0)
                sums.append(0)
                continue
            place, times = unpack(links, np.uint32, np.uint32)
            here = n[np.cumsum(place)]
            best.append(int(times[here < 0].sum()))
            sums.append(int((np.abs(here) * times).sum()))
        columns = [left.column("id"), *[left.column(c) for c in _COUNTS], pa.array(best, pa.int64()), pa.array(sums, pa.int64()), left.column("groups_sha256")]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=arrow)

    return docs.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(run, schema)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document aligned, with the corpus-wide counts of its links."""
    aligned = align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = with_counts(aligned, pair_counts(aligned))
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
