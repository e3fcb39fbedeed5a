"""Operator 7, byte-pair encoding and decoding with a pair occurrence index.

The tokenizer file (a public BPE vocabulary with word ends; its path is a parameter) is
read once per Python worker. Each text is cut at the special tokens, normalised, and
split into words. The distinct words of a slice that are not in the worker's bounded
word cache are encoded together: all their symbols lie in one doubly linked array, an
index maps every adjacent pair to all its positions, and a heap holds the ranks of the
pairs that occur. The smallest active rank is applied to all its positions, left to
right; each merge removes and adds the neighbouring pairs. If a merge creates a pair of
a smaller rank than the one being applied, the rest of the positions waits for it, so
every word gets exactly the merges it would get alone.

The normaliser and word pattern of the file are restated for code points below U+0250;
texts with others go through the file's own normaliser and word splitter (only the
splitting, never the encoding). A file with other settings is refused.

Defined cases: null and empty texts give no ids and an empty decoded text; special-token
strings inside a text become their ids; repeated rows give repeated results; an empty
table gives an empty result. Texts are read whole, however long. The cache is dropped
when it holds ``CACHE_WORDS`` words, which changes no result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from .arrowmap import map_texts, visible

CACHE_WORDS = 400_000
SLICE_BYTES = 1 << 21
_FAST_LIMIT = 0x250
_SPACE = "\t-\r \x85\xa0  -     　"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _category_class(kind: str) -> str:
    """Regex class body of the code points below the fast limit in a Unicode category group."""
    return "".join(re.escape(chr(c)) for c in range(_FAST_LIMIT) if unicodedata.category(chr(c)).startswith(kind))


def _byte_symbols() -> list[str]:
    """The visible character that byte-level vocabularies use for each byte.

    Printable Latin-1 bytes stand for themselves; the others, in order, for U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(0x100 + i)
    return [out[b] for b in range(256)]


class WordBPE:
    """Vocabulary, merges and word cache of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        self.path = path
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if not isinstance(pair, str) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + self.suffix] for s in symbols]
        self._symbol_byte = {s: b for b, s in enumerate(symbols)}
        letters, numbers = _category_class("L"), _category_class("N")
        # letters whose lower case lies beyond the fast limit
        letters += "".join(x for c in range(_FAST_LIMIT) for x in chr(c).lower() if ord(x) >= _FAST_LIMIT and unicodedata.category(x).startswith("L"))
        self._split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+").findall
        self._rare = re.compile(rf"[^\x00-{chr(_FAST_LIMIT - 1)}]").search
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.special_ids = {t: i.to_bytes(4, "little") for t, i in self.special.items()}
        self.cache: dict[str, bytes] = dict(self.special_ids)

    @staticmethod
    def _check(spec: dict) -> None:
        """The parts of a file that this class restates must be the ones it restates."""
        norm = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        pattern = split[0].get("pattern", {}).get("Regex")
        plain = all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        model = spec["model"]
        known = (norm == ["NFC", "Replace", "Lowercase"] and plain and spec["decoder"] is None and spec["post_processor"] is None
                 and [s.get("type") for s in split] == ["Split", "ByteLevel"]
                 and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                 and model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                 and not model.get("continuing_subword_prefix") and model.get("end_of_word_suffix"))
        if not known:
            raise ValueError("this tokenizer file has settings that WordBPE does not restate")

    @lru_cache(maxsize=1)  # noqa: B019 - one instance per file and worker
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if self._rare(text) is None:
            return self._split(text.lower())
        t = self._library()
        pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return [bytes(self._symbol_byte[c] for c in p).decode("utf-8", "surrogateescape") for p, _ in pieces]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, all words merged together through the pair occurrence index."""
        merges = self.merges
        sym: list[int] = []
        begin: list[int] = []
        for w in words:
            begin.append(len(sym))
            data = w.encode("utf-8", "surrogateescape")
            if data:
                sym += [self.inner[b] for b in data[:-1]]
                sym.append(self.final[data[-1]])
        total = len(sym)
        begin.append(total)
        nxt = list(range(1, total + 1))
        prv = list(range(-1, total - 1))
        for a, b in zip(begin, begin[1:]):
            if b > a:
                nxt[b - 1] = -1
                prv[a] = -1
        index: dict[tuple[int, int], list[int]] = {}
        for i in range(total):
            if nxt[i] >= 0:
                pair = (sym[i], sym[i + 1])
                if pair in merges:
                    index.setdefault(pair, []).append(i)
        heap = [(merges[p][0], p) for p in index]
        heapq.heapify(heap)
        while heap:
            rank, pair = heapq.heappop(heap)
            where = index.pop(pair, None)
            if not where:
                continue
            where.sort()
            left, right = pair
            new = merges[pair][1]
            for k, i in enumerate(where):
                j = nxt[i]
                if sym[i] != left or j < 0 or sym[j] != right:
                    continue
                sym[i], sym[j] = new, -1
                after = nxt[j]
                nxt[i] = after
                smaller = False
                if after >= 0:
                    prv[after] = i
                    p = (new, sym[after])
                    if p in merges:
                        at = index.get(p)
                        if at is None:
                            index[p] = [i]
                            heapq.heappush(heap, (merges[p][0], p))
                        else:
                            at.append(i)
                        smaller = merges[p][0] < rank
                before = prv[i]
                if before >= 0:
                    p = (sym[before], new)
                    if p in merges:
                        at = index.get(p)
                        if at is None:
                            index[p] = [before]
                            heapq.heappush(heap, (merges[p][0], p))
                        else:
                            at.append(before)
                        smaller = smaller or merges[p][0] < rank
                if smaller:
                    rest = where[k + 1:]
                    if rest:
                        index.setdefault(pair, []).extend(rest)
                        heapq.heappush(heap, (rank, pair))
                    break
        out = []
        for a, b in zip(begin, begin[1:]):
            out.append([s for s in sym[a:b] if s >= 0])
        return out

    def _learn(self, words: set[str]) -> None:
        todo = list(words)
        for w, ids in zip(todo, self.encode_words(todo)):
            self.cache[w] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split: list[list[str]] = []
        seen: set[str] = set()
        for text in texts:
            parts = self._cut(text) if self._cut else [text]
            toks = self.words(parts[0])
            for n, part in enumerate(parts[1:], 1):
                if n % 2:
                    toks.append(part)  # a special token; no word looks like one
                else:
                    toks += self.words(part)
            seen.update(toks)
            split.append(toks)
        unseen = seen - self.cache.keys()
        if len(self.cache) + len(unseen) > CACHE_WORDS:
            self.cache = dict(self.special_ids)
            unseen = seen - self.cache.keys()
        if unseen:
            self._learn(unseen)
        get = self.cache.__getitem__
        return [b"".join(map(get, toks)) for toks in split]

    def decode(self, ids: bytes) -> str:
        """Token strings joined by single spaces, as a file without a decoder gives them."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def _texts(raw: np.ndarray, offsets: np.ndarray) -> list[str]:
    data, at = raw.tobytes(), offsets.tolist()
    return [data[a:b].decode() for a, b in zip(at, at[1:])]


def encoder(path: str):
    """Number of tokens and packed ids of whole texts, for ``map_texts``."""
    def fn(raw, offsets):
        ids = tokenizer(path).encode(_texts(raw, offsets))
        return [[len(x) // 4 for x in ids], ids]

    return fn


def encode_texts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as packed little-endian unsigned 32-bit integers."""
    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
    return map_texts(docs, id_col, text_col, fields, encoder(path or default_path()), SLICE_BYTES)


def decode_ids(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) from packed ids; a null counts as no ids."""
    path = path or default_path()
    visible(encoded.sparkSession)

    def run(batches):
        for batch in batches:
            out = [tokenizer(path).decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded string")


def round_trip(path: str):
    """Number of tokens, packed ids and the text decoded from them, for ``map_texts``."""
    def fn(raw, offsets):
        t = tokenizer(path)
        ids = t.encode(_texts(raw, offsets))
        return [[len(x) // 4 for x in ids], ids, [t.decode(x) for x in ids]]

    return fn


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) in one pass over the texts."""
    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", StringType())]
    return map_texts(docs, id_col, text_col, fields, round_trip(path or default_path()), SLICE_BYTES)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ids and decoded text of every document, as digests."""
    e = encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return e.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
