"""Byte-level BPE encoding and decoding with a contiguous rank array.

Method. A pre-token is held as two short parallel arrays: the ids of its parts
and the merge rank of each adjacent pair. The smallest rank is found by a scan
(the leftmost on ties), its boundary is deleted, and only the two neighbouring
ranks are refreshed. Above ``LONG_PARTS`` parts the scan would be quadratic, so
long pre-tokens use a heap over a linked list, with the same order of merges.

The vocabulary file (JSON of the ``tokenizers`` library) is a parameter. It is
read on the driver and broadcast (1-2 MB), so executors need no local file.

Pre-tokens never cross a single space between two non-space characters, so a
text is cut there and each distinct piece is encoded once per worker (a
two-generation cache of bounded size; it never changes a result). A text with
other white space around such a cut is split by the full pattern instead.

Defined results: null or empty text gives no ids and the empty text; equal rows
give equal results, each row its own; special tokens inside a text become their
id, as the library does by default; extra input columns are dropped except those
named by ``carry``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import slices

#: split pattern of byte-level pre-tokenisation (fixed value of the file format)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_PARTS = 48
CACHE_PIECES = 400_000
CACHE_WORDS = 600_000
_SHIFT = 20
_NONE = 1 << 62


def byte_alphabet() -> list[str]:
    """Character that stands for each byte in a byte-level vocabulary file:
    printable Latin-1 characters stand for themselves, the others are numbered
    on from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in own}
    others = (b for b in range(256) if b not in chars)
    chars.update({b: chr(256 + k) for k, b in enumerate(others)})
    return [chars[b] for b in range(256)]


class RankArrayBPE:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        model, alphabet = doc["model"], byte_alphabet()
        to_byte = {c: b for b, c in enumerate(alphabet)}
        vocab: dict[str, int] = model["vocab"]
        self.byte_ids = [vocab[c] for c in alphabet]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = vocab[left] << _SHIFT | vocab[right]
            self.merges.setdefault(key, rank << _SHIFT | vocab[left + right])
        self.special = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.split = regex.compile(PATTERN)
        self.cut_special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.special_bytes = [t.encode() for t in self.special]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    # ---- one pre-token -------------------------------------------------
    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > LONG_PARTS:
            return self._merge_long(ids)
        look = self.merges.get
        ranks = [look(a << _SHIFT | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            at = ranks.index(low)
            ids[at] = low & ((1 << _SHIFT) - 1)
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = look(ids[at] << _SHIFT | ids[at + 1], _NONE)
            if at:
                ranks[at - 1] = look(ids[at - 1] << _SHIFT | ids[at], _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in the same order for long pre-tokens, in n log n."""
        n, look = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := look(ids[i] << _SHIFT | ids[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or look(ids[i] << _SHIFT | ids[j], _NONE) != rank:
                continue  # the pair has changed since it was queued
            ids[i], alive[j], after[i] = rank & ((1 << _SHIFT) - 1), False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := look(ids[i] << _SHIFT | ids[after[i]], _NONE)) != _NONE:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := look(ids[p] << _SHIFT | ids[i], _NONE)) != _NONE:
                heapq.heappush(heap, (r, p))
        return [x for x, keep in zip(ids, alive, strict=True) if keep]

    # ---- whole texts ---------------------------------------------------
    def _ids_of(self, text: str) -> bytes:
        """Ids of any text by the full pattern."""
        if not any(t in text for t in self.special):
            return self._plain_ids(text)
        parts = self.cut_special.split(text)
        return b"".join([struct.pack("<I", self.special[p]) if k % 2 else self._plain_ids(p) for k, p in enumerate(parts)])

    def _plain_ids(self, text: str) -> bytes:
        words, out = self.words, []
        for word in self.split.findall(text):
            packed = words.get(word)
            if packed is None:
                ids = self.merge_word(word.encode())
                packed = struct.pack(f"<{len(ids)}I", *ids)
                if len(words) >= CACHE_WORDS:
                    words.clear()
                words[word] = packed
            out.append(packed)
        return b"".join(out)

    def _piece(self, piece: bytes) -> bytes | None:
        """Ids (little-endian 32 bit) of a piece that starts a pre-token of its
        own; None if white space at its ends ties it to its neighbours."""
        found = self.old.get(piece)
        if found is None:
            text = piece.decode()
            body = text[1:] if text[:1] == " " else text
            if not body or body[0].isspace() or body[-1].isspace():
                return None
            found = self._ids_of(text)
        if len(self.young) >= CACHE_PIECES:
            self.old, self.young = self.young, {}
        self.young[piece] = found
        return found

    def encode(self, raw: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if not raw:
            return b""
        pieces = raw.split(b" ")
        first = pieces[0]
        pieces = [b" " + p for p in pieces]
        pieces[0] = first
        got = list(map(self.young.get, pieces))
        if None in got:
            for i, x in enumerate(got):
                if x is None:
                    x = self._piece(pieces[i])
                    if x is None:
                        return self._ids_of(raw.decode())
                    got[i] = x
        return b"".join(got)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_CODECS: dict[str, RankArrayBPE] = {}


def codec(spec: str) -> RankArrayBPE:
    """The encoder of a vocabulary, built once per worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = RankArrayBPE(spec)
    return _CODECS[key]


DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def encode_digests(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encode the
    whole text, decode the ids again, and digest both."""
    spec = spark.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value)
        for whole in batches:
            for batch in slices(whole, text=1):
                counts, ids_sha, text_sha = [], [], []
                for raw in batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist():
                    ids = bpe.encode(raw)
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=DIGESTS.names)

    return docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(run, DIGESTS)


TOKENS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def encode_ids(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""
    spec = spark.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value)
        for whole in batches:
            for batch in slices(whole, 500, text=1):
                ids = [np.frombuffer(bpe.encode(raw), "<u4").astype(np.int32) for raw in batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=TOKENS.names)

    return docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(run, TOKENS)


def decode_ids(spark: SparkSession, tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids: empty text."""
    spec = spark.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value)
        for whole in batches:
            for batch in slices(whole, 500):
                texts = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, schema)
