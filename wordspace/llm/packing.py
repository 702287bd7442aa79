"""Sum-of-squares online packing of token sequences.

Method. Every partition packs its own documents as they come. ``levels[h]``
counts the open (partly filled) windows that hold ``h`` tokens. A document's
remainder of ``s`` tokens goes to the open window, or the new one, for which the
sum of squared counts after the placement is smallest; ties go to the fullest.
Full stretches of a longer document fill windows by themselves before that.
When a partition ends, the open windows are closed: the emptiest are cut up to
fill the fullest, and the one window that stays partly filled is cut into powers
of two, which need no padding. So padding does not depend on the number of
partitions. If more than ``MAX_OPEN`` windows are open (64 MB of ids; it takes
documents that fit nowhere together), the emptiest is spread over the fullest.

Tokens come from the ``tokenizers`` library with the given vocabulary file. The
file's pre-tokens never hold white space, so the distinct runs between white space of some texts are encoded
once. Those of ASCII and Latin-1 letters are lowered and cut into their
pre-tokens, of which only the unseen ones go to the library's model, in the
characters by which the library writes bytes; other runs go to the library
whole. Both caches are of bounded size. The ids of a text are gathered from those
of its runs.

Defined results: null or empty text is the end id alone; equal rows are packed
each by itself; a null ``doc_id`` stays null; other columns are dropped; an
empty table gives no piece. A lost task packs the same rows of the same input
split again, so sequence ids stay unique.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import slices

WINDOW = 4096
END_ID = 2
MAX_OPEN = 4096
CACHE_RUNS = 100_000  # runs beyond Latin-1
CACHE_WORDS = 250_000  # words of a generation; that before it stays at hand
GATHER = 64  # texts whose ids are put together at a time
#: ASCII and the letters of Latin-1, which neither normalisation nor lowering makes into several characters
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
#: the vocabulary file's split pattern on such text, lowered (fixed value of the file), and the space
PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff ]+| ")

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])


class RunTokenizer:
    """Ids of whole texts by the library, which sees only words and runs that are new."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        added = json.loads(spec).get("added_tokens", [])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)").search
        # how the library writes the bytes of a plain character
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.written = {c: "".join(x for x, _ in written(chr(c))) for c in (*range(32), *range(33, 128), *range(0xC0, 0x100))}
        self.words: dict[str, bytes] = {" ": b""}  # the space only parts the runs
        self.forget()

    def forget(self) -> None:
        """Give the memory of all but the last generation of words back."""
        self.old: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        pa.default_memory_pool().release_unused()

    def _learn(self, new: list[str]) -> None:
        """Words of plain runs go straight to the library's model."""
        if not new:
            return
        model, words = self.library.model.tokenize, self.words
        for word, bytes_of in zip(new, " ".join(new).translate(self.written).split(" "), strict=True):
            words[word] = array("I", [t.id for t in model(bytes_of)]).tobytes()

    def _plain(self, text: str) -> tuple[bytes, list[int]]:
        """(ids of all runs of ``text``, where each run's ids end)."""
        parts = PLAIN_WORDS.findall(text.lower())
        distinct = set(parts)
        new = distinct.difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.old, self.words = self.words, {" ": b""}
            new = distinct
            new.discard(" ")
        found = self.old.keys() & new
        for word in found:
            self.words[word] = self.old[word]
        self._learn(list(new - found if found else new))
        got = list(map(self.words.__getitem__, parts))
        size = np.fromiter(map(len, got), np.int64, len(got))
        raw = b"".join(got)
        return raw, [*np.cumsum(size)[size == 0].tolist(), len(raw)]  # at the spaces

    def _other(self, run: str) -> bytes:
        if (ids := self.odd.get(run)) is None:
            if len(self.odd) >= CACHE_RUNS:
                self.odd.clear()
            ids = self.odd[run] = array("I", self.library.encode(run, add_special_tokens=False).ids).tobytes()
        return ids

    def _runs(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct runs, in order; number of ids of each)."""
        if not len(names):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(names)], names), " ")[0].as_py()
        rare = self.special(text) is not None  # no special token spans white space
        if not rare and PLAIN(text):
            raw, ends = self._plain(text)
            return np.frombuffer(raw, "<u4"), np.diff(ends, prepend=0) // 4
        runs = text.split(" ")
        plain = [(r.isascii() or PLAIN(r) is not None) and not (rare and self.special(r)) for r in runs]
        known: list[bytes] = []
        raw, ends = self._plain(" ".join(compress(runs, plain))) if any(plain) else (b"", [])
        at, start = iter(ends), 0
        for r, is_plain in zip(runs, plain, strict=True):
            if is_plain:
                end = next(at)
                known.append(raw[start:end])
                start = end
            else:
                known.append(self._other(r))
        return np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of each text; null: none."""
        runs = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        first = runs.offsets.to_numpy()
        coded = runs.flatten().dictionary_encode()
        # the ids of every run of every text, gathered from those of the distinct runs
        flat, size = self._runs(coded.dictionary)
        which = coded.indices.to_numpy()
        take = size[which]
        ends = np.cumsum(take)
        start = np.cumsum(size) - size
        out, cuts = [], np.concatenate([[0], ends])[first - first[0]].tolist()
        for a in range(0, len(texts), GATHER):  # some texts at a time
            b = min(len(texts), a + GATHER)
            lo, hi = int(first[a] - first[0]), int(first[b] - first[0])
            at = np.arange(cuts[a], cuts[b]) + np.repeat(start[which[lo:hi]] - ends[lo:hi] + take[lo:hi], take[lo:hi])
            ids = flat[at].tobytes()
            out += [ids[4 * (x - cuts[a]) : 4 * (y - cuts[a])] for x, y in zip(cuts[a:b], cuts[a + 1 : b + 1], strict=True)]
        return out


_TOKENIZERS: dict[str, RunTokenizer] = {}


def _tokenizer(spec: str) -> RunTokenizer:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = RunTokenizer(spec)
    return _TOKENIZERS[key]


class SumOfSquares:
    """Packer of one partition. A window is a list of (document, start, ids);
    a document is (doc_id, tokens)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.done: list[list] = []

    def add(self, doc: tuple, ids: bytes) -> None:
        size, w = len(ids) // 4, self.window
        full = size - size % w
        for a in range(0, full, w):
            self.done.append([(doc, a, ids[4 * a : 4 * (a + w)])])
        if size > full:
            self._place((doc, full, ids[4 * full :]), size - full)
        while self.n_open > max(1, self.max_open):
            self._relieve()

    def _place(self, piece: tuple, s: int) -> None:
        n, w = self.levels, self.window
        change = 2 * (n[s:] - n[: w - s + 1]) + 2  # leaves level h, reaches level h + s
        change[-1] = 1 - 2 * n[w - s]  # the window becomes full and is counted no more
        change[1:][n[1 : w - s + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * n[s] + 1 if s < w else 0  # a new window
        h = len(change) - 1 - int(np.argmin(change[::-1]))
        if h:
            target = self.open[h].pop()
            n[h] -= 1
            self.n_open -= 1
        else:
            target = []
        target.append(piece)
        self._put(target, h + s)

    def _put(self, target: list, level: int) -> None:
        if level == self.window:
            self.done.append(target)
        else:
            self.open.setdefault(level, []).append(target)
            self.levels[level] += 1
            self.n_open += 1

    def _relieve(self) -> None:
        """Spread the emptiest open window over the fullest ones."""
        level = int(np.flatnonzero(self.levels)[0])
        source = self._take(level)
        while level and self.n_open:
            high = int(np.flatnonzero(self.levels)[-1])
            target = self._take(high)
            take = min(level, self.window - high)
            self._move(source, target, take)
            level -= take
            self._put(target, high + take)
        if level:
            self._put(source, level)

    def _take(self, level: int) -> list:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    @staticmethod
    def _move(source: list, target: list, tokens: int) -> None:
        """Move so many tokens, cutting a piece where they end."""
        while tokens:
            doc, start, ids = source.pop()
            size = min(tokens, len(ids) // 4)
            target.append((doc, start, ids[: 4 * size]))
            if 4 * size < len(ids):
                source.append((doc, start + size, ids[4 * size :]))
            tokens -= size

    def close(self) -> None:
        """Fill the fullest open windows with cuts of the emptiest; cut the last
        one into powers of two."""
        w = self.window
        rest = [(h, x) for h in sorted(self.open) for x in self.open[h]]  # emptiest first
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        lo, hi = 0, len(rest) - 1
        while lo < hi:
            level, target = rest[hi]
            while level < w and lo < hi:
                have, source = rest[lo]
                doc, start, ids = source.pop()
                take = min(w - level, len(ids) // 4)
                target.append((doc, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    source.append((doc, start + take, ids[4 * take :]))
                level, have = level + take, have - take
                rest[lo] = (have, source)
                if not have:
                    lo += 1
            if level < w:
                rest[hi] = (level, target)
                break
            self.done.append(target)
            hi -= 1
        if lo <= hi and rest[hi][0]:
            self._powers(rest[hi][1], rest[hi][0])

    def _powers(self, source: list, level: int) -> None:
        source = source[::-1]
        while level:
            size = 1 << (level.bit_length() - 1)
            level -= size
            target: list = []
            while size:
                doc, start, ids = source.pop()
                take = min(size, len(ids) // 4)
                target.append((doc, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    source.append((doc, start + take, ids[4 * take :]))
                size -= take
            self.done.append(target)

    def drain(self) -> list[list]:
        """Finished windows since the last call."""
        out, self.done = self.done, []
        return out


def _rows(windows: list[list], first: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in PIECES.names]
    for k, window in enumerate(windows):
        at = 0
        for (doc_id, tokens), start, ids in window:
            size = len(ids) // 4
            for col, value in zip(cols, (doc_id, start, size, zlib.crc32(ids), tokens, first + k, at), strict=True):
                col.append(value)
            at += size
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=PIECES.names)


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = END_ID, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: which ids of which document lie where."""
    spec = spark.sparkContext.broadcast(open(vocabulary, encoding="utf-8").read())
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, packer = _tokenizer(spec.value), SumOfSquares(window)
        first = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, text=1):
                for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(batch.column(1)), strict=True):
                    packer.add((doc_id, len(ids) // 4 + 1), ids + end)
                if done := packer.drain():
                    yield _rows(done, first)
                    first += len(done)
        packer.close()
        if done := packer.drain():
            yield _rows(done, first)
        tokenizer.forget()  # the worker process lives on, also in stages that do not tokenise

    return docs.selectExpr(f"CAST(`{key}` AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(run, PIECES)
