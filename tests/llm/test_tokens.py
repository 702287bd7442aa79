import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wordspace.llm import bpe, packing
from wordspace.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY

PARTS = ["a", "B", " ", "  ", "\n", "\t", "\xa0", "é", "É", "1", "23", "'s", "'LL", "!", "<|endoftext|>", "中", "　", "́", "😀", "the", "ing", "\x1c", "\x85", "Σ", "İ", "x" * 60, "ab" * 40]


def texts(n):
    rng = random.Random(5)
    return [None, "", " ", "word " * 3000, "y" * 5000] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_bpe_equals_library(docs_of):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = list(enumerate(texts(1500))) + [(3, "again"), (3, "again"), (None, "no id")]
    got = bpe.encode_digests(docs_of([]).sparkSession, docs_of(rows, extra=True), BYTE_VOCABULARY).collect()
    want = []
    for k, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.encode_digests(docs_of([]).sparkSession, docs_of([]), BYTE_VOCABULARY).count() == 0


def test_bpe_round_trip_and_long_words(docs_of):
    spark = docs_of([]).sparkSession
    rows = [(1, "Hello <|endoftext|> wörld"), (2, None), (3, "z" * 300)]
    ids = bpe.encode_ids(spark, docs_of(rows), BYTE_VOCABULARY)
    assert {r.doc_id: r.text for r in bpe.decode_ids(spark, ids, BYTE_VOCABULARY).collect()} == {k: t or "" for k, t in rows}
    codec = bpe.codec(open(BYTE_VOCABULARY, encoding="utf-8").read())
    word = ("abcdefghij" * 30).encode()
    start = [codec.byte_ids[b] for b in word]
    long_way, bpe.LONG_PARTS = codec._merge_long(list(start)), 10**9
    try:
        assert codec.merge_word(word) == long_way
    finally:
        bpe.LONG_PARTS = 48


def test_packing_covers_every_id_once(docs_of):
    spark = docs_of([]).sparkSession
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    rows = list(enumerate(texts(600))) + [(7, "twice"), (None, "no id")]
    got = [tuple(r) for r in packing.pack(spark, docs_of(rows, extra=True).repartition(3), WORD_VOCABULARY).collect()]
    want = {}
    for k, t in rows:
        if k != 7 and k is not None:
            want[k] = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
    at = {}
    for doc, start, length, crc, total, _, _ in got:
        if doc in want:
            ids = want[doc]
            assert total == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at.setdefault(doc, []).append((start, length))
    for doc, ids in want.items():
        end = 0
        for start, length in sorted(at[doc]):
            assert start == end
            end = start + length
        assert end == len(ids)
    seqs = {}
    for _, _, length, _, _, seq, offset in got:
        seqs.setdefault(seq, []).append((offset, length))
    for pieces in seqs.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 4096 or end & (end - 1) == 0  # nothing is padded
    assert sum(d is None for d, *_ in got) == 1
    assert packing.pack(spark, docs_of([]), WORD_VOCABULARY).count() == 0


def test_runs_equal_library_with_small_caches(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 200)
    monkeypatch.setattr(packing, "CACHE_RUNS", 50)
    lib = Tokenizer.from_file(WORD_VOCABULARY)
    lib.no_truncation()
    lib.no_padding()
    tokenizer = packing.RunTokenizer(open(WORD_VOCABULARY, encoding="utf-8").read())
    rows = texts(2000)
    batches = [rows[i : i + 150] for i in range(0, len(rows), 150)]
    for k, batch in enumerate([*batches, batches[-1], ["known"], ["known"], [None], [""], []]):  # nothing new in some
        got = tokenizer.encode(pa.array(batch, pa.string()))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(t or "", add_special_tokens=False).ids for t in batch]
        if k % 5 == 4:
            tokenizer.forget()


def test_sum_of_squares_choice():
    rng = np.random.default_rng(3)
    p = packing.SumOfSquares(window=16)
    for k, s in enumerate(rng.integers(1, 16, 300).tolist()):
        before = p.levels.copy()
        p.add((k, s), bytes(4 * s))
        options = []
        for h in range(0, 16 - s + 1):
            if h == 0 or before[h]:
                after = before.copy()
                if h:
                    after[h] -= 1
                if h + s < 16:
                    after[h + s] += 1
                options.append(int((after[1:16] ** 2).sum()))
        assert int((p.levels[1:16] ** 2).sum()) == min(options)
    p.close()
    total = sum(len(i) // 4 for w in p.drain() for _, _, i in w)
    assert total and p.n_open == 0


@pytest.mark.parametrize("limit", [0, 3])
def test_closing_early_loses_nothing(limit):
    p, n = packing.SumOfSquares(window=64, max_open=limit), 0
    for k in range(200):
        size = 1 + (k * 37) % 150
        n += size
        p.add((k, size), bytes(4 * size))
    p.close()
    assert sum(len(i) // 4 for w in p.drain() for _, _, i in w) == n
