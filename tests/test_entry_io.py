import re
import tempfile

import pytest

from wordspace.operators import step as ST
from wordspace.operators import vocab as V
from wordspace.plans.trainer import Model, SGNSConfig
from wordspace.sources import corpus as C
from wordspace.sources import model_io as IO


def test_entry_contract(spark):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40
    out = E.entry(spark)
    assert out.columns == ["query", "neighbours"]
    rows = out.collect()
    assert all(isinstance(r.neighbours, str) and "(" in r.neighbours for r in rows)


def test_read_text_one_line_keeps_order(spark, monkeypatch):
    monkeypatch.setattr(C, "WORDS_PER_DOCUMENT", 30)
    text = "The cat, sat on 2 mats; the END " * 50
    d = tempfile.mkdtemp(prefix="wordspace-text-", dir="/tmp")
    with open(f"{d}/corpus.txt", "w", encoding="utf-8") as f:
        f.write(text)
    docs = C.read_text(spark, f"{d}/corpus.txt", one_line=True)
    assert 400 // 30 <= docs.count() <= 400 // 30 + 2
    toks = C.tokenize(docs).orderBy("doc_id", "pos").collect()
    assert [r.word for r in toks] == re.findall(r"[a-z]+", text.lower())
    lines = C.read_text(spark, f"{d}/corpus.txt")
    assert [r.word for r in C.tokenize(lines).orderBy("doc_id", "pos").collect()] == re.findall(r"[a-z]+", text.lower())


def test_lines_written_are_scanned_in_order(spark):
    texts = ["One two\nthree", None, "", "four\r\nfive\rsix", "seven"] * 30
    docs = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    d = tempfile.mkdtemp(prefix="wordspace-lines-", dir="/tmp")
    C.write_lines(docs, f"{d}/lines")
    got = C.tokenize(C.read_text(spark, f"{d}/lines")).orderBy("doc_id", "pos").collect()
    want = [(i, p, w) for i, t in enumerate(texts) for p, w in enumerate(re.findall(r"[a-z]+", (t or "").lower()))]
    assert [tuple(r) for r in got] == want


def test_model_roundtrip_checks_sizes(spark, demo_tokens):
    vocab = V.build_vocab(demo_tokens, 5)
    params = ST.init_params(vocab, 4, 42)
    m = Model(vocab=vocab, params=params, history=None, config=SGNSConfig(dim=4), meta={"vocab_size": 84, "embedding_dim": 4, "seed": 42})
    d = tempfile.mkdtemp(prefix="wordspace-model-", dir="/tmp")
    IO.save_model(m, f"{d}/m")
    back = IO.load_model(spark, f"{d}/m")
    assert back.meta["vocab_size"] == 84 and back.params.count() == 168
    IO.export_embeddings(back, f"{d}/e")
    e = IO.load_embeddings(spark, f"{d}/e")
    assert e.count() == 84 and set(e.columns) == {"idx", "word", "vec"}
    bad = Model(vocab=vocab, params=params, history=None, config=SGNSConfig(dim=4), meta={"vocab_size": 85, "embedding_dim": 4, "seed": 42})
    IO.save_model(bad, f"{d}/bad")
    with pytest.raises(ValueError):
        IO.load_model(spark, f"{d}/bad")
