import corpus_pipeline
import pytest
from wordspace.llm import packing

from .conftest import words
from .test_dedup import brute_components, brute_removed, split


@pytest.fixture(scope="module")
def folder(ready, docs_of, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    bad = lambda i: " ".join(w + "%%%" for w in split(words(i, 60, 900)))
    passage = words(999, 70, 5000)
    rows = [(i, words(i, 80, 5000) + ".") for i in range(60)] + [(100 + i, bad(i)) for i in range(20)]
    rows += [(200 + i, words(i, 80, 5000) + ".") for i in range(5)]  # exact copies
    rows += [(300 + i, words(i, 80, 5000) + f" more{i}.") for i in range(5)]  # near copies
    rows += [(400 + i, words(2000 + i, 90, 5000) + " " + passage) for i in range(6)] + [(500, None), (501, "")]
    docs_of(rows).write.parquet(f"{top}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 60, 2)] + [(100 + i, 0, 0) for i in range(0, 20, 2)]
    ready.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, rows


def test_stages(ready, folder, tmp_path):
    top, rows = folder
    docs = ready.read.parquet(f"{top}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(ready, docs, top)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = ready.read.parquet(f"{tmp_path}/{k}")
        if k < 3:
            assert docs.columns == columns, name
        seen.append(docs)
    kept = {r.doc_id: r.text for r in seen[0].collect()}
    assert {k for k, _ in rows if k not in kept} - {500, 501} == {100 + i for i in range(20)}
    groups = brute_components(sorted(kept.items()), 5, 8, 10)
    stay = {d for d, _, c in groups if d == c}
    after = {r.doc_id: r.text for r in seen[1].collect()}
    assert after.keys() == stay and all(after[d] == kept[d] for d in stay)
    want = {d: s for d, _, _, s in brute_removed(sorted(after.items()))}
    left = {r.doc_id: r.text for r in seen[2].collect()}
    assert {d: s for d, _, _, s in brute_removed(sorted(left.items()))}.keys() == want.keys()
    assert {d: len(split(t)) for d, t in left.items()} == {d: n - gone for d, n, gone, _ in brute_removed(sorted(after.items()))}
    pieces = seen[3].collect()
    assert {p.doc_id for p in pieces} == stay and seen[3].columns == packing.PIECES.names
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_run_gives_the_same(ready, folder):
    top, _ = folder
    rows = corpus_pipeline.run(ready, top).collect()
    assert {p.doc_id for p in rows} >= set(range(60)) and not {p.doc_id for p in rows} & {100 + i for i in range(20)}
