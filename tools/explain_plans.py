"""Print the formatted physical plans of the main operators.

usage: python tools/explain_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from wordspace.operators import encode as E  # noqa: E402
from wordspace.operators import pairs as P  # noqa: E402
from wordspace.operators import similarity as S  # noqa: E402
from wordspace.operators import vocab as V  # noqa: E402
from wordspace.plans import catalog  # noqa: E402
from wordspace.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    toks = catalog.doc_tokens(spark, sf)
    print("=== word counts (V1): partial + final hash aggregate, scan reads doc_id,text only")
    V.word_counts(toks, 5).explain("formatted")
    vocab = catalog.pinned(spark, sf, "vocab_keep", lambda: V.keep_probability(V.build_vocab(toks, 5), 1e-5, "plain"))
    print("=== encode + subsample (E1, T6): broadcast hash join after a size check")
    E.subsample(E.encode(toks, vocab, carry=("keep_prob",)), 42).explain("formatted")
    print("=== window pairs (E5/G2): one exchange on the chunk key, lag/lead window, no band join")
    dense = catalog.pinned(spark, sf, "dense", lambda: E.dense_positions(E.subsample(E.encode(toks, vocab, carry=("keep_prob",)), 42)))
    P.window_pairs(dense).explain("formatted")
    print("=== most similar (I5/R7): broadcast probe slice, WindowGroupLimit before the exchange")
    S.most_similar(catalog.emb_vectors(spark, sf), catalog.emb_probes(spark, sf), 10).explain("formatted")


if __name__ == "__main__":
    main()
