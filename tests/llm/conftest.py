import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def ready(spark):
    from wordspace.llm.common import prepare

    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(ready):
    def make(rows, extra=False):
        full = [(k, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, (k, t) in enumerate(rows)]
        df = ready.createDataFrame(full, DOCS)
        if extra:  # columns whose names could clash with those made inside
            for name in ("key", "leader", "chunk", "n", "prefix", "ids", "bucket", "ord", "kind", "digest", "spans", "cuts", "s1"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


def words(seed, n, size=40):
    """n made-up words of a small vocabulary."""
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(x >> 8) % size}")
    return " ".join(out)
