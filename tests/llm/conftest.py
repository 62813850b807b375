from __future__ import annotations

import pytest

WIDE = "doc_id long, text string, lang string, source string, n_chars long, pii string, leaks int, component long, _dropped int, shard string"


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, with columns whose names operators might use themselves."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t), None, k, k, k, "x") for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, WIDE).repartition(3)

    return make
