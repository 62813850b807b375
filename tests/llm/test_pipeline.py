"""The corpus pipeline, stage by stage, over a small made-up corpus."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8)))
    sentence = lambda: " ".join(word() for _ in range(12)) + "."
    text = lambda: "\n".join(sentence() for _ in range(8))
    item = "Which of the seven lanterns was lit when the third keeper left the tower, and who told the harbour master?"
    line = sentence()
    texts = {i: text() for i in range(120)}
    toxic = {i for i in range(120) if i % 4 == 0}
    for i in toxic:
        texts[i] = texts[i].replace(".", f". {rng.choice(['you', 'what a', 'such'])} snotgurgle indeed.", 3)
    texts[121] = texts[1] + "\n" + line
    texts[122] = line + "\n" + text()
    near = text().split()
    texts[130] = " ".join(near)
    texts[131] = " ".join(near[:50] + ["changed"] + near[51:])
    texts[140] = text() + " " + item + " " + text()
    texts[150], texts[151] = None, ""
    texts[160] = "long " + " ".join(word() for _ in range(4000))
    rows = [(i, t, "en", f"s{i % 7}", None if t is None else len(t), 1) for i, t in sorted(texts.items())]
    rows.append((None, "a text without an id", None, None, 20, 1))
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, toxic, line


def test_stages(spark, corpus):
    folder, texts, toxic, line = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    assert set(seen["toxicity"]) == (set(texts) | {None}) - toxic
    lines = seen["line dedup"]
    assert set(lines) == set(seen["toxicity"])
    assert lines[121]["text"] == line and line not in lines[122]["text"] and lines[150]["text"] is None
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values() if r["text"])
    assert set(lines) - set(seen["near duplicates"]) == {131}
    assert set(seen["near duplicates"]) - set(seen["decontamination"]) == {140}
    assert set(seen["packing"]) == set(seen["decontamination"])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == set(seen["packing"])


def test_empty_documents(spark, corpus):
    folder, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
