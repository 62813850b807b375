"""K-d tree sharding against a tree built row by row in Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, shards


def tree(rows, share):
    """Shard of each row by the definition; a row is (size, coordinates, text hash, id hash)."""
    out = {}

    def cut(members, first, share):
        if share == 1 or not members:
            out.update({m: first for m in members})
            return
        widths = [max(rows[m][1][d] for m in members) - min(rows[m][1][d] for m in members) for d in range(len(rows[members[0]][1]))]
        d = widths.index(max(widths))
        ordered = sorted(members, key=lambda m: (rows[m][1][d], rows[m][2], rows[m][3]))
        aim, below = int(sum(rows[m][0] for m in members) * (share // 2 / share)), 0
        for k, m in enumerate(ordered):
            if below + rows[m][0] >= aim:
                k += aim - below > rows[m][0] / 2
                break
            below += rows[m][0]
        cut(ordered[:k], first, share // 2)
        cut(ordered[k:], first + share // 2, share - share // 2)

    cut(list(rows), 0, share)
    return out


def made(n, seed):
    rng = random.Random(seed)
    return ["copy of it" if rng.random() < 0.33 else "x" * rng.choice([0, 1, 5, 40, 41, 700]) + str(i) for i in range(n)]


@pytest.mark.parametrize("bins", [1 << 15, 3])
def test_every_cut_is_the_weighted_median(docs, monkeypatch, bins):
    monkeypatch.setattr(shards, "TOLERANCE", 0)
    monkeypatch.setattr(shards, "BINS", bins)
    n = 60 if bins == 3 else 300
    frame = docs(made(n, 3)).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("big")).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    dimensions = {"source": F.col("source"), "doc_id": F.col("doc_id"), "n_chars": F.col("n_chars")}
    found = {r["doc_id"]: r["shard"] for r in shards.assign_shards(frame, shards=5, dimensions=dimensions).collect()}
    places, _ = shards._coordinates(frame, dimensions)
    keyed = frame.select(
        "doc_id", shards.text_bytes().alias("size"), F.array(*places).alias("at"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - shards.TEXT_BITS).alias("h"), F.shiftrightunsigned(F.xxhash64("doc_id"), 21).alias("i"),
    )
    rows = {r["doc_id"]: (r["size"], r["at"], r["h"], r["i"]) for r in keyed.collect()}
    assert found == tree(rows, 5)


def test_shards_weigh_the_same_whatever_repeats(spark, docs):
    texts = made(600, 5)
    frame = docs(texts, ids=[7 if i < 200 else i for i in range(600)]).withColumn("source", F.lit("one"))
    found = shards.assign_shards(frame, shards=6).collect()
    assert len(found) == 600
    weights = Counter()
    for r in found:
        weights[r["shard"]] += r["size"]
    heaviest = max(r["size"] for r in found)
    assert set(weights) == set(range(6)) and max(weights.values()) - min(weights.values()) <= heaviest * 2
    for s in range(6):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))


def test_target_bytes_and_odd_rows(spark, docs):
    texts = [None, "", "é" * 100, None, "y" * 1_000_000, *made(100, 1)]
    frame = docs(texts, ids=[0, None, None, 3, *range(4, 105)])
    found = shards.assign_shards(frame, target_bytes=3000, carry=("text", "component", "shard"))
    rows = found.collect()
    assert len(rows) == 105 and sorted(rows[0].asDict()) == ["component", "doc_id", "shard", "size", "slot", "text", "text_crc32"]
    for r in rows:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert len({r["shard"] for r in rows}) > 5
    assert shards.assign_shards(docs([]), shards=4).count() == 0
    assert [r["shard"] for r in shards.assign_shards(docs(["a"]), shards=4).collect()] != []
    plain = spark.createDataFrame([(1, "a"), (2, "bb")], "doc_id long, text string")
    assert sorted(r["shard"] for r in shards.assign_shards(plain, shards=2).collect()) == [0, 1]


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    shards.write_shards(docs(made(100, 2)), str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 3


def test_query_columns(spark, docs, tmp_path):
    docs(made(200, 9) + [None]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op11_shards"](spark, str(tmp_path)).collect()
    assert list(rows[0].asDict()) == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert len(rows) == 201 and {r["law"] for r in rows} == {"bytes"} and {r["shard"] for r in rows} == set(range(16))
