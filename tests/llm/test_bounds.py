"""Nothing is lost to odd ids or short items, no sample or shard grows with one key, and workers need no package."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, packing, repeats, toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prose(seed, n=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n // 5))[:n]


def test_texts_of_one_id_do_not_take_each_others_bytes(docs):
    a, b = prose(1), prose(2)
    frame = docs([a, a, b, b, None, prose(3)], ids=[1, 3, 3, 3, 3, 4])
    rows = [(r["doc_id"], r["text"], bytes(r["kept"]).decode(), r["n_removed"]) for r in repeats.remove_repeats(frame).collect()]
    assert sorted(r[3] for r in rows if r[1] == a) == [0, 400]
    assert all(kept == b and gone == 0 for _, text, kept, gone in rows if text == b)
    assert len(rows) == 6


def leaks(items, text):
    data = np.frombuffer(text.encode(), np.uint8)
    return decontaminate.find_leaks_in(decontaminate.build_index(items), data, np.array([0, len(data)])).get(0, [])


def test_items_of_any_length_are_searched():
    items = [(1, "why so?"), (2, "cat"), (3, "ten bytes!"), (4, "exactly twenty-eight bytes !"), (5, ""), (6, None)]
    found = lambda text: sorted({r["item_id"] for r in leaks(items, text)})
    assert found("He asked: Why  so? Ten bytes! The cat.") == [1, 2, 3]
    assert found("concatenate, oftten bytes!") == []
    assert found("exactly twenty-eigt bytes !") == [4]  # one edit in 28 bytes is allowed
    assert leaks(items, "a cat") == [{"item_id": 2, "start": 2, "end": 5, "edits": 0}]
    assert decontaminate.build_index([(5, ""), (6, None)]) is None


def test_short_items_over_a_table(spark, docs):
    benchmark = spark.createDataFrame([(1, "ten bytes!"), (2, "cat"), (3, None)], "item_id long, text string")
    rows = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in decontaminate.find_leaks(docs(["so ten bytes! it is", "the cat", "none", None]), benchmark).collect()}
    assert rows == {0: [1], 1: [2], 2: [], 3: []}


def test_repetition_takes_no_memory():
    code = """
        import resource, sys
        sys.path.insert(0, sys.argv[1])
        import numpy as np
        from tidemark.llm import decontaminate as d
        data = np.frombuffer(b"=" * 60_000 + b" " + b"ab" * 5_000, np.uint8)
        index = d.build_index([(1, "=" * 120), (2, "ab" * 9_000)])
        found = d.find_leaks_in(index, data, np.array([0, len(data)]))[0]
        assert {r["item_id"] for r in found} == {1, 2} and found[0]["end"] >= 60_000, found
        print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code), ROOT], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.strip().splitlines()[-1]) < 500  # MB


def test_cut_postings_find_what_whole_ones_find(monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(i, rng.choice([60, 150, 700]))) for i in range(40)]
    parts = [prose(900 + k, 200) + items[k % 40][1][10:rng.randint(95, 140)] for k in range(60)]
    text = " ".join(parts) + "=" * 300
    items.append((99, "=" * 200))
    whole = leaks(items, text)
    monkeypatch.setattr(decontaminate, "MOST_POSTINGS", 50)
    assert leaks(items, text) == whole and len(whole) > 10


def test_samples_hold_no_more_than_their_bound(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"), F.lit("xx").alias("lang")
    )
    assert len(language._sample(hot.unionByName(hot.limit(50).withColumn("lang", F.lit("yy"))), 300)) <= 300
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    sample, _ = toxicity._sample(hot.select("doc_id", "text"), labels, 300)
    assert sample.count() <= 300


def test_equal_rows_go_to_many_shards(spark):
    rows = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("s").alias("source"))
    packed = packing.pack(rows)
    groups = packed.groupBy(F.expr("bin_id >> 32").alias("shard")).count().collect()
    assert sum(r["count"] for r in groups) == 30_000 and max(r["count"] for r in groups) < packing.HOT_SHARD
    assert packed.groupBy("bin_id").count().where("count > 1").isEmpty()  # one source: nothing shares a bin


@pytest.fixture(scope="module")
def small_tables(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("small")
    for name in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows.limit(120).coalesce(2).write.parquet(str(folder / f"{name}.parquet"))
    return folder


CONTRACT = {
    "op1_packing": "bin_id bin_offset doc_id piece size start", "op2_pii": "base_sha256 doc_id n_card n_email n_ip n_phone spans",
    "op3_suffixes": "doc_id kept_sha256 n_bytes n_removed n_spans", "op4_chat": "conv_id formatted_chars loss_chars loss_sha256 n_turns turns_sha256",
    "op5_language": "doc_id held_out lang_pred score", "op6_embeddings": "component_id kept n_links vec_id", "op7_minhash": "component_id doc_id kept n_shingles",
    "op8_lines": "doc_id dropped_lines kept_sha256 n_dropped", "op9_toxicity": "doc_id held_out predicted score", "op10_decontaminate": "contaminated doc_id item_ids leaks",
    "op11_shards": "doc_id grown_shard law shard size slot text_crc32", "op12_alignment": "count_sum doc_id groups_sha256 n_a n_b n_best n_groups n_links",
    "op13_repair": "audit blank conv_id cost duplicate gaps illegal repaired_sha256 truncated", "pipeline": "bin_id bin_offset doc_id piece size start",
}


def test_workers_need_no_package(small_tables, tmp_path):
    """Every query over small tables, in a session whose workers cannot import this library."""
    code = """
        import json, sys
        sys.path.insert(0, sys.argv[1])
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", sys.argv[3]).config("spark.sql.warehouse.dir", sys.argv[3] + "/warehouse").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        def absent(batches):
            import importlib.util
            for batch in batches:
                if importlib.util.find_spec("tidemark"):
                    raise AssertionError("this test shows nothing: workers find the package")
                yield batch
        spark.range(2).mapInArrow(absent, "id long").count()
        from tidemark.llm.queries import QUERIES
        out = {}
        for name, run in QUERIES.items():
            rows = run(spark, sys.argv[2]).toPandas()
            out[name] = [sorted(rows.columns), len(rows)]
        print(json.dumps(out))
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code), ROOT, str(small_tables), str(tmp_path / "shared")],
        capture_output=True, text=True, timeout=1200, cwd=tmp_path, env=env,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    import json

    found = json.loads(done.stdout.strip().splitlines()[-1])
    assert {n: " ".join(c) for n, (c, _) in found.items()} == CONTRACT
    assert all(n > 0 for _, n in found.values())
