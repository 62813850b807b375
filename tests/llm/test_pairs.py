"""Operators that compare rows: near-duplicates, lines, repeated substrings, packing."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import embeddings, lines, minhash, packing, repeats
from tidemark.llm.graph import components
from tidemark.llm.suffixes import suffix_order


def reached(ids, pairs):
    """The smallest id reachable, for each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    edges += [(5, 5), (None, 3), (900, 901), (901, 900), (900, 901)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == reached({i for e in real for i in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [None, "", " \n\t", "two words", "Two  WORDS", "x" * 5000, "same four word text", "same four word text"]
    for _ in range(12):
        base = [word() for _ in range(120)]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    hot = [word() for _ in range(60)]
    texts += [" ".join(hot + [word() for _ in range(60)]) for _ in range(40)]  # one passage, not near
    texts += [" ".join(hot)] * 25
    texts.append(" ".join(word() for _ in range(30_000)))
    return texts


def test_minhash_agrees_with_all_pairs(docs, near_texts):
    sets = [shingles(t) for t in near_texts]
    pairs = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    want = reached(range(len(sets)), pairs)
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs(near_texts)).collect()}
    assert {i: r["component_id"] for i, r in rows.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in rows.items())


def test_minhash_of_odd_ids(docs):
    text = "one two three four five six seven"
    rows = minhash.near_duplicates(docs([text, text, text, None], ids=[None, 4, 4, None])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == [("4", "4", True), ("4", "4", True), ("None", "None", True), ("None", "None", True)]
    assert minhash.near_duplicates(docs([])).count() == 0


def test_embeddings_agree_with_all_pairs(spark):
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(60):
        base = rng.standard_normal(32)
        vectors += [(base + rng.standard_normal(32) * rng.choice([0.1, 0.3, 0.5])).tolist() for _ in range(rng.integers(1, 12))]
    hot = rng.standard_normal(32)
    vectors += [(hot + rng.standard_normal(32) * 0.15).tolist() for _ in range(1100)]  # more than one block
    vectors += [vectors[0]] * 5
    bad = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [1e-200] * 32, [1e200] * 32]
    rows = [(i, v, "x") for i, v in enumerate(vectors + bad)]
    frame = spark.createDataFrame(rows + [(None, vectors[0], "x")], "vec_id long, embedding array<double>, rep string").repartition(4)
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    n, x = len(vectors), np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j]
    degree = near.sum(axis=1) - 1
    found_links = sum(found[i]["n_links"] for i in range(n))
    assert found_links <= degree.sum() and found_links >= 0.999 * degree.sum()
    want = reached(range(n), pairs)
    assert np.mean([found[i]["component_id"] == want[i] for i in range(n)]) >= 0.99
    for i in range(n, n + 6):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert found[n + 7]["component_id"] == n + 6 and found[n + 9]["component_id"] == n + 8  # parallel at any length
    assert found[None]["n_links"] == 0 and found[None]["kept"]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=5, max_size=30), st.text("ab", min_size=5, max_size=30)), min_size=1, max_size=10), st.integers(1, 4))
def test_banded_distance(pairs, limit):
    lefts, rights = ([p[k].encode() for p in pairs] for k in (0, 1))
    assert lines.within_edits(lefts, rights, limit).tolist() == [edits(a, b) <= limit for a, b in pairs]


def test_lines_agree_with_all_pairs(docs, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SEGMENT", 4)  # so that the small table has hot segments
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcde ü") for _ in range(n))
    pool = [text(rng.randint(26, 60)) for _ in range(40)]
    shared = text(30)
    texts = [None, "", "\n\n", "short\nshort", text(20_000) + "\n" + text(50)]
    for _ in range(40):
        part = []
        for _ in range(rng.randint(1, 8)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                i = rng.randrange(len(line))
                line[i] = rng.choice(["", "z", line[i] + "z"])
            part.append(rng.choice(["", "  "]) + "".join(line) + rng.choice(["", "\r"]))
        part.append(shared + text(15))  # one long segment, different ends
        texts.append("\n".join(part))
    texts += [texts[10], "\n".join([pool[0]] * 5)]
    first = {}
    split = [None if t is None else t.split("\n") for t in texts]
    for i, own in enumerate(split):
        for k, raw in enumerate(own or []):
            line = raw.strip(" \t\r")
            if len(line.encode()) >= lines.LEAST_BYTES:
                first.setdefault(line, (i, k))
    names = list(first)
    lost = {max(a, b, key=first.get) for x, a in enumerate(names) for b in names[:x] if edits(a.encode(), b.encode()) <= lines.EDITS}
    assert len(lost) > 5
    found = {r["doc_id"]: r for r in lines.dedup_lines(docs(texts)).collect()}
    for i, own in enumerate(split):
        if own is None:
            assert found[i]["text"] is None and found[i]["n_chars"] is None
            continue
        kept = [raw for k, raw in enumerate(own) if (s := raw.strip(" \t\r")) not in first or (first[s] == (i, k) and s not in lost)]
        assert found[i]["text"] == "\n".join(kept), i
        assert found[i]["n_chars"] == len(found[i]["text"])


def test_equal_lines_of_any_length_agree_with_all_lines(docs):
    """Equal lines go at any length; up to edits, only lines of EDIT_BYTES or more are compared."""
    rng = random.Random(11)
    pool = ["x", "Les.", "Lea.", "}", "ü", "", " ", "b" * 23, "b" * 22 + "c", "a" * 24, "a" * 23 + "c", "a" * 23]
    texts = ["\n".join(rng.choice(["", " "]) + rng.choice(pool) + rng.choice(["", "\r"]) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    texts.append(texts[3])
    seen, long, rows = set(), [], {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs(texts)).collect()}
    for i, text in enumerate(texts):
        kept = []
        for raw in text.split("\n"):
            line = raw.strip(" \t\r")
            near = len(line.encode()) >= lines.EDIT_BYTES and any(edits(line.encode(), x) <= lines.EDITS for x in long)
            if not line or (line not in seen and not near):
                kept.append(raw)
            seen.add(line)
            if len(line.encode()) >= lines.EDIT_BYTES:
                long.append(line.encode())
        assert rows[i] == "\n".join(kept), i
    assert not rows[30].strip()  # of an exact copy of a document, no line is left


def test_lines_of_odd_ids(docs):
    line = "this line is long enough to be compared"
    rows = lines.dedup_lines(docs([line, line, line, "", None], ids=[None, 3, 3, 4, None])).collect()
    assert sorted(str(r["text"]) for r in rows) == ["", "None", line, line, line]
    assert lines.dedup_lines(docs([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60) | st.lists(st.sampled_from([b"ab", b"aab", b"\xff", b"\x00"]), max_size=60).map(b"".join), st.sampled_from([0, 1 << 20]))
def test_suffix_order(data, bound):
    order = suffix_order(np.frombuffer(data, np.uint8), 12, bound)
    assert sorted(order.tolist()) == list(range(len(data)))
    cut = [data[i : i + 12] for i in order]
    assert cut == sorted(cut)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_agree_with_a_scan(docs, seed, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_KEY", 256 if seed == 1 else 2)
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, long = text(260), text(130)
    texts = [None, "", "a" * 99, "a" * 700, "ab" * 400, "Anble anes. \n" * 60, passage[:99]]
    texts += [text(rng.randint(0, 200)) + passage[rng.randint(0, 80) : rng.randint(150, 260)] + text(rng.randint(0, 200)) for _ in range(30)]
    texts += [text(50) + long * 3 + text(20), text(400), text(60_000)]
    texts += texts[-3:] + [texts[10], texts[-1][:5000]]
    rows = {r["doc_id"]: r for r in repeats.remove_repeats(docs(texts)).collect()}
    seen = {}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            if seen.setdefault(data[k : k + 100], (i, k)) != (i, k):
                gone[k : k + 100] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(data) else 0
        assert (bytes(rows[i]["kept"]), rows[i]["n_removed"], rows[i]["n_spans"]) == (kept, int(gone.sum()), spans), i


def test_repeats_around_one_passage_stay_in_small_shards(docs, monkeypatch):
    """More documents than HOT_KEY share a passage: no shard grows with them, and nothing is missed."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", 8192)
    sizes, sort = [], repeats._repeats

    def measured(pieces, window):
        sizes.extend(r[0] for r in pieces.selectExpr("shard", "length(text) AS n").groupBy("shard").sum("n").select("sum(n)").collect())
        return sort(pieces, window)

    monkeypatch.setattr(repeats, "_repeats", measured)
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(400)
    texts = [text(150) + passage + text(150) for _ in range(repeats.HOT_KEY + 144)]
    texts += [texts[7][60:500] + text(30), text(40) + passage[50:] + texts[9][550:640]]
    rows = {r["doc_id"]: r for r in repeats.remove_repeats(docs(texts)).collect()}
    seen = {}
    for i, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 99):
            if seen.setdefault(t[k : k + 100], (i, k)) != (i, k):
                gone[k : k + 100] = True
        assert bytes(rows[i]["kept"]) == np.frombuffer(t.encode(), np.uint8)[~gone].tobytes(), i
    assert max(sizes, default=0) <= 4 * repeats.SHARD_BYTES


def test_repeats_of_odd_ids(docs):
    text = "".join(chr(97 + k * k % 23) + chr(97 + k % 19) for k in range(100))
    rows = repeats.remove_repeats(docs([text, text, text, None], ids=[None, 3, 3, 5])).collect()
    assert [r["n_removed"] for r in rows] == [0, 0, 0, 0]
    assert repeats.remove_repeats(docs([])).count() == 0


def slow_best_fit(items, capacity):
    bins = []
    for size, source, cluster in items:
        fits = [
            b for b in bins
            if b["left"] >= size and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])
        ]
        best = min(fits, key=lambda b: (b["left"], b["n"]), default=None)
        if best is None:
            best = {"n": len(bins), "left": capacity, "sources": set(), "clusters": set()}
            bins.append(best)
        yield best["n"], capacity - best["left"]
        best["left"] -= size
        best["sources"].add(source)
        best["clusters"].add(cluster)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2, 3])), max_size=40))
def test_best_fit_is_the_tightest_compatible_bin(items):
    assert packing.best_fit(*([i[k] for i in items] for k in range(3)), 20) == list(slow_best_fit(items, 20))


def test_packing_whole_tables(docs):
    rng = random.Random(9)
    texts = [None, "", None, "x" * 1000, "y" * 100, "z" * 250] + ["d" * rng.randint(1, 100) for _ in range(60)] + ["same"] * 10
    rows = packing.pack(docs(texts), capacity=100).collect()
    for i, t in enumerate(texts):
        own = sorted((r["start"], r["size"]) for r in rows if r["doc_id"] == i)
        assert sum(s for _, s in own) == len(t or "") and all(a + s == b for (a, s), (b, _) in zip(own, own[1:]))
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for own in bins.values():
        own.sort(key=lambda r: (r["bin_offset"], r["size"]))
        assert sum(r["size"] for r in own) <= 100
        assert all(a["bin_offset"] + a["size"] == b["bin_offset"] for a, b in zip(own, own[1:]))
        clusters = [texts[r["doc_id"]] for r in own if texts[r["doc_id"]] is not None]
        assert len(clusters) == len(set(clusters)) and len({r["doc_id"] % 3 for r in own}) == len(own)
    assert packing.pack(docs([])).count() == 0
    assert packing.pack(docs(["a", "a"], ids=[None, None]), capacity=10).count() == 2
