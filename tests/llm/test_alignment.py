"""Alignment of two tokenizers against plain Python over every text, pair and group."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as they come, and the bytes of their tokens."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    v = alignment.read_vocabularies(A, B)
    return a, b, v


def by_hand(plain, text):
    """Ids of both, links and groups as text; None where a text has no tokens."""
    a, b, v = plain
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    wanted = (" " + text).encode()
    if b"".join(v.bytes_a[i] for i in ids_a) != wanted or b"".join(v.bytes_b[i] for i in ids_b) != wanted:
        return None
    spans = []
    for ids, table in ((ids_a, v.bytes_a), (ids_b, v.bytes_b)):
        at, own = 0, []
        for i in ids:
            own.append((at, at + len(table[i]), i))
            at += len(table[i])
        spans.append(own)
    links, first = [], 0
    for s, e, i in spans[0]:
        while spans[1][first][1] <= s:
            first += 1
        k = first
        while k < len(spans[1]) and spans[1][k][0] < e:
            links.append((i, spans[1][k][2]))
            k += 1
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, ka, kb = [], 0, 0
    for cut in cuts:
        parts = []
        for own, k in ((spans[0], ka), (spans[1], kb)):
            n = k
            while n < len(own) and own[n][1] <= cut:
                n += 1
            parts.append((",".join(str(own[j][2]) for j in range(k, n)), n))
        ka, kb = parts[0][1], parts[1][1]
        groups.append(f"{parts[0][0]}|{parts[1][0]}")
    return ids_a, ids_b, links, groups


def expected(plain, texts):
    each = [by_hand(plain, t) for t in texts]
    counts = Counter(pair for e in each if e for pair in e[2])
    highest: dict[int, int] = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for e in each:
        if e is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = e
        out.append((len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), ";".join(groups)))
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("small", [False, True])
def test_every_number_of_every_text(docs, plain, monkeypatch, small):
    if small:  # many buckets, leaves, shards and pieces
        for name, value in (("BUCKET_PAIRS", 50), ("LEAF_ROWS", 20), ("HELD_PAIRS", 40), ("PIECE", 30), ("BLOCK", 400), ("FAN_IN", 2)):
            monkeypatch.setattr(alignment, name, value)
        monkeypatch.setattr(alignment.pieces, "__defaults__", (30,))
    rng = random.Random(4)
    words = ["it's", "Zürich", "日本語", "1234", "--", "über", "<|endoftext|>", "</s>", "<0x41>", "a\tb", "x" * 40, "naïve", "🙂", "the", "der"]
    texts = [None, "", " ", "  ", "▁ no", "\n", "same text here", "same text here", "x" * 3000, "\x00null"]
    texts += [rng.choice([" ", "  ", " \n"]).join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(60)]
    texts.append(" ".join(rng.choices(words, k=30_000)))
    frame = docs(texts)
    found = alignment.align(frame, A, B, shard_pairs=150 if small else alignment.SHARD_PAIRS)
    rows = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in found.collect()}
    assert [rows[i] for i in range(len(texts))] == expected(plain, texts)


def test_repeated_rows_missing_ids_and_no_rows(docs):
    rows = alignment.align(docs(["one two", "one two", "three"], ids=[7, 7, None]), A, B).collect()
    assert sorted((r["doc_id"] or -1, r["n_a"]) for r in rows) == [(-1, 1), (7, 2), (7, 2)]
    assert {r["count_sum"] for r in rows if r["doc_id"] == 7} == {4}
    assert alignment.align(docs([]), A, B).count() == 0
    assert alignment.align(docs([None, ""]), A, B).count() == 2


def test_cutting_texts_changes_no_token(plain):
    a, b, v = plain
    encoder, rng = alignment.Encoder(v), random.Random(1)
    letters = [" ", "  ", "a", "it's", "1", "é", "\n", " \n", "!", " Foo", "日", "\t", "\xa0", "　"]
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randint(1, 60)))
        parts = alignment.pieces(text, rng.randint(1, 10))
        assert " ".join(parts) == text
        assert sum((encoder._a(" " + p) for p in parts), []) == a.encode(" " + text, add_special_tokens=False).ids
        assert sum((b.encode(p) for p in parts), []) == b.encode(text)
    long = "\n" * (3 * alignment.PIECE)
    assert encoder._a(long) == a.encode(long, add_special_tokens=False).ids


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 31, 20_000))
    sizes, bits, ordered = alignment.build_hash(keys)
    at = alignment.PerfectHash(0, [sizes], [bits]).index(keys, np.zeros(len(keys), np.int64))
    assert np.array_equal(np.sort(at), np.arange(len(keys))) and np.array_equal(ordered[at], keys)


def test_query_columns(spark, docs, tmp_path, plain):
    docs(["one two", None, "three"]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r.asDict() for r in queries.QUERIES["op12_alignment"](spark, str(tmp_path)).collect()}
    assert rows[1] == {"doc_id": 1, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "n_best": 0, "count_sum": 0, "groups_sha256": ""}
    groups = ";".join(by_hand(plain, "one two")[3])
    assert rows[0]["groups_sha256"] == hashlib.sha256(groups.encode()).hexdigest()
