"""Operators that judge each text alone: personal data, language, toxicity, decontamination."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontaminate, language, pii, toxicity

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AUTOMATON = pii.anchors()


def base_spans(text):
    """The base definition, by plain regular expressions."""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


PARTS = ["@", ".", "+", "-", " ", "(", ")", "a", "B7", "%", "ß", "1", "25", "255", "256", "0", "4111 1111 1111 1111", "+49 30 1234567", "x@y.de", "10.0.0.1", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_are_those_of_the_definition(text):
    found = [s for s in pii.find_spans(text, AUTOMATON) if s[0] in pii.BASE]
    assert found == base_spans(text)


def test_anchors_beside_the_base():
    text = "see https://a.example/x?y=1, IBAN: DE89 3704 0044 0532 0130 00 and account no 12345678."
    kinds = {k: text[a:b] for k, a, b in pii.find_spans(text, AUTOMATON)}
    assert kinds["url"] == "https://a.example/x?y=1"
    assert kinds["iban"] == "DE89 3704 0044 0532 0130 00"
    assert kinds["account"] == "12345678"


def test_personal_data_of_odd_rows(docs):
    long = "word " * 200_000 + "me@home.org"
    rows = {r["doc_id"]: r["pii"] for r in pii.find_personal_data(docs([None, "", long, "me@home.org", "me@home.org"])).collect()}
    assert rows[0] == rows[1] == []
    assert [(s["start"], s["end"]) for s in rows[2]] == [(1_000_000, 1_000_011)]
    assert rows[3] == rows[4] != []
    assert pii.find_personal_data(docs([])).count() == 0


@pytest.fixture(scope="module")
def tongues():
    rng = random.Random(5)
    words = {"xx": ["zork", "blim", "krat", "zuzu"], "yy": ["alei", "oeau", "iuen", "eilo"]}
    return lambda lang, n=30: " ".join(rng.choice(words[lang]) for _ in range(n))


def test_language_learns_from_text_and_knows_nothing_else(spark, docs, tongues):
    training = spark.createDataFrame([(i, tongues(lang), lang) for i in range(60) for lang in ("xx", "yy")], "doc_id long, text string, lang string")
    model = language.train(training, bound=80)
    assert model.languages == ["xx", "yy"]
    texts = [None, "", "123 !?", tongues("xx"), tongues("yy"), tongues("yy", 20_000), tongues("xx").upper()]
    rows = {r["doc_id"]: r for r in language.identify(docs(texts), model).collect()}
    assert [rows[i]["lang_pred"] for i in range(7)] == ["und", "und", "und", "xx", "yy", "yy", "xx"]
    assert rows[0]["score"] == 0 and all(0.5 < rows[i]["score"] <= 1 for i in (3, 4, 5, 6))
    assert rows[3]["source"] == "s0"


def test_language_without_anything_to_learn(spark, docs):
    none = spark.createDataFrame([(1, None, "xx"), (2, "abc", None)], "doc_id long, text string, lang string")
    model = language.train(none)
    assert model is None
    assert {r["lang_pred"] for r in language.identify(docs(["abc", None]), model).collect()} == {"und"}
    assert language.identify(docs([]), model).count() == 0


def test_temperature_makes_sure_of_less_where_it_was_wrong():
    rng = np.random.default_rng(1)
    ys = rng.integers(0, 2, 500)
    logits = np.where(np.arange(2) == ys[:, None], 8.0, -8.0) * np.where(rng.random(500) < 0.7, 1, -1)[:, None]
    assert language.fit_temperature(logits, ys) > 5


def test_toxicity_finds_the_sentence(spark, docs):
    rng = random.Random(2)
    clean = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) + rng.choice(["", "", "."]) for _ in range(n))
    rows = [(i, clean(60) + (" snotgurgle " if i % 3 == 0 else " ") + clean(60), int(i % 3 == 0)) for i in range(300)]
    base = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(base, labels)
    offending = clean(40) + ". This snotgurgle again. " + clean(1000)
    texts = [None, "", "...", clean(50), "snotgurgle", offending, clean(1000)]
    found = {r["doc_id"]: r for r in toxicity.score(docs(texts), model, sentences=True).collect()}
    assert [found[i]["toxicity"] >= 0.5 for i in range(7)] == [False, False, False, False, True, True, False]
    assert found[0]["toxicity"] == found[1]["toxicity"] == found[2]["toxicity"] == 0
    hits = [offending.encode()[s["start"] : s["end"]] for s in found[5]["offending"]]
    assert hits == [b"This snotgurgle again"]
    assert toxicity.score(docs([]), model).count() == 0


def test_toxicity_without_labels_of_both_kinds(spark, docs):
    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs(["a b c"]), labels) is None
    assert [r["toxicity"] for r in toxicity.score(docs(["a b c"]), None).collect()] == [0.0]


def distance_within(pattern, text):
    """The least edit distance of a pattern to any stretch of a text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def test_leaks_are_those_of_a_full_search():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [" ".join(word() for _ in range(30)) for _ in range(6)]
    index = decontaminate.build_index(list(enumerate(items)))
    texts = []
    for k in range(60):
        item = rng.choice(items)
        a = rng.randrange(len(item) - 60)
        part = list(item[a : a + rng.randint(60, 140)])
        for _ in range(rng.randint(0, 9)):
            i = rng.randrange(len(part))
            part[i] = rng.choice(["", "x", part[i] + "y"])
        texts.append(" ".join(word() for _ in range(20)) + " " + "".join(part) + " " + " ".join(word() for _ in range(20)))
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = decontaminate.find_leaks_in(index, data, offsets)
    for k, text in enumerate(texts):
        want = set()
        for w, item in enumerate(index.window_item):
            a, n = index.window_start[w], index.window_length[w]
            if distance_within(index.texts[item][a : a + n], text.encode()) <= index.window_edits[w]:
                want.add(int(item))
        assert {r["item_id"] for r in found.get(k, [])} == want


def test_leaks_of_odd_rows_and_shards(spark, docs):
    item = "What is the shortest path between the two marked corners of the larger cube, if edges count double?"
    other = "Name every river that crosses the northern border of the province described in the first paragraph."
    benchmark = spark.createDataFrame([(1, item), (2, other), (2, other), (3, None), (4, ""), (5, "short one")], "item_id long, text string")
    long = "filler text " * 100_000
    texts = [None, "", item, "x " + other.upper().replace(" ", "\n\t ") + " y", long + item, long, item[:50], "short one"]
    for size in (1 << 20, 150):
        rows = {r["doc_id"]: r["leaks"] for r in decontaminate.find_leaks(docs(texts), benchmark, size).collect()}
        assert [sorted({x["item_id"] for x in rows[i]}) for i in range(8)] == [[], [], [1], [2], [1], [], [], [5]]
    start = rows[4][0]["start"]
    assert abs(start - len(long)) <= 6
    assert decontaminate.find_leaks(docs([]), benchmark).count() == 0
    assert [r["leaks"] for r in decontaminate.find_leaks(docs([item]), benchmark.limit(0)).collect()] == [[]]
