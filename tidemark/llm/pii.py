"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs and pairs of digits as they occur
in numbers, URL schemes and words that announce an identifier. From each anchor a
deterministic local parser expands to the left and right, never behind the end of the last
match of its kind, and validates what it has. Every text is handled whole and alone.

Kinds of the base: ``email``, ``ip``, ``card`` (13 to 19 digits passing Luhn), ``phone`` (9 to
15 digits). Kinds beside it: ``url``, ``iban`` (checked modulo 97), ``account`` (six digits or
more after a cue). Positions are code points, the end is exclusive.

Defined results: null and empty texts have no spans; the same text gives the same spans each
time it occurs; kinds may overlap one another, matches of one kind never do. Other columns are
kept, one named ``pii`` is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "ssn", "passport", "konto", "cuenta", "compte")

SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_FOUR = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`]+")
_VALUE = re.compile(r"[ \t]*(?:no|number|nr)?[ \t.:#=]*([A-Za-z0-9](?:[ -]?[A-Za-z0-9])*)", re.I)


def anchors() -> ahocorasick.Automaton:
    """All anchors, each with the parser that it starts and its own length."""
    found = ahocorasick.Automaton()
    digits = sorted(_DIGITS)
    found.add_word("@", ("email", 1))
    for a in digits:
        found.add_word("+" + a, ("phone", 2))
        for b in digits:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for between in ("", " ", "-"):
                found.add_word(a + between + b, ("card", 2 + len(between)))
    for scheme in SCHEMES:
        for word in (scheme, scheme.upper()):
            found.add_word(word, ("url", len(word)))
    for cue in CUES:
        for word in (cue, cue.upper(), cue.capitalize()):
            found.add_word(word, ("cue", len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _email(text: str, at: int, free: int, spans: list) -> int:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    if not domain:
        return free
    spans.append(("email", start, domain.end()))
    return domain.end()


def _ip(text: str, at: int, free: int, spans: list) -> int:
    if at < free:  # this digit belongs to the last match
        return free
    start = at
    while start > free and text[start - 1] in _DIGITS:
        start -= 1
    four = _FOUR.match(text, start)
    if not four:  # too few parts, also from any later one on
        return _DOTTED.match(text, start).end()
    if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four.group().split(".")):
        spans.append(("ip", start, four.end()))
    return four.end()


def _card(text: str, at: int, free: int, spans: list) -> int:
    if at < free:
        return free
    run = _GROUPED.match(text, at)
    if run.end() - at <= 2 * 19:
        digits = run.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", at, run.end()))
    return run.end()


def _phone(text: str, at: int, free: int, spans: list) -> int:
    run = _PHONE.match(text, at)
    if not run:
        return free
    if 9 <= sum(c in _DIGITS for c in run.group()) <= 15:
        spans.append(("phone", at, run.end()))
    return run.end()


def _url(text: str, at: int, after: int, free: int, spans: list) -> int:
    if at < free:
        return free
    rest = _URL.match(text, after)
    end = after + len(rest.group().rstrip(".,;:!?)]}")) if rest else after
    if "." not in text[after:end] and "localhost" not in text[after:end]:
        return free
    spans.append(("url", at, end))
    return end


def _identifier(text: str, at: int, after: int, free: int, spans: list) -> int:
    """The value that a cue announces: an IBAN, or a number of six digits or more."""
    if at < free or (at and text[at - 1].isalnum()):
        return free
    value = _VALUE.match(text, after)
    if not value:
        return free
    start, best = value.start(1), None
    # words that follow belong to the value as long as they look like parts of one
    tokens = list(re.finditer(r"[A-Za-z0-9]+", value.group(1)[:80]))
    for n in range(len(tokens), 0, -1):
        body = "".join(t.group() for t in tokens[:n])
        if 15 <= len(body) <= 34 and re.fullmatch(r"[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]+", body):
            if int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1:
                best = ("iban", start, start + tokens[n - 1].end())
                break
    if best is None:
        n = 0
        while n < len(tokens) and any(c in _DIGITS for c in tokens[n].group()):
            n += 1
        if n and sum(c in _DIGITS for t in tokens[:n] for c in t.group()) >= 6:
            best = ("account", start, start + tokens[n - 1].end())
    if best is None:
        return free
    spans.append(best)
    return best[2]


def find_spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of one text, by kind and then by start."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    email = ip = card = phone = url = identifier = 0
    for last, (kind, length) in automaton.iter(text):
        at = last + 1 - length
        if kind == "card":
            if at >= card:
                card = _card(text, at, card, spans)
        elif kind == "email":
            email = _email(text, at, email, spans)
        elif kind == "ip":
            ip = _ip(text, at, ip, spans)
        elif kind == "phone":
            phone = _phone(text, at, phone, spans)
        elif kind == "url":
            url = _url(text, at, last + 1, url, spans)
        else:
            identifier = _identifier(text, at, last + 1, identifier, spans)
    spans.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return spans


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``pii``: the spans of ``text``."""
    docs = docs.drop("pii")
    schema = docs.select("*").schema.add("pii", SPANS)
    at = docs.columns.index("text")

    def find(batches):
        automaton = anchors()
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text.as_py(), automaton)] for text in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, SPANS_ARROW)], schema.names)

    return docs.mapInArrow(find, schema)
