"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs and
digits, URL schemes, identifier cues and street words. From each anchor a
small deterministic parser expands to the boundaries of an email, network
address, card, phone, URL, account identifier or postal address and validates
it. Every parser keeps a cursor, so matches of one kind never overlap and a
text is read a bounded number of times.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "address")

SCHEMES = ("http://", "https://", "ftp://")
#: Words before an identifier. The value must contain a digit.
CUES = ("account", "acct", "iban", "ssn", "passport", "password", "passwd", "token", "secret", "api_key", "apikey", "akia")
#: Words that end a street name of their own, or one joined to them, or (in
#: Romance languages) begin one.
STREETS = (" street", " avenue", " road", " lane", " boulevard", " drive", " st", " ave", " rd", " ln", " blvd", " dr", " way", " court", " ct",
           " place", " square", " sq", " terrace", " crescent", " highway", " parkway",
           "straße", "strasse", "str.", "platz", "weg", "gasse", "allee", "rue ", "calle ")
#: Street words that are also other words: the name after them has a capital.
STREETS_BEFORE_CAPITALS = ("avenue ", "boulevard ", "place ", "avenida ", "paseo ", "plaza ", "via ", "viale ", "piazza ", "corso ")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").match
_DIGITS = re.compile(r"[0-9]+").match
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_URL = re.compile(r"[^\s<>\"'{}|\\^`]+").match
_HEAD = re.compile(r"[\"']?(?:[ \t]{0,3}(?:no\.|nr\.|(?:no|nr|number)(?![A-Za-z_/+.-])|(?:id|key)(?![A-Za-z0-9_/+.-]))[\"']?)?[ \t]{0,3}([:=#]?)[ \t]{0,3}([\"'`]?)", re.I).match
_QUOTED = {q: re.compile(rf"((?:[^{q}\\\n]|\\.)*){q}").match for q in "\"'`"}
_NAMED = re.compile(r"([A-Za-z_]{1,40})[\"']?[:=]").match
_TO_SPACE = re.compile(r"\S+").match
_GROUPED = re.compile(r"[0-9]{2,}(?:[ -][0-9]{2,})+(?![0-9A-Za-z])").match
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]{4}){2,7}(?:[ -]?[A-Z0-9]{1,3})?(?![0-9A-Za-z])").match
_IBAN_PLAIN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Z])", re.I).match
#: Marks of the sentence around a value, not of the value.
_AFTER_VALUE = ".,;:)]}>\"'`"
_CLOUD_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])").match
_HOUSE_BEFORE = re.compile(r"[0-9]{1,5}[A-Za-z]?(?: [A-ZÀ-Þ][\w'.-]{0,40}){1,4}$")
_HOUSE_AFTER = re.compile(r"[ ,]{1,2}[0-9]{1,5}[A-Za-z]?(?![0-9A-Za-z])").match
_NAME_AFTER = re.compile(r"(?:[\w'.-]{1,40} ){0,4}[\w'.-]{1,40}[ ,]{1,2}[0-9]{1,5}(?![0-9A-Za-z])").match
_CAPITAL_AFTER = re.compile(r"(?:(?:de|du|des|d'|del|della|dei|dell'|la|las|le|les|los|l') ?){0,2}[A-ZÀ-Þ]").match
_HOUSE_FIRST = re.compile(r"[0-9]{1,5}(?: ?bis)?,? $")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def iban(value: str) -> bool:
    value = value.replace(" ", "").replace("-", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", c))
    a.add_word("@", ("at", "@"))
    a.add_word("+", ("plus", "+"))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES), ("street", (*STREETS, *STREETS_BEFORE_CAPITALS))):
        for w in words:
            a.add_word(w, (kind, w))
    a.make_automaton()
    return a


_ANCHORS: list[ahocorasick.Automaton] = []


def find(raw: bytes) -> dict[str, list[tuple[int, int]]]:
    """Spans per kind in one text, code points, end exclusive, by start."""
    if not _ANCHORS:
        _ANCHORS.append(_automaton())
    text = raw.decode("utf-8")
    folded = raw.lower().decode("utf-8")  # A-Z only, so positions stay
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # first position each kind may still use
    dull = 0  # no account value that runs to a white space starts before this
    for end, (anchor, word) in _ANCHORS[0].iter(folded):
        at = end + 1 - len(word)
        if anchor == "digit":
            if at >= free["ip"]:
                m = _IP(text, at)
                if m:
                    free["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                        spans["ip"].append(m.span())
                else:
                    free["ip"] = _DIGITS(text, at).end()
            if at >= free["card"]:
                m = _CARD(text, at)
                if m:
                    free["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(m.span())
                else:
                    free["card"] = at + 1
        elif anchor == "at":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN(text, at + 1) if start < at else None
            if m:
                free["email"] = m.end()
                spans["email"].append((start, m.end()))
        elif anchor == "plus":
            m = _PHONE(text, at) if at >= free["phone"] else None
            if m:
                free["phone"] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    spans["phone"].append(m.span())
        elif anchor == "scheme":
            if at < free["url"] or (at and text[at - 1].isalnum()):
                continue
            m = _URL(text, end + 1)
            stop = m.end() if m else end + 1
            while stop > end + 1 and text[stop - 1] in ".,;:!?)]":
                stop -= 1
            if stop > end + 1 and text[end + 1].isalnum():
                free["url"] = stop
                spans["url"].append((at, stop))
        elif anchor == "cue":
            if at < free["account"] or (at and (text[at - 1].isalnum() or text[at - 1] == "_")):
                continue
            if word == "akia":
                m = _CLOUD_KEY(text, at)
                span = m.span() if m else None
            else:
                span, dull = _value(text, end + 1, word, dull)
            if span:
                free["account"] = span[1]
                spans["account"].append(span)
        else:
            span = _street(text, at, end + 1, word)
            if span and span[0] >= free["address"]:
                free["address"] = span[1]
                spans["address"].append(span)
    return spans


def _value(text: str, at: int, word: str, dull: int) -> tuple[tuple[int, int] | None, int]:
    """Identifier after a cue that ends at ``at``, and ``dull`` moved on.

    An IBAN or digits may stand in groups; any other value runs to its closing
    quote, else to the next white space without the punctuation before it.
    What runs from before ``dull`` to a white space is known to have no digit."""
    if at >= len(text) or text[at].isalnum():
        return None, dull
    head = _HEAD(text, at)
    sign, quote, start = head[1], head[2], head.end()
    m = _IBAN(text, start)
    stop = m.end() if m else start
    while stop > start and not iban(text[start:stop]):  # a capital word after it may look like a group
        stop = max(text.rfind(" ", start, stop), text.rfind("-", start, stop), start)
    if stop > start:
        return (start, stop), dull
    m = _IBAN_PLAIN(text, start)
    if m and iban(m[0]):
        return m.span(), dull
    if word == "iban":
        return None, dull
    closed = _QUOTED[quote](text, start) if quote and sign else None
    if closed:
        return (closed.span(1) if len(closed[1]) >= 6 and any("0" <= c <= "9" for c in closed[1]) else None), dull
    named = _NAMED(text, start)
    if named and (not sign or named[1].lower() in CUES):  # the value of that name, found from its own cue
        return None, dull
    m = _TO_SPACE(text, start) if start >= dull else None
    if not m or not (sign or m[0][0].isalnum()):
        return None, dull
    if not any("0" <= c <= "9" for c in m[0]):
        return None, m.end()
    stop = start + len(m[0].rstrip(_AFTER_VALUE))
    grouped = _GROUPED(text, start)
    if grouped:
        stop = max(stop, grouped.end())
    return ((start, stop) if stop - start >= 6 else None), dull


def _street(text: str, at: int, stop: int, word: str) -> tuple[int, int] | None:
    """Postal address around a street word: house number and name before it,
    name joined to it and number after it, or number, word and name."""
    if word.startswith(" "):
        if stop < len(text) and text[stop].isalnum():
            return None
        lead = max(0, at - 120)
        m = _HOUSE_BEFORE.search(text[lead:at])
        return (lead + m.start(), stop) if m else None
    if word.endswith(" "):
        if at and text[at - 1].isalnum() or word in STREETS_BEFORE_CAPITALS and not _CAPITAL_AFTER(text, stop):
            return None
        lead = max(0, at - 12)
        m = _HOUSE_FIRST.search(text[lead:at])
        if m:
            after = re.compile(r"(?:[\w'.-]{1,40} ?){1,4}").match(text, stop)
            return (lead + m.start(), after.end()) if after else None
        m = _NAME_AFTER(text, stop)
        if m and word in STREETS_BEFORE_CAPITALS and not text[at].isupper():
            return None
        return (at, m.end()) if m else None
    start = at
    while start and text[start - 1].isalpha() and at - start < 60:
        start -= 1
    m = _HOUSE_AFTER(text, stop)
    return (start, m.end()) if m and start < at else None


def joined(spans: dict[str, list[tuple[int, int]]], kinds=KINDS) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def detect(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: ``keep`` columns, a count per base kind,
    ``base_sha256`` and ``spans``. NULL text is the empty text (no spans);
    repeated rows repeat; an empty table gives no rows; other columns of
    ``docs`` are ignored."""
    prepare(docs.sparkSession)
    counted = [f"n_{k}" for k in BASE_KINDS]
    names = [f"__k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digests, listed = [], []
            for raw in texts_of(batch, "__pii_text"):
                spans = find(raw)
                for column, kind in zip(counts, BASE_KINDS, strict=True):
                    column.append(len(spans[kind]))
                digests.append(hashlib.sha256(joined(spans, BASE_KINDS).encode()).hexdigest())
                listed.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                [*names, *counted, "base_sha256", "spans"])

    schema = T.StructType([T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep, strict=True)]
                          + [T.StructField(c, T.LongType()) for c in counted]
                          + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    source = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").alias("__pii_text"))
    found = source.mapInArrow(run, schema)
    for name, c in zip(names, keep, strict=True):
        found = found.withColumnRenamed(name, c)
    return found


def redact_text(raw: bytes) -> str:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans become one, named after the one that starts first."""
    spans = sorted((a, b, KINDS.index(k)) for k, found in find(raw).items() for a, b in found)
    text, out, at = raw.decode("utf-8"), [], 0
    i = 0
    while i < len(spans):
        start, stop, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < stop:
            stop = max(stop, spans[i][1])
            i += 1
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = stop
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; NULL stays NULL.
    ``n_chars``, where present, is the new length. All other columns, and
    repeated rows, stay as they are."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column(at).is_null().to_pylist()
            texts = [None if gone else redact_text(raw) for gone, raw in zip(null, texts_of(batch, "text"), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    cleaned = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned
