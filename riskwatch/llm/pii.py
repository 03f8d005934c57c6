"""PII (2): anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
schemes, plus signs, digits and identifier cues. Small deterministic parsers
then walk from an anchor to the borders of an address and check it. Text without
anchors costs the automaton's pass only.

Kinds. Base, in this order: ``email``, ``ip``, ``card``, ``phone``. Added by
expansion: ``url`` (an address behind a scheme that names a person: with user
information, or a mail or telephone scheme) and ``account`` (an identifier behind
a cue such as "iban" or "ssn", with checks of its own). Base matches never
depend on the added ones.

Each row is handled by itself, in Arrow batches, so nothing is shuffled. Every
parser goes on where the last of its kind ended, and a run of address characters
is read once for all schemes in it, so a text costs time in proportion to its
length, whatever stands in it.

Defined results: a null text is an empty one, without spans. A null ``doc_id``
stays null. Repeated rows give a row each. Other columns are not read by
``find_pii``; ``redact`` keeps every column of its input. Positions are code
points, ends exclusive; spans of different kinds may overlap. An empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import ship

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account")

# What the automaton looks for, apart from "@", "+" and digits.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:", "sip:")
CUES = ("iban", "ssn", "account no", "account number", "acct", "passport", "tax id", "konto", "compte")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS_BACK = re.compile(r"[^0-9]")
_ADDRESS = re.compile(r"[^\s<>\"'(){}\[\]]+")
_ACCOUNT = re.compile(r"[\s:#=.]{0,4}(?:(?:is|no|nr|number)[\s:#=.]{1,3})?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){2,8}|[0-9](?:[ -]?[0-9]){5,17})")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}")

Span = tuple[str, int, int]


def _automaton() -> ahocorasick.Automaton:
    anchors = {"@": "email", "+": "phone"}
    anchors.update(dict.fromkeys("0123456789", "digit"))
    anchors.update(dict.fromkeys(SCHEMES, "url"))
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            anchors[form] = "account"
    found = ahocorasick.Automaton()
    for text, kind in anchors.items():
        found.add_word(text, (kind, len(text)))
    found.make_automaton()
    return found


_anchors = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _iban(text: str) -> bool:
    """The remainder of 97 over the rearranged number, letters as two digits."""
    turned = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _email(text: str, at: int, after: int) -> Span | None:
    """From an at-sign to both borders, not before the last match's end."""
    start = at
    while start > after and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return ("email", start, domain.end()) if domain else None


def _ips(text: str, at: int) -> tuple[list[Span], int]:
    """Groups of four in the dotted chain of numbers that starts at ``at``."""
    chain = _NUMBERS.match(text, at)
    found, start = [], at
    numbers = chain.group().split(".")
    for k in range(0, len(numbers) - 3, 4):
        group = numbers[k : k + 4]
        end = start + sum(map(len, group)) + 3
        # Leading zeros go first: a number may have any length.
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (number.lstrip("0") for number in group)):
            found.append(("ip", start, end))
        start = end + 1
    return found, chain.end()


def _card(text: str, at: int) -> tuple[Span | None, int]:
    chain = _CARD.match(text, at)
    if chain is None:
        return None, at + 1
    digits = _DIGITS_BACK.sub("", chain.group())
    fits = 16 <= len(digits) <= 19 and luhn(digits)
    return ("card", at, chain.end()) if fits else None, chain.end()


def _phone(text: str, at: int) -> tuple[Span | None, int]:
    chain = _PHONE.match(text, at)
    if chain is None:
        return None, at + 1
    fits = 8 <= sum(map(str.isdigit, chain.group())) <= 15
    return ("phone", at, chain.end()) if fits else None, chain.end()


class _Address:
    """The run of address characters around a scheme, looked at once for all
    schemes in it."""

    def __init__(self) -> None:
        self.stop = self.end = 0
        self.last_at = self.seventh = -1

    def enter(self, text: str, start: int) -> bool:
        """Whether characters follow at ``start``; reads their run if it is a new one."""
        if start >= self.stop:
            rest = _ADDRESS.match(text, start)
            if rest is None:
                return False
            self.stop = self.end = rest.end()
            while self.end > start and text[self.end - 1] in ".,;:!?":
                self.end -= 1
            self.last_at = text.rfind("@", start, self.end)
            digits = [k for k, c in enumerate(text[start : self.end], start) if c.isdigit()][-7:]
            # From here on or before, seven digits follow.
            self.seventh = digits[0] if len(digits) == 7 else -1
        return True

    def url(self, text: str, start: int, scheme_end: int) -> Span | None:
        if not self.enter(text, scheme_end):
            return None
        if text.startswith("//", scheme_end - 2):
            path = text.find("/", scheme_end, self.end)
            personal = "@" in text[scheme_end : path if path >= 0 else max(scheme_end, self.end)]
        else:
            personal = max(self.last_at, self.seventh) >= scheme_end
        return ("url", start, self.end) if personal else None


def _account(text: str, start: int, cue_end: int) -> Span | None:
    if start and text[start - 1].isalnum():
        return None
    found = _ACCOUNT.match(text, cue_end)
    if found is None:
        return None
    value = found.group(1)
    plain = re.sub(r"[ -]", "", value)
    if plain[0].isdigit():
        number = text[start:cue_end].lower() != "ssn" or _SSN.fullmatch(value)
        return ("account", found.start(1), found.end(1)) if number else None
    # An identifier may run into a following word: take the longest valid part.
    parts = value.split(" ")
    while parts:
        if _iban("".join(parts)):
            return ("account", found.start(1), found.start(1) + len(" ".join(parts)))
        parts.pop()
    return None


def find_spans(text: str) -> list[Span]:
    """All spans, by kind as listed and then by start."""
    by_kind: dict[str, list[Span]] = {kind: [] for kind in (*BASE, *ADDED)}
    after = dict.fromkeys((*BASE, *ADDED), 0)
    digits_after, address = 0, _Address()
    for last, (anchor, length) in _anchors.iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= after["ip"]:
                found, after["ip"] = _ips(text, at)
                by_kind["ip"] += found
            if at >= digits_after:
                span, digits_after = _card(text, at)
                if span:
                    by_kind["card"].append(span)
            continue
        if at < after[anchor]:
            continue
        if anchor == "email":
            span = _email(text, at, after["email"])
        elif anchor == "phone":
            span, after["phone"] = _phone(text, at)
        elif anchor == "url":
            span = address.url(text, at, last + 1)
        else:
            span = _account(text, at, last + 1)
        if span:
            by_kind[anchor].append(span)
            after[anchor] = span[2]
    return [span for spans in by_kind.values() for span in spans]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {kind: [] for kind in (*BASE, *ADDED)}
        hashes, texts = [], []
        for text in batch.column(1).to_pylist():
            spans = find_spans(text) if text else []
            for kind, column in counts.items():
                column.append(sum(s[0] == kind for s in spans))
            base = _joined([s for s in spans if s[0] in BASE])
            hashes.append(hashlib.sha256(base.encode()).hexdigest())
            texts.append(_joined(spans))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(counts[kind], pa.int64()) for kind in BASE],
                pa.array(hashes, pa.string()),
                pa.array(texts, pa.string()),
                *[pa.array(counts[kind], pa.int64()) for kind in ADDED],
            ],
            names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", *[f"n_{k}" for k in ADDED]],
        )


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row: counts by kind, the base spans' hash and all spans as text."""
    ship(docs.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in BASE)
    added = ", ".join(f"n_{k} long" for k in ADDED)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _digest, f"doc_id {kind}, {counts}, base_sha256 string, spans string, {added}"
    )


def mask(text: str | None) -> str | None:
    """The text with each span, or run of overlapping spans, named by its kind."""
    if not text:
        return text
    out, done = [], 0
    # The longest of those with one start first; what overlaps it goes with it.
    for kind, start, end in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, personal data in ``text`` masked."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(mask, na_action="ignore")

    out = docs.withColumn("text", masked("text"))
    # The recorded length, where there is one, follows the text.
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
