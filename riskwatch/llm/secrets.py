"""Secret scans (3): novelty against zstandard dictionaries.

A candidate is a string in a sensitive context. Its novelty is measured by a
compressor that is primed with the identifiers and fixed words of code: the
compressed size of the surrounding text with the candidate less the size without
it. Names, words and repeated text cost little; random keys cost nearly their
full information. What that is depends on the alphabet, the length and the
surroundings, so ``DRAWS`` fixed random strings of the candidate's own alphabet
and length are measured in the same place. Candidates that cost ``SHARE`` of their
mean, less ``SLACK`` bytes, are reported as ``novel``, besides the base kinds,
which are always reported.

Each row is handled by itself, in Arrow batches. The compressor sees a window of
``AROUND`` characters on both sides of a candidate, so cost is linear in the text.
Copies of the candidate in the window are blanked out first: a key that stands
twice close by is as novel as one that stands once, at both places.

Defined results: a null text is an empty one, without spans. A null ``doc_id``
stays null. Repeated rows give a row each; other columns are not read. Positions
are code points, ends exclusive; spans of different kinds may overlap.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_lowercase, ascii_uppercase, digits

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from riskwatch.llm.common import ship

BASE = ("assign", "access", "hex")
SHARE, SLACK, DRAWS = 0.85, 1.0, 6
AROUND = 200
SHORTEST = 16

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_LONG = re.compile(r"[0-9a-f]{32}")

# Sensitive context: a cue, a separator within a few characters, and a string.
_CONTEXT = re.compile(
    r"(?:auth|bearer|credential|private|signature|session|cookie|pwd|passphrase|access|client|key|token|secret)"
    r"[A-Za-z_.-]{0,24}[\"']?\x20{0,3}(?:[:=]|\x20)\x20{0,3}[\"']?([A-Za-z0-9+/_.=-]{16,})",
    re.IGNORECASE | re.ASCII,
)

# A run of this kind is a key of its own in a candidate like "id=...;" or "... .".
_RUN = re.compile(r"[A-Za-z0-9]{16,}")
_MARKS = "+/_.=-"
_LEAST_COPY = 8
_USUAL = (digits, digits + "abcdef", digits + "ABCDEF")

# Identifiers and words that are common around keys and are none.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key client_id client_secret private_key public_key "
    "authorization bearer session cookie signature credential username user_name hostname endpoint region "
    "function return import class self config settings environment default example sample placeholder changeme "
    "https http www com org net localhost database connection string true false null none value name type "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef xxxxxxxxxxxxxxxx "
    "the and for that with this from have are was not but you all can had her his one our out day get has him how"
)
# Other words that names are made of.
NAME_WORDS = (
    "about above abstract accept account action active adapter address after agent alias align allow already always "
    "analysis analyze another answer append application apply argument array assert assign async attach attempt "
    "attribute audit available average await backend background backup balance base batch before begin between binary "
    "block body boolean border bottom boundary branch broker browser buffer build builder bundle button byte cache "
    "calculate callback cancel capture catalog category center certificate change channel character charge check "
    "child choice chunk clean clear click clone close cluster code collect collection color column command comment "
    "commit common compare compile complete component compress compute condition confirm connect consumer contact "
    "contain container content context continue control convert coordinate copy count country create current cursor "
    "custom customer data date debug decimal decode decorator default define delay delete delimiter deploy depth "
    "describe description destination detail detect device dialog dictionary difference digest dimension direct "
    "directory disable discard dispatch display document domain double download driver dynamic edge edit element "
    "email empty enable encode encrypt engine ensure entity entry enum error escape evaluate event every exact except "
    "exception execute exist exit expand expect expire explain export expression extend external extract factory "
    "failure feature fetch field file fill filter final find finish first flag flatten float flush folder follow "
    "footer force foreign format forward fragment frame framework free full future gateway general generate generator "
    "global grant graph group handle handler hash header height helper hidden history hook hour icon identifier "
    "ignore image implement include index information initial initialize inner input insert inspect install instance "
    "integer interface internal interval invalid invoke issue item iterator join journal keyword label language large "
    "last latest layer layout length level library license limit line link list listen load local location lock "
    "logger login lookup machine main manager manifest mapping margin marker mask master match matrix maximum measure "
    "member memory menu merge message metadata method metric middle migration minimum minute mobile mode model modify "
    "module monitor month mount move multiple native network next node normal notification notify number object "
    "offset online open operation operator option order origin other outer output overflow override owner package "
    "packet padding page parameter parent parse partial partition party patch path pattern payment peer pending "
    "percent performance permission persistent phone pipeline pixel plain platform plugin point pointer policy pool "
    "popup port position post prefix prepare present preview previous price primary print priority process processor "
    "produce product profile program progress project promise prompt property protocol provider proxy publish push "
    "quality query queue quick quote random range rate read reader ready reason receive record redirect reduce "
    "reference refresh register registry relation release reload remote remove rename render repeat replace report "
    "repository request require reset resize resolve resource response rest result resume retry reverse revision "
    "right role rollback root rotate round route router rule runtime safe sample save scale schedule schema scope "
    "score screen script scroll search second section security segment select send sender separator sequence serial "
    "server service share shell shift short signal simple single size skip slice small snapshot socket sort source "
    "space span special split stack stage standard start state statement static station statistics status step stop "
    "storage store stream street strict style subject submit subscribe success suffix summary support switch symbol "
    "sync system table tag target task template temporary tenant terminal test text thread threshold throw ticket "
    "time timeout timestamp title toggle tool total trace track traffic transaction transfer transform translate "
    "transport tree trigger trim tuple type undefined unique unit unknown unlock until update upgrade upload usage "
    "valid validate variable vector vendor verbose verify version vertical video view virtual visible visit volume "
    "wait warning watch weight width widget window wrapper write writer year zone"
)

Span = tuple[str, int, int]
_primer = f"{NAME_WORDS} {IDENTIFIERS}".encode()
_dictionary = zstandard.ZstdCompressionDict(_primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
_compressors: list[zstandard.ZstdCompressor] = []


def _size(text: str) -> int:
    if not _compressors:
        _compressors.append(
            zstandard.ZstdCompressor(level=9, dict_data=_dictionary, write_checksum=False, write_content_size=False)
        )
    return len(_compressors[0].compress(text.encode()))


def _around(text: str, start: int, end: int) -> str:
    """The text on both sides of a candidate, with copies of it blanked out.

    A copy across the window's border lies whole in the wider window, so its part
    inside goes too.
    """
    key, wide = text[start:end], AROUND + end - start
    copy, runs = key.strip(_MARKS), set(_RUN.findall(key))

    def blanked(part: str) -> str:
        if len(copy) >= _LEAST_COPY:
            part = part.replace(copy, " " * len(copy))
        return _RUN.sub(lambda m: " " * len(m[0]) if m[0] in runs else m[0], part) if runs else part

    return blanked(text[max(0, start - wide) : start])[-AROUND:] + blanked(text[end : end + wide])[:AROUND]


def alphabet_of(key: str) -> str:
    """The smallest usual alphabet that holds a key; marks only as they occur."""
    found = set(key)
    for usual in _USUAL:
        if found <= set(usual):
            return usual
    classes = [c for c in (ascii_lowercase, ascii_uppercase, digits) if not found.isdisjoint(c)]
    return "".join([*classes, *sorted(found.intersection(_MARKS))])


def _draws(alphabet: str, length: int) -> list[str]:
    """Random strings, the same ones in every process."""
    pick = random.Random(f"{alphabet} {length}")
    return ["".join(pick.choices(alphabet, k=length)) for _ in range(DRAWS)]


_short_draws = lru_cache(maxsize=1000)(_draws)


def novelty(text: str, start: int, end: int) -> tuple[int, float]:
    """Marginal compressed bytes of ``text[start:end]``, and of random strings there."""
    around, key = _around(text, start, end), text[start:end]
    base = _size(around)
    draws = (_short_draws if len(key) <= 500 else _draws)(alphabet_of(key), len(key))
    return _size(around + key) - base, sum(_size(around + d) - base for d in draws) / DRAWS


def is_novel(text: str, start: int, end: int) -> bool:
    own, usual = novelty(text, start, end)
    return own >= SHARE * usual - SLACK


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; failing ones dropped."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    at = 0
    # A run of 32 lies in the match that starts at the run's first character.
    while (hit := _HEX_LONG.search(text, at)) is not None:
        end = _HEX.match(text, hit.start()).end()
        found.append(("hex", hit.start(), end))
        at = end
    order = {kind: k for k, kind in enumerate(BASE)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def novel_spans(text: str) -> list[Span]:
    """Candidates in a sensitive context that do not compress."""
    found = []
    for m in _CONTEXT.finditer(text):
        start, end = m.span(1)
        if end - start >= SHORTEST and is_novel(text, start, end):
            found.append(("novel", start, end))
    return found


def find_spans(text: str) -> list[Span]:
    return sorted(base_spans(text) + novel_spans(text), key=lambda s: (s[1], (*BASE, "novel").index(s[0])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_novel"]
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            spans = find_spans(text) if text else []
            count = [sum(s[0] == kind for s in spans) for kind in (*BASE, "novel")]
            base = _joined([s for s in spans if s[0] != "novel"])
            rows.append((*count[:3], hashlib.sha256(base.encode()).hexdigest(), _joined(spans), count[3]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: counts by kind, the base spans' hash and all spans as text."""
    ship(docs.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in BASE)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _digest, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_novel long"
    )
