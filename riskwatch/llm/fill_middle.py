"""Fill-in-middle (12): a text is cut at two line borders and its parts reordered.

Repeated-capture matching: one ``fullmatch`` of ``(unit)*`` by the regex library
retains every repetition of the group, so ``match.ends(1)`` holds all line ends
at once. Its length is the number of lines, and both cut offsets are looked up in
it. The unit has no second way to match, so its possessive form gives the same
match and keeps no states to fall back on: time is linear in the text.

Where the cuts fall, whether a text is transformed and in which form is decided
by a hash of seed and ``doc_id`` alone, so reruns and lost executors give the
same rows. Every row is handled by itself: nothing is shuffled, a hot source is
like any other, and a worker holds the output of ``DOCS`` texts at a time.

Defined results: a null text is an empty one; an empty text is plain with no
lines. A null ``doc_id`` is hashed as an empty number and stays null. Repeated
rows give a row each, with equal cuts. Other columns are not read, so they may
have any name. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import ship

# The markers, and the three forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

LINES = regex.compile(r"([^\n]*+\n|[^\n]++)*+")

SEED = 7
#: Texts transformed, and of them those with the suffix first, in per cent.
RATE = 100
SPM_RATE = 50
#: Texts whose output a worker holds at once.
DOCS = 128

Made = tuple[int, str, int | None, int | None, str]


def _numbers(seed: int, doc_id: int | None) -> list[int]:
    """Four unsigned 32-bit numbers for a document."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(key.encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in (0, 8, 16, 24)]


def fill_middle(text: str, doc_id: int | None, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> Made:
    """Lines, form, length of prefix and middle (None if plain), and the output."""
    ends = LINES.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = _numbers(seed, doc_id)
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not n or marked or h3 % 100 >= rate:
        return n, PLAIN, None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a = ends[first - 1] if first else 0
    b = ends[last - 1] if last else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and ``output`` per row of ``docs``."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), DOCS):
                part = batch.slice(at, DOCS)
                rows = zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True)
                made = [fill_middle(text or "", doc, seed, rate, spm_rate) for text, doc in rows]
                n, form, prefix, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of.

    A transformed text holds no marker of its own, and none can arise where a
    part meets a marker, so the output falls into exactly four pieces.
    """
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output))


def digests(made: DataFrame) -> DataFrame:
    """``transform``'s rows with hashes of the output and of the text rebuilt from it."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL: lines by splitting, offsets by summing lengths."""
    hashed = f"sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))"

    def number(at: int) -> str:
        return f"('0x' || substr(h, {at}, 8))::BIGINT"

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {hashed} AS h FROM documents
), cut AS (
  SELECT doc_id, t, {number(1)} AS h1, {number(9)} AS h2, {number(17)} AS h3, {number(25)} AS h4,
    string_split(t, chr(10)) AS pieces
  FROM d
), lined AS (
  SELECT *, [p || chr(10) FOR p IN pieces[:-2]] || [p FOR p IN pieces[-1:] IF p <> ''] AS lines FROM cut
), placed AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS i,
    greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS j
  FROM lined
), parts AS (
  SELECT doc_id, t, n, h3, h4, array_to_string(lines[:i], '') AS p, array_to_string(lines[i + 1:j], '') AS m,
    array_to_string(lines[j + 1:], '') AS s
  FROM placed
), formed AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
      OR h3 % 100 >= {RATE} THEN '{PLAIN}' WHEN h4 % 100 < {SPM_RATE} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM parts
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> '{PLAIN}' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> '{PLAIN}' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    WHEN '{SPM}' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE t END) AS output_sha256,
  sha256(CASE WHEN form = '{PLAIN}' THEN t ELSE p || m || s END) AS restored_sha256
FROM formed
"""
