"""Token counts (5): count-only Viterbi over Aho-Corasick matches.

An automaton enumerates all vocabulary matches in text order, at each end the
longest first. The dynamic programme keeps the best score and the number of
pieces of the best path for each place, no path. Words that were not seen before
are laid end to end and take one pass; counts are remembered by word.

Each row is handled by itself, in Arrow batches: nothing is shuffled, and a task
holds a bounded memory of words.

Defined results: a null or empty text has no tokens. A null ``doc_id`` stays
null. Repeated rows give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from riskwatch.llm.common import ship
from riskwatch.llm.unigram import MARK, Vocabulary, load, marked, marked_words

MODEL = "piece_bpe_32k.model"
WORDS_KEPT = 700_000
DOCS = 1000


@lru_cache(maxsize=2)
def _automaton(path: str) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, (_, score) in load(path).pieces.items():
        found.add_word(text, (len(text), score))
    found.make_automaton()
    return found


def count_known(automaton: ahocorasick.Automaton, text: str) -> list[int]:
    """Pieces of the best path to each place; each character is a piece."""
    best: list[float | None] = [None] * (len(text) + 1)
    count = [0] * (len(text) + 1)
    best[0] = 0.0
    for last, (length, score) in automaton.iter(text):
        start = last + 1 - length
        total = best[start] + score
        now = best[last + 1]
        if now is None or total > now:
            best[last + 1] = total
            count[last + 1] = count[start] + 1
    return count


def count_any(automaton: ahocorasick.Automaton, vocabulary: Vocabulary, text: str) -> int:
    """As ``count_known``, with unknown characters counted by their bytes."""
    ends: list[list[tuple[int, float, int]]] = [[] for _ in text]
    for last, (length, score) in automaton.iter(text):
        ends[last].append((last + 1 - length, score, 1))
    best, count = [0.0], [0]
    for last, arrivals in enumerate(ends):
        if text[last] not in vocabulary.pieces:
            arrivals.append((last, vocabulary.unknown_score, len(text[last].encode())))
        top, pieces = None, 0
        for start, score, n in arrivals:
            if top is None or best[start] + score > top:
                top, pieces = best[start] + score, count[start] + n
        best.append(top)
        count.append(pieces)
    return count[-1]


_counts: dict[str, dict[str, int]] = {}


def _learn(path: str, counts: dict[str, int], keys: set[str]) -> None:
    automaton, vocabulary = _automaton(path), load(path)
    known = vocabulary.characters
    # A word of marks alone would run into the next one.
    plain = [k for k in keys if known.issuperset(k) and k[-1] != MARK]
    at = count_known(automaton, "".join(map(marked, plain)))
    place = 0
    for key in plain:
        end = place + len(marked(key))
        counts[key] = at[end] - at[place]
        place = end
    for key in keys.difference(plain):
        counts[key] = count_any(automaton, vocabulary, marked(key))


def count_tokens(texts: list[str | None], path: str) -> list[int]:
    counts = _counts.setdefault(path, {})
    words = [marked_words(t) if t else [] for t in texts]
    new = set().union(*words).difference(counts) if words else set()
    if len(counts) + len(new) > WORDS_KEPT:
        counts.clear()
        new = set().union(*words)
    _learn(path, counts, new)
    return [sum(map(counts.__getitem__, w)) for w in words]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row; ``path`` is a model file."""
    ship(docs.sparkSession)
    model = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), DOCS):
                part = batch.slice(at, DOCS)
                texts = part.column(1).to_pylist()
                words = pa.array([len(marked_words(t)) if t else 0 for t in texts], pa.int64())
                tokens = pa.array(count_tokens(texts, model), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), words, tokens], names=["doc_id", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
