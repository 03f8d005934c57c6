"""SentencePiece encoding and decoding (8): shared-prefix Viterbi.

The distinct marked words of a batch are sorted, which lays them out as a trie in
depth-first order. Going from one word to the next, the forward scores of their
common prefix are kept and only the new characters are computed. A word's ids are
remembered as bytes, and a document is its words' bytes joined.

Each row is handled by itself, in Arrow batches: nothing is shuffled, and a task
holds a bounded memory of words.

Decoding gives the text back, except that the space mark itself comes back as a
space. Defined results: a null text has null ids, an empty one none, and both
come back as they were. A null ``doc_id`` stays null, repeated rows give a row
each, other columns are not read by ``encode``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import ship
from riskwatch.llm.unigram import MARK, Vocabulary, load, marked, marked_words

MODEL = "piece_bpe_32k.model"
WORDS_KEPT = 700_000
DOCS = 1000

Node = dict


@lru_cache(maxsize=2)
def _trie(path: str) -> Node:
    """Character to (node behind it, id or -1, score)."""
    root: Node = {}
    for text, (number, score) in sorted(load(path).pieces.items()):
        node = root
        for c in text[:-1]:
            node = node[c][0] if c in node else node.setdefault(c, ({}, -1, 0.0))[0]
        behind = node[text[-1]][0] if text[-1] in node else {}
        node[text[-1]] = (behind, number, score)
    return root


class PrefixViterbi:
    """Encodes words in sorted order; the state is a stack over the last word."""

    def __init__(self, root: Node, vocabulary: Vocabulary):
        self.root, self.vocabulary = root, vocabulary
        self.word = ""
        self.best, self.start, self.piece = [0.0], [0], [-1]
        self.open: list[list[tuple[int, Node]]] = [[]]

    def _extend(self, c: str) -> None:
        at = len(self.best) - 1
        best, single = self.best, False
        top, start, piece, still = None, at, -1, []
        # Starts ascend, so of equal scores the longest piece stays.
        for s, node in (*self.open[at], (at, self.root)):
            step = node.get(c)
            if step is None:
                continue
            behind, number, score = step
            if behind:
                still.append((s, behind))
            if number >= 0:
                single = s == at
                if top is None or best[s] + score > top:
                    top, start, piece = best[s] + score, s, number
        if not single and (top is None or best[at] + self.vocabulary.unknown_score > top):
            top, start, piece = best[at] + self.vocabulary.unknown_score, at, -1
        best.append(top)
        self.start.append(start)
        self.piece.append(piece)
        self.open.append(still)

    def encode(self, word: str) -> list[int]:
        shared, last = 0, self.word
        limit = min(len(word), len(last))
        while shared < limit and word[shared] == last[shared]:
            shared += 1
        for stack in (self.best, self.start, self.piece, self.open):
            del stack[shared + 1 :]
        for c in word[shared:]:
            self._extend(c)
        self.word = word
        ids, at = [], len(word)
        while at:
            piece, start = self.piece[at], self.start[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.vocabulary.bytes_from + b for b in reversed(word[start:at].encode())]
            at = start
        return ids[::-1]


_known: dict[str, dict[str, bytes]] = {}


def encode_texts(texts: list[str | None], path: str) -> list[bytes | None]:
    """Each text's ids as little-endian 32-bit integers."""
    known = _known.setdefault(path, {})
    words = [marked_words(t) if t else [] for t in texts]
    new = set().union(*words).difference(known) if words else set()
    if len(known) + len(new) > WORDS_KEPT:
        known.clear()
        new = set().union(*words)
    viterbi = PrefixViterbi(_trie(path), load(path))
    for word, key in sorted((marked(k), k) for k in new):
        known[key] = np.array(viterbi.encode(word), "<i4").tobytes()
    return [None if t is None else b"".join(map(known.__getitem__, w)) for t, w in zip(texts, words, strict=True)]


def decode_ids(ids: np.ndarray, path: str) -> str:
    """The text of ids; runs of byte pieces become characters."""
    return b"".join(map(_bytes_of(path).__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> list[bytes]:
    vocabulary = load(path)
    first = vocabulary.bytes_from
    plain = [t.replace(MARK, " ").encode() for t in vocabulary.texts]
    return [bytes([k - first]) if first <= k < first + 256 else b for k, b in enumerate(plain)]


def _array_of(encoded: list[bytes | None]) -> pa.Array:
    """An Arrow list array over the joined bytes, without Python integers."""
    sizes = np.cumsum([0, *[len(e) // 4 if e is not None else 0 for e in encoded]]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(e for e in encoded if e), "<i4"))
    return pa.ListArray.from_arrays(pa.array(sizes), values, mask=pa.array([e is None for e in encoded]))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): ``exact`` where decoding gives the text."""
    ship(docs.sparkSession)
    model = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), DOCS):
                part = batch.slice(at, DOCS)
                texts = part.column(1).to_pylist()
                encoded = encode_texts(texts, model)
                exact = [
                    None if t is None else decode_ids(np.frombuffer(e, "<i4"), model) == t.replace(MARK, " ")
                    for t, e in zip(texts, encoded, strict=True)
                ]
                count = pa.array([len(e) // 4 if e is not None else 0 for e in encoded], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), count, _array_of(encoded), pa.array(exact, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "exact"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids array<int>, exact boolean"
    )


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with their ``ids`` turned back into a column ``text``."""
    ship(rows.sparkSession)
    model = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("string")
    def text_of(ids):
        return ids.map(lambda x: decode_ids(np.asarray(x, np.int64), model), na_action="ignore")

    return rows.withColumn("text", text_of("ids"))
