"""Token-ID output (1): flat unsigned integer files and 64-bit document offsets.

Documents are range-partitioned by ``doc_id`` and sorted. Each partition becomes
a shard: ``<name>.bin`` holds its ids, one after another, as little-endian
unsigned integers (16 bits where the vocabulary allows, else 32), ``<name>.idx``
holds 64-bit little-endian integers: the number of documents n, n doc_ids and
n + 1 offsets into the ids. A manifest table has a row per shard, and a shard's
base is the prefix sum of the ids in the shards before it. Readers map the files.

Lost executors: an attempt writes files of its own names, and only the files in
the manifest, which Spark commits, are part of the output.

The library encodes every word it has not met yet; words are cut where its own
first split always cuts (before a single space), so ids are those of the whole
text. A text with other white space around a cut, or with the content of one of the
library's added tokens (``<|endoftext|>``, which is one id), is encoded whole.

Defined results: a null or empty text has the end id only. Rows without
``doc_id`` come first; repeated ids stay together, each with its own ids. Only
``doc_id`` and ``text`` are read. An empty table gives no documents.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskwatch.llm.common import new_path, ship, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
WORDS_KEPT = 600_000
DOCS = 200
NO_ID = -(2**63)

# White space other than the space and the line feed.
_SPACES = (
    0x9, 0xB, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)
_OTHER_SPACE = re.compile(f"[{''.join(map(chr, _SPACES))}]")
_MANIFEST = "shard int, file string, n_docs long, n_tokens long"


# Marks that may end a word; with nothing else behind a word's
# letters they are one unit of the library's first split, and so are the letters.
_MARKS = ".,;:!?*%&$#-)(\"'"


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: visible bytes stand for themselves, the others
    for the characters from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: 256 + k for k, b in enumerate(hidden)}


class WordEncoder:
    """A tokenizer with a memory of words, bounded in size.

    A new word's letters and its marks go to the library's model directly; what
    is not built that way is encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.normalizer is not None:
            raise ValueError("a normalizer would need the whole text")
        self.model = self.tokenizer.model
        #: The library looks for these before its first split.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.space = chr(self.letters[32])
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        #: Packers of short lists of ids.
        self.pack = [struct.Struct(f"<{n}{'H' if self.dtype.itemsize == 2 else 'I'}").pack for n in range(33)]
        self.newline = self._whole("\n")
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _unit(self, lead: str, text: str) -> bytes:
        """A unit of the first split: letters behind a space or none, or marks."""
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.model.tokenize(lead + text)]
        return self.pack[len(ids)](*ids) if len(ids) < len(self.pack) else self._bytes(ids)

    def _word(self, key: str) -> bytes:
        """A key stands for the word behind a space; a text's first is marked by one."""
        known = self.known
        text, lead = (key[1:], "") if key[0] == " " else (key, self.space)
        head = text.rstrip(_MARKS)
        if head.isalpha():
            if len(head) == len(text):
                ids = self._unit(lead, head)
            else:
                # The bare word is likely to come with other marks.
                tail = text[len(head) :]
                bare = key[: -len(tail)]
                ids = known.get(bare)
                if ids is None:
                    ids = known[bare] = self._unit(lead, head)
                marks = self.marks.get(tail)
                if marks is None:
                    marks = self.marks[tail] = self._unit("", tail)
                ids += marks
        elif "\n" in text.strip("\n") and "\n\n" not in text and text[0] != "\n" and text[-1] != "\n":
            first, *others = key.split("\n")
            parts = [first, *[" " + w for w in others]]
            ids = self.newline.join(known.get(p) or self._word(p) for p in parts)
        else:
            ids = self._whole(text if key[0] == " " else " " + text)
        known[key] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_KEPT:
            # Short words are the frequent ones; if they alone fill it, all go.
            short = {k: v for k, v in self.known.items() if len(k) <= 8}
            self.known = short if 2 * len(short) < WORDS_KEPT else {}
            self.marks = {"": b""}
        out = []
        for text in texts:
            keys = None if any(x in text for x in self.added) else _cut(text)
            if keys is None:
                out.append(self._whole(text))
                continue
            ids = list(map(self.known.get, keys))
            if None in ids:
                ids = [self._word(k) if i is None else i for k, i in zip(keys, ids, strict=True)]
            out.append(b"".join(ids))
        return out


def _cut(text: str) -> list[str] | None:
    """Keys of the text's words, or None where a cut could matter."""
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text:
        return None
    if _OTHER_SPACE.search(text):
        return None
    keys = text.split(" ")
    keys[0] = " " + keys[0]
    return keys


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def _writer(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        files, place = _file_system(folder)
        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}-{uuid.uuid4().hex}"
        end = np.array([END_ID], words.dtype).tobytes()
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        with files.open_output_stream(f"{place}/{name}.bin") as out:
            for batch in batches:
                for at in range(0, len(batch), DOCS):
                    part = batch.slice(at, DOCS)
                    encoded = words.encode([t or "" for t in part.column(1).to_pylist()])
                    out.write(b"".join(x for e in encoded for x in (e, end)))
                    ids.append(part.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy())
                    sizes.append(np.array([len(e) // words.dtype.itemsize + 1 for e in encoded], np.int64))
        if not ids:
            return
        count = np.concatenate(sizes)
        offsets = np.concatenate([[0], np.cumsum(count)])
        index = np.concatenate([[len(count)], *ids, offsets]).astype("<i8")
        with files.open_output_stream(f"{place}/{name}.idx") as out:
            out.write(index.tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([context.partitionId()], pa.int32()),
                pa.array([f"{folder}/{name}"]),
                pa.array([len(count)], pa.int64()),
                pa.array([int(offsets[-1])], pa.int64()),
            ],
            names=["shard", "file", "n_docs", "n_tokens"],
        )

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Writes the shards; gives the manifest with each shard's ``base``.

    The prefix sum is over one row per shard.
    """
    ship(docs.sparkSession)
    files, place = _file_system(folder)
    files.create_dir(place, recursive=True)
    model = path or public_tokenizers.path(TOKENIZER)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = stage(ordered.mapInArrow(_writer(folder, model), _MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(uri: str, dtype: np.dtype) -> np.ndarray:
    """The file's integers: memory-mapped where it is local, else read."""
    files, place = _file_system(uri)
    if isinstance(files, pa.fs.LocalFileSystem):
        return np.memmap(place, dtype, "r")
    with files.open_input_file(place) as source:
        return np.frombuffer(source.read(), dtype)


def read_shard(file: str, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's doc_ids, offsets and ids."""
    index = _mapped(f"{file}.idx", np.dtype("<i8"))
    n = int(index[0])
    return index[1 : n + 1], index[n + 1 :], _mapped(f"{file}.bin", dtype)


def read_tokens(manifest: DataFrame, path: str | None = None) -> DataFrame:
    """Per document from the files: start, n_tokens and the ids' crc32."""
    model = path or public_tokenizers.path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(model).dtype
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs, offsets, ids = read_shard(file, dtype)
                spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64(), mask=docs == NO_ID),
                        pa.array(offsets[:-1] + base, pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    shards = manifest.count()
    spread = manifest.select("file", "base").repartition(max(1, shards))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``docs`` to the shared folder and reads the documents back."""
    manifest = write_tokens(docs, new_path(docs.sparkSession, "tokens"), path)
    return read_tokens(manifest, path)
