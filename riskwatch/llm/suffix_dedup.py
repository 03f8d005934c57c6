"""Suffix-array dedup (10): bytes inside a long string that also starts earlier.

Earlier is a smaller ``doc_id``, or the same document and an earlier start. All
strings of ``length`` bytes are compared, none across documents.

1. Candidates. Every string holds a place that its own bytes decide: the least
   hash of its short grams (winnowing). Equal strings have equal places, so a
   string can only repeat where its place's fingerprint does. A document sends
   each fingerprint once; those that come twice remain. Nothing is lost here.
   Later copies of a whole text lose all bytes and go no further.
2. Documents with such fingerprints send the segment around each place: the
   strings that belong to it. Equal segments of a batch are combined first. A
   fingerprint of more than ``HOT`` places is split by content: strings that
   start within ``WIDTH`` bytes before its place share a core, and its bytes are
   the key, so different texts around one passage go to different tasks.
3. Segments meet by fingerprint. A task cuts them into shards of ``SHARD`` bytes,
   sorts a shard's suffixes by refinement in the manner of Larsson and Sadakane
   (groups doubled in depth, only unsorted ones touched), and takes common
   prefixes by Kasai's walk. Neighbours that share ``length`` bytes are one
   class; all but its first member are removed. One shard is held at a time.
4. Shards of a fingerprint that spans several are written with the order of their
   strings. Each (shard, earlier shard) is a group of its own, which one task
   merges by binary search of the later one's strings in the earlier one's.
5. Covered bytes are united per document and cut out.

How it scales: the text is shuffled once, by id, for the documents that share
something; the rest moves as fingerprints. Copies are combined before they move.
A task of the matching holds a shard, one of the merging holds two, whatever the
input; a key of n shards is merged by n (n - 1) / 2 groups.

Defined results: a null text is an empty one. Texts shorter than ``length`` keep
all bytes, and so do rows without ``doc_id``. Rows that repeat an id are the same
document: their equal starts do not remove each other, and each gives a row. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwatch.llm.common import new_path, new_table, ship, stage

LENGTH = 100
GRAM = 32
BLOCK = 1 << 20
PIECE = 8 << 20
SHARD = 1 << 19
HOT = 10_000
WIDTH = 8
PLACE = np.uint64((1 << 24) - 1)
MIX = np.uint64(0x9FB21C651E98DF25)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place, doubled up from single bytes."""
    h, factor, step = data.astype(np.uint64) + np.uint64(1), 0x5851F42D4C957F2D, 1
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of (document, first byte, bytes); a long text comes in pieces that
    overlap, so that every string is in exactly one."""
    block, held = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1] if len(text) > PIECE else text
            if len(part) < length:
                continue
            block.append((k, at, part))
            held += len(part)
            if held >= BLOCK:
                yield block
                block, held = [], 0
    if block:
        yield block


def _places(block: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    """Of each string the least gram (ties: the first); strings with one place
    follow each other. Gives data, piece, first and last string, fingerprint."""
    data = np.frombuffer(b"".join(part for _, _, part in block), np.uint8)
    sizes = np.array([len(part) for _, _, part in block])
    h = _gram_hashes(data)
    least = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    want, step = length - GRAM + 1, 1
    while 2 * step <= want:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if want > step:
        least = np.minimum(least[: -(want - step)], least[want - step :])
    piece = np.repeat(np.arange(len(block)), sizes)[: len(least)]
    ends = np.cumsum(sizes)
    strings = np.flatnonzero(np.arange(len(least)) + length <= ends[piece])
    place = (least[strings] & PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(strings) - 1]])
    return data, piece[strings[new]], strings[new], strings[last], h[place[new]].view(np.int64)


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [t.encode() if t else b"" for t in column.to_pylist()]


def _fingerprints(length: int):
    names = ["fp", "doc_id", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for block in _pieces(_bytes_of(batch.column(1)), length):
                _, piece, _, _, fp = _places(block, length)
                doc = ids[np.array([b[0] for b in block])][piece]
                order = np.lexsort((fp, doc))
                doc, fp = doc[order], fp[order]
                first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])]))
                places = np.diff(np.append(first, len(fp))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(fp[first]), pa.array(doc[first]), pa.array(places)], names=names)

    return run


def _split(fp: int, doc: int, at: int, raw: bytes, length: int) -> list[tuple[int, int, int, int, bytes]]:
    """The rows of a hot fingerprint's segment: each of its strings in one of them.

    A string's distance to its place follows from its bytes, and so does the core
    that all strings of a range of distances hold: equal strings get equal keys.
    """
    last = len(raw) - length
    hashes = _gram_hashes(np.frombuffer(raw, np.uint8)).view(np.int64)
    place = last + int(np.flatnonzero(hashes[last : length - GRAM + 1] == fp)[0])
    rows, start = [], 0
    while start <= last:
        group = (place - start) // WIDTH
        core = place - group * WIDTH
        end = min(last, core) + length
        mark = hashlib.blake2b(b"%d %d " % (fp, group) + raw[core : core - WIDTH + 1 + length], digest_size=8).digest()
        key = int.from_bytes(mark, "little", signed=True)
        rows.append((key, doc, at + start, end - start, raw[start:end]))
        start = end - length + 1
    return rows


def _segments(length: int):
    """(fp, doc_id, at, size, bytes): segments; without bytes, a covered range."""
    schema = pa.schema(
        [("fp", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("size", pa.int32()), ("bytes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shared = batch.column(0).to_pylist(), np.unique(batch.column(2).flatten().to_numpy())
            hot = set(batch.column(3).flatten().to_pylist())
            kept: dict[tuple[int, bytes], tuple[int, int]] = {}
            covered = []
            for block in _pieces(_bytes_of(batch.column(1)), length):
                data, piece, first, last, fp = _places(block, length)
                starts = np.cumsum([0, *[len(b[2]) for b in block]])
                raw = data.tobytes()
                for k in np.flatnonzero(np.isin(fp, shared)).tolist():
                    doc, base, _ = block[piece[k]]
                    a, b = int(first[k]), int(last[k]) + length
                    here = (ids[doc], base + a - int(starts[piece[k]]))
                    key = (int(fp[k]), raw[a:b])
                    there = kept.setdefault(key, here)
                    if there != here:
                        kept[key], later = min(here, there), max(here, there)
                        # Settled already: any task may pass it on.
                        covered.append((hash(later), *later, b - a, None))
            rows = [(f, d, at, len(s), s) for (f, s), (d, at) in kept.items() if f not in hot] + covered
            rows += [row for (f, s), (d, at) in kept.items() if f in hot for row in _split(f, d, at, s, length)]
            for at in range(0, len(rows), 20_000):
                columns = zip(*rows[at : at + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)], schema=schema
                )

    return run


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Suffixes ordered by their first ``depth`` bytes at least.

    Also gives, per place in that order, whether the suffix differs from the one
    before it within the reached depth, and within the depth before the last
    doubling, and that depth.
    """
    n, step = len(data), 7
    byte = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(step, np.uint64)])
    # Seven bytes of nine bits each: the end is less than any byte.
    first = np.zeros(n, np.uint64)
    for k in range(step):
        first = (first << np.uint64(9)) | byte[k : k + n]
    order = np.argsort(first, kind="stable")
    new = np.concatenate([[True], np.diff(first[order]) != 0])
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    while True:
        size = np.diff(np.append(np.flatnonzero(new), n))
        unsorted = np.flatnonzero(np.repeat(size > 1, size))
        before = new.copy()
        suffix = order[unsorted]
        behind = rank[np.minimum(suffix + step, n)]
        group = rank[suffix]
        sub = np.lexsort((behind, group))
        suffix, behind, group = suffix[sub], behind[sub], group[sub]
        order[unsorted] = suffix
        if len(suffix):
            head = np.concatenate([[True], (behind[1:] != behind[:-1]) | (group[1:] != group[:-1])])
            new[unsorted] = head
            rank[suffix] = unsorted[np.flatnonzero(head)[np.cumsum(head) - 1]]
        if 2 * step >= depth:
            return order, new, before, step
        step *= 2


def common_prefixes(raw: bytes, order: np.ndarray, places: np.ndarray, least: int, most: int) -> np.ndarray:
    """Kasai's walk: bytes (up to ``most``) that the suffixes at ``places`` of the
    order share with the one before, ``least`` being known.

    Suffixes are visited as they stand in the text: of the next one, one byte
    less than of this one is known to be shared.
    """
    n = len(order)
    at = order[places]
    by_text = np.argsort(at)
    shared = np.zeros(len(places), np.int64)
    known, last = least, -2
    left = order[places - 1]
    for k, i, j in zip(by_text.tolist(), at[by_text].tolist(), left[by_text].tolist(), strict=True):
        known = max(least, known - 1) if i == last + 1 else least
        stop = min(most, n - max(i, j))
        while known < stop and raw[i + known] == raw[j + known]:
            known += 1
        shared[k], last = known, i
    return shared


Row = tuple[int, int, int, bytes]
Cover = tuple[int, int, int]
COVER = [("doc_id", pa.int64()), ("at", pa.int64()), ("size", pa.int64())]
#: A written shard: its bytes, its classes' first strings in the order of their
#: bytes, and of each segment the id, the start in its document and here.
INTS = {"firsts": "<i4", "doc": "<i8", "start": "<i8", "begin": "<i4"}
STORED = [("fp", pa.int64()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("raw", *INTS))]


def _covers(at: np.ndarray, doc: np.ndarray, start: np.ndarray, begin: np.ndarray, length: int) -> list[Cover]:
    """(doc_id, first byte, size) of the runs of strings ``at``, within segments."""
    if not len(at):
        return []
    owner = np.searchsorted(begin, at, "right") - 1
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(owner) > 0)) + 1
    first, last = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    own = owner[np.concatenate([[0], cut])]
    places = first - begin[own] + start[own]
    return list(zip(doc[own].tolist(), places.tolist(), (last - first + length).tolist(), strict=True))


class _Shard:
    """Segments laid end to end, their strings sorted and put into classes."""

    def __init__(self, rows: list[Row], length: int):
        self.length = length
        sizes = np.array([len(r[3]) for r in rows])
        ends = np.cumsum(sizes)
        self.raw = b"".join(r[3] for r in rows)
        self.doc = np.array([r[1] for r in rows], np.int64)
        self.start = np.array([r[2] for r in rows], np.int64)
        self.begin = ends - sizes
        owner = np.repeat(np.arange(len(rows)), sizes)
        data = np.frombuffer(self.raw, np.uint8)
        order, new, before, known = suffix_order(data, length)
        unsure = np.flatnonzero(new & ~before)
        shared = common_prefixes(self.raw, order, unsure, known, length)
        new[unsure[shared >= length]] = False
        kind = np.empty(len(data), np.int64)
        kind[order] = np.cumsum(new)
        # Whole strings; by class, then as they stand, which is by id and start.
        at = np.flatnonzero(np.arange(len(data)) + length <= ends[owner])
        by_kind = at[np.argsort(kind[at], kind="stable")]
        head = np.concatenate([[True], np.diff(kind[by_kind]) != 0])
        #: The first of each class, in the order of their bytes.
        self.firsts = by_kind[head]
        first = np.empty(len(data), np.int64)
        first[by_kind] = np.repeat(self.firsts, np.diff(np.append(np.flatnonzero(head), len(by_kind))))
        mine, theirs, place = owner[at], owner[first[at]], self.start - self.begin
        same = (self.doc[mine] == self.doc[theirs]) & (at + place[mine] == first[at] + place[theirs])
        self.gone = at[~same]

    def covers(self) -> list[Cover]:
        return _covers(self.gone, self.doc, self.start, self.begin, self.length)

    def stored(self, fp: int, shard: int) -> tuple:
        columns = {"firsts": self.firsts, "doc": self.doc, "start": self.start, "begin": self.begin}
        return fp, shard, self.raw, *(x.astype(INTS[c]).tobytes() for c, x in columns.items())


def _strings(raw: bytes, at: np.ndarray, length: int) -> np.ndarray:
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), length)
    return np.ascontiguousarray(windows[at]).view(f"S{length}").ravel()


def merge(later: dict, earlier: dict, length: int) -> list[Cover]:
    """What the later of two stored shards loses: strings that the earlier one
    holds, found by binary search in the order of its strings.

    Later strings are the first of their classes; the others are removed already.
    A string at the very same place of a repeated id is no other string.
    """
    shards = [{c: np.frombuffer(s[c], kind).astype(np.int64) for c, kind in INTS.items()} for s in (later, earlier)]
    (mine, theirs), found = shards, []
    sought = _strings(earlier["raw"], theirs["firsts"], length)

    def origin(shard: dict, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.searchsorted(shard["begin"], at, "right") - 1
        return shard["doc"][owner], at - shard["begin"][owner] + shard["start"][owner]

    for k in range(0, len(mine["firsts"]), 1 << 16):
        at = mine["firsts"][k : k + (1 << 16)]
        strings = _strings(later["raw"], at, length)
        place = np.minimum(np.searchsorted(sought, strings), len(sought) - 1)
        equal = sought[place] == strings
        at, there = at[equal], theirs["firsts"][place[equal]]
        (doc, start), (other, before) = origin(mine, at), origin(theirs, there)
        found.append(at[(doc != other) | (start != before)])
    return _covers(np.sort(np.concatenate(found)), mine["doc"], mine["start"], mine["begin"], length)


class _Sharder:
    """Takes segments ordered by fingerprint, id and place; gives covered ranges,
    and puts shards of fingerprints that span several into ``stored``."""

    def __init__(self, length: int, shard: int):
        self.length, self.limit = length, shard
        self.fp: int | None = None
        self.ready: list[Row] = []
        self.held = 0
        self.stored: list[tuple] = []
        self._begin()

    def _begin(self) -> None:
        self.mine: list[Row] = []
        self.seen: dict[bytes, tuple[int, int]] = {}
        self.size = self.shards = 0

    def add(self, row: Row) -> list[Cover]:
        fp, doc, at, string = row
        out = []
        if fp != self.fp:
            out, self.fp = self.end(), fp
        first = self.seen.setdefault(string, (doc, at))
        if first != (doc, at):
            return [*out, (doc, at, len(string))]
        self.mine.append(row)
        self.size += len(string)
        if self.size >= self.limit:
            out += self._part()
        return out

    def _part(self) -> list[Cover]:
        """A shard out of the open fingerprint alone."""
        shard = _Shard(self.mine, self.length)
        self.stored.append(shard.stored(self.fp, self.shards))
        self.mine, self.seen, self.size = [], {}, 0
        self.shards += 1
        return shard.covers()

    def end(self, last: bool = False) -> list[Cover]:
        """The open fingerprint is complete; segments without a partner go."""
        out = []
        if self.shards and self.mine:
            out += self._part()
        elif len(self.mine) > 1:
            self.ready += self.mine
            self.held += self.size
        self._begin()
        if self.ready and (last or self.held >= self.limit):
            out += _Shard(self.ready, self.length).covers()
            self.ready, self.held = [], 0
        return out


def _match(length: int, size: int):
    """Covered ranges, and beside them stored shards in columns of their own."""
    schema = pa.schema([*COVER, *STORED])

    def batch_of(rows: list[tuple], first: int) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.nulls(len(rows), field.type) for field in schema]
        for k, column in enumerate(columns, first):
            arrays[k] = pa.array(column, schema[k].type)
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sharder = _Sharder(length, size)
        for batch in batches:
            covers: list[Cover] = []
            for fp, doc, at, n, string in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if string is None:
                    covers.append((doc, at, n))
                else:
                    covers += sharder.add((fp, doc, at, string))
                if sharder.stored:
                    yield batch_of(sharder.stored, len(COVER))
                    sharder.stored = []
            yield batch_of(covers, 0)
        yield batch_of(sharder.end(last=True), 0)
        yield batch_of(sharder.stored, len(COVER))

    return run


def _merge_pair(length: int):
    def run(pair: pa.Table) -> pa.Table:
        earlier, later = sorted(pair.to_pylist(), key=lambda s: s["shard"])
        columns = list(zip(*merge(later, earlier, length), strict=True)) or [()] * len(COVER)
        return pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, COVER, strict=True)], schema=pa.schema(COVER))

    return run


def merged(shards: DataFrame, length: int) -> DataFrame:
    """(doc_id, at, size): ranges that shards lose to earlier ones of their key.

    A shard goes once to each pair that it is part of, and a pair is a group: any
    task may take it, and holds its two shards.
    """
    number = shards.groupBy("fp").agg(F.max("shard").alias("last")).where("last > 0")
    other = F.explode(F.sequence(F.lit(0), "last"))
    pairs = (
        shards.join(number, "fp")
        .withColumn("other", other)
        .where("other <> shard")
        .withColumn("low", F.least("shard", "other"))
        .withColumn("high", F.greatest("shard", "other"))
        .drop("last", "other")
    )
    return pairs.groupBy("fp", "low", "high").applyInArrow(_merge_pair(length), "doc_id long, at long, size long")


def cut_out(text: bytes, covers: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left without the (first byte, size) ranges, and the removed runs."""
    kept, runs, done = [], 0, 0
    end = -1
    for at, size in sorted(covers):
        if at > end:
            kept.append(text[done:at])
            runs += 1
        end = max(end, at + size)
        done = end
    return b"".join([*kept, text[done:]]), runs


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_sha", "left", "n_spans", "kept_sha256"]
    for batch in batches:
        sha, left, spans, kept_sha = [], [], [], []
        for text, covers in zip(_bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            kept, runs = cut_out(text, [(c["at"], c["size"]) for c in covers])
            sha.append(hashlib.sha256(text).hexdigest())
            left.append(len(kept))
            spans.append(runs)
            kept_sha.append(hashlib.sha256(kept).hexdigest())
        arrays = [pa.array(sha), pa.array(left, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept_sha)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)


def _by_id(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in buckets of ``doc_id``, which joins on the id
    read as they are, without another shuffle."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = new_table(spark, path, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, "doc_id").option("compression", "zstd").option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)


def covered(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(doc_id, text, covers): documents with repeated strings and their ranges.

    Later copies of a whole text are left out; they lose all bytes.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)
    )
    prints = source.mapInArrow(_fingerprints(length), "fp long, doc_id long, places int")
    alike = Window.partitionBy("fp")
    shared = prints.withColumn("n", F.sum("places").over(alike)).where("n > 1")
    of_doc = shared.groupBy("doc_id").agg(
        F.collect_set("fp").alias("fps"), F.collect_set(F.when(F.col("n") > HOT, F.col("fp"))).alias("hot")
    )
    firsts = _firsts(source.select("doc_id", F.sha2("text", 256).alias("text_sha"))).select(F.col("first").alias("doc_id")).distinct()
    suspects = _by_id(source.join(of_doc.join(firsts, "doc_id", "left_semi"), "doc_id"), "suspects")
    segments = suspects.mapInArrow(_segments(length), "fp long, doc_id long, at long, size int, bytes binary")
    matched = stage(
        segments.repartition("fp").sortWithinPartitions("fp", "doc_id", "at").mapInArrow(
            _match(length, shard),
            "doc_id long, at long, size long, fp long, shard int, "
            "raw binary, firsts binary, doc binary, start binary, begin binary",
        ),
        "matched",
    )
    shards = matched.where("fp IS NOT NULL").select([name for name, _ in STORED])
    covers = (
        matched.where("fp IS NULL")
        .select("doc_id", "at", "size")
        .unionByName(merged(shards, length))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "size")).alias("covers"))
    )
    return suspects.select("doc_id", "text").join(covers, "doc_id").select("doc_id", "text", "covers")


def _firsts(rows: DataFrame) -> DataFrame:
    """(text_sha, first): the least id of each text."""
    return rows.groupBy("text_sha").agg(F.min("doc_id").alias("first"))


def dedup(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans and the remaining bytes' sha256."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.sha2(text, 256).alias("text_sha"),
    )
    lost = covered(docs, length, shard).mapInArrow(
        _remove, "doc_id long, text_sha string, left long, n_spans long, kept_sha256 string"
    )
    joined = base.join(_firsts(base), "text_sha", "left").join(
        lost.distinct(), ["doc_id", "text_sha"], "left"
    )
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= length)
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_bytes") - F.coalesce("left", "n_bytes")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "text_sha")).alias("kept_sha256"),
    )


def oracle(length: int = LENGTH) -> str:
    """Brute force over every string of every document in DuckDB's SQL.

    Strings are compared by a 64-bit hash.
    """
    return f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT doc_id, h, unnest(range(0, len(h) // 2 - {length} + 1, 256)) AS o FROM d WHERE len(h) >= {2 * length}
), parts AS (
  SELECT doc_id, o, substr(h, 2 * o + 1, 2 * (255 + {length})) AS h FROM c
), s AS (
  SELECT doc_id, o, h, unnest(range(0, len(h) // 2 - {length} + 1)) AS q FROM parts
), w AS (
  SELECT doc_id, o + q AS p, doc_id * {1 << 27} + o + q AS k, hash(substr(h, 2 * q + 1, {2 * length})) AS g FROM s
), first AS (
  SELECT g, min(k) AS f FROM w GROUP BY g HAVING count(*) > 1
), hit AS (
  SELECT doc_id, p FROM w JOIN first USING (g) WHERE k > f
), steps AS (
  SELECT doc_id, p, p > lag(p, 1, -{2 * length}) OVER o + {length} AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), runs AS (
  SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM steps
), spans AS (
  SELECT doc_id, r, min(p) AS a, max(p) + {length} AS b FROM runs GROUP BY doc_id, r
), gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS x, a AS y FROM spans
  UNION ALL
  SELECT spans.doc_id, max(b), any_value(len(h)) // 2 FROM spans JOIN d USING (doc_id) GROUP BY spans.doc_id
), kept AS (
  SELECT gaps.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY gaps.doc_id
), n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
