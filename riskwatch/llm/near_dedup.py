"""MinHash near-dedup (9): circulant MinHash, banding, exact verification.

Two permutations give a whole signature: one scrambles the shingles, the other
is circularly shifted by k for the k-th coordinate. Documents that agree in all
rows of a band meet in a bucket, and links are confirmed on the documents' full
sets of word shingles.

How it scales: texts are read once for the signatures and once more for the
comparison. Documents with the same words become one before banding, so a third
of all rows being copies costs a map-side combine. A bucket is not expanded into
pairs: its members are first compared with one centre each, and after that only
members that are not yet known to be in one component, and whose rarest shingles
allow a link. All joins on a bucket, a centre or a shingle are plain equi-joins
that AQE splits. Only texts of documents that share a bucket are moved, and few
others: a bitmap of ``BITS`` bits, a bit for each such id's hash, is broadcast
and lets through as many further texts as its share of set bits. It has one size
whatever the input; with more ids than bits it lets all texts through, and they
are moved once. Members of one family whose similarity lies below the one asked
for are compared with each other as far as their rare shingles meet.

Exactness: every reported link is verified on words. A linked pair is missed by
all bands with a probability of at most ``MISS`` (the number of bands follows
from the similarity asked for). Members of one bucket in different components
are always compared before they are told apart.

Defined results: a null or empty text, or one without words, has no shingles and
is linked with nothing. Fewer words than a shingle's make one shingle. A row
without ``doc_id`` is linked with nothing, has no component and is kept. Rows
with the same ``doc_id`` are one document. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwatch.llm.common import ship, stage
from riskwatch.llm.components import components

ROWS = 4
MISS = 1e-6
WORDS_KEPT = 400_000
BLOCK = 1 << 15
#: Bits of the filter on ids, and of one row of it (fixed by Spark's function).
BITS = 1 << 26
ROW_BITS = 1 << 15

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased."""
    return text.encode().translate(LOWER).split() if text else []


def shingles_of(words: list[bytes], size: int) -> set:
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


class _Hashes(dict):
    """Word to 64-bit hash, remembered up to a size (a cache, not a limit)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair just similar enough is missed with at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _scramble(x: np.ndarray) -> np.ndarray:
    """The first permutation: a 64-bit finaliser, cut to the 32-bit circle."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(32)).astype(np.uint32)


def _shifted_minima(v: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Minima per document of the second permutation, shifted by 0..count-1.

    The permutation p(y) of the circle is evaluated at y = v + k.
    """
    out = np.empty((count, len(starts)), np.uint32)
    base = v * np.uint32(0x9E3779B1)
    x, y = np.empty_like(base), np.empty_like(base)
    for k in range(count):
        np.add(base, np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF), out=x)
        np.right_shift(x, 15, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0x85EBCA77), out=x)
        np.right_shift(x, 13, out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint32(0xC2B2AE3D), out=x)
        out[k] = np.minimum.reduceat(x, starts)
    return out


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash per shingle, in text order, from the words' hashes."""
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    s = np.zeros(max(1, len(words) - size + 1), np.uint64)
    for k in range(size):
        part = h[k : k + len(s)]
        s[: len(part)] = (s[: len(part)] * np.uint64(0x9E3779B97F4A7C15)) ^ (part + (part << np.uint64(k + 7)))
    return s


def signatures(texts: list[list[bytes]], size: int, count: int) -> np.ndarray:
    """One column of ``count`` minima per word list; none of the lists is empty."""
    out = np.empty((count, len(texts)), np.uint32)
    at = 0
    while at < len(texts):
        end, held, parts = at, 0, []
        while end < len(texts) and (held < BLOCK or end == at):
            parts.append(shingle_hashes(texts[end], size))
            held += len(parts[-1])
            end += 1
        starts = np.cumsum([0, *map(len, parts[:-1])])
        out[:, at:end] = _shifted_minima(_scramble(np.concatenate(parts)), starts, count)
        at = end
    return out


def _buckets(minima: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit bucket id per band and document."""
    bands = len(minima) // rows
    ids = np.arange(bands, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    for k in range(rows):
        ids = (ids ^ minima[k::rows][:bands]) * np.uint64(0x9FB21C651E98DF25)
        ids ^= ids >> np.uint64(29)
    return ids.view(np.int64)


def _sign(size: int, bands: int, rows: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("words_key", pa.binary()), ("buckets", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                words = [words_of(t) for t in part.column(1).to_pylist()]
                full = [w for w in words if w]
                ids = _buckets(signatures(full, size, bands * rows), rows) if full else np.empty((bands, 0), np.int64)
                lists, k = [], 0
                for w in words:
                    lists.append(ids[:, k].tolist() if w else [])
                    k += bool(w)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([len(shingles_of(w, size)) for w in words], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(w)).digest() if w else None for w in words], pa.binary()),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return run


def _shingle_rows(size: int):
    """A row per document and different shingle hash."""
    names = ["doc", "n", "label", "g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                hashes = [np.unique(shingle_hashes(words_of(t), size)) for t in part.column(3).to_pylist()]
                if hashes:
                    each = np.repeat(np.arange(len(part)), [len(h) for h in hashes])
                    columns = [part.column(k).take(pa.array(each)) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(hashes).view(np.int64))], names=names)

    return run


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(size: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come ordered by one side; its set is kept while it stays the same.
        held: list[tuple[str | None, set]] = [(None, set()), (None, set())]
        for batch in batches:
            left, right = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = []
            for k, (a, b) in enumerate(zip(left, right, strict=True)):
                for side in (0, 1):
                    text = batch.column(2 + side)[k].as_py()
                    if text != held[side][0]:
                        held[side] = text, shingles_of(words_of(text), size)
                if similar(held[0][1], held[1][1], percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], schema=schema
            )

    return run


class _Matcher:
    """Verifies pairs of documents that share a bucket."""

    def __init__(self, members: DataFrame, texts: DataFrame, size: int, percent: int):
        self.members, self.texts, self.size, self.percent = members, texts, size, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar; pairs hold each pair once."""
        left = self.texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
        right = self.texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
        full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return stage(full.mapInArrow(_verify(self.size, self.percent), "a long, b long"), "links")

    def pairs(self, joined: DataFrame) -> DataFrame:
        """Of (x, n_x, y, n_y): each pair once, if the set sizes allow a link."""
        few, many = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
        return (
            joined.where((F.col("x") != F.col("y")) & (100 * few >= self.percent * many))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )

    def star(self) -> DataFrame:
        """Each bucket's members with its centre.

        The centre is the member that meets most documents over all its buckets:
        of a group of copies, one near the text they were made from.
        """
        met = self.members.groupBy("doc").agg(F.sum("size").alias("met"))
        members = self.members.join(met, "doc")
        centre = F.max(F.struct("met", (-F.col("doc")).alias("first"), "doc", "n"))
        centres = members.groupBy("bucket").agg(centre.alias("c"))
        centres = centres.select("bucket", F.col("c.doc").alias("y"), F.col("c.n").alias("n_y"))
        joined = members.join(centres, "bucket").where(F.col("doc") != F.col("y"))
        return self.pairs(joined.select(F.col("doc").alias("x"), F.col("n").alias("n_x"), "y", "n_y"))

    def open_members(self, labels: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, with their labels."""
        labelled = self.members.join(labels, "doc", "left").select(
            "bucket", "doc", "n", F.coalesce("component", "doc").alias("label")
        )
        each = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        several = each.where(F.col("low") != F.col("high")).select("bucket")
        return labelled.join(several, "bucket", "left_semi")

    def rest(self, open_members: DataFrame) -> DataFrame:
        """Pairs of different components that can be similar at all.

        Shingles are ordered from the rarest. In similar sets the first common
        shingle stands so early that enough of both sets is left behind it
        (prefix and positional filter); this loses no pair. Of each shingle only
        members outside its largest component are joined with all others.
        """
        docs = open_members.select("doc", "n", "label").distinct()
        rows = docs.join(self.texts, "doc").select("doc", "n", "label", "text")
        shingles = rows.mapInArrow(_shingle_rows(self.size), "doc long, n long, label long, g long")
        shingles = stage(shingles, "shingles")
        # Counted partly in each task, and joined back: a common shingle is split.
        # Written tables on both sides of a join let AQE split its hot partitions.
        counts = stage(shingles.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1), "counts")
        common = shingles.join(counts, "g")
        of_doc = Window.partitionBy("doc")
        # Shingles of one document only come first; they are not in ``common``.
        rank = F.row_number().over(of_doc.orderBy("df", "g"))
        behind = F.count(F.lit(1)).over(of_doc) - rank
        early = stage(
            common.select("doc", "n", "label", "g", (behind + 1).alias("left"))
            .where(100 * F.col("left") >= self.percent * F.col("n")),
            "early",
        )
        each = early.groupBy("g", "label").agg(F.count(F.lit(1)).alias("k"))
        major = each.groupBy("g").agg(F.max_by("label", "k").alias("major"), F.count(F.lit(1)).alias("labels"))
        major = stage(major.where(F.col("labels") > 1).select("g", "major"), "major")
        x = early.join(major, "g").where(F.col("label") != F.col("major"))
        x = stage(x.select("g", *[F.col(c).alias(f"{c}_x") for c in ("doc", "n", "label", "left")]), "minor")
        y = early.select("g", *[F.col(c).alias(f"{c}_y") for c in ("doc", "n", "label", "left")])
        enough = (100 + self.percent) * F.least("left_x", "left_y") >= self.percent * (F.col("n_x") + F.col("n_y"))
        joined = x.join(y, "g").where((F.col("label_x") != F.col("label_y")) & enough)
        return self.pairs(joined.select(F.col("doc_x").alias("x"), "n_x", F.col("doc_y").alias("y"), "n_y"))


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc`` is one of ``ids``, none missing, and few others moved.

    The bitmap has ``BITS`` bits in rows of ``ROW_BITS``, which bounds the broadcast
    to 8 MB. Ids that share a bit with a wanted one pass it, and go in the join.
    """
    place = F.pmod(F.xxhash64("doc"), F.lit(BITS))
    row, bit = F.floor(place / ROW_BITS).cast("long"), place % ROW_BITS
    bits = ids.groupBy(row.alias("_row")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.join(F.broadcast(stage(bits, "bits")), row == F.col("_row"))
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) != 0
    return marked.where(hit).select(*rows.columns).join(ids, "doc", "left_semi")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = ROWS) -> DataFrame:
    """Per document: n_shingles, component_id (least id reachable), kept."""
    ship(docs.sparkSession)
    bands = bands_for(percent, rows)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = source.mapInArrow(
        _sign(size, bands, rows), "doc_id long, n_shingles long, words_key binary, buckets array<long>"
    )
    signed = stage(signed, "signed")
    key = F.when(F.col("doc_id").isNotNull(), F.col("words_key"))
    # One document for all with the same words.
    firsts = (
        signed.where(key.isNotNull())
        .groupBy("words_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "buckets")).alias("d"))
        .select("words_key", F.col("d.doc_id").alias("doc"), F.col("d.n_shingles").alias("n"), F.col("d.buckets").alias("buckets"))
    )
    firsts = stage(firsts, "firsts")
    rows_in = firsts.select("doc", "n", F.explode("buckets").alias("bucket"))
    shared = rows_in.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    members = stage(rows_in.join(shared, "bucket").select("bucket", "doc", "n", "size"), "members")
    wanted = stage(members.select("doc").distinct(), "wanted")
    texts = stage(_among(source.withColumnRenamed("doc_id", "doc"), wanted), "texts")

    matcher = _Matcher(members, texts, size, percent)
    links = matcher.links(matcher.star())
    labels = stage(components(links), "labels")
    found = matcher.links(matcher.rest(matcher.open_members(labels)))
    labels = stage(components(links.unionByName(found)), "labels")
    same_words = firsts.select("words_key", "doc")
    least = same_words.join(labels, "doc", "left").select(
        "words_key", F.coalesce("component", "doc").alias("component")
    )
    component = F.coalesce("component", "doc_id")
    return (
        signed.select("doc_id", "n_shingles", key.alias("words_key"))
        .join(least, "words_key", "left")
        .select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, all columns kept.

    The ids to leave out are a table; Spark broadcasts it if it is small. Rows
    that repeat an id are one document and leave one row; rows without an id all
    stay.
    """
    judged = near_duplicates(docs, size, percent)
    dropped = stage(judged.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = stage(repeated.where(F.col("_rows") > 1).select("doc_id"), "repeated")
    single = docs.join(repeated, "doc_id", "left_anti").join(dropped, "doc_id", "left_anti")
    once = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).join(dropped, "doc_id", "left_anti")
    return single.unionByName(once).select(*docs.columns)


def oracle(size: int = 3, percent: int = 85) -> str:
    """Brute force over shared shingles in DuckDB's SQL."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM documents
), runs AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size} + 1, 1) + 1)) AS i FROM d WHERE len(w) > 0
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {size - 1}], ' ') AS g FROM runs
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g)
  WHERE x.doc_id < y.doc_id GROUP BY a, b
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= {percent} * (na.n + nb.n - k)
), e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.doc_id
), c AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
