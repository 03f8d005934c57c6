"""Operators over whole corpora against brute force, and hot groups."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskwatch.llm import common, decontaminate, near_dedup, pieces, pii, quality, queries, suffix_dedup, token_output
from riskwatch.llm.components import components
from tests.llm.data import plain, sentence

SF_DIR = "/root/testdata/sf0.001"


def near_copies(seed, n=120, hot=60):
    """Random texts, edited copies at all distances, and one large group."""
    pick = random.Random(seed)
    rows, base = [], sentence(pick, 90)
    for i in range(n):
        if i < hot:
            words = base.split()
            for _ in range(pick.randrange(0, 6)):
                words[pick.randrange(len(words))] = pick.choice(["edit", "other", "new"])
            text = " ".join(words)
        elif rows and pick.random() < 0.5:
            words = rows[pick.randrange(len(rows))][1].split()
            words[pick.randrange(len(words))] = "X" + str(pick.randrange(9))
            text = " ".join(words).upper() if pick.random() < 0.3 else " ".join(words)
        else:
            text = sentence(pick, pick.randrange(1, 120))
        rows.append((i * 3, text))
    pick.shuffle(rows)
    return rows


def brute_components(rows, size, percent):
    sets = {i: near_dedup.shingles_of(near_dedup.words_of(t), size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and near_dedup.similar(sets[a], sets[b], percent):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("seed, size, percent", [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates_equal_brute_force(spark, seed, size, percent):
    rows = near_copies(seed)
    want, sizes = brute_components(rows, size, percent)
    for row in near_dedup.near_duplicates(plain(spark, rows), size, percent).collect():
        assert row["component_id"] == want[row["doc_id"]]
        assert row["n_shingles"] == sizes[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_buckets_miss_hardly_any_similar_pair():
    assert (1 - 0.85**4) ** near_dedup.bands_for(85) <= near_dedup.MISS
    pick, rows, agree = random.Random(4), near_dedup.ROWS, []
    bands = near_dedup.bands_for(85)
    found = 0
    for _ in range(300):
        words = sentence(pick, 200).encode().split()
        other = list(words)
        for k in pick.sample(range(200), 5):
            other[k] = b"edit"
        minima = near_dedup.signatures([words, other], 3, bands * rows)
        a, b = (near_dedup.shingles_of(w, 3) for w in (words, other))
        agree.append((minima[:, 0] == minima[:, 1]).mean() - len(a & b) / len(a | b))
        ids = near_dedup._buckets(minima, rows)
        found += bool((ids[:, 0] == ids[:, 1]).any())
    assert found == 300 and abs(np.mean(agree)) < 0.01


def test_a_family_below_the_threshold_is_told_apart(spark):
    """Documents of one template, all pairs nearly similar enough, and real copies among them."""
    pick = random.Random(12)
    base = sentence(pick, 100).split()
    rows = []
    for k in range(70):
        words = list(base)
        for at in pick.sample(range(100), 6):
            words[at] = f"own{k}x{at}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, rows[k][1] + " end") for k in range(5)] + [(200, rows[9][1].upper())]
    want, sizes = brute_components(rows, 3, 85)
    assert len(set(want.values())) > 60
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(plain(spark, rows), 3, 85).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == want and {k: r["n_shingles"] for k, r in got.items()} == sizes


@pytest.mark.parametrize("bits", [1 << 15, 1 << 17, 1 << 26])
def test_the_filter_on_ids_loses_and_adds_none(spark, monkeypatch, bits):
    monkeypatch.setattr(near_dedup, "BITS", bits)
    rows = spark.range(-3000, 3000).selectExpr("id * 7 AS doc", "concat('t', id) AS text").union(spark.sql("SELECT null, 'x'"))
    ids = spark.range(-2500, 2500, 11).selectExpr("id * 7 AS doc")
    got = near_dedup._among(rows, ids)
    assert got.columns == ["doc", "text"]
    assert sorted(got.collect()) == sorted(rows.join(ids, "doc", "left_semi").collect())
    assert near_dedup._among(rows, ids.limit(0)).count() == 0


def test_staged_files_can_be_dropped_and_settings_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path))
    common.drop_staged(spark)
    before = {t.name for t in spark.catalog.listTables()}
    near_dedup.near_duplicates(plain(spark, near_copies(3, 20, 9))).collect()
    suffix_dedup.dedup(plain(spark, repeated_passages(1, 20))).collect()
    assert len(list(tmp_path.iterdir())) > 5 and {t.name for t in spark.catalog.listTables()} > before
    assert common.drop_staged(spark) > 5 and not list(tmp_path.iterdir())
    assert {t.name for t in spark.catalog.listTables()} <= before


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199)]
    found = {r["doc"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(41)) and all(found[k] == 100 for k in range(100, 160)) and found[200] == 199


# --- Suffixes ---------------------------------------------------------------


def brute_removed(rows, length):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            if seen.setdefault(data[at : at + length], (doc, at)) != (doc, at):
                gone[at : at + length] = True
        runs = int(np.diff(np.concatenate([[0], gone.astype(int)]), prepend=0).clip(0).sum())
        kept = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        out[doc] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeated_passages(seed, n=60):
    pick = random.Random(seed)
    passages = [sentence(pick, 30), "é" * 90, "ab" * 120, sentence(pick, 20), "z" * 101]
    rows = []
    for i in range(n):
        parts = [pick.choice([sentence(pick, pick.randrange(40)), pick.choice(passages)]) for _ in range(pick.randrange(5))]
        text = "".join(parts)
        if pick.random() < 0.3 and rows:
            text = rows[pick.randrange(len(rows))][1][pick.randrange(20) :]
        rows.append((i * 2, text))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_equal_brute_force(spark, seed):
    rows = repeated_passages(seed)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(plain(spark, rows)).collect()}
    assert got == brute_removed(rows, suffix_dedup.LENGTH)


@pytest.mark.parametrize("seed", [1, 5])
def test_split_fingerprints_change_nothing(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    rows = repeated_passages(seed)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(plain(spark, rows)).collect()}
    assert got == brute_removed(rows, suffix_dedup.LENGTH)


@pytest.mark.parametrize("hot", [1, 10**6])
def test_shards_of_one_key_meet_as_rows(spark, monkeypatch, hot):
    """Shards of a few segments, so that nearly every repeat spans two of them."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = [*repeated_passages(4), (9_999, "x\0" * 150), (9_998, "x\0" * 120 + "\0" * 130)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup(plain(spark, rows), shard=400).collect()}
    assert got == brute_removed(rows, suffix_dedup.LENGTH)


def test_a_key_over_many_shards_is_told_once(spark):
    """(doc_id, at, size) of what later shards lose: every pair of shards is compared."""
    length, pick = suffix_dedup.LENGTH, random.Random(7)
    texts = [sentence(pick, 40).encode()[:length] for _ in range(12)]
    shards = []
    for k in range(5):
        rows = [(1, 10 * k + j, 0, t) for j, t in enumerate(pick.sample(texts, 6))]
        shards.append((rows, suffix_dedup._Shard(rows, length).stored(1, k)))
    table = spark.createDataFrame(
        [s for _, s in shards], "fp long, shard int, raw binary, firsts binary, doc binary, start binary, begin binary"
    )
    got = {tuple(r) for r in suffix_dedup.merged(table, length).collect()}
    seen, want = set(), set()
    for rows, _ in shards:
        want |= {(doc, at, length) for _, doc, at, t in rows if t in seen}
        seen |= {t for *_, t in rows}
    assert got == want


def test_a_hot_fingerprint_is_spread_by_its_texts():
    """A passage between other texts in each document: most keys hold few strings."""
    length, pick = suffix_dedup.LENGTH, random.Random(3)
    passage, keys, strings = sentence(pick, 9).encode(), Counter(), Counter()
    for doc in range(300):
        text = sentence(pick, 30).encode() + passage + sentence(pick, 30).encode()
        _, _, first, last, fp = suffix_dedup._places([(0, 0, text)], length)
        for f, a, b in zip(fp.tolist(), first.tolist(), last.tolist(), strict=True):
            rows = suffix_dedup._split(f, doc, a, text[a : b + length], length)
            starts = [at + k for _, _, at, size, raw in rows for k in range(len(raw) - length + 1)]
            assert starts == list(range(a, b + 1)) and all(text[at : at + size] == raw for _, _, at, size, raw in rows)
            strings[f] += sum(len(raw) for *_, raw in rows)
            for key, _, _, size, _ in rows:
                keys[key] += size
    assert max(strings.values()) > 300 * length and max(keys.values()) < max(strings.values()) / 3


@pytest.mark.parametrize(
    "n, shard, block, piece", [(40, 300, 1, 150), (40, 900, 1, 150), (40, 3000, 4000, 700), (40, 1 << 21, 1 << 20, 8 << 20)]
)
def test_shards_pieces_and_blocks_change_nothing(monkeypatch, n, shard, block, piece):
    """One fingerprint over many shards is merged by binary search."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    length, rows = suffix_dedup.LENGTH, sorted(repeated_passages(3, n))
    segments = []
    for doc, text in rows:
        for part in suffix_dedup._pieces([text.encode()], length):
            data, owner, first, last, fp = suffix_dedup._places(part, length)
            starts = np.cumsum([0, *[len(b[2]) for b in part]])
            for k in range(len(fp)):
                a, b = int(first[k]), int(last[k]) + length
                segments.append((int(fp[k]), doc, part[owner[k]][1] + a - int(starts[owner[k]]), data.tobytes()[a:b]))
    sharder, covers = suffix_dedup._Sharder(length, shard), {}
    found = [c for s in sorted(segments) for c in sharder.add(s)] + sharder.end(last=True)
    stored = [dict(zip([name for name, _ in suffix_dedup.STORED], s, strict=True)) for s in sharder.stored]
    keys = {}
    for s in stored:
        keys.setdefault(s["fp"], []).append(s)
    for shards in keys.values():
        for k, later in enumerate(shards):
            assert later["shard"] == k
            for earlier in shards[:k]:
                found += suffix_dedup.merge(later, earlier, length)
    for doc, at, size in found:
        covers.setdefault(doc, []).append((at, size))
    want = brute_removed(rows, length)
    for doc, text in rows:
        kept, runs = suffix_dedup.cut_out(text.encode(), covers.get(doc, []))
        assert (len(text.encode()) - len(kept), runs, hashlib.sha256(kept).hexdigest()) == want[doc][1:]


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefgh"])
def test_suffix_order_and_common_prefixes(alphabet):
    pick = random.Random(len(alphabet))
    raw = "".join(pick.choice(alphabet) for _ in range(500)).encode()
    order, new, before, known = suffix_dedup.suffix_order(np.frombuffer(raw, np.uint8), 100)
    depth = 2 * known
    assert [raw[i : i + depth] for i in order] == sorted(raw[i : i + depth] for i in range(len(raw)))
    places = np.flatnonzero(~before)
    shared = suffix_dedup.common_prefixes(raw, order, places, known, 100)
    for k, n in zip(places.tolist(), shared.tolist(), strict=True):
        i, j = int(order[k]), int(order[k - 1])
        assert raw[i : i + n] == raw[j : j + n]
        assert n == 100 or raw[i + n : i + n + 1] != raw[j + n : j + n + 1]


# --- Words ------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark):
    pick = random.Random(9)
    rows = [(k, "".join(pick.choices(["a", "b ", "c\n", "\t", "é", "#", " x y z ", " ", "\n\n"], k=pick.randrange(60)))) for k in range(150)]
    for row in quality.quality_rules(plain(spark, rows)).collect():
        assert tuple(row)[1:6] == brute_counts(dict(rows)[row["doc_id"]])


def test_quality_keeps_clean_and_rejects_junk(spark):
    clean = "The house by the river and the mill was old. It stood there with a garden to walk in.\n" * 1
    pick = random.Random(2)
    good = clean + " ".join(f"{w} of the {pick.randrange(10**6)}" for w in "abcdefghijklmnop")
    junk = {2: good.replace(" ", "*** "), 3: good.upper() + "!!" * 80, 4: "buy now cheap " * 60, 5: "short"}
    rows = [(1, good), *junk.items()]
    assert {r["doc_id"] for r in quality.passing(plain(spark, rows)).collect()} == {1}


def brute_hits(docs, items, size=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            n = min(size, len(p))
            for k in range(len(p) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == p[k : k + n]:
                        hit.update(range(at, at + n))
                        found.add(str(item))
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), listed, bool(hit))
    return out


def test_decontamination_equals_brute_force(spark):
    pick = random.Random(6)
    items = [(k, sentence(pick, pick.choice([1, 4, 10, 25]))) for k in range(12)] + [(90, None), (91, "--"), (92, "Zwölf ÄPFEL")]
    docs = []
    for k in range(80):
        text = sentence(pick, pick.randrange(60))
        if pick.random() < 0.5:
            words = pick.choice(items)[1] or ""
            text += " -- " + words.upper()[: pick.choice([40, 1000])] + " " + text
        docs.append((k, text + (" zwölf Äpfel" if k % 9 == 0 else "")))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.decontaminate(plain(spark, docs), table).collect()}
    near = brute_near(docs, items)
    assert got == {doc: (*row, near[doc]) for doc, row in brute_hits(docs, items).items()}


def brute_near(docs, items, size=10, slack=2):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    counts = Counter(w for _, text in docs for w in words(text))
    out = {}
    for doc, text in docs:
        w, found = words(text), set()
        for item, passage in items:
            p = words(passage)
            n = min(size, len(p))
            for k in range(len(p) - n + 1 if n else 0):
                window = p[k : k + n]
                order = sorted(range(n), key=lambda at: (counts[window[at]], at))
                one, two = order[0], order[min(1, n - 1)]
                if not counts[window[one]]:
                    continue
                for s in [at - one for at, x in enumerate(w) if x == window[one]]:
                    other = any(0 <= s + two + d < len(w) and w[s + two + d] == window[two] for d in range(-slack, slack + 1))
                    around = set(w[max(s - slack, 0) : max(s + n + slack, 0)])
                    if s >= -slack and other and len(around & set(window)) >= len(set(window)) - slack:
                        found.add(item)
        out[doc] = len(found)
    return out


def test_a_changed_passage_is_near_and_not_exact(spark):
    """One word put in, left out or replaced in the middle of 15 leaves no exact window."""
    pick = random.Random(3)
    passage = sentence(pick, 15).split()
    changed = {
        1: passage,
        2: passage[:7] + ["added"] + passage[7:],
        3: passage[:7] + passage[8:],
        4: passage[:7] + ["other"] + passage[8:],
        5: passage[::-1],
        6: sentence(pick, 40).split(),
        7: passage[:7] + sentence(pick, 9).split() + passage[7:],
    }
    before = sentence(pick, 70)
    docs = plain(spark, [(k, f"{before} {' '.join(words)} {before}") for k, words in changed.items()])
    table = spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_near"]) for r in decontaminate.decontaminate(docs, table).collect()}
    assert got[1] == (True, 1) and got[5] == got[6] == (False, 0)
    assert got[2] == got[3] == got[4] == (False, 1)


# --- Files and the pipeline -------------------------------------------------


def test_token_files_hold_the_whole_texts_ids(spark):
    pick = random.Random(8)
    rows = [(k * 7, pick.choice([None, "", sentence(pick, pick.randrange(50)), "a  b\n c\t" * 9])) for k in range(90)]
    shuffled = rows[:]
    pick.shuffle(shuffled)
    library = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    got = {r["doc_id"]: tuple(r)[1:] for r in token_output.token_files(plain(spark, shuffled)).collect()}
    start = 0
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[doc] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_hold_added_tokens(spark):
    texts = ["<|endoftext|>", "one <|endoftext|> two", "glued<|endoftext|>words", "  <|endoftext|>  ", "plain <|endoftext| >", "<|endoftext|>" * 3 + "\n", "after"]
    library = Tokenizer.from_file(public_tokenizers.path(token_output.TOKENIZER))
    got = {r["doc_id"]: tuple(r)[1:] for r in token_output.token_files(plain(spark, list(enumerate(texts)))).collect()}
    start = 0
    for doc, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert got[doc] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    cursor = connection.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = [dict(zip(names, row, strict=True)) for row in cursor.fetchall()]
    got = [r.asDict() for r in queries.QUERIES[name](spark, SF_DIR).collect()]
    assert sorted(map(sorted, map(dict.items, got))) == sorted(map(sorted, map(dict.items, want)))


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables")
def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    rows = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    judged = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    texts = [(r["doc_id"], r["text"]) for r in rows if judged[r["doc_id"]]]
    root, _ = brute_components(texts, 5, 80)
    texts = [(i, t) for i, t in texts if root[i] == i]
    hits = brute_hits(texts, items)
    want = {i: pii.mask(t) for i, t in texts if not hits[i][4]}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(want) and len(got) > 50
    model = public_tokenizers.path(pieces.MODEL)
    for doc, row in got.items():
        assert row["exact"] and row["n_tokens"] == len(row["ids"])
        assert pieces.decode_ids(np.array(row["ids"]), model) == want[doc].replace("▁", " ")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "sentencepiece"]


def test_every_query_runs_on_its_whole_table(spark):
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
