"""Fill-in-middle and mixing against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskwatch.llm import fill_middle as fim
from riskwatch.llm import mixing
from tests.llm.data import documents, edge_rows, plain, sentence

many = settings(max_examples=300, deadline=None)


def brute_fill(text, doc, rate=100, spm=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{doc}".encode()).hexdigest()
    h = [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@many
@given(st.text(alphabet="ab\n\r\x85<>PSMé\U0001f600", max_size=40), st.integers(-5, 10**6))
def test_fill_equals_plain_lines(text, doc):
    assert fim.fill_middle(text, doc) == brute_fill(text, doc)
    assert fim.fill_middle(text, doc, rate=40, spm_rate=10) == brute_fill(text, doc, 40, 10)


def test_long_texts_take_linear_time():
    start = time.time()
    for text in ("\n" * 2_000_000, "x" * 5_000_000, "ab\n" * 700_000 + "z"):
        n, _, prefix, middle, _ = fim.fill_middle(text, 3)
        assert (n, prefix, middle) == (brute_fill(text, 3)[0], *brute_fill(text, 3)[2:4])
    assert time.time() - start < 20


def test_text_is_rebuilt_from_output_and_form(spark):
    pick = random.Random(1)
    parts = ["<", "P>", "<P", "S>", "M", ">", "\n", "word ", "é", "\r\n", "<S>"]
    rows = [(k, "".join(pick.choices(parts, weights=[5] * 10 + [1], k=pick.randrange(30)))) for k in range(300)]
    rows += [(None, "one\ntwo\n"), (7, None), (8, ""), (9, "same\n"), (9, "same\n")]
    made = fim.transform(plain(spark, rows)).select("*", fim.restored().alias("back")).collect()
    assert Counter(r["back"] for r in made) == Counter(t or "" for _, t in rows)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}
    digests = fim.digests(fim.transform(plain(spark, rows))).collect()
    assert Counter(r["restored_sha256"] for r in digests) == Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)
    by_text = {(r["doc_id"], r["restored_sha256"]): r for r in digests}
    for doc, text in rows:
        want = brute_fill(text or "", "" if doc is None else doc)
        got = by_text[doc, hashlib.sha256((text or "").encode()).hexdigest()]
        assert tuple(got)[1:5] == want[:4] and got["output_sha256"] == hashlib.sha256(want[4].encode()).hexdigest()


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, the excess dealt again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, room, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), list(names)
    while room > 1e-9 and free:
        whole = sum(weight[s] for s in free)
        for s in free:
            target[s] += room * weight[s] / whole
        room = 0.0
        for s in free:
            if target[s] > most * sizes[s]:
                room += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
        free = [s for s in free if target[s] < most * sizes[s]]
    return target


def mix_rows(seed, n_sources=9, n=600):
    """A hot source, sources that fill up, one without words, and no source."""
    pick = random.Random(seed)
    names = [None, "empty", *[pick.choice("AZaz_é世\U0001f600") + str(k) for k in range(n_sources)]]
    rows = []
    for k in range(n):
        source = names[2] if pick.random() < 0.4 else pick.choice(names[:4]) if k < 40 else pick.choice(names)
        text = " \n" if source == "empty" else pick.choice([None, sentence(pick, pick.randrange(60)), "a  b\tc\x0bd"])
        rows.append((k // 2, text, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_reaches_its_targets(spark, seed):
    rows = mix_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets({s: sizes[s] for s in {r[2] for r in rows}})
    rates = {r["source"]: r for r in mixing.source_rates(docs.select("source", mixing.size().alias("size"))).collect()}
    assert set(rates) == set(want)
    for source, row in rates.items():
        assert row["source_size"] == sizes[source] and row["target"] == pytest.approx(want[source], abs=1e-6)
        assert row["rate"] == pytest.approx(want[source] / sizes[source] if sizes[source] else 0)
    assert any(r["rate"] == 3 for r in rates.values())
    planned = mixing.plan(docs).collect()
    again = mixing.plan(docs.repartition(7)).collect()
    assert len(planned) == len(rows) and Counter(planned) == Counter(again)
    assert all(r["taken"] in (int(x) * r["size"] for x in range(4)) for r in planned)
    emitted = Counter(tuple(r) for r in mixing.mix(docs).collect())
    assert sum(r["copies"] for r in planned) == sum(emitted.values())
    for source, row in rates.items():
        for doc, count in Counter(r for r in rows if r[2] == source).items():
            assert emitted[doc] // count in (int(row["rate"]), int(row["rate"]) + (row["rate"] % 1 > 0))


def test_words_taken_come_near_the_target(spark):
    rows = [(k, "w " * (20 + k % 30), f"s{min(k % 7, 4)}") for k in range(20000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned = mixing.plan(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert len(planned) > 2
    for _, target, taken in planned:
        assert abs(taken / target - 1) < 0.05


def test_mix_of_odd_rows(spark):
    docs = documents(spark, edge_rows())
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(edge_rows())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.limit(0).collect() == [] and mixing.mix(docs.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert sorted(tuple(r)[1:] for r in mixing.plan(nothing).collect()) == [(0, 0, 0.0, 0, 0)] * 2
