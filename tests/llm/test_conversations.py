"""Conversation repair against exhaustive search, and conversations of many partitions."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import pytest

from riskwatch.llm import conversations as c
from riskwatch.llm import queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, code int, edits string"
FORM = re.compile(r"(s?(ua)+)?")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, "" if hit == 0 else text)
        role = "user" if hit == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def brute_faults(turns):
    seen, faults = set(), []
    for _, role, text in turns:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    return faults


def brute_edits(turns, faults):
    """All edit sequences up to the cheapest cost, by whole audits."""
    best = {}

    def go(at, made, cost, audit, inserts):
        if cost > best.get("cost", 10**9):
            return
        if at == len(turns):
            if FORM.fullmatch("".join(role[:1] or "-" for role, _ in made)):
                found = (cost, audit, made)
                if "cost" not in best or found[:2] < (best["cost"], best["audit"]):
                    best.update(cost=cost, audit=audit, made=made)
        else:
            _, role, text = turns[at]
            extra = 5 if faults[at] == "truncated" else 0
            go(at + 1, made, cost + 2, audit + "D", 0)
            if faults[at] not in ("blank", "duplicate"):
                go(at + 1, [*made, (role, text)], cost + extra, audit + "K", 0)
                for new in ("user", "assistant"):
                    go(at + 1, [*made, (new, text)], cost + 1 + extra, audit + "R", 0)
        if inserts < 3:
            for new in ("user", "assistant"):
                go(at, [*made, (new, "")], cost + 5, audit + "I", inserts + 1)

    go(0, [], 0, "", 0)
    return best["cost"], best["audit"], best["made"]


def brute_report(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    faults = brute_faults(turns)
    numbers = {t for t, _, _ in turns if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
    cost, audit, made = brute_edits(turns, faults)
    text = "\n".join(f"{role}:{text}" for role, text in made)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def random_turns(pick, n):
    roles = ["user", "assistant", "system", "tool", "", "unknown"]
    texts = ["Yes.", "No", "", " \t", "Why?", "well", "Go on!", "One.", "Two.", "Three."]
    weights = [8, 8, 2, 1, 1, 1]
    numbers = [pick.choice([None, k, k, k, k + 1]) for k in range(n)]
    return [(t, pick.choices(roles, weights)[0], pick.choice(texts) + pick.choice(["", "", " x.", " "])) for t in numbers]


def test_edits_equal_exhaustive_search():
    pick = random.Random(11)
    for n in [0, 1, 1, 2, 2, 3, 3, 3] + [4] * 60 + [5] * 20:
        turns = random_turns(pick, n)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert c.report_of(turns) == brute_report(turns), turns


def test_segments_equal_the_whole():
    """Matrices, ends, exits and entries of any cut give the edits of the whole."""
    pick = random.Random(5)
    for _ in range(200):
        codes = bytes(pick.randrange(16) for _ in range(pick.randrange(1, 60)))
        cuts = sorted({0, len(codes), *[pick.randrange(len(codes)) for _ in range(3)]})
        parts = [codes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        end, ends = c.END, []
        for part in reversed(parts):
            ends.append(end)
            end = c.through(c.matrix(part), end)
        state, edits = c.START, []
        for k, (part, costs) in enumerate(zip(parts, reversed(ends), strict=True)):
            made, state = c.walk(part, costs, state, last=k == len(parts) - 1)
            edits += made
        assert edits == c.walk(codes, c.END, c.START)[0]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def conversations(seed, n=60):
    pick = random.Random(seed)
    rows = []
    for conv in [*range(n), None, 2**40]:
        for turn, role, text in random_turns(pick, pick.randrange(1, 5)):
            rows.append((conv, turn, pick.choice([role, role, role, None]), pick.choice([text, text, text, None])))
    rows += rows[:4]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_report_equals_brute_force(spark, partitions):
    rows = conversations(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        damaged = c.damaged(table(spark, rows))
        got = {r["conv_id"]: tuple(r)[1:] for r in c.report(damaged).collect()}
        repaired = c.repair(damaged).orderBy("conv_id", "seg", "seq", "step").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hurt = brute_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == brute_report([r[1:] for r in hurt if r[0] == conv])
        text = "\n".join(f"{r['role']}:{r['text']}" for r in repaired if r["conv_id"] == conv)
        assert hashlib.sha256(text.encode()).hexdigest() == found[-1]


def test_one_conversation_over_many_partitions(spark):
    """A conversation with most rows, of repeated and of different turns, is cut anywhere."""
    pick = random.Random(3)
    rows = [(5, k // 3, pick.choice(["user", "assistant", "system"]), pick.choice(["Same.", f"Other {k}.", f"cut {k}", " "])) for k in range(3000)]
    rows += [(9, 1, "user", "Copy.")] * 900 + [(7, None, "assistant", "Late?"), (7, 2, "user", "So.")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["conv_id"]: tuple(r)[1:] for r in c.report(table(spark, rows)).collect()}
        spread = c._first(c._with_presence(table(spark, rows)), True).where("not whole").select("conv_id", "seg").distinct()
        segments = [r["conv_id"] for r in spread.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert segments.count(5) > 6 and segments.count(9) > 2
    for conv in (5, 7, 9):
        turns = sorted([r[1:] for r in rows if r[0] == conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert got[conv] == c.report_of(turns)
    assert got[9][2] == 899 and got[7][5] == brute_report([r[1:] for r in rows if r[0] == 7])[5]


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables")
def test_query_equals_a_plain_program(spark):
    """Over a whole table: planned damage, and each conversation alone."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = brute_damage(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()}
    assert set(got) == {r[0] for r in rows} and len(got) > 10
    for conv, found in got.items():
        turns = sorted([r[1:] for r in hurt if r[0] == conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        assert found == c.report_of(turns)
        if len(turns) < 5:
            assert found == brute_report(turns)


def test_empty_and_dropped(spark):
    empty = table(spark, [(1, 1, "user", "a")]).limit(0)
    assert c.report(c.damaged(empty)).collect() == [] and c.repair(c.damaged(empty)).collect() == []
    turn = next(k for k in range(1000) if zlib.crc32(f"1:{k}".encode()) % 20 == 0)
    found = c.report(c.damaged(table(spark, [(1, turn, "user", "Gone.")]))).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "x " * 400_000 + "."), (1, 1, "assistant", "y" * 700_000 + "!"), (2, 0, "r" * 5000, "Odd."), (2, 0, "r" * 4999, "Odd.")]
    got = {r["conv_id"]: tuple(r)[1:] for r in c.report(table(spark, rows)).collect()}
    assert got[1][:6] == (0, 0, 0, 0, 0, 0) and got[1][6] == "KK"
    assert got[2] == brute_report([r[1:] for r in rows if r[0] == 2])
