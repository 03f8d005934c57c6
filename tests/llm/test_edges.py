"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import hashlib

import pytest

from riskwatch.llm import decontaminate, fill_middle, html_text, mixing, near_dedup, pieces, pii, quality, secrets, suffix_dedup, token_counts, token_output
from tests.llm.data import documents, edge_rows, plain

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def edges(spark):
    return documents(spark, edge_rows())


def benchmark(spark):
    return spark.createDataFrame([(1, "word", 5), (2, None, 5), (3, "", 5), (4, "word", 5)], "item_id bigint, text string, n int")


OPERATORS = {
    "tokens": lambda spark, docs: token_output.token_files(docs),
    "pii": lambda spark, docs: pii.find_pii(docs),
    "secrets": lambda spark, docs: secrets.find_secrets(docs),
    "decontaminate": lambda spark, docs: decontaminate.decontaminate(docs, benchmark(spark)),
    "counts": lambda spark, docs: token_counts.token_counts(docs),
    "quality": lambda spark, docs: quality.quality_rules(docs),
    "pieces": lambda spark, docs: pieces.encode(docs),
    "near": lambda spark, docs: near_dedup.near_duplicates(docs),
    "suffix": lambda spark, docs: suffix_dedup.dedup(docs),
    "fill": lambda spark, docs: fill_middle.digests(fill_middle.transform(docs)),
    "mix": lambda spark, docs: mixing.plan(docs),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_one_row_each_on_odd_rows_and_none_on_an_empty_table(spark, edges, name):
    rows = OPERATORS[name](spark, edges).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in edge_rows())
    assert OPERATORS[name](spark, edges.limit(0)).collect() == []


def test_defined_results(spark, edges):
    found = {r["doc_id"]: r for r in OPERATORS["decontaminate"](spark, edges).collect()}
    assert (found[4]["n_hit"], found[4]["n_items"], found[4]["contaminated"]) == (1, 2, True)
    assert found[1]["n_words"] == 0 and found[1]["items_sha256"] == EMPTY_SHA
    near = [r for r in OPERATORS["near"](spark, edges).collect()]
    by_id = {r["doc_id"]: r for r in near}
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"] and by_id[5]["kept"]
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["component_id"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in near if r["doc_id"] is None)
    cut = {r["doc_id"]: r for r in OPERATORS["suffix"](spark, edges).collect()}
    assert cut[6]["n_removed"] == cut[6]["n_bytes"] and cut[6]["kept_sha256"] == EMPTY_SHA and cut[5]["n_removed"] == 0
    assert cut[10]["n_removed"] == 4999 and cut[10]["n_spans"] == 1
    assert cut[8]["n_removed"] == 0
    assert cut[None]["n_removed"] == 0
    judged = {r["doc_id"]: r for r in OPERATORS["quality"](spark, edges).collect()}
    assert judged[1]["base_failed"] and judged[2]["base_failed"] and judged[11]["n_repeat_words"] == 4000
    encoded = {r["doc_id"]: r for r in OPERATORS["pieces"](spark, edges).collect()}
    assert encoded[1]["ids"] is None and encoded[2]["ids"] == [] and encoded[7]["exact"]


def test_rows_pass_with_all_their_columns(spark, edges):
    for kept in (quality.passing(edges), near_dedup.one_of_each(edges), decontaminate.clean(edges, benchmark(spark)), pii.redact(edges)):
        assert kept.columns == edges.columns
        assert kept.limit(0).collect() == []
    once = [r["doc_id"] for r in near_dedup.one_of_each(edges).collect()]
    # Copies and repeated rows leave one; rows without an id stay.
    assert sorted(x for x in once if x is not None) == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert once.count(None) == 2
    assert 4 not in [r["doc_id"] for r in decontaminate.clean(edges, benchmark(spark)).collect()]


def test_pages(spark):
    rows = [(1, None, None, 2), (None, "u", "", 2), (2, "u", "<p", 2), (3, "u", "a < b &amp; c", 2), (3, "u", "<article>" + "<p>x y" * 3000, 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = html_text.extract(pages).collect()
    assert [r["n_chars"] for r in found] == [len(r["text"]) for r in found] and len(found) == 5
    assert found[4]["text"] == " ".join(["x y"] * 3000)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_without_a_benchmark_nothing_is_contaminated(spark, edges):
    rows = decontaminate.decontaminate(edges, benchmark(spark).limit(0)).collect()
    assert len(rows) == len(edge_rows()) and not any(r["n_hit"] or r["n_items"] or r["n_near"] or r["contaminated"] for r in rows)
