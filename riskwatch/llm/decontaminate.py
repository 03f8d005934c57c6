"""Benchmark decontamination (4): a distributed positional inverted index.

Only DataFrame functions. The postings (term, document, position) of the terms
that can decide something are stored as a table. A window of a test item is
looked up by its rarest term, and the list is intersected with the offset-adjusted
list of its second rarest: equal starts can be exact phrases, starts that differ by
at most ``SLACK`` words proximity matches. What is left is compared word by word
with the document.

A proximity match of a window of n words at place s of a document: its rarest term
stands where s puts it, its second rarest at most ``SLACK`` words off, and of its
different words all but ``SLACK`` stand among the words from s - SLACK to
s + n + SLACK. An exact phrase is one, too. So a passage with a word put in, left
out or replaced is found by windows around the change, also if the item has no
window without it; ``n_near`` counts such items and decides nothing else.

How it scales: the corpus is cut into words once, for the postings of all terms of
the benchmark, and its texts are read once more for the candidates; it is never
shuffled as a whole. Terms are counted from their postings, on the map side. A
common term's list is used only where a window has no rarer one. Lists are joined
by term with the windows, of which Spark broadcasts the table if it is small; else
AQE splits a common term's list, as both sides are written tables. The lists of a
window meet by document and stretch of it. Tables that grow with the benchmark are
joined without a hint.

Defined results: a null or empty text has no words, no hits and no items. An
item without words has no window; one of fewer than ten words is one window.
Equal windows of several items count for each item. Rows without ``doc_id`` have
no hits, rows with the same ``doc_id`` count as one document's passages and each
gives a row. Only ``doc_id``, ``text`` and ``item_id`` are read. Without documents
there are no rows, without a benchmark no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import lower_ascii, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words that a proximity match may have more, fewer or elsewhere.
SLACK = 2
#: Words of a stretch, by which the two lists of a window meet.
STRETCH = 64
END = ""  # not a word: its posting carries a document's number of words


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; none for a null one."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def test_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, item_id): each run of ``size`` words of an item, as an array."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    runs = items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return runs.select("item_id", F.slice("words", F.col("at") + 1, size).alias("window")).distinct()


def window_id(window: Column) -> Column:
    return F.sha2(F.array_join(window, " "), 256).alias("window_id")


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stores (term, doc_id, position) for the given terms, positions from 0.

    ``END`` is among the terms; its position is the document's word count.
    """
    words = F.concat(words_of(F.col("text")), F.array(F.lit(END)))
    tokens = docs.select("doc_id", F.posexplode(words).alias("position", "term"))
    return stage(tokens.join(terms, "term", "left_semi").select("term", "doc_id", "position"), "postings")


def rarest_terms(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, first, first_at, second, second_at): a window's two rarest terms.

    Counts are over the whole corpus. Ties go to the earlier place. A window of
    one word has it as both.
    """
    places = windows.select("window", F.posexplode("window").alias("at", "term"))
    # A written table has a known size, by which Spark chooses the join.
    counts = stage(index.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranked = (
        places.join(counts, "term", "left")
        .groupBy("window")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term"))).alias("r"))
    )
    second = F.get("r", F.least(F.lit(1), F.size("r") - 1))
    return ranked.where(F.get("r", F.lit(0))["n"] > 0).select(
        "window",
        F.get("r", F.lit(0))["term"].alias("first"),
        F.get("r", F.lit(0))["at"].alias("first_at"),
        second["term"].alias("second"),
        second["at"].alias("second_at"),
    )


def _close(first: DataFrame, second: DataFrame, slack: int) -> DataFrame:
    """The first list's starts with one of the second list at most ``slack`` away.

    Lists meet by stretches of the document; a start next to the border of one
    is in both stretches.
    """
    def stretch(shift: int) -> Column:
        return F.floor((F.col("start") + shift) / STRETCH)

    ours = first.withColumn("stretch", stretch(0))
    theirs = second.select(
        "number", "doc_id", F.col("start").alias("other"),
        F.explode(F.array_distinct(F.array(stretch(-slack), stretch(slack)))).alias("stretch"),
    )
    keys = ["number", "doc_id", "stretch"]
    theirs = theirs.select(*[F.col(k).alias(f"_{k}") for k in keys], "other")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    near = reduce(Column.__and__, same) & (F.abs(F.col("start") - F.col("other")) <= slack)
    return ours.join(theirs, near, "left_semi").select("number", "doc_id", "start")


def _around(words: Column, start: Column, n: Column, slack: int) -> Column:
    """The words from ``slack`` before a place to ``slack`` behind its window."""
    low = F.greatest(start - slack, F.lit(0))
    return F.slice(words, low + 1, F.greatest(start + n + slack - low, F.lit(0)))


def occurrences(docs: DataFrame, windows: DataFrame, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """Where each window occurs, exactly or nearly, and each document's number of words.

    Gives (window_id, doc_id, start, n, exact) and (doc_id, n_words).
    """
    windows = windows.select("window").distinct()
    terms = windows.select(F.explode("window").alias("term"))
    ends = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
    index = positional_index(docs, stage(terms.unionByName(ends).distinct(), "terms"))
    # A number each, as rows of the lists carry it.
    numbered = rarest_terms(index.where(F.col("term") != END), windows)
    numbered = stage(numbered.withColumn("number", F.monotonically_increasing_id()), "windows")

    def starts(which: str) -> DataFrame:
        lists = index.where(F.col("term") != END).withColumnRenamed("term", which)
        keys = numbered.select("number", which, f"{which}_at")
        return lists.join(keys, which).select(
            "number", "doc_id", (F.col("position") - F.col(f"{which}_at")).alias("start")
        )

    both = _close(starts("first").where(F.col("start") >= -slack), starts("second"), slack)
    candidates = (
        both.distinct()
        .join(numbered.select("number", "window"), "number")
        .groupBy("doc_id", F.floor(F.col("start") / 512).alias("part"))
        .agg(F.collect_list(F.struct("start", "number", "window")).alias("found"))
    )

    def judged(words: Column, c: Column) -> Column:
        start, window, n = c["start"], c["window"], F.size(c["window"])
        # An array begins at 1; a window that begins before the document is none.
        exact = (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, n) == window)
        kept = F.size(F.array_intersect(window, _around(words, start, n, slack)))
        near = kept >= F.size(F.array_distinct(window)) - slack
        return F.struct(
            c["number"].alias("number"), start.alias("start"), n.alias("n"), exact.alias("exact"), near.alias("near")
        )

    # Texts travel as they are and are cut into words behind the join.
    texts = docs.select("doc_id", "text").join(stage(candidates, "candidates"), "doc_id")
    cut = texts.select("doc_id", "found", words_of(F.col("text")).alias("words"))
    checked = cut.select("doc_id", F.explode(F.transform("found", lambda c: judged(F.col("words"), c))).alias("c"))
    found = checked.select("doc_id", "c.*").where("near").drop("near")
    found = found.join(numbered.select("number", window_id(F.col("window"))), "number").drop("number")
    n_words = index.where(F.col("term") == END).select("doc_id", F.col("position").cast("bigint").alias("n_words"))
    return found, n_words


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and
    ``n_near``, the items with a proximity match."""
    windows = test_windows(benchmark, size)
    found, n_words = occurrences(docs, windows, slack)
    found = stage(found, "occurrences")
    hit = (
        found.where("exact")
        .select("doc_id", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at"))
        .groupBy("doc_id", "at")
        .agg(F.lit(1).alias("one"))
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    of_items = windows.select("item_id", window_id(F.col("window")))
    item = F.col("item_id").cast("string")
    items = (
        found.groupBy("doc_id", "window_id")
        .agg(F.max("exact").alias("exact"))
        .join(of_items, "window_id")
        .groupBy("doc_id")
        .agg(F.collect_set(F.when(F.col("exact"), item)).alias("items"), F.count_distinct(item).alias("n_near"))
        .select(
            "doc_id",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
            "n_near",
        )
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return (
        n_words.join(items.join(hit, "doc_id", "left"), "doc_id", "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    hit = decontaminate(docs, benchmark, size).where("contaminated").select("doc_id").distinct()
    return docs.join(stage(hit, "contaminated"), "doc_id", "left_anti").select(*docs.columns)


def oracle(size: int = WINDOW, slack: int = SLACK) -> str:
    """Brute force in DuckDB's SQL: every window of every length that occurs."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS words FROM documents),
b AS (SELECT item_id, {words} AS words FROM benchmark),
bw AS (
  SELECT item_id, least(len(words), {size}) AS n,
         unnest(range(1, greatest(len(words) - {size}, 0) + 2)) AS i, words FROM b WHERE len(words) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS w FROM bw
), lengths AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(words) - n + 2)) AS i, words FROM d, lengths WHERE len(words) >= n
), runs AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS w FROM dw
), found AS (
  SELECT doc_id, item_id, i, n FROM runs JOIN win USING (n, w)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
), places AS (
  SELECT doc_id, unnest(words) AS term, unnest(range(0, len(words))) AS position FROM d
), counts AS (
  SELECT term, count(*) AS df FROM places GROUP BY term
), spread AS (
  SELECT DISTINCT words[i : i + n - 1] AS w, n FROM bw
), ranked AS (
  SELECT w, n, place, term, row_number() OVER (PARTITION BY w ORDER BY coalesce(df, 0), place) AS rank,
         min(coalesce(df, 0)) OVER (PARTITION BY w) AS least_n
  FROM (SELECT w, n, unnest(range(0, n)) AS place, unnest(w) AS term FROM spread) LEFT JOIN counts USING (term)
), rarest AS (
  SELECT w, n, max(term) FILTER (rank = 1) AS t1, max(place) FILTER (rank = 1) AS at1,
         max(term) FILTER (rank = least(2, n)) AS t2, max(place) FILTER (rank = least(2, n)) AS at2
  FROM ranked WHERE least_n > 0 GROUP BY w, n
), near AS (
  SELECT DISTINCT w, n, x.doc_id, x.position - at1 AS s
  FROM rarest JOIN places x ON x.term = t1 JOIN places y ON y.term = t2 AND y.doc_id = x.doc_id
  WHERE abs((x.position - at1) - (y.position - at2)) <= {slack} AND x.position - at1 >= -{slack}
), close AS (
  SELECT DISTINCT doc_id, w, n FROM near JOIN d USING (doc_id)
  WHERE len(list_distinct(list_intersect(w, words[greatest(s - {slack}, 0) + 1 : s + n + {slack}])))
        >= len(list_distinct(w)) - {slack}
), nears AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near
  FROM close JOIN (SELECT DISTINCT item_id, n, words[i : i + n - 1] AS w FROM bw) USING (w, n) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN nears USING (doc_id)
"""
