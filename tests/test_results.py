"""Written results, the log's fields, and checksums of tables."""

from datetime import timedelta
from decimal import Decimal
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from riskwatch.operators.fingerprint import fingerprint
from riskwatch.sources import log_field, log_fields, read_written, result_log, write_results
from tests.tables import AS_OF

SCHEMA = "creditor_id string, amount decimal(18,2), fields array<struct<id:bigint,value:string>>, process_name string"
ROWS = [("C1", None, [(1, "a")], "p"), ("C2", Decimal(5), [], "p"), (None, Decimal(7), None, "p")]


def written(spark, path, schema):
    found = read_written(spark, path, schema).collect()
    return sorted((str(r["run_date"]), r["process_name"], str(r["creditor_id"])) for r in found)


def test_a_repeated_run_replaces_its_own_rows_only(spark, tmp_path):
    path, rows = str(tmp_path / "out"), spark.createDataFrame(ROWS, SCHEMA)
    other = rows.withColumn("process_name", F.lit("q"))
    write_results(rows, path, AS_OF, verify=True)
    write_results(other, path, AS_OF, verify=True)
    write_results(rows, path, AS_OF + timedelta(days=1), process="p", verify=True)
    before = written(spark, path, rows.schema)
    assert len(before) == 9
    write_results(rows, path, AS_OF, verify=True)
    assert written(spark, path, rows.schema) == before
    write_results(rows.limit(1), path, AS_OF, process="p", verify=True)
    assert len(written(spark, path, rows.schema)) == 7
    # No rows any more: the named process's directory is replaced all the same.
    write_results(rows.limit(0), path, AS_OF, process="p", verify=True)
    left = written(spark, path, rows.schema)
    assert len(left) == 6 and not [r for r in left if r[:2] == (AS_OF.isoformat(), "p")]


def test_files_that_differ_from_the_rows_are_found(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    read = result_log.read_written
    monkeypatch.setattr(result_log, "read_written", lambda *a: read(*a).withColumn("amount", F.lit(5).cast("decimal(18,2)")))
    with pytest.raises(ValueError, match="amount"):
        write_results(rows, str(tmp_path / "out"), AS_OF, verify=True)


def test_checksums_see_changed_moved_and_repeated_values(spark):
    rows = [(1, "a", 1.5, (None, "x")), (2, "b", None, (3, "y")), (3, None, 0.1, (4, None))]
    schema = "n int, s string, d double, t struct<u: int, v: string>"

    def lines(values):
        return {r["column_name"]: tuple(r)[1:] for r in fingerprint(spark.createDataFrame(values, schema)).collect()}

    plain = lines(rows)
    assert list(plain) == ["n", "s", "d", "t.u", "t.v", "*"] and plain["s"][:2] == (3, 1) and plain["t.u"][1] == 1
    assert lines(rows[::-1]) == plain
    changed = lines([(1, "a", 1.5, (None, "x")), (2, "c", None, (3, "y")), rows[2]])
    assert {k for k in plain if plain[k] != changed[k]} == {"s", "*"}
    swapped = lines([(1, "b", 1.5, (None, "x")), (2, "a", None, (3, "y")), rows[2]])
    assert {k for k in plain if plain[k] != swapped[k]} == {"*"}
    assert all(lines([*rows, rows[0]])[k][0] == 4 for k in plain)
    assert lines([])["*"] == (0, 0, "0")


def test_checksums_are_summed_as_integers_and_exact(spark):
    """The sums pass 64 bits; they are kept as integers, and booleans are not hashed row by row."""
    rows = spark.range(1_000).selectExpr("id", "if(id % 7 = 0, null, id % 3 = 0) AS paid", "cast(null AS boolean) AS none")
    lines = fingerprint(rows)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    # one hash for the ids and one for whole rows
    assert plan.count("md5(") == 2 and "decimal(38,0)" not in plan

    def checksum(texts):
        return str(sum(int(md5(t.encode()).hexdigest()[:15], 16) for t in texts))

    ids, paid = range(1_000), [None if k % 7 == 0 else str(k % 3 == 0).lower() for k in range(1_000)]
    whole = [f"{len(str(k))}:{k}{'-' if p is None else f'{len(p)}:{p}'}-" for k, p in zip(ids, paid, strict=True)]
    known = [p for p in paid if p is not None]
    assert [tuple(r) for r in lines.collect()] == [
        ("id", 1_000, 0, checksum(map(str, ids))),
        ("paid", 1_000, 143, checksum(known)),
        ("none", 1_000, 1_000, "0"),
        ("*", 1_000, 0, checksum(whole)),
    ]


def test_log_fields_are_scalars_and_parse_once(spark):
    documents = [
        '{"a":"x","b":1.50,"c":null}', '{"a":{"b":1},"b":[1],"c":"[text]"}', '{"a":"{","b":true}', "broken", None,
        '{"a":"{\\"k\\":1}","b":"","c":-3}',
    ]
    rows = spark.createDataFrame([(k, d) for k, d in enumerate(documents)], "n int, `values` string")
    got = {r["n"]: (r["a"], r["b"], r["c"]) for r in log_fields(rows, "a", "b", "c").collect()}
    assert got[0] == ("x", "1.5", None) and got[1] == (None, None, "[text]") and got[2] == ("{", "true", None)
    assert got[3] == got[4] == (None, None, None) and got[5] == ('{"k":1}', "", "-3")
    one_by_one = rows.select("n", *[log_field(k).alias(k) for k in "abc"]).collect()
    assert got == {r["n"]: (r["a"], r["b"], r["c"]) for r in one_by_one}
