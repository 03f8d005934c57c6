"""What the plans look like: pruning, pushdown, early limits, hot keys."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import binding, catalog
from checks.params import CHARGEBACK, INSOLVENCY, RE_REVIEW, SCORE_DROP
from riskwatch import PIPELINES, Sources, run
from riskwatch import config as c
from riskwatch.operators import staging
from riskwatch.operators.joins import hot_cells, many_to_many, packed, spread_lookup, told_apart
from riskwatch.operators.rows import latest, with_previous
from riskwatch.operators.staging import stage
from riskwatch.plans import features as f
from riskwatch.plans import merge
from tests.tables import AS_OF, MERCHANT, ORGANISATION, SCHEMAS, days, make_sources, paid, report


SF_DIR = "/root/testdata/sf0.01"
PARAMS = {c.PROCESS_SCORE_DROP: SCORE_DROP, c.PROCESS_CHARGEBACK: CHARGEBACK, c.PROCESS_RE_REVIEW: RE_REVIEW, c.PROCESS_INSOLVENCY: INSOLVENCY}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Sources over parquet files, and their folder."""
    folder = tmp_path_factory.mktemp("tables")
    tables = make_sources(
        spark, creditor=[MERCHANT], organisation=[ORGANISATION], payment=[paid("C1", -3)],
        score_report=[report("C1", days(-1), 40)])
    paths = {name: str(folder / name) for name in SCHEMAS}
    for name, path in paths.items():
        tables.table(name).write.parquet(path)
    return Sources.from_parquet(spark, paths)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans_of(text):
    return [line for line in text.splitlines() if "FileScan" in line]


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast, partitions left as they are."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", list(PIPELINES))
def test_no_python_and_no_products_of_tables(stored, name):
    text = plan(run(name, stored, AS_OF))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_the_portfolio_row_is_the_only_keyless_join(stored):
    params = c.ChargebackParams(only_alerts=False)
    text = plan(run(c.PROCESS_CHARGEBACK, stored, AS_OF, params))
    assert text.count("BroadcastNestedLoopJoin") == 1 and "CartesianProduct" not in text


def test_payment_windows_reach_the_scan(stored):
    text = plan(f.payment_window_metrics(stored, AS_OF))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    for column in ("charge_date", "charged_back_date", "failed_or_late_failure_date", "refund_created_at"):
        assert f"GreaterThanOrEqual({column}" in pushed
    assert text.count("FileScan") == 1


def test_paid_amount_reads_the_year_and_one_column_of_the_history(stored):
    text = plan(f.paid_last_year(stored, AS_OF))
    scans = scans_of(text)
    columns = [{part.split(":")[0] for part in re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1).split(",")} for scan in scans]
    assert columns == [{"creditor_id", "amount_gbp", "is_paid", "charge_date"}, {"creditor_id"}]
    assert "GreaterThanOrEqual(charge_date" in scans[0] and "LessThan" in scans[0]


def test_only_the_nested_leaf_is_read(stored):
    text = plan(f.latest_failure_score(stored))
    assert "dnb_assessment:struct<failure_score:struct<national_percentile:bigint>>" in text
    assert "legal_events" not in text
    assert "IsNotNull(dnb_assessment.failure_score.national_percentile)" in text


def test_log_filters_reach_the_scan(stored):
    text = plan(f.last_alert(stored, AS_OF, c.PROCESS_CHARGEBACK, "cb_rate_30days", f.CHARGEBACK_HISTORY))
    assert f"EqualTo(process_name,{c.PROCESS_CHARGEBACK})" in text and "EqualTo(logtype,result)" in text


def test_latest_limits_each_key_before_the_shuffle(stored):
    text = plan(f.latest_exposure(stored))
    assert text.count("WindowGroupLimit") == 2
    assert re.search(r"Exchange hashpartitioning.*?WindowGroupLimit.*?Partial", text, re.S)


def test_features_share_the_merge_partitioning(stored, no_broadcast):
    """Every feature is shuffled once, by the creditor, and joined as it is."""
    base = f.creditor_details(stored)
    merged = base.join(f.latest_exposure(stored), "creditor_id", "left").join(
        f.paid_last_year(stored, AS_OF), "creditor_id", "left")
    text = plan(merged)
    # creditor and organisation by organisation, then the pair and two features by creditor
    assert text.count("Exchange hashpartitioning") == 5


def test_chargebacks_read_payments_once(stored):
    assert plan(f.payment_activity(stored, AS_OF)).count("FileScan") == 1
    result = run(c.PROCESS_CHARGEBACK, stored, AS_OF)
    assert "charged_back_date" not in plan(result)
    assert "staged-" in plan(result)


def test_score_change_scans_twice_and_comes_partitioned_by_creditor(stored, no_broadcast):
    change = f.failure_score_change(stored, AS_OF)
    change.collect()
    text = plan(change).split("Initial Plan")[0]
    # yesterday's rows (used twice), history as one row per creditor, bucket borders, the result
    assert text.count("FileScan") == 2 and text.count("ReusedExchange") == 1
    assert text.count("- Exchange hashpartitioning") == 4
    assert "Join" not in text and text.count("WindowGroupLimit") == 2
    merged = plan(f.latest_exposure(stored).join(change, "creditor_id", "left"))
    # one more shuffle, that of the exposures
    assert merged.count("Exchange hashpartitioning(creditor_id") == plan(f.failure_score_change(stored, AS_OF)).count(
        "Exchange hashpartitioning(creditor_id") + 1


def test_due_reviews_are_decided_before_facts_are_read(stored, no_broadcast):
    """The few creditors with a due ticket filter the fact scans."""
    text = plan(run(c.PROCESS_RE_REVIEW, stored, AS_OF))
    assert "ticket_field_title" not in text
    assert text.count("LeftSemi") == 5
    payments = text[text.index("charged_back_date"):]
    assert payments.index("LeftSemi") < payments.index("FileScan")


@pytest.mark.parametrize("name, params, deciding", [
    (c.PROCESS_CHARGEBACK, CHARGEBACK, {"creditor", "result_log"}),
    (c.PROCESS_NEGATIVE_BALANCE, c.NegativeBalanceParams(max_balance=-5, only_alerts=True), {"creditor", "daily_balance", "result_log"}),
    (c.PROCESS_SCORE_DROP, SCORE_DROP, {"score_report"}),
    (c.PROCESS_RE_REVIEW, RE_REVIEW, {"ticket", "ticket_field", "ticket_org"}),
])
def test_alerts_are_decided_on_few_columns(stored, no_broadcast, monkeypatch, name, params, deciding):
    """What is staged first reads the deciding tables and no wide column; the rest
    is read for the kept merchants."""
    staged = []
    monkeypatch.setattr(merge, "stage", lambda df: staged.append(plan(df)) or stage(df))
    result = plan(run(name, stored, AS_OF, params))
    tables = {t for t in SCHEMAS for scan in scans_of(staged[0]) if f"/{t}]" in scan}
    assert tables == deciding
    assert not any(column in staged[0] for column in ("merchant_name", "parent_account", "geo#", "current_state"))
    facts = {"exposure", "payment"} if name == c.PROCESS_SCORE_DROP else {"exposure", "score_report", "default_prediction"}
    assert facts <= {t for t in SCHEMAS for scan in scans_of(result) if f"/{t}]" in scan}
    assert result.count("LeftSemi") >= len(facts) + 1


@pytest.mark.parametrize("name", [
    c.PROCESS_SCORE_DROP, c.PROCESS_CHARGEBACK, c.PROCESS_SANCTIONED, c.PROCESS_RE_REVIEW, c.PROCESS_INSOLVENCY])
def test_without_a_shared_folder_the_plan_stays_lazy(spark, monkeypatch, name):
    """Nothing is staged then, and the rows are the same."""
    sources, params = binding.sources(spark, SF_DIR), PARAMS.get(name)
    staged = run(name, sources, binding.AS_OF, params)
    for module in (staging, merge):
        monkeypatch.setattr(module, "shared_folder", lambda _: None)
    lazy = run(name, sources, binding.AS_OF, params)
    assert "staged-" in str(staged.inputFiles()) and "staged-" not in str(lazy.inputFiles())
    assert staged.count() > 0
    assert sorted(map(str, staged.collect())) == sorted(map(str, lazy.collect()))


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    stage(spark.range(3))
    assert len(list(tmp_path.glob("staged-*"))) == 1
    assert staging.drop_staged(spark) >= 1
    assert not list(tmp_path.glob("staged-*"))


def test_staged_rows_are_written_once_and_keep_their_types(spark):
    rows = spark.range(5).select("id", F.col("id").cast("decimal(28,2)").alias("amount"))
    staged = stage(rows)
    assert staged.schema["amount"].dataType == rows.schema["amount"].dataType
    assert sorted(staged.collect()) == sorted(rows.collect())
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder in staged.inputFiles()[0]


def test_hot_lookup_key_is_spread(spark, no_broadcast):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("code"))
    lookup = spark.createDataFrame([("hot", 1), ("0", 2), (None, 3)], "code string, rate int")
    joined = spread_lookup(rows, lookup, "code", "id")
    spread = joined.where("code = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1
    plain = rows.join(lookup, "code", "left")
    assert sorted(joined.select("id", "code", "rate").collect()) == sorted(plain.select("id", "code", "rate").collect())


def test_hot_organisation_is_split_at_run_time(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # many map tasks, so that the hot partition consists of blocks to split
        creditor = spark.range(0, 30_000, 1, 8).select(
            F.concat(F.lit("C"), "id").alias("id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("O"), "id")).alias("organisation_id"),
            *[F.lit(None).cast(t).alias(n) for n, t in
              [x.split() for x in re.split(r",\s+", SCHEMAS["creditor"])] if n not in ("id", "organisation_id", "is_payment_provider")],
            F.lit(False).alias("is_payment_provider"))
        tables = make_sources(spark, organisation=[{**ORGANISATION, "organisation_id": "hot"}]).replace(creditor=creditor)
        details = f.creditor_details(tables).select("creditor_id", "current_state")
        assert details.where("current_state = 'active'").count() == 10_000
        details.write.format("noop").mode("overwrite").save()
        details.collect()
        assert "skew=true" in plan(details)
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("cell", [1, 7, 100, 10_000])
def test_many_to_many_equals_a_join(spark, how, cell):
    pick = random.Random(cell)
    keys = ["hot", "left only", "a", "b", None]
    left = spark.createDataFrame([(k, pick.choice(keys + ["hot"] * 4)) for k in range(300)], "c int, o string")
    right = spark.createDataFrame([(k, pick.choice(["hot", "hot", "a", "right only", None])) for k in range(90)], "t int, o string")
    joined = many_to_many(left, right, "o", "c", "t", how, cell).select("c", "o", "t")
    plain = left.join(right, "o", how).select("c", "o", "t")
    assert sorted(joined.collect(), key=str) == sorted(plain.collect(), key=str)


def test_an_organisation_hot_on_both_sides_is_cut_into_cells(spark, no_broadcast):
    """A third of the creditors and a third of the tickets: no task makes it alone."""
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("O"), "id")).alias("o"))
    right = spark.range(900).select(F.col("id").alias("t"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("O"), "id")).alias("o"))
    cells = hot_cells(left, right, "o", 50).collect()
    assert [tuple(r) for r in cells] == [("hot", 20, 6)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        joined = many_to_many(left, right, "o", "id", "t", "inner", cell=50)
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in left.join(right, "o").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(tasks) == sum(plain) and max(plain) >= 300_000
    # 120 cells of about 2,500 rows on 40 tasks
    assert max(tasks) < 25_000


def test_repeats_of_a_hot_key_grow_with_its_rows(spark):
    """Four times the rows are sixteen times the pairs, and four times what is shuffled."""

    def cut(ours, theirs, **limits):
        sides = [spark.range(n).select(F.lit("hot").alias("o")) for n in (ours, theirs)]
        [(_, rows, columns)] = hot_cells(*sides, "o", 16, **limits).collect()
        return rows, columns, ours * columns + theirs * rows

    once, more = cut(2_000, 20_000), cut(8_000, 80_000)
    assert more[2] <= 4.1 * once[2] < 100 * 22_000
    # enough cells for many tasks, and a long side beside a short one is cut alone
    assert 1_000 < once[0] * once[1] < 1_200
    assert cut(10, 80_000)[:2] == (1, 1_024)
    assert cut(80_000, 10)[:2] == (1_024, 1)
    # a task holds a slice of the right side
    assert cut(8_000, 80_000, held=100)[1] == 800


def test_packs_hold_every_row_once_and_no_more_than_their_size(spark):
    rows = spark.createDataFrame(
        [(k % 90 or None, pick) for k, pick in enumerate(["hot", "hot", "a", None] * 100)] + [(7, "hot")] * 500,
        "c int, o string")
    packs = packed(rows, "o", "c", 20).cache()
    back = packs.select("o", F.inline("_packed")).select("c", "o")
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
    assert packs.agg(F.max(F.size("_packed"))).first()[0] == 20
    assert packs.select("o", "_pack").distinct().count() == packs.count() < 100


def test_equal_rows_are_divided_evenly(spark):
    rows = spark.createDataFrame([(1, 2.0), (None, None)], "a int, b double").crossJoin(spark.range(3_000)).drop("id")
    slices = told_apart(rows, "by").groupBy("a", "b", F.pmod("by", F.lit(10))).count().collect()
    assert len(slices) == 20 and max(r["count"] for r in slices) < 450
    assert sum(r["count"] for r in slices) == 6_000


def test_all_pairs_of_a_hot_key_take_few_bytes(spark, tmp_path):
    """Nine million pairs, some of equal payments, in files of under half a byte a pair."""
    when = F.to_date(F.lit("2001-07-01")).cast("timestamp_ntz")
    customer = spark.range(3_050).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("n"), "id").alias("c_name"),
        F.when(F.col("id") < 3_000, 1).when(F.col("id") < 3_020, 2).when(F.col("id") < 3_030, 3).cast("int").alias("c_nationkey"),
        F.lit(0.0).alias("c_acctbal"), F.lit("M").alias("c_mktsegment"))
    orders = spark.range(1_000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), when.alias("o_orderdate"))
    lineitem = spark.range(3_300).select(
        (F.col("id") % 1_000).alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.when(F.col("id") < 2_900, 95_001 + F.col("id") / 7).when(F.col("id") < 3_000, 96_000.5)
        .when(F.col("id") < 3_100, 94_500.0).when(F.col("id") < 3_200, 100.0).alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), when.alias("l_shipdate"))
    # equal payments
    lineitem = lineitem.union(lineitem.where("l_extendedprice = 96000.5 AND l_orderkey < 950"))
    for name, table in {"customer": customer, "orders": orders, "lineitem": lineitem}.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))

    catalog.QUERIES["jon8_cells"](spark, str(tmp_path)).write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))

    amount = F.col("l_extendedprice")
    paying = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("CR"), "o_custkey").alias("payer"), amount.cast("decimal(18,2)").cast("double").alias("amount_gbp"),
        F.when(amount > 95_000, 1).when(amount > 94_000, 2).alias("c_nationkey"))
    plain = customer.join(paying, "c_nationkey").select(
        F.concat(F.lit("CR"), "c_custkey").alias("creditor_id"), "payer", "amount_gbp")

    def told(rows):
        return rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("creditor_id", "payer", "amount_gbp").cast("decimal(38,0)"))).first()

    assert told(pairs) == told(plain)
    assert told(pairs)[0] == 3_000 * 3_050 + 20 * 100
    size = sum(file.stat().st_size for file in (tmp_path / "pairs").glob("*.parquet"))
    assert size < told(pairs)[0] / 2


# --- Against brute force ----------------------------------------------------


def history(seed, hot):
    """Reports of a few creditors; one of them may hold most of the rows."""
    pick, start = random.Random(seed), datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        key = "hot" if hot and pick.random() < 0.7 else pick.choice(["a", "b", "c", None])
        when = None if pick.random() < 0.02 else start + timedelta(minutes=pick.randrange(6000))
        rows.append((i, key, when, pick.choice([None, *range(5)])))
    return rows


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True), (3, True)])
def test_bucketed_lag_equals_one_window(spark, seed, hot):
    df = spark.createDataFrame(history(seed, hot), "n int, k string, ts timestamp, v int")
    window = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), F.col("n").asc_nulls_first())
    plain = df.withColumn("p", F.coalesce(F.lag("v").over(window), F.col("v")))
    # All columns decide ties, so equal times cannot lose or repeat a row.
    twins = spark.createDataFrame([(k, "hot", datetime(2024, 1, 1), k % 7) for k in range(500)], df.schema)
    stepped = with_previous(twins, "k", ["ts"], {"p": "v"}, F.date_trunc("hour", "ts"))
    assert sorted(r["n"] for r in stepped.repartition(9).collect()) == list(range(500))
    for unit in ("hour", "day", "year"):
        bucketed = with_previous(df, "k", ["ts", "n"], {"p": "v"}, F.date_trunc(unit, "ts"))
        assert sorted(bucketed.select("n", "p").collect(), key=str) == sorted(plain.select("n", "p").collect(), key=str)


@pytest.mark.parametrize("seed", [4, 5])
def test_latest_is_unique_and_ignores_row_order(spark, seed):
    rows = history(seed, True)
    expected = {}
    for row in rows:
        rank = (row[2] or datetime.min, row[0])
        if row[1] not in expected or rank > expected[row[1]][0]:
            expected[row[1]] = (rank, row)
    for arranged in (rows, rows[::-1]):
        df = spark.createDataFrame(arranged, "n int, k string, ts timestamp, v int")
        found = [tuple(r) for r in latest(df, ["k"], ["ts", "n"]).collect()]
        assert sorted(found, key=str) == sorted((row for _, row in expected.values()), key=str)


def test_payments_outside_every_window_change_nothing(spark):
    inside = [paid("C1", -3), paid("C2", -80)]
    outside = [paid("C1", -366), paid("C2", 0), {"creditor_id": "C1", "refund_created_at": days(-91), "is_refunded": True}]
    a = f.payment_rates(f.payment_window_metrics(make_sources(spark, payment=inside), AS_OF))
    b = f.payment_rates(f.payment_window_metrics(make_sources(spark, payment=outside + inside), AS_OF))
    assert sorted(a.collect()) == sorted(b.collect())
